"""Vector columns: metrics, normalization, previews. All arithmetic is in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DISTANCE_METRICS = ("euclidean",)
METRICS = ("cosine", "dot_product", "euclidean")


def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _same_length(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _squares(vector: Column) -> Column:
    return F.aggregate(_doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(_squares(vector))


def dot_product(a: Column, b: Column) -> Column:
    """Dot product; NULL for unequal lengths, null vectors or null values."""
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return _same_length(a, b, _total(products))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine in [-1, 1]; NULL where undefined (a zero vector, unequal lengths, nulls)."""
    sums = F.struct(dot_product(a, b).alias("dot"), _squares(a).alias("a"), _squares(b).alias("b"))
    # The sums go in as a one-element array, so they are computed once.
    return F.get(F.transform(F.array(sums), _cosine), F.lit(0))


def _cosine(sums: Column) -> Column:
    """One root of both norms, unless their product leaves the range of doubles; rounding never leaves [-1, 1]."""
    both = sums["a"] * sums["b"]
    norms = F.when((both > 0) & (both < float("inf")), F.sqrt(both)).otherwise(F.sqrt(sums["a"]) * F.sqrt(sums["b"]))
    value = F.try_divide(sums["dot"], norms)
    return F.when(F.isnan(value), value).when(value > 1, 1.0).when(value < -1, -1.0).otherwise(value)


def euclidean_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return _same_length(a, b, F.sqrt(_total(squares)))


def similarity(metric: str, a: Column, b: Column) -> Column:
    functions = {
        "cosine": cosine_similarity,
        "dot_product": dot_product,
        "euclidean": euclidean_distance,
    }
    if metric not in functions:
        raise ValueError(f"unknown metric {metric!r}; choose one of {list(functions)}")
    return functions[metric](a, b)


def max_abs_difference(a: Column, b: Column) -> Column:
    gaps = F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x - y))
    return _same_length(a, b, F.array_max(gaps))


def l2_normalize(vector: Column) -> Column:
    """Unit-length vector as array<float>; a zero vector stays zero."""
    # The norm goes in as a one-element array, so it is computed once and not once per value.
    unit = F.transform(
        F.array(l2_norm(vector)),
        lambda norm: F.transform(_doubles(vector), lambda x: F.coalesce(F.try_divide(x, norm), x)),
    )
    return F.get(unit, F.lit(0)).cast("array<float>")


def as_float_vector(vector: Column) -> Column:
    """The one stored vector type: a plain array<float>."""
    return vector.cast("array<float>")


def embedding_preview(vector: Column, values: int = 3, decimals: int = 4) -> Column:
    """The first values as text, for a look at a record."""
    return F.transform(
        F.slice(vector, 1, values), lambda v: F.format_string(f"%.{decimals}f", v.cast("double"))
    )


def text_preview(text: Column, length: int = 40) -> Column:
    """Null as empty text, then the first characters."""
    return F.substring(F.coalesce(text, F.lit("")), 1, length)
