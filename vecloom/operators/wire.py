"""Model request and response JSON as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.operators.project import quoted

# The two request shapes and the two response shapes.
RECORDS, INPUT = "dataframe_records", "input"
NESTED_PREDICTIONS = "struct<predictions:array<array<array<double>>>>"
FLAT = "struct<predictions:array<array<double>>,data:array<struct<embedding:array<double>>>>"


def build_requests(chunked: DataFrame, text: str = "text", shape: str = RECORDS) -> DataFrame:
    """One request row per chunk; a chunk never holds more rows than the chunk size.

    A null text fails the job: left out it would move the places of the texts behind it.
    """
    if shape not in (RECORDS, INPUT):
        raise ValueError(f"unknown request shape {shape!r}; choose {RECORDS!r} or {INPUT!r}")
    given = F.coalesce(quoted(text), F.raise_error(F.lit("a request cannot hold a null text")).cast("string"))
    rows = F.sort_array(F.collect_list(F.struct("row_num", given.alias("text"))))
    if shape == RECORDS:
        body = F.transform("rows", lambda r: F.struct(r["text"].alias("text"))).alias(RECORDS)
    else:
        body = F.transform("rows", lambda r: r["text"]).alias(INPUT)
    return (
        chunked.groupBy("chunk_id")
        .agg(rows.alias("rows"))
        .select("chunk_id", F.size("rows").alias("texts"), F.to_json(F.struct(body)).alias("request"))
    )


def response_vectors(body: Column) -> Column:
    """All vectors of a response, one per text; NULL if the body holds none.

    Reads `predictions` (also with one more level of nesting) and `data[].embedding`.
    """
    deep = F.from_json(body, NESTED_PREDICTIONS)["predictions"]
    parsed = F.from_json(body, FLAT)
    flat, data = parsed["predictions"], parsed["data"]
    unwrapped = F.transform(deep, lambda v: F.get(v, F.lit(0)))
    usable = F.filter(unwrapped, lambda v: v.isNotNull())
    found = F.coalesce(
        F.when(F.size(usable) > 0, unwrapped),
        F.when(F.exists(flat, lambda v: v.isNotNull()), flat),
        F.when(F.size(data) > 0, F.transform(data, lambda d: d["embedding"])),
    )
    return found.cast("array<array<float>>")


def first_vector(body: Column) -> Column:
    """The vector of a one-text response; NULL for an error, bad JSON or an empty list."""
    return F.get(response_vectors(body), F.lit(0))


def parse_responses(
    responses: DataFrame, chunked: DataFrame, chunk_size: int, body: str = "response"
) -> DataFrame:
    """Put the vectors of per-chunk responses back on the rows of the chunks.

    The join key is the chunk and the place in it, so it spreads evenly. A row whose
    vector is missing from the response gets NULL.
    """
    vectors = responses.select(
        "chunk_id", F.posexplode(response_vectors(F.col(body))).alias("_place", "embedding")
    )
    place = (F.col("row_num") - 1 - F.col("chunk_id") * chunk_size).cast("int")
    return (
        chunked.withColumn("_place", place).join(vectors, ["chunk_id", "_place"], "left").drop("_place")
    )
