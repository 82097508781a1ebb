"""Exact and approximate top-k similarity search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecloom.functions import kernels
from vecloom.functions.vector import DISTANCE_METRICS, METRICS, similarity
from vecloom.operators.filters import valid_embeddings
from vecloom.operators.project import quoted
from vecloom.session import work_path

# Query vectors and keys sent with every task take this much; a larger table goes in blocks, with one scan of the records for each.
QUERY_BYTES = 32 << 20


class DimensionMismatch(ValueError):
    """Query and record vectors do not have the same length."""


def _check(metric: str, k: int) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {list(METRICS)}")
    if k < 1:
        raise ValueError("k must be at least 1")


def guard_dimensions(expected: int, found: int) -> None:
    if found != expected:
        raise DimensionMismatch(f"query vector has {found} values, records have {expected}")


def best_first(metric: str, score: str = "score"):
    return F.asc(score) if metric in DISTANCE_METRICS else F.desc(score)


def top_k(scored: DataFrame, k: int, key: str, metric: str = "cosine") -> DataFrame:
    """The k best rows by `score`; the smaller key wins a tie."""
    return scored.orderBy(best_first(metric), quoted(key)).limit(k)


def vector_search(
    records: DataFrame,
    query: Sequence[float],
    dimensions: int,
    k: int = 5,
    *,
    key: str,
    columns: Sequence[str] = (),
    vector: str = "embedding",
    metric: str = "cosine",
) -> DataFrame:
    """The k records nearest to one query vector: key, columns, score.

    One query needs no matrix, so it is a column expression and Spark's own top-k; only
    the wanted columns are read. Records whose score is undefined are left out.
    """
    _check(metric, k)
    scored = vector_search_scored(records, query, dimensions, vector=vector, metric=metric)
    defined = scored.filter(F.col("score").isNotNull() & ~F.isnan("score"))
    return top_k(defined, k, key, metric).select(quoted(key), *[quoted(c) for c in columns], "score")


def vector_search_scored(
    records: DataFrame,
    query: Sequence[float],
    dimensions: int,
    *,
    vector: str = "embedding",
    metric: str = "cosine",
) -> DataFrame:
    """Every valid record with its score, as a plain column expression."""
    _check(metric, 1)
    guard_dimensions(dimensions, len(query))
    literal = F.array(*[F.lit(float(x)) for x in query])
    return valid_embeddings(records, dimensions, vector).withColumn("score", similarity(metric, quoted(vector), literal))


def query_blocks(queries: DataFrame, query_key: str, vector: str, dimensions: int, query_bytes: int) -> Iterator[pa.Table]:
    """The queries (key, _vector, and other columns) that have a vector, in blocks of about so many bytes.

    A vector of another length refuses the whole table; null vectors are no queries. More than one block is
    written once to the shared folder, with a number for each row, so that blocks are of
    like sizes even if all rows are copies.
    """
    size = F.size(quoted(vector))
    wrong = F.when(quoted(vector).isNotNull() & (size != dimensions), size)
    key = F.coalesce(F.octet_length(quoted(query_key).cast("string")), F.lit(0))
    bytes_ = F.coalesce(F.sum(F.when(quoted(vector).isNotNull(), key + 8 * dimensions)), F.lit(0))
    found = queries.agg(F.max(wrong).alias("wrong"), bytes_.alias("bytes")).first()
    if found["wrong"] is not None:
        guard_dimensions(dimensions, found["wrong"])
    usable = queries.filter(quoted(vector).isNotNull())
    blocks = max(1, -(-found["bytes"] // query_bytes))
    if blocks == 1:
        yield usable.toArrow()
        return
    path = work_path(queries.sparkSession, "queries")
    usable.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    staged = queries.sparkSession.read.parquet(path)
    for block in range(blocks):
        rows = staged.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == block).drop("_id").toArrow()
        if rows.num_rows:
            yield rows


def in_blocks(spark: SparkSession, blocks: Iterator[pa.Table], answer: Callable[[pa.Table], DataFrame]) -> DataFrame:
    """The answers to all blocks; those to more than one are written one after another."""
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return answer(first)
    path, schema = work_path(spark, "answers"), None
    for block in chain([first, second], blocks):
        found = answer(block)
        schema = found.schema
        found.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def matrix_of(vectors: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    vectors = vectors.combine_chunks()
    return kernels.to_matrix(vectors, dimensions) if len(vectors) else np.zeros((0, dimensions))


def _scan(
    records: DataFrame,
    queries: pa.Table,
    dimensions: int,
    k: int,
    key: str,
    query_key: T.StructField,
    columns: list[str],
    vector: str,
    metric: str,
    probes: np.ndarray | None = None,
    cells: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """One narrow pass: each task returns at most k candidates per query (query key, key, columns, score)."""
    kept = list(dict.fromkeys([key, *columns]))
    needed = [*kept, vector, *([cells, table] if cells else [])]
    source = valid_embeddings(records, dimensions, vector).select(*[quoted(c) for c in needed])
    schema = T.StructType(
        [
            T.StructField(query_key.name, query_key.dataType),
            *[T.StructField(c, records.schema[c].dataType) for c in kept],
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    matrix, names = matrix_of(queries["_vector"], dimensions), queries[query_key.name].combine_chunks()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = kernels.best_per_query(batches, matrix, k, key, vector, kept, metric, probes, cells, table)
        if best is not None:
            named = best.append_column(query_key.name, names.take(best["_query"].combine_chunks()))
            yield from named.select(arrow.names).cast(arrow).combine_chunks().to_batches()

    return source.mapInArrow(scan, schema)


def _rank(candidates: DataFrame, query_key: str, key: str, k: int, metric: str) -> DataFrame:
    """The k best of each query; Spark prunes to k per query before the shuffle."""
    window = Window.partitionBy(quoted(query_key)).orderBy(best_first(metric), quoted(key))
    return candidates.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def vector_search_many(
    records: DataFrame,
    queries: DataFrame,
    dimensions: int,
    k: int = 5,
    *,
    key: str,
    query_key: str,
    columns: Sequence[str] = (),
    vector: str = "embedding",
    query_vector: str = "embedding",
    metric: str = "cosine",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The k nearest records of every query: query_key, key, columns, score, rank.

    Queries go to the tasks that scan the records in blocks of `query_bytes`, with a scan
    for each block; the records are never shuffled. One query of a wrong length refuses the whole
    table. Ranks come from the exact scores.
    """
    _check(metric, k)
    if query_key == key or query_key in columns:
        raise ValueError("the query key needs a name of its own")
    wanted = queries.select(quoted(query_key), quoted(query_vector).alias("_vector"))
    names = [quoted(c) for c in (query_key, *dict.fromkeys([key, *columns]))]

    def answer(block: pa.Table) -> DataFrame:
        found = _scan(records, block, dimensions, k, key, queries.schema[query_key], list(columns), vector, metric)
        return _rank(found, query_key, key, k, metric).select(*names, "score", "rank")

    return in_blocks(records.sparkSession, query_blocks(wanted, query_key, "_vector", dimensions, query_bytes), answer)
