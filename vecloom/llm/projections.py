"""Approximate nearest neighbours: stable low-dimensional projections, kd-trees and a chi-square stop.

Gaussian projections turn a squared distance d^2 into d^2 times a chi-square variable with
as many degrees of freedom as projected dimensions. Each block of rows puts its projected
points into a kd-tree; a query takes the leaves in the order of their projected distance
r, verifies their points on the original vectors, and stops when a point nearer than its
k-th best would lie nearer than r with probability `sure`. Every row is in some block's
tree and every query meets every block, so the blocks' size bounds the memory and changes
no result but by that probability.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.llm.numbering import with_row
from vecloom.llm.text import col, helper, written

#: Rows in a block's tree and queries that search it together; memory bounds, not results.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 14, 1 << 12
LEAF, DIMS, CHUNK = 64, 8, 128
SEED = 20240


def chi_square(x: np.ndarray | float, freedom: int) -> np.ndarray | float:
    """Distribution function of the chi-square law for an even number of degrees of freedom."""
    half, term, total = np.asarray(x, float) / 2, 1.0, 0.0
    for i in range(freedom // 2):
        term = term * half / i if i else np.ones_like(half)
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_bound(sure: float, freedom: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < sure else (low, middle)
    return high


class Tree:
    """A kd-tree over projected points: leaves of at most LEAF points with their bounding boxes."""

    def __init__(self, points: np.ndarray):
        parts, leaves = [np.arange(len(points))], []
        while parts:
            part = parts.pop()
            if len(part) <= LEAF:
                leaves.append(part)
                continue
            axis = int(np.argmax(np.ptp(points[part], axis=0)))
            half = len(part) // 2
            order = np.argpartition(points[part, axis], half)
            parts += [part[order[:half]], part[order[half:]]]
        self.members = np.full((len(leaves), LEAF), -1)
        for i, part in enumerate(leaves):
            self.members[i, : len(part)] = part
        self.low = np.stack([points[p].min(0) for p in leaves])
        self.high = np.stack([points[p].max(0) for p in leaves])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Least squared distance of each query to each leaf's box."""
        gap = np.maximum(np.maximum(self.low[None] - queries[:, None], queries[:, None] - self.high[None]), 0)
        return np.einsum("qld,qld->ql", gap, gap)


def nearest(vectors: np.ndarray, queries: np.ndarray, k: int, sure: float) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and places of the k nearest found; places are -1 where there are fewer.

    Among equal distances the smaller place comes first.
    """
    matrix = np.random.default_rng(SEED + vectors.shape[1]).standard_normal((vectors.shape[1], DIMS))
    tree, least = Tree(vectors @ matrix), chi_square_bound(sure, DIMS)
    best_d, best_i = np.full((len(queries), k), np.inf), np.full((len(queries), k), -1)
    for begin in range(0, len(queries), CHUNK):
        chunk = queries[begin : begin + CHUNK]
        bounds = tree.bounds(chunk @ matrix)
        order = np.argsort(bounds, axis=1, kind="stable")
        distance, place = np.full((len(chunk), k), np.inf), np.full((len(chunk), k), -1)
        active = np.arange(len(chunk))
        for step in range(bounds.shape[1]):
            leaf = order[active, step]
            going = bounds[active, leaf] < distance[active, -1] * least
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            members = tree.members[leaf]
            gap = vectors[members] - chunk[active, None]
            found = np.where(members >= 0, np.einsum("qld,qld->ql", gap, gap), np.inf)
            all_d = np.concatenate([distance[active], found], axis=1)
            all_i = np.concatenate([place[active], members], axis=1)
            first = np.lexsort((all_i, all_d))[:, :k]
            distance[active] = np.take_along_axis(all_d, first, 1)
            place[active] = np.take_along_axis(all_i, first, 1)
        best_d[begin : begin + CHUNK], best_i[begin : begin + CHUNK] = distance, np.where(np.isinf(distance), -1, place)
    return best_d, best_i


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(values), -1) + 0.0


def _search_block(rows: pa.Table, queries: pa.Table, k: int, sure: float) -> pa.Table:
    schema = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())])
    if not rows.num_rows or not queries.num_rows:
        return schema.empty_table()
    rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
    vectors, asked = _matrix(rows["vector"]), _matrix(queries["vector"])
    ids, numbers = rows["id"].to_numpy(), rows["row"].to_numpy()
    # Equal vectors are one point; of its rows the k + 1 first can be among the k nearest of others.
    _, first, group = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    group = rank[group.reshape(-1)]
    sort = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[sort], np.arange(len(first) + 1))
    squares, places = nearest(vectors[np.sort(first)], asked, k + 1, sure)
    out: list[tuple] = []
    query_ids, query_rows = queries["id"].to_pylist(), queries["row"].to_pylist()
    for q, own in enumerate(query_rows):
        found = []
        for square, place in zip(squares[q].tolist(), places[q].tolist()):
            if place >= 0:
                members = sort[begin[place] : min(begin[place + 1], begin[place] + k + 1)]
                found += [(math.sqrt(square), int(ids[m]), int(numbers[m])) for m in members if numbers[m] != own]
        found.sort()
        out += [(query_ids[q], own, i, n, s) for s, i, n in found[:k]]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, schema.types)], schema=schema)


def search(
    spark: SparkSession, vectors: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding",
    k: int = 10, sure: float = 0.9,
) -> DataFrame:
    """The k nearest rows found for each row that `is_query` (an SQL condition) picks: query_id, rank, vec_id, score.

    The score is the Euclidean distance in double precision, ties go to the smaller id, and a
    row is no candidate of its own. Rows with a null key, and vectors that are null, empty,
    zero or hold null or non-finite values, take no part; vectors meet only others of their
    length. Rows of equal keys are queries and candidates each for itself.
    """
    values = col(vector).cast("array<double>")
    usable = (
        col(key).isNotNull() & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0)
    )
    asks, row = helper("asks"), helper("row")
    marked = with_row(vectors.withColumn(asks, F.expr(is_query)), row).where(F.coalesce(usable, F.lit(False)))
    points = marked.select(
        col(key).cast("long").alias("id"), F.col(row).alias("row"), values.alias("vector"),
        F.size(values).alias("length"), F.coalesce(asks, F.lit(False)).alias("asks"),
    )
    points = written(spark, points, "points")
    n, asking = points.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    row_blocks, query_blocks = -(-n // BLOCK_ROWS) or 1, -(-asking // BLOCK_QUERIES) or 1

    def block(blocks: int):
        return F.pmod(F.xxhash64("id", "row"), F.lit(blocks))

    def every(blocks: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    grid = ["length", "rows_in", "asked_in"]
    tree_side = points.withColumn("rows_in", block(row_blocks)).withColumn("asked_in", every(query_blocks))
    query_side = points.where("asks").withColumn("asked_in", block(query_blocks)).withColumn("rows_in", every(row_blocks))
    found = (
        tree_side.groupBy(*grid).cogroup(query_side.groupBy(*grid))
        .applyInArrow(lambda a, b: _search_block(a, b, k, sure), "query_id long, query_row long, vec_id long, row long, score double")
    )
    best = Window.partitionBy("query_row").orderBy("score", "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
