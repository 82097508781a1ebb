"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Documents become an index of one row each, in place: their length and the counts of those
terms that some query has. It is cut into blocks of a bounded number of documents, and each
block answers every query for itself: a query's terms come rarest first, each adds its
impact to the accumulators of the documents it occurs in, and new accumulators are made
until what the remaining terms can add at most is below the k-th best partial score. From
then on only accumulators that can still be among the k best are updated, exactly. The k
best of a block contain all of its documents that are among the k best of the table, so
only k candidates a query leave a block, and no posting is ever shuffled.

Queries go to the tasks in blocks of a bounded size, each with one scan of the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.bits import bit_filter, passes
from vecloom.llm.numbering import numbered
from vecloom.llm.text import LOWER, WORD, col, flat, list_array, or_empty, runs, span_hashes, spans_of, steps, text_array, written

#: Documents and postings of a block, and bytes of query terms that one scan of the index answers.
BLOCK_ROWS, BLOCK_POSTINGS, QUERY_BYTES = 1 << 16, 1 << 22, 1 << 23


def counted_terms(column: pa.Array, words: np.ndarray | None = None):
    """Texts' lengths in terms, and their distinct terms with counts: owners, hashes, counts, the terms, starts.

    With a filter, only terms that pass it are listed; the lengths count all.
    """
    body, starts = flat(column)
    body = LOWER[body]
    begins, ends, first = runs(WORD[body], starts)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    hashes = span_hashes(body, begins, ends)
    if words is not None:
        kept = passes(hashes, words)
        owner, hashes, begins, ends = owner[kept], hashes[kept], begins[kept], ends[kept]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])][: len(order)]
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.r_[heads, len(order)])
    at = order[heads]
    sizes = ends[at] - begins[at]
    terms = text_array(body[spans_of(begins[at], sizes)], np.r_[0, np.cumsum(sizes)])
    return np.diff(first), owner[heads], hashes[heads], counts, terms, np.searchsorted(owner[heads], np.arange(len(starts)))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query, term, hash, times) for each distinct term of each query (query long, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            _, owner, hashes, counts, terms, _ = counted_terms(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), terms, pa.array(hashes.view(np.int64)), pa.array(counts)], ["query", "term", "hash", "times"]
            )

    return queries.select("query", "text").mapInArrow(run, "query long, term string, hash long, times long")


def build_index(spark: SparkSession, documents: DataFrame, key: str, text: str, words: np.ndarray) -> DataFrame:
    """(key, length, terms, counts) of every document, in terms that pass the filter; written."""
    shared = spark.sparkContext.broadcast(words)
    named = documents.select(col(key).alias("key"), or_empty(text).alias("body"))
    schema = T.StructType([
        T.StructField("key", named.schema["key"].dataType), T.StructField("length", T.LongType()),
        T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "body"):
            lengths, _, _, counts, terms, starts = counted_terms(batch.column(1), shared.value)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), terms)
            columns = [batch.column(0), pa.array(lengths.astype(np.int64)), lists, list_array(counts.astype(np.int32), starts)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return written(spark, named.mapInArrow(run, schema), "index")


class Queries:
    """Some queries as the tasks hold them: for each, its terms' places in a vocabulary, rarest first, with weights."""

    def __init__(self, rows: pa.Table):
        """Rows (query, term, frequency, weight), weight with the term's repeats in the query."""
        rows = rows.sort_by([("query", "ascending"), ("frequency", "ascending"), ("term", "ascending")])
        self.vocabulary = pc.unique(rows["term"].combine_chunks())
        self.term = pc.index_in(rows["term"], self.vocabulary).to_numpy().astype(np.int64)
        self.weight = rows["weight"].to_numpy()
        query = rows["query"].to_numpy()
        self.start = np.r_[np.flatnonzero(np.r_[True, query[1:] != query[:-1]][: len(query)]), len(query)]
        self.query = query[self.start[:-1]]


class Block:
    """Postings of some documents by term, with the greatest impact of each term."""

    def __init__(self, term: np.ndarray, document: np.ndarray, impact: np.ndarray, terms: int, documents: int, order: np.ndarray):
        """Order: documents' places in the order that settles equal scores."""
        by_term = np.argsort(term, kind="stable")
        self.document, self.impact = document[by_term], impact[by_term]
        self.start = np.searchsorted(term[by_term], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        held = np.flatnonzero(np.diff(self.start))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.start[held])
        self.scores, self.order = np.zeros(documents, np.int64), order

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the k greatest scores above 0, and the scores; the terms come rarest first."""
        held = self.most[terms] * weights > 0
        terms, weights = terms[held], weights[held]
        bounds = self.most[terms] * weights
        left = np.r_[np.cumsum(bounds[::-1])[::-1], 0]
        scores = self.scores
        scores[:] = 0
        done, threshold = len(terms), 0
        for j, t in enumerate(terms):
            span = slice(self.start[t], self.start[t + 1])
            scores[self.document[span]] += weights[j] * self.impact[span]
            # The k-th best partial score is no more than what the terms so far can give.
            if left[j + 1] < left[0] - left[j + 1] and k <= len(scores):
                threshold = np.partition(scores, len(scores) - k)[len(scores) - k]
                if left[j + 1] < threshold:
                    done = j + 1
                    break
        alive = np.flatnonzero(scores > 0)
        if done < len(terms):
            alive = alive[scores[alive] + left[done] >= threshold]
        found = scores[alive]
        for j in range(done, len(terms)):
            span = slice(self.start[terms[j]], self.start[terms[j] + 1])
            document = self.document[span]
            at = np.minimum(np.searchsorted(document, alive), len(document) - 1)
            found = found + np.where(document[at] == alive, weights[j] * self.impact[span][at], 0)
        if len(found) > k:
            least = np.partition(found, len(found) - k)[len(found) - k]
            alive, found = alive[found >= least], found[found >= least]
        first = np.lexsort((self.order[alive], -found))[:k]
        return alive[first], found[first]


def _block_of(batches: list[pa.RecordBatch], queries: Queries, documents: int, total: int) -> tuple[Block, pa.Array]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    keys = rows["key"].combine_chunks() if rows["key"].num_chunks != 1 else rows["key"].chunk(0)
    terms, counts = (rows[n].combine_chunks() if rows[n].num_chunks != 1 else rows[n].chunk(0) for n in ("terms", "counts"))
    owner = pc.list_parent_indices(terms).to_numpy()
    place = pc.index_in(pc.list_flatten(terms), queries.vocabulary)
    kept = pc.is_valid(place).to_numpy(zero_copy_only=False)
    owner, times = owner[kept], pc.list_flatten(counts).to_numpy()[kept].astype(np.int64)
    term = place.drop_null().to_numpy().astype(np.int64)
    length = rows["length"].to_numpy()
    slowed = 75 + (25 * length * documents) // total
    impact = (1_000_000_000 * times) // (1000 * times + 12 * slowed[owner])
    order = np.empty(len(keys), np.int64)
    order[pc.sort_indices(keys, null_placement="at_start").to_numpy()] = np.arange(len(keys))
    return Block(term, owner, impact, len(queries.vocabulary), len(keys), order), keys


def search(
    spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item: str = "item_id", text: str = "text",
    block_rows: int = BLOCK_ROWS, query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(item, rank, key, score): the k best documents of each item, best first, equal scores by key (null first).

    Both tables have a column named `text`; a null or empty one has no terms. Such an item, one
    whose terms no document has, and any item over an empty table have no rows. Items of equal texts are searched once
    and answered each; a repeated document is a document each time. Other columns are not read.
    """
    asked = numbered(spark, items.where(col(text).isNotNull()).select(col(text).alias("text")).distinct(), "query")
    terms = written(spark, query_terms(asked), "query-terms")
    index = build_index(spark, documents, key, text, bit_filter(terms.select("hash").distinct(), "hash"))
    count, total = index.agg(F.count_if(F.col("length") > 0), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))
    rarity = F.floor(1000 * F.log(F.lit(float(2 * count + 2)) / (2 * F.col("frequency") + 1).cast("double")))
    weighted = terms.join(frequency, "term").select("query", "term", "frequency", (rarity * F.col("times")).alias("weight"))
    weighted = written(spark, weighted, "weighted")
    size = weighted.agg(F.coalesce(F.sum(F.octet_length("term") + 24), F.lit(0))).first()[0]
    parts = -(-size // query_bytes)
    shape = T.StructType([
        T.StructField("query", T.LongType()), T.StructField("key", index.schema["key"].dataType), T.StructField("score", T.LongType()),
    ])
    found = spark.createDataFrame([], shape)
    for part in range(parts):
        rows = weighted.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).toArrow()
        if rows.num_rows:
            best = _candidates(spark, index, Queries(rows), k, count, total, block_rows, shape)
            found = written(spark, best, "candidates") if part == 0 else found.unionByName(written(spark, best, "candidates"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = items.select(col(item).alias("_item"), col(text).alias("text")).join(asked, "text").select("_item", "query")
    return named.join(ranked, "query").select(F.col("_item").alias(item), F.col("rank").cast("int"), F.col("key").alias(key), "score")


def _candidates(spark: SparkSession, index: DataFrame, queries: Queries, k: int, documents: int, total: int, block_rows: int, shape: T.StructType) -> DataFrame:
    """(query, key, score): the k best of every block of documents for every query."""
    shared = spark.sparkContext.broadcast(queries)

    def answer(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        block, keys = _block_of(batches, asked, documents, total)
        out: list[list[np.ndarray]] = [[], [], []]
        for q, a, b in zip(asked.query, asked.start[:-1], asked.start[1:]):
            rows, scores = block.best(asked.term[a:b], asked.weight[a:b], k)
            for into, values in zip(out, (np.full(len(rows), q), rows, scores)):
                into.append(values)
        query, rows, scores = (np.concatenate(x) for x in out)
        yield pa.RecordBatch.from_arrays([pa.array(query), keys.take(pa.array(rows)), pa.array(scores)], shape.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, postings = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, postings = rows + batch.num_rows, postings + len(pc.list_flatten(batch.column(2)))
            if rows >= block_rows or postings >= BLOCK_POSTINGS:
                yield from answer(held)
                held, rows, postings = [], 0, 0
        if held:
            yield from answer(held)

    return index.mapInArrow(run, shape)
