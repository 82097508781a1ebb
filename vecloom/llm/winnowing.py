"""Benchmark passages in documents, by winnowing.

Of every window of ten words the five-word gram of least hash (the last of equal ones) is
its fingerprint. Which gram that is depends on the window alone, so a window that a document
shares with an item has one fingerprint in both: a join of fingerprints misses no shared
span of ten words or more. A document's fingerprint that an item has too is extended to the
windows around it, which are held against the item's windows word by word. An item of
fewer words is one window and its own fingerprint.

Equal windows are one row with one list of items, however many items hold them, and
documents with the same lists share one digest: neither a passage that many documents hold nor one
that many items hold is multiplied out. The fingerprints of the items go to the tasks as a
bit filter of bounded size, so nearly all of the documents' fingerprints end where they are
made; what passes the filter still meets the exact join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.bits import bit_filter, passes
from vecloom.llm.numbering import numbered
from vecloom.llm.text import LOWER, WORD, col, flat, helper, mixed, or_empty, runs, span_hashes, spans_of, steps, text_array, written

#: Words of a window, and of a gram.
WINDOW, GRAM = 10, 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts, lower-cased, as spans of flat bytes with hashes."""

    def __init__(self, column: pa.Array):
        body, starts = flat(column)
        self.body = LOWER[body]
        self.begin, self.end, self.first = runs(WORD[self.body], starts)
        self.owner = np.repeat(np.arange(len(starts) - 1), np.diff(self.first))
        self.hash = span_hashes(self.body, self.begin, self.end)
        self.left = self.first[1:][self.owner] - np.arange(len(self.owner))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a gram of so many words lies within one text, and a hash of each place's gram."""
        n = len(self.hash)
        value = np.zeros(max(n - size + 1, 0), np.uint64)
        for k in range(size):
            value = mixed(value + self.hash[k : n - size + 1 + k] * _STEP + np.uint64(size))
        return np.flatnonzero(self.left[: len(value)] >= size), value

    def joined(self, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        """The words begin, ..., end - 1 of each span, with one space after each but the last."""
        sizes = end - begin
        at = spans_of(begin, sizes)
        lengths = self.end[at] - self.begin[at] + 1
        bytes_at = spans_of(self.begin[at], lengths)
        # The byte after a word is replaced by the space; a span's last one goes.
        stops = np.cumsum(lengths) - 1
        out = self.body[np.minimum(bytes_at, len(self.body) - 1)] if len(bytes_at) else self.body[:0].copy()
        out[stops] = 32
        kept = np.ones(len(out), bool)
        last = np.cumsum(sizes) - 1
        kept[stops[last]] = False
        total = np.r_[0, np.cumsum(lengths)][np.r_[0, last + 1]]
        return text_array(out[kept], total - np.arange(len(total)))


def least_grams(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows' first words, the place of each one's least gram (the last of equal ones), and all grams' hashes."""
    _, value = words.grams(gram)
    whole = np.flatnonzero(words.left >= window)
    least, place = value[whole], whole.copy()
    for k in range(1, window - gram + 1):
        other = value[whole + k]
        less = other <= least
        least, place = np.where(less, other, least), np.where(less, whole + k, place)
    return whole, place, value


def _item_rows(batch: pa.RecordBatch, words: Words, begin: np.ndarray, size: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    columns = [batch.column(0).take(pa.array(words.owner[begin])), pa.array(size.astype(np.int32)), pa.array(prints.view(np.int64))]
    return pa.RecordBatch.from_arrays([*columns, words.joined(begin, begin + size)], ["item", "size", "print", "window"])


class Items:
    """Windows and fingerprints of benchmark items."""

    def __init__(self, spark: SparkSession, items: DataFrame, item: str, text: str, window: int, gram: int):
        named = items.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("item"), or_empty(text).alias("body"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body", 1 << 18):
                words = Words(batch.column(1))
                whole, place, value = least_grams(words, window, gram)
                yield _item_rows(batch, words, whole, np.full(len(whole), window), value[place])
                counts = np.diff(words.first)
                for size in np.unique(counts[(counts > 0) & (counts < window)]):
                    _, value = words.grams(int(size))
                    begin = words.first[:-1][counts == size]
                    yield _item_rows(batch, words, begin, np.full(len(begin), size), value[begin])

        rows = named.mapInArrow(run, "item string, size int, print long, window string").distinct()
        self.windows = written(spark, rows, "item-windows")
        self.prints = written(spark, self.windows.select("print").distinct(), "item-prints")
        short = self.windows.where(F.col("size") < window).select("size").distinct()
        self.short = sorted(r[0] for r in short.collect())  # window - 1 numbers at most

    def lists(self) -> tuple[DataFrame, DataFrame]:
        """(size, window, list) and (list, item): equal windows' items as one list, equal lists as one."""
        held = self.windows.groupBy("size", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        held = held.withColumn("list", F.sha2(F.to_json("items"), 256))
        items = held.groupBy("list").agg(F.first("items").alias("items")).select("list", F.explode("items").alias("item"))
        return held.select("size", "window", "list"), items


def _marked(spark: SparkSession, documents: DataFrame, text: str, row: str, bits: np.ndarray, short: list[int], window: int, gram: int) -> DataFrame:
    """(row, n_words, marks): the documents' fingerprints that pass the filter, each with the words around it."""
    shared = spark.sparkContext.broadcast(bits)
    mark = T.StructType([
        T.StructField("size", T.IntegerType()), T.StructField("print", T.LongType()), T.StructField("at", T.LongType()), T.StructField("around", T.StringType()),
    ])
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("marks", T.ArrayType(mark)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "body"):
            words = Words(batch.column(1))
            _, place, value = least_grams(words, window, gram)
            place = np.unique(place)
            place = place[passes(value[place], shared.value)]
            # All windows that hold the gram lie between these words.
            begin = np.maximum(place - (window - gram), words.first[words.owner[place]])
            end = np.minimum(place + window, words.first[words.owner[place] + 1])
            found = [(np.full(len(place), window), value[place], begin, end)]
            for size in short:
                able, value = words.grams(size)
                able = able[passes(value[able], shared.value)]
                found.append((np.full(len(able), size), value[able], able, able + size))
            size, prints, begin, end = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(words.owner[begin], kind="stable")
            size, prints, begin, end = size[order], prints[order], begin[order], end[order]
            owner = words.owner[begin]
            columns = [pa.array(size.astype(np.int32)), pa.array(prints.view(np.int64)), pa.array(begin - words.first[owner]), words.joined(begin, end)]
            marks = pa.StructArray.from_arrays(columns, mark.names)
            starts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), marks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(words.first)), lists], schema.names)

    return written(spark, documents.select(F.col(row).alias("row"), or_empty(text).alias("body")).mapInArrow(run, schema), "marks")


def _covered(spans: Column) -> Column:
    """Words that lie in any of the spans (at, size), which come sorted."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"))

    def add(held: Column, span: Column) -> Column:
        end = span["at"] + span["size"]
        fresh = F.greatest(end - F.greatest(span["at"], held["end"]), F.lit(0).cast("long"))
        return F.struct((held["words"] + fresh).alias("words"), F.greatest(held["end"], end).alias("end"))

    return F.aggregate(spans, start, add)["words"]


def contaminated(
    spark: SparkSession, documents: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
    window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of letters and digits, A-Z in lower case. A word is hit if an occurrence of an item's
    window covers it; `items_sha256` is of the items' ids as text, sorted and joined by commas.
    A null or empty text has no words, and an item without words no window; rows of
    one item id are one item, and a null id is the empty text. Repeated documents and keys are rows each for
    itself; empty tables give no rows or no hits. Other columns are not read.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram has at least one word and no more than a window")
    row = helper("row")
    rows = numbered(spark, documents.select(col(key), col(text)), row)
    known = Items(spark, items, item, text, window, gram)
    marked = _marked(spark, rows, text, row, bit_filter(known.prints, "print"), known.short, window, gram)
    marks = marked.where(F.size("marks") > 0).select("row", F.explode("marks").alias("m")).select("row", "m.*")
    hits = marks.join(known.prints, "print", "left_semi")
    parts = F.split("around", " ")
    ahead = F.sequence(F.lit(0), F.size(parts) - F.col("size"))
    spans = hits.select("row", "size", "at", parts.alias("parts"), F.explode(ahead).alias("k")).select(
        "row", "size", (F.col("at") + F.col("k")).alias("at"), F.array_join(F.slice("parts", F.col("k") + 1, F.col("size")), " ").alias("window")
    )
    windows, lists = known.lists()
    found = spans.join(windows, ["size", "window"]).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans"), F.sort_array(F.collect_set("list")).alias("lists")
    )
    # Documents with the same lists have the same items.
    found = found.select("row", _covered(F.col("spans")).alias("n_hit"), F.sha2(F.to_json("lists"), 256).alias("set"), "lists")
    found = written(spark, found, "contaminated")
    sets = found.groupBy("set").agg(F.first("lists").alias("lists")).select("set", F.explode("lists").alias("list"))
    named = sets.join(lists, "list").groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    )
    judged = found.select("row", "n_hit", "set").join(named, "set").drop("set")
    keys = rows.select(F.col(row).alias("row"), col(key))
    return keys.join(marked.select("row", "n_words"), "row").join(judged, "row", "left").select(
        col(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
