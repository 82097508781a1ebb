"""Line dedup: equal lines and lines one edit apart, by a join of deletion neighbourhoods.

Two lines are at most one edit (a character put in, taken out or changed) apart if and only
if deleting one character of both, or of the longer one, makes them equal. Lines emit all
such variants as hashed keys; lines that meet under a key are linked, the earliest one of
a meeting is the partner of all, and the pair's edit distance is verified on the texts.
Variants that leave out the same place of lines of one length come from lines that are all
within one edit of each other, and a variant that is a line itself lies one edit from each
of its sources, so a meeting needs no pairs but those with its earliest line.

Full neighbourhoods are only emitted by lines that can have a partner: the same keys with
whole blocks left out, of half a line and then of a sixteenth, must meet first. An edit
lies in one block, so this loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.numbering import numbered
from vecloom.llm.text import col, flat, helper, mixed, or_empty, powers, spans_of, steps, written

#: Lines of fewer characters are never removed.
MIN_CHARS = 10
#: Bits of the filter of meeting half-line keys that goes to every task; its size bound. A
#: full filter lets more lines through and changes no result.
FILTER_BITS = 1 << 26
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Lines:
    """The lines of some texts as flat code points with prefix sums of polynomial hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        heads = (data & 0xC0) != 0x80
        before = np.r_[0, np.cumsum(heads)]
        self.points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        text_starts = before[starts]
        breaks = np.flatnonzero(self.points == 10)
        # A line ends at each break and at each end of text.
        self.begin = np.sort(np.concatenate([text_starts[:-1], breaks + 1]))
        self.end = np.sort(np.concatenate([breaks, text_starts[1:]]))
        order = np.searchsorted(breaks, text_starts[:-1])
        self.first = np.r_[order + np.arange(len(text_starts) - 1), len(self.begin)]
        self.owner = np.repeat(np.arange(len(text_starts) - 1), np.diff(self.first))
        self.number = np.arange(len(self.begin)) - self.first[self.owner]
        self.length = self.end - self.begin
        self.sums: list[np.ndarray] = []

    def hashes(self, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial hashes of spans, not yet mixed; the hash of a joined pair is a * base^len(b) free of place."""
        while len(self.sums) <= which:
            power, _ = powers(BASES[len(self.sums)], len(self.points))
            sums = np.zeros(len(self.points) + 1, np.uint64)
            np.cumsum((self.points.astype(np.uint64) + np.uint64(0x1F1)) * power[: len(self.points)], out=sums[1:])
            self.sums.append(sums)
        _, inverse = powers(BASES[which], len(self.points))
        return (self.sums[which][end] - self.sums[which][begin]) * inverse[begin]

    def without(self, which: int, begin: np.ndarray, end: np.ndarray, gap: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Hashes of [begin, gap) joined with [after, end)."""
        power, _ = powers(BASES[which], len(self.points))
        return self.hashes(which, begin, gap) + self.hashes(which, after, end) * power[gap - begin]

    def identity(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.length[at].astype(np.uint64)
        return tuple(mixed(self.hashes(k, self.begin[at], self.end[at]) + size * np.uint64(0xD6E8FEB86659FD93)).view(np.int64) for k in (0, 1))

    def block_keys(self, at: np.ndarray, blocks: int) -> np.ndarray:
        """Keys of each line with one block left out: as a line of its length, and as one with a character put in."""
        begin, end = self.begin[at], self.end[at]
        out = []
        for put_in in (0, 1):
            size = np.maximum(self.length[at] - put_in, 0)
            for j in range(blocks):
                gap, tail = size * j // blocks, size - size * (j + 1) // blocks
                value = self.without(0, begin, end, begin + gap, end - tail)
                out.append(mixed(value + (size.astype(np.uint64) * np.uint64(64) + np.uint64(j)) * np.uint64(0xD6E8FEB86659FD93)))
        return np.stack(out, axis=1).view(np.int64)


def _keys_hit(keys: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    bit = keys.view(np.uint64) % np.uint64(FILTER_BITS)
    return ((filter_[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).any(axis=1)


def within_one(a: str, b: str) -> bool:
    """Whether at most one edit turns one text into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


_ID = ["h1", "h2"]
_PLACE = ["key", "row", "line"]


def _meeting(keys: DataFrame) -> DataFrame:
    """Keys under which at least two different lines meet."""
    return keys.groupBy("k").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("k")


def _first() -> Column:
    return F.min(F.struct(F.col("key").isNull().alias("none"), *_PLACE)).alias("first")


class LineDedup:
    """The lines of a table of texts that an earlier line makes superfluous.

    Lines are the parts between line feeds. A line is removed if a line that is equal or one
    edit away stands earlier: in a text of a smaller key, of an equal key in an earlier
    row, or before it in the same text; null keys come last. All lines are judged on the
    input. A null or empty text is one empty line, which is never removed.
    """

    def __init__(self, spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, pinned: bool = False):
        self.spark, self.min_chars = spark, max(1, min_chars)
        self.row = helper("row")
        self.numbered = numbered(spark, documents, self.row, pinned)
        self.text = text
        self.texts = self.numbered.select(col(key).alias("key"), F.col(self.row).alias("row"), or_empty(text).alias("body"))
        self.key_type = self.texts.schema["key"].dataType

    def _lines(self) -> DataFrame:
        """Every line that may be removed: place, identity and the keys without either half."""
        least = self.min_chars
        schema = T.StructType([
            T.StructField("key", self.key_type), T.StructField("row", T.LongType()), T.StructField("line", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in ("h1", "h2", "k0", "k1", "k2", "k3")),
        ])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body"):
                lines = Lines(*flat(batch.column(2)))
                at = np.flatnonzero(lines.length >= least)
                owner = pa.array(lines.owner[at])
                columns = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(lines.number[at].astype(np.int32))]
                columns += [pa.array(x) for x in (*lines.identity(at), *lines.block_keys(at, 2).T)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return written(self.spark, self.texts.mapInArrow(run, schema), "lines")

    def _filter(self, lines: DataFrame) -> np.ndarray:
        """Bits of the half-line keys under which different lines meet."""
        keys = lines.select("h1", F.explode(F.array("k0", "k1", "k2", "k3")).alias("k"))
        # An unsigned remainder by a power of two is a mask.
        bit = F.col("k").bitwiseAND(F.lit(FILTER_BITS - 1))
        words = _meeting(keys).groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((k & {FILTER_BITS - 1}) & 63 as int))")).alias("bits"))
        found = words.toArrow()
        out = np.zeros(FILTER_BITS // 64, np.uint64)
        out[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return out

    def _candidates(self, bits: np.ndarray) -> DataFrame:
        """Distinct lines whose half-line keys are in the filter, with their text and first place."""
        shared, least = self.spark.sparkContext.broadcast(bits), self.min_chars
        schema = T.StructType([
            T.StructField("key", self.key_type), T.StructField("row", T.LongType()), T.StructField("line", T.IntegerType()),
            T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("body", T.StringType()),
        ])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body"):
                lines = Lines(*flat(batch.column(2)))
                at = np.flatnonzero(lines.length >= least)
                at = at[_keys_hit(lines.block_keys(at, 2), shared.value)]
                owner = pa.array(lines.owner[at])
                bodies = [lines.points[a:b].tobytes().decode("utf-32-le") for a, b in zip(lines.begin[at], lines.end[at])]
                columns = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(lines.number[at].astype(np.int32))]
                columns += [*(pa.array(x) for x in lines.identity(at)), pa.array(bodies, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        found = self.texts.mapInArrow(run, schema).groupBy(*_ID).agg(_first(), F.first("body").alias("body"))
        return written(self.spark, found, "candidates")

    def _narrowed(self, candidates: DataFrame, blocks: int = 16) -> DataFrame:
        """The candidates that meet another one with a small block left out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body"):
                lines, at = _single(batch.column(2))
                keys = lines.block_keys(at, blocks)
                ids = [np.repeat(batch.column(k).to_numpy(), keys.shape[1]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in ids), pa.array(keys.reshape(-1))], [*_ID, "k"])

        keys = candidates.select(*_ID, "body").mapInArrow(run, "h1 long, h2 long, k long")
        able = keys.join(_meeting(keys), "k", "left_semi").select(*_ID).distinct()
        return written(self.spark, candidates.join(able, _ID, "left_semi"), "narrowed")

    def _links(self, lines: DataFrame) -> DataFrame:
        """(h1, h2, g1, g2): lines and the earliest line that each meets under a variant."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body", 1 << 16):
                lines, at = _single(batch.column(2))
                # Every line itself (place -1), and without each of its characters.
                size = lines.length[at]
                line = np.concatenate([np.arange(len(at)), np.repeat(np.arange(len(at)), size)])
                place = np.concatenate([np.full(len(at), -1), spans_of(np.zeros(len(at), np.int64), size)])
                begin, end = lines.begin[at][line], lines.end[at][line]
                gap = np.where(place < 0, end, begin + place)
                after = np.where(place < 0, end, gap + 1)
                left = (end - begin - (place >= 0)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                values = [mixed(lines.without(k, begin, end, gap, after) + left).view(np.int64) for k in (0, 1)]
                owner = pa.array(line)
                columns = [*(pa.array(v) for v in values), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(k).take(owner) for k in (0, 1, 3))], schema.names)

        first = lines.schema["first"].dataType
        schema = T.StructType([
            T.StructField("v1", T.LongType()), T.StructField("v2", T.LongType()), T.StructField("place", T.IntegerType()),
            T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("first", first),
        ])
        variants = lines.select(*_ID, "body", "first").mapInArrow(run, schema)
        several = variants.groupBy("v1", "v2").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")
        met = written(self.spark, variants.join(several.select("v1", "v2"), ["v1", "v2"], "left_semi"), "meetings")
        earliest = F.min(F.struct("first", *_ID)).alias("e")
        changed = met.where("place >= 0")
        # One character changed: the same place left out.
        same = changed.join(changed.groupBy("v1", "v2", "place").agg(earliest), ["v1", "v2", "place"])
        # One character put in: one line is the variant of the other.
        source, itself = changed.groupBy("v1", "v2").agg(earliest), met.where("place < 0")
        shorter = itself.join(source, ["v1", "v2"])
        longer = changed.join(itself.select("v1", "v2", F.struct("first", *_ID).alias("e")), ["v1", "v2"])
        pairs = [x.where(F.col("e.first") < F.col("first")).select(*_ID, F.col("e.h1").alias("g1"), F.col("e.h2").alias("g2")) for x in (same, shorter, longer)]
        return pairs[0].unionByName(pairs[1]).unionByName(pairs[2]).distinct()

    def near(self, lines: DataFrame) -> DataFrame:
        """(h1, h2) of the lines that have an earlier line one edit away; verified on the texts."""
        kept = self._narrowed(self._candidates(self._filter(lines)))
        texts = kept.select(*_ID, "body")
        others = kept.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("body").alias("other"))
        pairs = self._links(kept).join(texts, _ID).join(others, ["g1", "g2"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = [within_one(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
                yield batch.select(_ID).filter(pa.array(ok, pa.bool_()))

        checked = pairs.select(*_ID, "body", "other").mapInArrow(run, "h1 long, h2 long").distinct()
        return written(self.spark, checked, "near-lines")

    def removed(self) -> DataFrame:
        """(row, line, near) of all removed lines; near where no equal line stands earlier."""
        lines = self._lines()
        places = lines.select(*_PLACE, *_ID)
        first = places.groupBy(*_ID).agg(_first()).select(*_ID, F.col("first.row").alias("r"), F.col("first.line").alias("l"))
        marked = first.join(self.near(lines).withColumn("near", F.lit(True)), _ID, "left")
        own = (F.col("row") == F.col("r")) & (F.col("line") == F.col("l"))
        return places.join(marked, _ID).where(~own | F.col("near").isNotNull()).select("row", "line", own.alias("near"))

    def kept(self, n_lines: str, n_near: str, n_equal: str, out: str) -> DataFrame:
        """All columns of the table, the numbers of lines, of near and equal lines removed, and the text that is left."""
        gone = self.removed().groupBy(F.col("row").alias(self.row)).agg(
            F.sort_array(F.collect_list("line")).alias("gone"), F.count_if("near").alias(n_near), F.count_if(~F.col("near")).alias(n_equal)
        )
        joined = self.numbered.join(gone.withColumnRenamed("gone", out + "_gone"), self.row, "left")
        parts = F.split(or_empty(self.text), "\n", -1)
        numbers = col(out + "_gone")
        # Places of the lines that stay; array_except is by hash set.
        rest = F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), numbers), lambda i: F.element_at(parts, i + 1)), "\n"
        )
        return joined.withColumns({
            out: F.when(numbers.isNull(), col(self.text)).otherwise(rest),
            n_lines: F.size(parts),
            n_near: F.coalesce(n_near, F.lit(0)), n_equal: F.coalesce(n_equal, F.lit(0)),
        }).drop(self.row, out + "_gone")


def _single(column: pa.Array) -> tuple[Lines, np.ndarray]:
    """Texts that are one line each."""
    lines = Lines(*flat(column))
    return lines, np.arange(len(lines.begin))


def digests(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_lines, n_equal and n_near lines removed, kept_sha256 of the text that is left."""
    found = LineDedup(spark, documents.select(col(key), col(text)), key, text).kept("n_lines", "n_near", "n_equal", "kept")
    return found.select(
        col(key), F.col("n_lines").cast("long"), F.col("n_equal").cast("long"), F.col("n_near").cast("long"),
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def drop_lines(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", pinned: bool = False) -> DataFrame:
    """The documents without their superfluous lines; a text that loses all that was not blank goes with its row.

    A text that loses nothing stays as it is, null and blank ones included. `pinned` as in `numbering.numbered`.
    """
    names = documents.columns
    a, b, c, d = (helper(x) for x in ("lines", "near", "equal", "kept"))
    found = LineDedup(spark, documents, key, text, pinned=pinned).kept(a, b, c, d)
    stays = (col(b) + col(c) == 0) | (F.length(F.trim(F.regexp_replace(col(d), r"\s+", " "))) > 0)
    return found.where(stays).withColumn(text, col(d)).select(*[col(n) for n in names])
