"""Repeated passages: every byte covered by a string of a least length that also starts elsewhere.

All texts are too long for one suffix array, so equal strings are first brought together.
Of each window of the least length the gram of least hash is its anchor. Runs of windows
with one anchor gram make a region, and equal windows lie in regions of the same gram.
Equal regions are counted before anything moves: a region that occurs twice is repeated as
a whole. Grams with unlike regions send one copy of each to a task, which joins them to a
text, takes its Burrows-Wheeler transform and expands intervals backwards, breadth first:
level by level this finds the boundaries of common prefixes of 0, 1, 2, ... bytes, and it
stops at the least length. Suffixes with no boundary between them share at least that.

A gram with more unlike regions than a task should hold is settled by the hashes of its
windows instead, which meet by their values and not by the gram; the result is the same. Hashes
change tasks in packed pieces, and what comes back are spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.bits import MOST_BITS
from vecloom.llm.dealing import CHUNK_BITS, PIECES, blobs, chunks, dealt, home_of, met_rows, run_starts, unpacked
from vecloom.llm.numbering import numbered
from vecloom.llm.text import col, flat, helper, mixed, or_empty, powers, spans_of, steps, written

LEAST = 400
#: Bytes of unlike regions of one gram that a task joins; beyond it windows are compared. Tasks
#: gather grams up to as many bytes for one transform.
GROUP_BYTES, GATHER_BYTES = 1 << 19, 1 << 19
#: Windows that one task makes a piece of or brings together, and the least number of such tasks.
WINDOWS, WINDOW_TASKS = 1 << 19, 64
STEP = 1 << 19
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)


def gram_size(least: int) -> int:
    return max(1, least * 4 // 25)


class Hashes:
    """Polynomial hashes of any spans of some bytes, by one of the bases."""

    def __init__(self, data: np.ndarray, which: int):
        power, self.inverse = powers(BASES[which], len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(0x1F1)) * power[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        return mixed(value + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each `width` consecutive ones, from prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def regions(data: np.ndarray, starts: np.ndarray, least: int = LEAST) -> dict[str, np.ndarray]:
    """Regions of all texts: text, place in the flat bytes, length, gram and content hash, and whether the gram recurs inside."""
    size = gram_size(least)
    n = len(data) - least + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return {"text": none, "begin": none, "length": none, "gram": none, "content": none, "again": none.astype(bool)}
    at = np.arange(len(data) - size + 1)
    gram = Hashes(data, 0).of(at, at + size)
    # The leftmost least hash of a window, by its upper half; the place is the lower half.
    anchor = (_sliding_least((gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), least - size + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
    valid = np.arange(n) + least <= starts[1:][owner]
    window = np.flatnonzero(valid)
    own, anchor = gram[anchor[window]], anchor[window]
    new = np.r_[True, (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)] if len(window) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(window)] - 1
    last = last[: len(first)]
    begin, length = window[first], window[last] - window[first] + least
    content = Hashes(data, 1).of(begin, begin + length)
    return {
        "text": owner[begin], "begin": begin, "length": length, "gram": own[first].view(np.int64),
        "content": content.view(np.int64), "again": anchor[first] != anchor[last],
    }


def _suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` symbols at least; symbols below 512."""
    n = len(symbols)
    key, packed = np.zeros(n, np.int64), 7
    for k in range(packed):
        key <<= 9
        key[: max(n - k, 0)] |= symbols[k:]
    order = np.argsort(key)
    done = packed
    while True:
        ordered = key[order]
        rank_in_order = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        if done >= depth or rank_in_order[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = rank_in_order + 1
        key = rank * (n + 1)
        key[: max(n - done, 0)] += rank[done:]
        order = np.argsort(key)
        done *= 2


def repeated_starts(pieces: list[bytes], least: int = LEAST) -> np.ndarray:
    """For the joined pieces (each with a byte more at its end), whether a string of `least` bytes that starts there also starts elsewhere."""
    # 0 ends the text, 1 a piece; strings that run across an end are told apart below.
    joined_pieces = b"".join(pieces)
    sizes = np.array([len(p) for p in pieces]) + 1
    symbols = np.ones(int(sizes.sum()) + 1, np.int64)
    symbols[-1] = 0
    symbols[spans_of(np.cumsum(sizes) - sizes, sizes - 1)] = np.frombuffer(joined_pieces, np.uint8).astype(np.int64) + 2
    n = len(symbols)
    order = _suffix_order(symbols, least + 1)
    before = symbols[order - 1]  # the transform: the symbol before each suffix, and 0 before the first
    # Places of each symbol in the transform, in one sorted row: a search in it counts occurrences.
    places = before * n + np.arange(n)
    places.sort()
    bounded = np.zeros(n + 1, bool)
    bounded[[0, n]] = True
    # Ends of strings that occur once, by where they begin: all that contains one occurs once.
    once = np.full(n, n + least + 1)
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for length in range(1, least + 1):
        if not len(low):
            break
        size = high - low
        inside = before[spans_of(low, size)]
        # By symbol first: the searches that follow then go through `places` in order.
        pair = np.sort((inside << 40) | np.repeat(np.arange(len(low)), size))
        pair = pair[np.r_[True, pair[1:] != pair[:-1]]]
        interval, symbol = pair & ((1 << 40) - 1), (pair >> 40) * n
        new_low = np.searchsorted(places, symbol + low[interval])
        new_high = np.searchsorted(places, symbol + high[interval])
        single = new_high == new_low + 1
        at = order[new_low[single]]
        once[at] = np.minimum(once[at], at + length)
        fresh = ~bounded[new_high] & ~single
        bounded[new_high] = True
        low, high = new_low[fresh], new_high[fresh]
    once = np.minimum.accumulate(once[::-1])[::-1] <= np.arange(n) + least
    alone = np.flatnonzero(once[order])
    bounded[alone] = bounded[alone + 1] = True
    joined = ~bounded
    again = np.zeros(n, bool)
    again[order] = joined[:-1] | joined[1:]
    left = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(n - 1)
    return again[:-1] & (left >= least)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of set flags."""
    edge = np.diff(np.r_[False, flags, False].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


class Repeats:
    """Repeated passages of a table of texts: spans of UTF-8 bytes, by row number.

    A byte is in a span if a string of `least` bytes that covers it also starts at another
    place of any text; overlaps count, and matches never cross texts. Null and empty texts
    have no bytes. Rows are told apart by their number, so repeated rows and keys repeat
    each other's bytes.
    """

    def __init__(
        self, spark: SparkSession, documents: DataFrame, text: str = "text", least: int = LEAST, group_bytes: int = GROUP_BYTES,
        pinned: bool = False,
    ):
        self.spark, self.least, self.group_bytes = spark, least, group_bytes
        self.row = helper("row")
        self.numbered = numbered(spark, documents, self.row, pinned)
        self.texts = self.numbered.select(F.col(self.row).alias("row"), or_empty(text).alias("body"))

    def _regions(self) -> DataFrame:
        least = self.least

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "body", STEP):
                data, starts = flat(batch.column(1))
                found = regions(data, starts, least)
                row = batch.column(0).take(pa.array(found["text"]))
                a = found["begin"] - starts[found["text"]]
                yield pa.RecordBatch.from_arrays(
                    [row, *(pa.array(x) for x in (a, found["length"], found["gram"], found["content"], found["again"]))],
                    ["row", "a", "length", "gram", "content", "again"],
                )

        schema = "row long, a long, length long, gram long, content long, again boolean"
        return written(self.spark, self.texts.mapInArrow(run, schema), "regions", "zstd")

    def _met(self, found: DataFrame) -> DataFrame:
        """The regions whose gram occurs in another one too, or twice in one; nearly all others end here.

        A filter of those grams, of MOST_BITS at most, goes to every task; what it lets through meets them exactly.
        """
        grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again")).where("n > 1 or again").select("gram")
        grams = written(self.spark, grams, "grams", "zstd")
        place = F.col("gram").bitwiseAND(F.lit(MOST_BITS - 1))
        words = grams.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits")
        )
        maybe = F.expr("(shiftrightunsigned(bits, cast(gram & 63 as int)) & 1) = 1")
        near = found.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(words), "word").where(maybe).select(*found.columns)
        return written(self.spark, near.join(grams, "gram", "left_semi"), "met", "zstd")

    def _pieces(self, contents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """One copy of each unlike region of the grams that have several, with its bytes; hot if the gram has too many."""
        grams = contents.groupBy("gram").agg(F.count(F.lit(1)).alias("d"), F.max("again").alias("again"), F.sum("length").alias("bytes"))
        grams = written(self.spark, grams.where("d > 1 or again").select("gram", (F.col("bytes") > self.group_bytes).alias("hot")), "grams", "zstd")
        wanted = contents.join(grams, "gram").select(
            F.struct(F.col("first.row").alias("row"), "gram", F.col("first.a").alias("a"), "length", (F.col("n") == 1).alias("single"), "hot").alias("x")
        )
        joined = chunks(self.texts, "row", "body").join(by_chunk(wanted, "xs"), "chunk").select("rows", "xs")
        schema = "gram long, row long, a long, single boolean, piece binary, hot boolean"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, owner, parts in met_rows(batches, "row"):
                data, starts = flat(rows.column("body"))
                begin = starts[owner] + parts.field("a").to_numpy()
                size = parts.field("length").to_numpy()
                body = data.tobytes()
                pieces = [body[b : b + n] for b, n in zip(begin.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [parts.field("gram"), parts.field("row"), parts.field("a"), parts.field("single"), pa.array(pieces, pa.binary()), parts.field("hot")],
                    ["gram", "row", "a", "single", "piece", "hot"],
                )

        pieces = joined.mapInArrow(run, schema)
        # Pieces that are read twice, for grams that are hot and for all others, are written.
        return pieces, None if grams.where("hot").isEmpty() else written(self.spark, pieces, "pieces", "zstd")

    def _expanded(self, pieces: DataFrame) -> DataFrame:
        """(row, a, e): spans of the pieces, whose grams are gathered for one transform."""
        least = self.least

        def spans(group: list[tuple]) -> pa.RecordBatch:
            again = repeated_starts([x[4] for x in group], least)
            rows, begins, ends, offset = [], [], [], 0
            for _, row, a, single, piece in group:
                if single:
                    first, last = _runs(again[offset : offset + len(piece)])
                    rows += [row] * len(first)
                    begins += (a + first).tolist()
                    ends += (a + last + least).tolist()
                offset += len(piece) + 1
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows, begins, ends)], ["row", "a", "e"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ready: list[tuple] = []
            group: list[tuple] = []
            ready_bytes = group_bytes = 0
            for batch in batches:
                for x in zip(*(c.to_pylist() for c in batch.columns)):
                    if group and group[0][0] != x[0]:
                        if ready and ready_bytes + group_bytes > GATHER_BYTES:
                            yield spans(ready)
                            ready, ready_bytes = [], 0
                        ready, ready_bytes = ready + group, ready_bytes + group_bytes
                        group, group_bytes = [], 0
                    group.append(x)
                    group_bytes += len(x[4])
            for rest in (ready, group) if ready_bytes + group_bytes > GATHER_BYTES else (ready + group,):
                if rest:
                    yield spans(rest)

        return pieces.drop("hot").repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "row long, a long, e long")

    def _compared(self, pieces: DataFrame) -> DataFrame:
        """(row, a, e): spans of the pieces of hot grams, by the two hashes of every window."""
        least = self.least
        windows = pieces.agg(F.coalesce(F.sum(F.octet_length("piece") - least + 1), F.lit(0))).first()[0]
        tasks = max(WINDOW_TASKS, windows // WINDOWS)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, ...]] = []
            count = 0
            for batch in batches:
                for row, a, single, piece in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
                    data = np.frombuffer(piece, np.uint8)
                    at = np.arange(len(data) - least + 1)
                    values = [Hashes(data, k).of(at, at + least).view(np.int64) for k in (0, 2)]
                    # Copies of a piece that is not single are spans already; one window of it stands for them.
                    held.append((*values, np.full(len(at), row), a + at if single else np.full(len(at), -1)))
                    count += len(at)
                    if count >= WINDOWS:
                        columns = tuple(np.concatenate(x) for x in zip(*held))
                        yield dealt(home_of(columns[0], tasks), tasks, columns)
                        held, count = [], 0
            if held:
                columns = tuple(np.concatenate(x) for x in zip(*held))
                yield dealt(home_of(columns[0], tasks), tasks, columns)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not (held := blobs(batches)):
                return
            w1, w2, row, a = unpacked(held, 4)
            order = np.lexsort((w2, w1))
            w1, w2, row, a = w1[order], w2[order], row[order], a[order]
            size = np.diff(np.r_[run_starts(w1, w2), len(w1)])
            often = np.flatnonzero(np.repeat(size > 1, size) & (a >= 0))
            # A long text is dealt out by stretches.
            home = home_of(row[often] * np.int64(1 << 20) + (a[often] >> np.int64(16)), tasks)
            yield dealt(home, tasks, (row[often], a[often]))

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not (held := blobs(batches)):
                return
            row, a = unpacked(held, 2)
            order = np.lexsort((a, row))
            row, a = row[order], a[order]
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (a[1:] > a[:-1] + least)])
            last = np.r_[first[1:], len(a)] - 1
            yield pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(a[first]), pa.array(a[last] + least)], ["row", "a", "e"])

        variants = pieces.repartition(tasks).mapInArrow(spread, PIECES)
        met = variants.repartition(tasks, "home").mapInArrow(meet, PIECES)
        return met.repartition(tasks, "home").mapInArrow(settle, "row long, a long, e long")

    def spans(self) -> DataFrame:
        """(row, a, e): spans of bytes, which may overlap and touch."""
        found = self._met(self._regions())
        contents = found.groupBy("gram", "content", "length").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "a")).alias("first"), F.max("again").alias("again")
        )
        contents = written(self.spark, contents, "contents", "zstd")
        whole = found.join(contents.where("n > 1").select("gram", "content", "length"), ["gram", "content", "length"], "left_semi").select("row", "a", (F.col("a") + F.col("length")).alias("e"))
        pieces, stored = self._pieces(contents)
        if stored is None:
            return whole.unionByName(written(self.spark, self._expanded(pieces), "expanded"))
        expanded = written(self.spark, self._expanded(stored.where(~F.col("hot"))), "expanded")
        return whole.unionByName(expanded).unionByName(self._compared(stored.where("hot")))

    def joined(self, text: str) -> DataFrame:
        """Chunks of all rows of the table, with the row number, and of their texts' spans; null where there is none."""
        lists = by_chunk(self.spans().select(F.struct("row", "a", "e").alias("x")), "spans")
        return chunks(self.numbered, self.row, text).join(lists, "chunk", "left").select("rows", "spans")


def by_chunk(items: DataFrame, out: str) -> DataFrame:
    """(chunk, out): the structs x of the rows of each chunk."""
    return items.groupBy(F.shiftright("x.row", CHUNK_BITS).alias("chunk")).agg(F.collect_list("x").alias(out))


def merged_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order, with those that overlap or touch made one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.r_[True, begins[1:] > ends[:-1]] if len(begins) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return begins[first], ends[np.r_[first[1:] - 1, len(ends) - 1]] if len(first) else ends


def _texts_and_spans(texts: pa.Array, owner: np.ndarray, spans: pa.StructArray) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Each row's bytes and merged spans."""
    data, starts = flat(texts)
    body = data.tobytes()
    order = np.argsort(owner, kind="stable")
    a, e = spans.field("a").to_numpy()[order], spans.field("e").to_numpy()[order]
    cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1)).tolist()
    for k in range(len(texts)):
        yield body[starts[k] : starts[k + 1]], *merged_spans(a[cuts[k] : cuts[k + 1]], e[cuts[k] : cuts[k + 1]])


def _cut(text: bytes, begins: np.ndarray, ends: np.ndarray) -> bytes:
    edges = [0, *np.stack([begins, ends], axis=1).reshape(-1).tolist(), len(text)]
    return b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))


def digests(
    spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that are left."""
    repeats = Repeats(spark, documents.select(col(key), col(text)), text, least, group_bytes)
    schema = T.StructType([
        T.StructField(key, documents.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
        T.StructField("kept_sha256", T.StringType()),
    ])

    repeats_row = repeats.row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, owner, spans in met_rows(batches, repeats_row):
            rows = [
                (len(x), int((e - b).sum()), len(b), hashlib.sha256(_cut(x, b, e)).hexdigest()) for x, b, e in _texts_and_spans(batch.column(1), owner, spans)
            ]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return repeats.joined(text).mapInArrow(run, schema)


def drop_repeats(spark: SparkSession, documents: DataFrame, text: str = "text", least: int = LEAST, pinned: bool = False) -> DataFrame:
    """The documents without their repeated passages; columns stay as they are.

    A character that is covered in part stays, so the text stays valid. A text that loses all
    that was not blank goes with its row; a text that loses nothing stays as it is, null and
    blank ones included. `pinned` as in `numbering.numbered`.
    """
    names = documents.columns
    repeats = Repeats(spark, documents, text, least, pinned=pinned)
    place, row = names.index(text), repeats.row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, owner, spans in met_rows(batches, row):
            texts, stays = [], []
            for (body, begins, ends), value in zip(_texts_and_spans(batch.column(place), owner, spans), batch.column(place)):
                if not len(begins):
                    texts.append(value.as_py())
                    stays.append(True)
                    continue
                inner = [(b, e) for b, e in zip(begins.tolist(), ends.tolist())]
                for k, (b, e) in enumerate(inner):
                    while b < e and body[b] & 0xC0 == 0x80:
                        b += 1
                    while e > b and e < len(body) and body[e] & 0xC0 == 0x80:
                        e -= 1
                    inner[k] = (b, e)
                pairs = np.array(inner)
                left = _cut(body, pairs[:, 0], pairs[:, 1])
                texts.append(left.decode())
                stays.append(bool(left.strip()))
            columns = list(batch.columns[: len(names)])
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays))

    return repeats.joined(text).mapInArrow(run, documents.schema)
