"""Best-fit packing of token sequences by patterns of few documents.

Lengths are counted into a histogram, which is all that the plan needs, so the plan's size
depends on the sequence length and not on the corpus. Patterns are the ways to fill a
sequence with up to three lengths on a grid; non-negative least squares finds how often to
repeat each so that together they use the histogram up; the counts are rounded down. A
repeat takes all lengths but the last from its grid cells and the last as what is missing,
so it is full to the token. What the patterns leave over is packed best-fit decreasing.
Documents find their places by their number among those of equal length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.numbering import gapless, with_row
from vecloom.llm.text import LOWER, WordCache, col, flat, helper, or_empty, runs, spans_of, steps, text_array, written

CAPACITY, END = 2048, 0
GRID, PARTS = 128, 3
#: Share of the fitted repeats that is used; the rest keeps short lengths for the residual's gaps.
SHARE = 0.8
#: Grid cells too short for a pattern: such lengths are worth most in the residual's gaps.
SMALL = 24
REMEMBERED = 400_000
#: Words that the tokenizer gets in one text.
TOGETHER = 4000

# Words are cut at white space, and after Latin letters that begin one if one of these marks follows:
# the tokenizer cuts there too, so the parts' ids make up the text's. It also drops case, but
# for its special tokens, which have this beginning.
_SPACES, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_MARKS[list(b".,!?;:&%$#*|")] = True
_SPECIAL = "<|"


def word_parts(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the parts of all texts begin and end in their bytes, and the first part of each text (one more for the end)."""
    begins, ends, _ = runs(~_SPACES[body], starts)
    after = np.r_[body[1:], np.uint8(0)] if len(body) else body
    # Two bytes in UTF-8: À to ÿ, but for the signs of multiplication and division.
    accented = (body == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    letter = ((body >= 65) & (body <= 90)) | ((body >= 97) & (body <= 122)) | accented
    letter[1:] |= accented[:-1]
    other = np.flatnonzero(~letter)
    stop = np.r_[other, len(body)][np.searchsorted(other, begins)]
    cut = (stop > begins) & (stop < ends)
    cut[cut] = _MARKS[body[stop[cut]]]
    begins, ends = np.sort(np.r_[begins, stop[cut]]), np.sort(np.r_[ends, stop[cut]])
    return begins, ends, np.searchsorted(begins, starts)


class Tokens:
    """Ids of texts by a tokenizer file whose words never span white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.stop_id, self.stop = max((k, t.content) for k, t in self.library.get_added_tokens_decoder().items() if t.special)
        self.words = WordCache(self._encode, REMEMBERED)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: many at once, with a special token after each, which the tokenizer takes for itself."""
        odd = [k for k, w in enumerate(words) if _SPECIAL in w]
        plain = [w for w in words if _SPECIAL not in w] if odd else words
        texts = [self.stop.join(plain[k : k + TOGETHER]) + self.stop for k in range(0, len(plain), TOGETHER)]
        found = [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        last = ids == self.stop_id
        sizes = np.diff(np.r_[-1, np.flatnonzero(last)]) - 1
        ids = ids[~last]
        if odd:
            own = [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast([words[k] for k in odd], add_special_tokens=False)]
            parts = np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []
            for k, x in zip(odd, own):
                parts.insert(k, x)
            ids, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, np.r_[0, np.cumsum(sizes)]

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin; one more for the end."""
        body, starts = flat(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        special = np.flatnonzero((body[:-1] == 60) & (body[1:] == 124)) if len(body) else np.zeros(0, np.int64)
        lower = LOWER[body]
        for k in np.unique(np.searchsorted(starts, special, side="right") - 1).tolist():
            lower[starts[k] : starts[k + 1]] = body[starts[k] : starts[k + 1]]
        begins, ends, first = word_parts(lower, starts)
        sizes = ends - begins
        words = text_array(lower[spans_of(begins, sizes)], np.r_[0, np.cumsum(sizes)]).dictionary_encode()
        return self.words.look_up_coded(words.dictionary.to_pylist(), words.indices.to_numpy(), first)


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def cut_pieces(
    frame: DataFrame, path: str, keys: list[str], text: str = "text", capacity: int = CAPACITY, ids: str | None = None
) -> DataFrame:
    """Token pieces of each whole text: keys, piece, start, length, ids_crc32 and, if named, the ids.

    Each document ends with id 0, so a null or empty text is one piece of that id alone.
    """
    body = helper("body")
    narrow = frame.select(*[col(k) for k in keys], or_empty(text).alias(body))
    fields = [f for f in narrow.schema if f.name != body]
    fields += [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))]
    fields += [T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens(path)
        for batch in steps(batches, body):
            found, starts = tokenizer.encode(batch.column(len(keys)))
            owner, piece, start, length, crc, parts = [], [], [], [], [], []
            for k, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
                own = np.append(found[a:b], END).astype("<u4")
                for n, begin in enumerate(range(0, len(own), capacity)):
                    part = own[begin : begin + capacity]
                    owner.append(k)
                    piece.append(n)
                    start.append(begin)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if ids:
                        parts.append(part.astype(np.int32))
            columns = [c.take(pa.array(owner)) for c in batch.columns[:-1]]
            columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            columns += [pa.array(parts, pa.list_(pa.int32()))] if ids else []
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return narrow.mapInArrow(run, T.StructType(fields))


def patterns(grid: int, parts: int) -> np.ndarray:
    """All ways to fill `grid` cells with up to three lengths, as rows of descending cells (0: none)."""
    out = [(grid, 0, 0)]
    if parts > 1:
        out += [(a, grid - a, 0) for a in range(-(-grid // 2), grid)]
    if parts > 2:
        out += [(a, b, grid - a - b) for a in range(-(-grid // 3), grid - 1) for b in range(-(-(grid - a) // 2), min(a, grid - a - 1) + 1)]
    return np.array(out)


def nnls(matrix: np.ndarray, target: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares by an active set (Lawson and Hanson), on the normal equations."""
    square, side = matrix.T @ matrix, matrix.T @ target
    x, used = np.zeros(len(side)), np.zeros(len(side), bool)
    scale = max(1.0, float(np.abs(target).max()))
    ridge = 1e-9
    for _ in range(rounds):
        gradient = np.where(used, -np.inf, side - square @ x)
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-6 * scale:
            break
        used[best] = True
        while used.any():
            at = np.flatnonzero(used)
            trial = np.zeros(len(side))
            trial[at] = np.linalg.solve(square[np.ix_(at, at)] + ridge * np.eye(len(at)), side[at])
            bad = at[trial[at] <= 0]
            if not len(bad):
                x = trial
                break
            step = np.min(x[bad] / np.maximum(x[bad] - trial[bad], 1e-300))
            x = np.maximum(x + step * (trial - x), 0)
            used &= x > 1e-12 * scale
            x[~used] = 0
    return x


class Plan:
    """Places for counted lengths: rows (length, first number, count, first sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.rows, self.sequences = capacity, [], 0
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in histogram.items():
            self.left[length] = count
        self.taken = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[tuple[int, int]]] = {}
        self._repeat_patterns()
        self._pack_rest()

    def _put(self, length: int, count: int, first: int, offset: int) -> None:
        self.rows.append((length, int(self.taken[length]), count, first, offset))
        self.taken[length] += count
        self.left[length] -= count

    def _repeat_patterns(self) -> None:
        capacity = self.capacity
        grid = min(GRID, capacity)
        cell = -(-np.arange(capacity + 1) * grid // capacity)
        have = np.bincount(cell, weights=self.left, minlength=grid + 1)
        ways = patterns(grid, PARTS)
        ways = ways[((ways == 0) | (ways > SMALL)).all(axis=1)]
        matrix = np.zeros((grid + 1, len(ways)))
        for k in range(ways.shape[1]):
            np.add.at(matrix, (ways[:, k], np.arange(len(ways))), 1.0)
        repeats = np.floor(SHARE * nnls(matrix[1:], have[1:])).astype(np.int64)
        cells = [np.flatnonzero(cell == c) for c in range(grid + 1)]
        for w in np.argsort(-repeats, kind="stable"):
            if not repeats[w]:
                break
            self._repeat([cells[c] for c in ways[w][:-1] if 0 < c < grid], int(repeats[w]), int((ways[w] > 0).sum()))

    def _repeat(self, heads: list[np.ndarray], count: int, parts: int) -> None:
        """Full sequences: a length of each head cell, and one of just the rest."""
        heads = heads[: parts - 1]
        for chosen in product(*(cell[::-1].tolist() for cell in heads)):
            rest = self.capacity - sum(chosen)
            if rest < 1 or not self.left[rest]:
                continue
            way = [*chosen, rest]
            n = min([count, *(int(self.left[x]) // way.count(x) for x in way)])
            offset = 0
            for x in way if n else []:
                self._put(x, n, self.sequences, offset)
                offset += x
            self.sequences += n
            count -= n
            if not count:
                return

    def _leave(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            self.open.setdefault(gap, []).append((first, count))

    def _pack_rest(self) -> None:
        capacity = self.capacity
        for length in range(capacity, 0, -1):
            while self.left[length]:
                want = int(self.left[length])
                gap = next((g for g in range(length, capacity + 1) if self.open.get(g)), None)
                if gap is None:
                    each = capacity // length
                    n, used = (want // each, each) if want >= each else (1, want)
                    for k in range(used):
                        self._put(length, n, self.sequences, k * length)
                    self._leave(capacity - used * length, self.sequences, n)
                    self.sequences += n
                    continue
                first, count = self.open[gap].pop()
                n = min(want, count)
                self._put(length, n, first, capacity - gap)
                self._leave(gap - length, first, n)
                self._leave(gap, first + n, count - n)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted codes of (length, first number), and for each the length, number, sequence and offset."""
        rows = np.array(sorted((x[0], x[1], x[3], x[4]) for x in self.rows), np.int64).reshape(-1, 4)
        return (rows[:, 0] << 48) + rows[:, 1], rows


def place(spark: SparkSession, pieces: DataFrame, row: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (column `length`) with sequence_id and offset. Pass a written frame with its row numbers."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(counts, capacity).arrays())
    number = helper("number")
    numbered = gapless(pieces, ["length"], row, number)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, rows = plan.value
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            own = batch.column(len(names)).to_numpy()
            found = rows[np.searchsorted(codes, (length << 48) + own, side="right") - 1]
            places = [pa.array(found[:, 2] + own - found[:, 1]), pa.array(found[:, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *places], schema.names)

    return numbered.mapInArrow(run, schema)


def pack(
    spark: SparkSession, documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, ids: str | None = None,
) -> DataFrame:
    """Every document's pieces with their places: key, piece, start, length, ids_crc32, [ids], sequence_id, offset.

    Repeated rows and keys are documents each for itself. An empty table gives no rows. The
    histogram brought to the driver has at most `capacity` rows.
    """
    row = helper("row")
    cut = cut_pieces(documents, path, [key], text, capacity, ids)
    return place(spark, written(spark, with_row(cut, row), "pieces"), row, capacity).drop(row)
