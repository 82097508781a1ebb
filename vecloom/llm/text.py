"""Text helpers shared by the operators: flat byte buffers inside tasks, row ids and staging outside."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import work_path

#: Text that one numpy step handles at a time; a longer text makes a step of its own.
STEP_BYTES = 1 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def helper(name: str) -> str:
    """A column name that no table has, so that added columns never clash."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def or_empty(name: str) -> Column:
    return F.coalesce(col(name), F.lit(""))


def written(spark: SparkSession, frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there and lost executors cost nothing."""
    path = work_path(spark, name)
    (frame.write.option("compression", codec) if codec else frame.write).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text begins (one more for the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (body[starts[0] : starts[-1]], starts - starts[0]) if len(column) else (body[:0], np.zeros(1, np.int64))


def steps(batches: Iterator[pa.RecordBatch], text: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of bounded text; one row at least in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = flat(batch.column(batch.schema.get_field_index(text)))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(starts, starts[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each span, in a row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def text_array(body: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Texts from flat bytes; the bytes must be valid UTF-8."""
    return pa.Array.from_buffers(
        pa.string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))]
    )


def list_array(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift rounds) over an array of hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and the inverses modulo 2^64; base is odd."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        size = max(n + 1, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


def span_hashes(body: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit polynomial hash of each byte span; equal bytes give equal hashes wherever they lie."""
    power, inverse = powers(base, len(body))
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(0x1F1)) * power[: len(body)], out=sums[1:])
    value = (sums[ends] - sums[begins]) * inverse[begins]
    return mixed(value + (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: The ASCII white space that separates words (9 to 13 and 32).
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: ASCII upper case to lower case, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: The bytes of words that are only letters and digits (those of ASCII, and all beyond it).
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def words(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends in the flat bytes, and the first word of each text (one more for the end)."""
    return runs(~SPACE[body], starts)


def runs(solid: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for runs of any bytes that are marked."""
    body = solid
    before = np.zeros(len(body), bool)
    before[1:] = solid[:-1]
    edges = starts[:-1][starts[:-1] < len(body)]
    before[edges] = False
    begins = np.flatnonzero(solid & ~before)
    after = np.zeros(len(body), bool)
    after[:-1] = solid[1:]
    last = starts[1:][starts[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return begins, ends, np.searchsorted(begins, starts)


class WordCache:
    """Token ids of words, kept within a task up to a number of words and then forgotten at once."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Encode those of the words that are not known."""
        if len(self.known) > self.most:
            self.forget()
        fresh = list(set(words).difference(self.known))
        if fresh:
            ids, starts = self.encode(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
            self.ids = np.concatenate([self.ids, ids])

    def look_up(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts' words in a row, and where each text's begin; one more for the end."""
        self.learn(chain.from_iterable(cut))
        known = self.known
        index = np.array([known[w] for words in cut for w in words], np.int64)
        return self._ids(index, np.cumsum([0, *(len(words) for words in cut)]))

    def look_up_coded(self, words: list[str], codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts' words by their places in a list, and the first one of each text (one more for the end)."""
        self.learn(words)
        return self._ids(np.array([self.known[w] for w in words], np.int64)[codes], firsts)

    def _ids(self, index: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.starts[index + 1] - self.starts[index]
        return self.ids[spans_of(self.starts[index], lengths)], np.r_[0, np.cumsum(lengths)][firsts]


def crc_mod(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the text of nothing."""
    return F.pmod(F.crc32(F.coalesce(col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
