"""Document fingerprints: every shingle hash below a fixed threshold, and the smallest one.

The threshold is a fixed fraction of all hashes, so a sketch grows with its document and the
share of shared hashes estimates containment even between documents of very unequal
length. Sketches of parts merge: the union, and of the smallest hashes that lie above the
threshold only the least. That one keeps the sketch of a short text from being empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.text import LOWER, col, flat, helper, list_array, mixed, or_empty, span_hashes, spans_of, steps, words

SIZE, FRACTION = 5, 1 / 8
THRESHOLD = np.uint64(int(FRACTION * 2**64))
#: Documents that are sorted together by key, and the most such blocks: the bound of what is
#: broadcast (one key for each).
BLOCK_ROWS, BLOCKS = 4096, 1 << 18

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def sketch(data: np.ndarray, starts: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Ascending sketch hashes of all texts in a row, and where each text's begin; one more for the end.

    Words are runs without white space, A-Z in lower case. A text of fewer words than a
    shingle is one shingle; a text without words has an empty sketch.
    """
    begins, ends, first = words(data, starts)
    word = span_hashes(LOWER[data], begins, ends)
    texts, total = len(starts) - 1, len(word)
    count = np.diff(first)
    owner = np.repeat(np.arange(texts), count)
    found_hash, found_owner = [], []
    for n in range(1, size + 1):
        if total < n:
            break
        # Whole shingles, or all words of the texts that have just n.
        place = np.flatnonzero(np.arange(total) + n <= first[1:][owner]) if n == size else first[:-1][count == n]
        code = np.full(len(place), n, np.uint64)
        for k in range(n):
            code = code * _STEP + word[place + k]
        found_hash.append(mixed(code))
        found_owner.append(owner[place])
    if not found_hash:
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    code, owner = np.concatenate(found_hash), np.concatenate(found_owner)
    least = np.full(texts, np.uint64(2**64 - 1))
    np.minimum.at(least, owner, code)
    keep = (code < THRESHOLD) | (code == least[owner])
    code, owner = code[keep], owner[keep]
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    new = np.r_[True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])] if len(code) else np.zeros(0, bool)
    return code[new], np.searchsorted(owner[new], np.arange(texts + 1))


def sketches(frame: DataFrame, keys: list[str], text: str = "text", out: str = "sketch") -> DataFrame:
    """The key columns and each whole text's sketch as ascending unsigned hashes, stored as longs."""
    body = helper("body")
    narrow = frame.select(*[col(k) for k in keys], or_empty(text).alias(body))
    schema = T.StructType([*[f for f in narrow.schema if f.name != body], T.StructField(out, T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, body):
            code, starts = sketch(*flat(batch.column(len(keys))))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], list_array(code.view(np.int64), starts)], [*keys, out])

    return narrow.mapInArrow(run, schema)


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of either sketch that both have; two empty sketches are alike."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def contained(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; an empty sketch is contained in any."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents' shingles together, unordered."""
    both = F.array_union(a, b)
    bound = F.lit(int(THRESHOLD))
    # Hashes are unsigned: those below the threshold (an eighth) are positive longs.
    low = F.filter(both, lambda x: (x >= 0) & (x < bound))
    least = F.array_min(F.transform(both, lambda x: x.bitwiseXOR(F.lit(-(2**63)))))
    return F.when(F.size(low) > 0, low).when(F.size(both) > 0, F.array(least.bitwiseXOR(F.lit(-(2**63))))).otherwise(both)


_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _hex(code: np.ndarray, starts: np.ndarray) -> pa.Array:
    body = _HEX[code.astype(">u8").view(np.uint8)].reshape(-1)
    offsets = pa.py_buffer((starts * 16).astype(np.int32))
    return pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(body))])


def _shares(code: np.ndarray, starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likeness and containment of row k's sketch and the other's, for all k."""
    n = len(starts) - 1
    sizes, others = np.diff(starts), np.diff(other_starts)
    owner = np.concatenate([np.repeat(np.arange(n), sizes), np.repeat(np.arange(n), others)])
    both = np.concatenate([code, other])
    order = np.lexsort((both, owner))
    both, owner = both[order], owner[order]
    same = (both[1:] == both[:-1]) & (owner[1:] == owner[:-1])
    shared = np.bincount(owner[1:][same], minlength=n) if len(both) else np.zeros(n, np.int64)
    either = sizes + others - shared
    return np.where(either > 0, shared / np.maximum(either, 1), 1.0), np.where(sizes > 0, shared / np.maximum(sizes, 1), 1.0)


def _edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def blocks(spark: SparkSession, documents: DataFrame, key: str) -> list:
    """Keys that cut the documents into blocks of about BLOCK_ROWS in key order; the first is the smallest."""
    keys = documents.select(col(key).alias("key")).where(F.col("key").isNotNull())
    count = min(BLOCKS, -(-keys.count() // BLOCK_ROWS))
    if not count:
        return []
    ranged = keys.repartitionByRange(count, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key"))
    return [r["key"] for r in ranged.orderBy("key").collect()]


def fingerprint_edits(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text ends in the beginning of the next document by key, a quarter of the
    text long; the first document follows the last. Equal keys are ordered by text, null
    keys come last, null texts are empty, and a table of one document follows itself.
    Documents are dealt out by blocks of the key order; a block's first document is also sent
    to the block before, so that each finds its successor in its own block.
    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next (likeness), contained_edited, contained_next.
    """
    bounds = blocks(spark, documents, key)
    cuts = spark.sparkContext.broadcast(np.array(bounds))
    last = max(0, len(bounds) - 1)

    @F.pandas_udf("array<long>")
    def homes(values: pd.Series) -> pd.Series:
        keys, cut = values.to_numpy(), cuts.value
        block = np.searchsorted(cut, keys, side="right") - 1
        before = np.where(block > 0, block - 1, len(cut) - 1)
        leads = cut[block] == keys
        return pd.Series([[b, -1 - p] if f else [b] for b, p, f in zip(block.tolist(), before.tolist(), leads)])

    whole = documents.select(col(key).alias("key"), or_empty(text).alias("body"))
    some = whole.where(F.col("key").isNotNull()).withColumn("home", F.explode(homes("key")))
    # Of null keys there is no block; they end the last one, and lead all if there is no other.
    none = whole.where(F.col("key").isNull())
    ends = none.withColumn("home", F.lit(last).cast("long"))
    if not bounds:
        ends = ends.unionByName(none.orderBy("body").limit(1).withColumn("home", F.lit(-1 - last).cast("long")))
    placed = some.unionByName(ends).select(
        F.when(F.col("home") < 0, -1 - F.col("home")).otherwise(F.col("home")).alias("block"),
        (F.col("home") < 0).alias("guest"), "key", "body",
    )
    dealt = placed.repartition("block").sortWithinPartitions("block", "guest", F.col("key").asc_nulls_last(), "body")
    schema = T.StructType([
        T.StructField(key, whole.schema["key"].dataType), T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next", "contained_edited", "contained_next")),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for step in steps(batches, "body"):
            batch = pa.Table.from_batches([held, step] if held is not None else [step]).combine_chunks().to_batches()[0]
            held = batch.slice(batch.num_rows - 1)
            block, guest = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            own = np.flatnonzero((block[:-1] == block[1:]) & ~guest[:-1])
            if not len(own):
                continue
            code, starts = sketch(*flat(batch.column(3)))
            texts = batch.column(3).to_pylist()
            edited = [_edited(texts[i], texts[i + 1]).encode() for i in own]
            changed, changed_starts = sketch(*flat(pa.array(edited, pa.large_binary())))
            mine, following = _picked(code, starts, own), _picked(code, starts, own + 1)
            near = _shares(*mine, changed, changed_starts)
            beside = _shares(*mine, *following)
            columns = [
                batch.column(2).take(pa.array(own)), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), _hex(*mine), _hex(changed, changed_starts),
                *(pa.array(x) for x in (near[0], beside[0], near[1], beside[1])),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return dealt.mapInArrow(run, schema)


def _picked(code: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = starts[rows + 1] - starts[rows]
    return code[spans_of(starts[rows], lengths)], np.r_[0, np.cumsum(lengths)]
