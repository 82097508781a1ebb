"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram counts once in a text, as a hashed bucket. Over the labelled training rows Spark
counts in how many toxic and clean texts each bucket occurs; the log ratio r of the two
smoothed shares is the feature's scale. The buckets whose shares differ most surely are
kept, a logistic regression is fitted on the scaled features, and its weights times r make
one weight per bucket. A score is a sum of weights. All this is learned from a bounded
sample of the labelled keys, chosen by hash: SAMPLE_ROWS is its documented bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.text import LOWER, SPACE, col, crc_mod, flat, helper, or_empty, steps, written

BUCKETS = 1 << 20
ORDERS = (3, 4, 5, 6)
#: Buckets kept, by the significance of their difference.
FEATURES = 4096
#: Bounds of the sample: labelled keys that are learned from; rows that the regression is
#: fitted on, and kept buckets that these may have together.
SAMPLE_ROWS, FIT_ROWS, FIT_CELLS = 50_000, 20_000, 20_000_000
#: Text that is cut into n-grams at a time: each byte makes four pairs of 8 bytes and their sort.
STEP = 1 << 18
SMOOTHING = 0.5
THRESHOLD = 0.7


def buckets(data: np.ndarray, starts: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs of the n-grams of lower-cased UTF-8 bytes, by text.

    Texts are set in spaces, and white space is one byte. With `keep`, a number for each
    bucket, buckets of negative numbers are left out and numbers are returned.
    """
    count = len(starts) - 1
    lengths = np.diff(starts)
    padded_starts = starts + np.arange(count + 1)
    body = np.full(len(data) + count + 1, 32, np.uint8)
    owner = np.repeat(np.arange(count), lengths + 1)
    body[np.arange(len(data)) + np.repeat(np.arange(count), lengths) + 1] = np.where(SPACE[data], 32, LOWER[data])
    owner = np.append(owner, count - 1)
    code, found = body.astype(np.uint64), []
    place = np.arange(len(body))
    # A text's last gram may end on the space that the next begins with, and not beyond.
    end = padded_starts[1:][owner]
    for n in range(2, max(ORDERS) + 1):
        code = code[:-1] * np.uint64(257) + body[n - 1 :]
        if n not in ORDERS:
            continue
        inside = place[: len(code)] + n - 1 <= end[: len(code)]
        cell = ((code * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(44)).astype(np.int64)
        if keep is not None:
            cell = keep[cell]
            inside &= cell >= 0
        found.append((owner[: len(code)][inside] << 20) | cell[inside])
    pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    return pairs >> 20, pairs & (BUCKETS - 1)


def _features(texts: DataFrame, body: str, keys: list[str], keep: np.ndarray | None) -> DataFrame:
    """The key columns and each text's distinct buckets."""
    schema = T.StructType([*[f for f in texts.schema if f.name != body], T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, body, STEP):
            owner, cell = buckets(*flat(batch.column(len(keys))), keep)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], cells], [*keys, "cells"])

    return texts.select(*[col(k) for k in keys], col(body)).mapInArrow(run, schema)


def _counts(texts: DataFrame, body: str) -> DataFrame:
    """Per bucket, how many toxic and clean texts hold it; summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in steps(batches, body, STEP):
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            owner, cell = buckets(*flat(batch.column(1)))
            mark = label[owner]
            toxic += np.bincount(cell[mark], minlength=BUCKETS)
            clean += np.bincount(cell[~mark], minlength=BUCKETS)
        there = np.flatnonzero(toxic + clean)
        for part in np.array_split(there, max(1, len(there) >> 16)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(toxic[part]), pa.array(clean[part])], ["cell", "p", "q"])

    return texts.mapInArrow(run, "cell long, p long, q long").groupBy("cell").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def fit(cells: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, rounds: int = 150, decay: float = 2e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled presence of features, classes weighted alike; Adam on all rows."""
    counts = np.array([len(c) for c in cells])
    flat_cells = np.concatenate(cells) if len(cells) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(cells)), counts)
    share = labels.mean()
    weight = np.where(labels, 0.5 / share, 0.5 / (1 - share)) / len(labels)
    w, bias, state = np.zeros(len(scale)), 0.0, np.zeros((2, len(scale) + 1))
    values = scale[flat_cells]
    for step in range(1, rounds + 1):
        margin = np.bincount(row, values * w[flat_cells], len(cells)) + bias
        slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * weight
        gradient = np.append(np.bincount(flat_cells, values * slope[row], len(scale)) + decay * w, slope.sum())
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w * scale, float(bias)


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """(number of each bucket or -1, weight of each number, bias), learned from keys whose crc32 mod 3 is not 1.

    Without both classes among the training rows there is no feature, and every score is the
    share of toxic rows (one half without rows). Labels that are null, and keys that are null
    or repeated with unlike labels, teach nothing.
    """
    marks = (
        labels.where(col(key).isNotNull() & col(label).isNotNull() & (crc_mod(key, 3) != 1))
        .groupBy(col(key).alias("key")).agg(F.min(col(label)).alias("low"), F.max(col(label)).alias("high"))
        .where("low = high").select("key", (F.col("low") > 0).alias("mark"))
        .orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS)
    )
    texts = documents.select(col(key).alias("key"), or_empty(text).alias("body")).join(F.broadcast(marks), "key")
    texts = written(spark, texts.select("mark", "body", F.xxhash64("key", "body").alias("order")), "labelled")
    number = {r["mark"]: r["n"] for r in texts.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = number.get(True, 0), number.get(False, 0)
    keep = np.full(BUCKETS, -1, np.int32)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        return keep, np.zeros(1), float(np.log(share / (1 - share)))
    p, q = F.col("p") / toxic, F.col("q") / clean
    both = (F.col("p") + F.col("q") + 1) / (toxic + clean + 2)
    surely = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / toxic + 1 / clean))
    top = (
        _counts(texts.select("mark", "body"), "body").where("p + q >= 3")
        .select("cell", F.log((p + SMOOTHING / toxic) / (q + SMOOTHING / clean)).alias("r"), surely.alias("z"))
        .orderBy(F.desc("z"), "cell").limit(FEATURES).collect()
    )
    scale = np.array([x["r"] for x in top] or [0.0])
    keep[[x["cell"] for x in top]] = np.arange(len(top))
    rows = _features(texts, "body", ["mark", "order"], keep).orderBy("order", "mark").limit(FIT_ROWS).collect()
    cells, total = [], 0
    for x in rows:
        total += len(x["cells"])
        if total > FIT_CELLS:
            break
        cells.append(np.array(x["cells"], np.int64))
    marks_ = np.array([x["mark"] for x in rows[: len(cells)]], bool)
    if marks_.all() or not marks_.any():
        return keep, scale, float(np.log(toxic / clean))
    weights, bias = fit(cells, marks_, scale)
    return keep, weights, bias


def score(spark: SparkSession, documents: DataFrame, model: tuple[np.ndarray, np.ndarray, float], keys: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """The key columns and each whole text's score between 0 and 1; null texts count as empty."""
    shared = spark.sparkContext.broadcast(model)
    body = helper("body")
    narrow = documents.select(*[col(k) for k in keys], or_empty(text).alias(body))
    schema = T.StructType([*[f for f in narrow.schema if f.name != body], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, weights, bias = shared.value
        for batch in steps(batches, body, STEP):
            owner, cell = buckets(*flat(batch.column(len(keys))), keep)
            margin = np.bincount(owner, weights[cell], batch.num_rows) + bias
            found = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(found)], [*keys, out])

    return narrow.mapInArrow(run, schema)


def drop_toxic(spark: SparkSession, documents: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold; columns and texts stay as they are."""
    shared, names = spark.sparkContext.broadcast(model), documents.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, weights, bias = shared.value
        for batch in steps(batches, text, STEP):
            owner, cell = buckets(*flat(batch.column(place)), keep)
            margin = np.bincount(owner, weights[cell], batch.num_rows) + bias
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))) < threshold))

    return documents.mapInArrow(run, documents.schema)
