"""Language-model scores: a log-bilinear model of word classes, trained by noise-contrastive estimation.

Counts of all training words give the classes: the most frequent words and the end are
classes of their own, every other word falls into a class by its last bytes. A class is
predicted from the classes of the two words before by a log-bilinear neural model, and a
word within its class by the smoothed counts, so the probabilities of all words after a
context add up to one. The model is trained in every task on that task's texts and
averaged over tasks, weighted by tokens. Its sums over classes are taken for all pairs of
contexts by one matrix product.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.numbering import with_row
from vecloom.llm.text import col, crc_mod, flat, helper, or_empty, steps, written

#: Words with classes of their own, classes of the rest, and the classes' total with the end.
WORDS, ENDINGS = 767, 256
CLASSES = WORDS + 1 + ENDINGS
END, START = WORDS, CLASSES
#: Words whose counts go to every task, and their greatest length in bytes: the bound of what
#: is broadcast. All other words meet their counts in a join.
KNOWN_WORDS, KNOWN_BYTES = 200_000, 64
#: Words that a task counts before it hands them on; a memory bound.
COUNTED = 500_000
DIMS, BATCH, NOISE, RATE = 16, 8192, 40, 0.15
SMOOTHING = 0.1
SEED = 11


def split(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return text.lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def _ending_column(word: Column) -> Column:
    data = word.cast("binary")
    return F.crc32(F.substring(data, F.greatest(F.length(data) - 2, F.lit(1)), F.lit(3))) % ENDINGS


def _texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in steps(batches, text):
        data, starts = flat(batch.column(batch.schema.get_field_index(text)))
        whole = data.tobytes()
        yield batch, [whole[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]


def count_words(texts: DataFrame, body: str) -> DataFrame:
    """(word, c) of all texts; each task adds up its own words first."""

    def rows(counts: Counter) -> Iterator[pa.RecordBatch]:
        words, numbers = list(counts.keys()), list(counts.values())
        for k in range(0, len(words), 1 << 16):
            word = pa.array(words[k : k + (1 << 16)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([word, pa.array(numbers[k : k + (1 << 16)], pa.int64())], ["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for _, found in _texts(batches, body):
            for text in found:
                counts.update(split(text))
            if len(counts) > COUNTED:
                yield from rows(counts)
                counts = Counter()
        yield from rows(counts)

    return texts.select(body).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Counts: of the training tokens, of the known words, and of each ending's other words."""

    tokens: int
    distinct: int
    documents: int
    place: dict[bytes, int]
    count: np.ndarray
    ending_tokens: np.ndarray
    ending_words: np.ndarray

    def __post_init__(self) -> None:
        words = list(self.place)
        self.classes = np.array([k if k < WORDS else END + 1 + ending(w) for k, w in enumerate(words)], np.int64)
        per_class = np.zeros(CLASSES)
        per_class[: min(WORDS, len(words))] = self.count[:WORDS]
        per_class[END] = self.documents
        per_class[END + 1 :] = self.ending_tokens
        self.noise = (per_class + 1) / (per_class + 1).sum()
        self.log_count = np.log10(self.count + SMOOTHING) if len(words) else np.zeros(0)
        # What an ending's word takes of its class, beside log10(c + smoothing).
        self.log_class = np.log10(self.ending_tokens + SMOOTHING * (self.ending_words + 1))

    def codes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Classes and places (-1: not known, -2: end) of all tokens, the first token of each text, and the words."""
        get = self.place.get
        words = [split(t) for t in texts]
        firsts = np.cumsum([0, *(len(w) + 1 for w in words)])
        place = np.full(firsts[-1], -2, np.int64)
        classes = np.full(firsts[-1], END, np.int64)
        inside = np.ones(firsts[-1], bool)
        inside[firsts[1:] - 1] = False
        own = np.array([get(x, -1) for w in words for x in w], np.int64)
        place[inside] = own
        mapped = self.classes[own] if len(self.classes) else own.copy()
        strange = np.flatnonzero(own < 0)
        if len(strange):
            crc = zlib.crc32
            mapped[strange] = END + 1 + np.array([crc(x[-3:]) % ENDINGS for w in words for x in w if x not in self.place], np.int64)
        classes[inside] = mapped
        return classes, place, firsts, words

    @staticmethod
    def contexts(classes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class before each token and the one before that; START where a text begins."""
        one, two = np.full_like(classes, START), np.full_like(classes, START)
        one[1:], two[2:] = classes[:-1], classes[:-2]
        one[firsts[:-1]] = START
        two[firsts[:-1]] = START
        second = firsts[:-1] + 1
        two[second[second < firsts[1:]]] = START
        return one, two


def learn_vocabulary(spark: SparkSession, texts: DataFrame, body: str) -> tuple[Vocabulary, DataFrame]:
    """Counts over all training texts, and the written table (word, c)."""
    counts = written(spark, count_words(texts, body), "word-counts")
    documents = texts.count()
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = (
        counts.where(F.octet_length("word") <= KNOWN_BYTES).orderBy(F.desc("c"), "word").limit(KNOWN_WORDS).toArrow()
    )
    words = top["word"].cast(pa.binary()).to_pylist()
    rest = counts.where(~F.col("word").isin([w.decode() for w in words[:WORDS]]))
    ending_tokens, ending_words = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for e, c, n in rest.groupBy(_ending_column(F.col("word")).alias("e")).agg(F.sum("c"), F.count(F.lit(1))).collect():
        ending_tokens[e], ending_words[e] = c, n
    place = {w: k for k, w in enumerate(words)}
    vocabulary = Vocabulary(
        tokens + documents, distinct + (documents > 0), documents, place, top["c"].to_numpy().astype(float), ending_tokens, ending_words
    )
    return vocabulary, counts


class Model:
    """Log-bilinear class model: h = a1 * in[c1] + a2 * in[c2]; score of t = h . out[t] + bias[t]."""

    def __init__(self, noise: np.ndarray):
        random = np.random.default_rng(SEED)
        self.inner = random.normal(0, 0.3, (CLASSES + 1, DIMS)).astype(np.float32)
        self.outer = np.zeros((CLASSES, DIMS), np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.mix = np.ones((2, DIMS), np.float32)
        self.noise = noise
        self.squares = [np.full(x.shape, 1e-3, np.float32) for x in (self.inner, self.outer, self.bias, self.mix)]
        self.random = random
        self.cumulative = np.cumsum(noise)

    def _move(self, k: int, at, gradient: np.ndarray) -> None:
        part, square = (self.inner, self.outer, self.bias, self.mix)[k], self.squares[k]
        square[at] += gradient * gradient
        part[at] -= RATE * gradient / np.sqrt(square[at])

    @staticmethod
    def _summed(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of values added up by index."""
        order = np.argsort(index.astype(np.int16), kind="stable")  # by radix
        ordered = index[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        return ordered[first], np.add.reduceat(values[order], first, axis=0)

    def train(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        """One step of noise-contrastive estimation on a batch; the noise words are shared within it."""
        n = len(target)
        x1, x2 = self.inner[one], self.inner[two]
        h = x1 * self.mix[0] + x2 * self.mix[1]
        noise = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), CLASSES - 1)
        shift = np.log(NOISE * self.noise).astype(np.float32)
        out = self.outer[target]
        good = np.einsum("nd,nd->n", h, out) + self.bias[target] - shift[target]
        bad = h @ self.outer[noise].T + (self.bias[noise] - shift[noise])
        # Gradients by score: probability of noise for the word, of the word for noise.
        g = np.float32(-1 / n) / (1 + np.exp(good))
        np.exp(-bad, out=bad)
        bad += 1
        b = np.divide(np.float32(1 / n), bad, out=bad)
        dh = g[:, None] * out + b @ self.outer[noise]
        at, summed = self._summed(np.concatenate([target, noise]), np.concatenate([g[:, None] * h, b.T @ h]))
        bias_at, bias_sum = self._summed(np.concatenate([target, noise]), np.concatenate([g, b.sum(0)]))
        in_at, in_sum = self._summed(np.concatenate([one, two]), np.concatenate([dh * self.mix[0], dh * self.mix[1]]))
        mixed = np.stack([(dh * x1).sum(0), (dh * x2).sum(0)])
        self._move(1, at, summed)
        self._move(2, bias_at, bias_sum)
        self._move(0, in_at, in_sum)
        self._move(3, slice(None), mixed)

    def rows(self) -> np.ndarray:
        """All parameters in rows of DIMS + 1."""
        wide = np.zeros((CLASSES + 1 + CLASSES + 2, DIMS + 1))
        wide[: CLASSES + 1, :DIMS] = self.inner
        wide[CLASSES + 1 : 2 * CLASSES + 1, :DIMS] = self.outer
        wide[CLASSES + 1 : 2 * CLASSES + 1, DIMS] = self.bias
        wide[2 * CLASSES + 1 :, :DIMS] = self.mix
        return wide

    def load(self, wide: np.ndarray) -> None:
        self.inner = wide[: CLASSES + 1, :DIMS]
        self.outer = wide[CLASSES + 1 : 2 * CLASSES + 1, :DIMS]
        self.bias = wide[CLASSES + 1 : 2 * CLASSES + 1, DIMS]
        self.mix = wide[2 * CLASSES + 1 :, :DIMS]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 parts of each class by either context class, and log10 of the sums of all pairs of contexts."""
        first = (self.inner * self.mix[0]) @ self.outer.T + self.bias
        second = (self.inner * self.mix[1]) @ self.outer.T
        top1, top2 = first.max(1, keepdims=True), second.max(1, keepdims=True)
        sums = np.log(np.exp(first - top1) @ np.exp(second - top2).T) + top1 + top2.T
        return tuple((x / math.log(10)).astype(np.float32) for x in (first, second, sums))


def fit(spark: SparkSession, texts: DataFrame, body: str, vocabulary: Vocabulary) -> Model:
    """The average of the models that the tasks train, each in one pass over its texts."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, 0
        model = Model(known.noise)
        for _, found in _texts(batches, body):
            classes, _, firsts, _ = known.codes(found)
            one, two = known.contexts(classes, firsts)
            order = model.random.permutation(len(classes))
            for k in range(0, len(order), BATCH):
                at = order[k : k + BATCH]
                model.train(one[at], two[at], classes[at])
            seen += len(classes)
        if seen:
            wide = model.rows() * seen
            columns = [pa.array(np.arange(len(wide))), pa.array(np.full(len(wide), seen, float)), *(pa.array(x) for x in wide.T)]
            yield pa.RecordBatch.from_arrays(columns, ["k", "n", *(f"v{i}" for i in range(DIMS + 1))])

    values = [f"v{i}" for i in range(DIMS + 1)]
    schema = "k long, n double, " + ", ".join(f"{v} double" for v in values)
    summed = texts.select(body).mapInArrow(run, schema).groupBy("k").agg(F.sum("n"), *(F.sum(v) for v in values))
    model = Model(vocabulary.noise)
    wide = np.zeros((2 * CLASSES + 3, DIMS + 1))
    rows = summed.collect()
    for row in rows:
        wide[row[0]] = np.array(row[2:]) / row[1]
    if rows:
        model.load(wide)
    return model


def score(
    spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10
) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the keys whose crc32 modulo `folds` is not 0 and scores all whole texts, a null
    text as an empty one, which is its end alone. Scores are log10 probabilities of the text:
    base_score by the smoothed counts of single words, score by the model. Repeated keys
    are documents each for itself. Without training texts no word is known.
    """
    body, row = helper("body"), helper("row")
    whole = documents.select(col(key).alias("key"), (crc_mod(key, folds) == 0).alias("held_out"), or_empty(text).alias(body))
    training = whole.where(~F.col("held_out")).select(body)
    vocabulary, counts = learn_vocabulary(spark, training, body)
    model = fit(spark, training, body, vocabulary)
    shared = spark.sparkContext.broadcast((vocabulary, *model.tables()))
    total = math.log10(vocabulary.tokens + SMOOTHING * (vocabulary.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first, second, sums = shared.value
        end_count = math.log10(known.documents + SMOOTHING)
        for batch, found in _texts(batches, body):
            classes, place, firsts, words = known.codes(found)
            one, two = known.contexts(classes, firsts)
            value = first[one, classes].astype(float) + second[two, classes] - sums[one, two]
            log_count = np.where(place == -2, end_count, 0.0)
            inside = place >= 0
            log_count[inside] = known.log_count[place[inside]]
            rare = classes > END
            value[rare] += log_count[rare] - known.log_class[classes[rare] - END - 1]
            n = np.diff(firsts)
            base = np.add.reduceat(log_count, firsts[:-1]) - n * total
            scored = np.add.reduceat(value, firsts[:-1])
            ends_known = known.documents > 0
            n_known = np.add.reduceat((inside | ((place == -2) & ends_known)).astype(np.int64), firsts[:-1])
            others, numbers, lengths = [], [], []
            for ws in words:
                strange = Counter(w for w in ws if w not in known.place)
                others += strange.keys()
                numbers += strange.values()
                lengths.append(len(strange))
            offsets = pa.array(np.cumsum([0, *lengths]).astype(np.int32))
            items = pa.StructArray.from_arrays([pa.array(others, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])
            columns = [*batch.columns[:-1], *(pa.array(x) for x in (n.astype(np.int64), n_known, base, scored))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, items)], [f.name for f in fields])

    numbered = with_row(whole, row).select(row, "key", "held_out", body)
    fields = [f for f in numbered.schema if f.name != body]
    fields += [T.StructField(n, t) for n, t in (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()))]
    rare_word = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    fields.append(T.StructField("rest", T.ArrayType(rare_word)))
    scored = written(spark, numbered.mapInArrow(run, T.StructType(fields)), "scored")
    rest = scored.select(row, F.explode("rest").alias("x")).select(row, "x.word", "x.n")
    found = rest.join(counts, "word", "left").groupBy(row).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTHING)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
    )
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return scored.drop("rest").join(found, row, "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + more_known).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
