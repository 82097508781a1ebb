"""SimHash fingerprints and near copies within two bits, by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most two bits have a third within one bit of both. Every
distinct fingerprint therefore emits itself and its 64 one-bit neighbours; those that meet
under one variant are linked. All members of such a meeting lie within two bits of each
other and number 65 at most, so links go from each member to the smallest one: the
components are those of all pairs. A meeting is kept as one bit mask while it is grouped.

Copies down to a shingle Jaccard of 0.8 differ in some ten bits of 64, out of reach of one
ball. `alike_links` therefore cuts several salted fingerprints into short ones, each with a
half-radius ball of its own, and holds the pairs that meet against their exact Jaccard.
A text whose meetings are all small is held against everyone it meets. Texts that crowd
together are held, round by round, against one text a table, first the one that most others lie near,
which the original of many copies is, until a round adds hardly any link: most texts of a crowd
are in one component by then. All pairs that meet and are still in two components are then held
against each other, in blocks of a crowd: nothing that meets is left out. How many shingles two texts
can share is bounded from counts of their hashes by bucket; only pairs whose Jaccard can be reached
leave the tasks of their blocks and have their texts compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.components import components
from vecloom.llm.dealing import PIECES, blobs, dealt, home_of, run_starts, unpacked
from vecloom.llm.numbering import numbered
from vecloom.llm.text import col, flat, helper, mixed, or_empty, spans_of, steps, written

SEED = 42
#: The share of planted pairs at just the wanted Jaccard that should meet, by the bits' chance to differ.
MEET = 0.96
#: Members of a meeting that makes its members a crowd; smaller ones give all their pairs.
CROWD = 5
#: Share of the crowds' links that a further round must add; what the rounds leave over is compared whole.
ROUND_SHARE = 0.01
#: Texts of a block of a crowd, the most blocks of one (blocks grow beyond), and pairs compared at a time.
BLOCK_ROWS, BLOCKS, PAIRS = 1024, 64, 1 << 18
#: Buckets that a text's distinct shingles are counted in, as half-bytes, and the words that hold their number and those.
BUCKETS, COUNT_WORDS = 128, 1 + 128 // 16
#: Texts that one group of a hub's verification holds against it.
HUB_ROWS = 1000
#: Pieces of members that are opened at a time.
MANY = 16
#: Ball variants that one task makes or brings together, and the least number of such tasks.
BALL_ROWS, BALL_TASKS = 1 << 20, 64
#: Groups of keys, by table and upper bits, that each such task has on average at least.
HOME_GROUPS = 64

_SALT = 0x9E3779B97F4A7C15
_LANES = np.uint64(0x0101010101010101)


def _salted(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """Fingerprints from salted hashes of the shingles; eight bits are counted in one word, 255 shingles at a time."""
    pieces = -(-counts // 255)
    begins = np.cumsum(pieces) - pieces
    cuts = np.repeat(first, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(begins, pieces))
    hashes = mixed(hashes ^ np.uint64(salt * _SALT % 2**64))
    ones = np.empty((len(counts), 8, 8), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones[:, :, k] = np.add.reduceat(lanes, begins, axis=0, dtype=np.int64)
    return np.packbits(ones.reshape(-1, 64) * 2 > counts[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def _bucket_counts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text the number of its distinct shingles, and half-bytes with their number in each bucket, 15 at most."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = run_starts(owner, hashes)
    cell = owner[first] * BUCKETS + (hashes[first] % np.uint64(BUCKETS)).astype(np.int64)
    number = np.bincount(cell, minlength=len(counts) * BUCKETS).reshape(-1, BUCKETS)
    low = np.minimum(number, 15).astype(np.uint8)
    halves = np.ascontiguousarray(low[:, ::2] | low[:, 1::2] << np.uint8(4))
    return np.concatenate([number.sum(1)[:, None], halves.view("<i8")], axis=1)


def can_be_alike(x: np.ndarray, y: np.ndarray, alike: float) -> np.ndarray:
    """Whether rows of COUNT_WORDS words leave a shingle Jaccard of `alike` or more possible; False is certain.

    Texts share no more shingles of a bucket than either has there; what full half-bytes leave out is added.
    """
    a, b = (np.ascontiguousarray(z[:, 1:]).view(np.uint8) for z in (x, y))
    halves = [(a & np.uint8(15), b & np.uint8(15)), (a >> np.uint8(4), b >> np.uint8(4))]
    both = sum(np.minimum(i, j).sum(1, dtype=np.int64) for i, j in halves)
    both += np.minimum(*(z[:, 0] - sum(h[k].sum(1, dtype=np.int64) for h in halves) for k, z in enumerate((x, y))))
    return both >= alike * (x[:, 0] + y[:, 0] - both)


def fingerprint_texts(texts: list[bytes], size: int, words: int = 1, counted: bool = False) -> np.ndarray:
    """Fingerprints of texts: a bit is set where over half of the shingles' hashes have it.

    With several `words`, one row for each text: the fingerprint and those of salted hashes. If
    `counted`, the words of `_bucket_counts` follow.
    """
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        parts = text.lower().split()
        if not parts:
            continue
        line = b" ".join(parts)
        if len(parts) <= size:
            hashes.append(digest(line, SEED))
            counts[k] = 1
            continue
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        begins = [0, *(gaps[: len(gaps) - size + 1] + 1).tolist()]
        ends = [*gaps[size - 1 :].tolist(), len(line)]
        hashes += [digest(line[a:b], SEED) for a, b in zip(begins, ends)]
        counts[k] = len(begins)
    out = np.zeros((len(texts), words + COUNT_WORDS * counted), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        whole = np.array(hashes, "<u8")
        bits = np.unpackbits(whole.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = (np.cumsum(counts) - counts)[full]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        out[full, 0] = np.packbits(ones * 2 > counts[full, None], axis=1, bitorder="little").view("<u8")[:, 0]
        for k in range(1, words):
            out[full, k] = _salted(whole, first, counts[full], k)
        if counted:
            out[full, words:] = _bucket_counts(whole, counts[full]).view(np.uint64)
    return out.view(np.int64) if words > 1 or counted else out[:, 0].view(np.int64)


def fingerprints(
    frame: DataFrame, keys: list[str], text: str, size: int, out: str, more: str | None = None, words: int = 2
) -> DataFrame:
    """The key columns and each whole text's fingerprint as a long. Null or blank text: zero.

    With a name in `more`, also all `words` fingerprints as bytes, eight for each, and the counts of the shingles.
    """
    body = helper("body")
    narrow = frame.select(*[col(k) for k in keys], or_empty(text).alias(body))
    schema = T.StructType([*[f for f in narrow.schema if f.name != body], T.StructField(out, T.LongType())])
    if more:
        schema = schema.add(more, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, body):
            data, starts = flat(batch.column(len(keys)))
            whole = data.tobytes()
            texts = [whole[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            found = fingerprint_texts(texts, size, words if more else 1, bool(more)).reshape(len(texts), -1)
            columns = [*batch.columns[:-1], pa.array(np.ascontiguousarray(found[:, 0]))]
            if more:
                columns.append(pa.array([row.tobytes() for row in found.astype("<i8")], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return narrow.mapInArrow(run, schema)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) links that connect every two values of `print` at two bits or fewer; values must be distinct."""
    bit = F.expr("shiftleft(1L, i)")
    variants = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i")).select(
        F.when(F.col("i") == 64, F.col("print")).otherwise(F.col("print").bitwiseXOR(bit)).alias("variant"),
        F.when(F.col("i") == 64, F.lit(0).cast("long")).otherwise(bit).alias("flipped"),
        (F.col("i") == 64).cast("int").alias("own"),
    )
    met = (
        variants.groupBy("variant")
        .agg(F.bit_or("flipped").alias("flipped"), F.max("own").alias("own"))
        .where(F.bit_count("flipped") + F.col("own") > 1)
    )
    members = F.expr(
        "concat(if(own = 1, array(variant), array()),"
        " transform(filter(sequence(0, 63), i -> (flipped & shiftleft(1L, i)) <> 0), i -> variant ^ shiftleft(1L, i)))"
    )
    return (
        met.select(members.alias("m"))
        .select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
        .distinct()
    )


def classes(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """(print, root) for every fingerprint in column `print` that is linked to another."""
    return components(spark, links(prints.select("print").distinct())).withColumnsRenamed({"node": "print"})


def near_copies(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per document: key, fingerprint (long) and component_id, the smallest key reachable.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Null
    keys take part but never name a component unless all its keys are null.
    """
    found = written(spark, fingerprints(documents, [key], text, size, "print"), "prints")
    first = written(spark, found.groupBy("print").agg(F.min(col(key)).alias("least")), "distinct-prints")
    linked = first.join(classes(spark, first), "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("print", "component_id")
    return found.join(named, "print").select(col(key), F.col("print").alias("fingerprint"), "component_id")


def layout(rows: int, alike: float) -> tuple[int, int]:
    """Bits of a short fingerprint and how many of them there are, for so many texts.

    The bits grow with the logarithm of the texts, so that each meets a few strangers at any
    size; the number follows from the chance that `alike` texts are within two bits.
    """
    bits = min(40, max(16, math.ceil(math.log2(max(2, rows))) + 6))
    differ = math.acos(2 * alike / (1 + alike)) / math.pi
    near = sum(math.comb(bits, k) * differ**k * (1 - differ) ** (bits - k) for k in range(3))
    return bits, math.ceil(math.log(1 - MEET) / math.log(1 - near))


def _short(more: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The short fingerprints, a column for each table, from rows of fingerprint bytes."""
    every = np.unpackbits(more, axis=1, bitorder="little")[:, : bits * tables].reshape(len(more), tables, bits)
    return every @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _low_bits(bits: int, tables: int, tasks: int) -> int:
    """Bits of a short fingerprint that its home does not follow: the others give each task HOME_GROUPS groups of keys or so."""
    return max(0, bits - math.ceil(math.log2(max(2, HOME_GROUPS * tasks / tables))))


def _balls(batches: Iterator[pa.RecordBatch], bits: int, tables: int, tasks: int) -> Iterator[pa.RecordBatch]:
    """The variants of rows (node, more, ...) as rows (code, node, the columns after it) at the homes of their keys.

    The home of a key follows its table and upper bits, so variants in a lower bit have the home of the short
    fingerprint, and are made there by `_variants`. The last bit of a code says that it is a variant itself.
    """
    low = _low_bits(bits, tables, tasks)
    flips = np.r_[np.int64(0), np.int64(1) << np.arange(low, bits, dtype=np.int64)]
    varied = (flips != 0).astype(np.int64)
    high = np.arange(tables, dtype=np.int64) << bits
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
            key = (_short(rows, bits, tables) + high)[:, :, None] ^ flips
            others = [np.repeat(part.column(k).to_numpy(), tables * len(flips)) for k in (0, *range(2, part.num_columns))]
            yield dealt(home_of(key.ravel() >> np.int64(low), tasks), tasks, ((key << np.int64(1) | varied).ravel(), *others))


def _variants(held: list[bytes], columns: int, low: int) -> Iterator[tuple[np.ndarray, ...]]:
    """All variants (key, whether it is the short fingerprint itself, the columns after it) from rows of `_balls`.

    They come in parts of about a quarter of BALL_ROWS, each of which holds all rows of its keys.
    """
    code, *others = unpacked(held, columns)
    itself = np.flatnonzero(code & 1 == 0)
    code = code >> np.int64(1)
    parts = 1 + 4 * (len(code) + low * len(itself)) // BALL_ROWS
    for part in range(parts):
        keys, places = [], []
        for flip in (0, *(1 << j for j in range(low))):
            place = itself if flip else np.arange(len(code))
            key = code[place] ^ np.int64(flip)
            if parts > 1:
                mine = home_of(key ^ np.int64(_SALT >> 1), parts) == part
                key, place = key[mine], place[mine]
            keys.append(key)
            places.append(place)
        at, own = np.concatenate(places), np.isin(places[0], itself, assume_unique=True)
        own = np.r_[own, np.zeros(len(at) - len(own), bool)].astype(np.int64)
        yield np.concatenate(keys), own, *(x[at] for x in others)


def _prints(bits: int, tables: int) -> Column:
    """The fingerprints in `more`, without the counts."""
    return F.substring("more", 1, 8 * -(-bits * tables // 64)).alias("more")


def _tasks(rows: int, bits: int, tables: int) -> int:
    return max(BALL_TASKS, rows * tables * (bits + 1) // BALL_ROWS)


def meetings(prints: DataFrame, bits: int, tables: int) -> DataFrame:
    """Who meets whom by short fingerprints within two bits, for rows (node, more): (a, b, near).

    Of texts of which one at least is in no crowd, all pairs (a, b), perhaps in both orders. Of
    each text in a crowd one row (a, null, near) with how many lie within a bit of it, over all tables.
    """
    tasks = _tasks(prints.count(), bits, tables)
    low = _low_bits(bits, tables, tasks)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _balls(batches, bits, tables, tasks)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        for key, own, node in _variants(held, 2, low):
            order = np.argsort(key, kind="stable")
            key, node, own = key[order], node[order], own[order]
            begin = run_starts(key)
            size = np.repeat(np.diff(np.r_[begin, len(key)]), np.diff(np.r_[begin, len(key)]))
            left, right = [], []
            for lag in range(1, CROWD - 1):
                same = np.flatnonzero((key[lag:] == key[:-lag]) & (size[lag:] < CROWD)) if lag < len(key) else key[:0]
                left += [node[same], node[same + lag]]
                right += [node[same + lag], node[same]]
            crowd = np.flatnonzero(size >= CROWD)
            members, place = np.unique(node[crowd], return_inverse=True)
            near = np.bincount(place, weights=size[crowd] * own[crowd], minlength=len(members)).astype(np.int64)
            a = np.concatenate([*left, members])
            b = np.concatenate([*right, np.full(len(members), -1)])
            n = np.concatenate([np.zeros(len(a) - len(members), np.int64), near])
            yield dealt(home_of(a, tasks), tasks, (a, b, n))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        a, b, n = unpacked(held, 3)
        members, place = np.unique(a[b < 0], return_inverse=True)
        near = np.bincount(place, weights=n[b < 0], minlength=len(members)).astype(np.int64)
        alone = (b >= 0) & ~np.isin(a, members)
        pairs = np.unique(np.stack([a[alone], b[alone]]), axis=1)
        none = pa.nulls(len(members), pa.int64())
        columns = [np.concatenate([pairs[0], members]), pa.concat_arrays([pa.array(pairs[1]), none])]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), columns[1], pa.array(np.concatenate([np.zeros(pairs.shape[1], np.int64), near]))], ["a", "b", "near"])

    variants = prints.select("node", _prints(bits, tables)).repartition(tasks).mapInArrow(spread, PIECES)
    met = variants.repartition(tasks, "home").mapInArrow(meet, PIECES)
    return met.repartition(tasks, "home").mapInArrow(settle, "a long, b long, near long")


def partners(members: DataFrame, bits: int, tables: int, turn: int = 0) -> DataFrame:
    """(a, b): each node b of rows (node, more, root, near) and, for each table, the node a of highest rank that it meets and that has another root.

    In turn 0 the rank is `near`. In later ones it is drawn from the node where it is needed, so that draws, which
    do not compress, change no tasks; a root does as its distance from the node, most often nothing.
    """
    tasks = _tasks(members.count(), bits, tables)
    low = _low_bits(bits, tables, tasks)

    def ranks(node: np.ndarray, near: np.ndarray) -> np.ndarray:
        if not turn:
            return near
        return (mixed(node.view(np.uint64) ^ np.uint64(turn * _SALT % 2**64)) >> np.uint64(1)).view(np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _balls(batches, bits, tables, tasks)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        for key, _, node, way, near in _variants(held, 4, low):
            root, rank = node + way, ranks(node, near)
            order = np.lexsort((node, -rank, key))
            key, node, root, near = key[order], node[order], root[order], near[order]
            begin = run_starts(key)
            group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(key)]))
            # The first of a meeting, and the first one of another root, are all that can be chosen.
            other = np.flatnonzero(root != root[begin][group])
            second = np.full(len(begin), -1)
            second[group[other[::-1]]] = other[::-1]
            chosen = np.where(root != root[begin][group], begin[group], second[group])
            able = np.flatnonzero(chosen >= 0)
            table = key[able] >> np.int64(bits)
            b, a, n = node[able], node[chosen[able]], near[chosen[able]]
            yield dealt(home_of(b, tasks), tasks, (b, table, n, a))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        b, table, near, a = unpacked(held, 4)
        order = np.lexsort((a, -ranks(a, near), table, b))
        best = order[run_starts(b[order], table[order])]
        pairs = np.unique(np.stack([a[best], b[best]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    way, near = F.col("root") - F.col("node"), F.lit(0).cast("long") if turn else F.col("near")
    variants = members.select("node", _prints(bits, tables), way.alias("way"), near.alias("near")).repartition(tasks).mapInArrow(spread, PIECES)
    met = variants.repartition(tasks, "home").mapInArrow(meet, PIECES)
    return met.repartition(tasks, "home").mapInArrow(settle, "a long, b long")


def _words(more: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(more), "<i8").reshape(len(more), -1)


def apart(members: DataFrame, bits: int, tables: int, most: int, alike: float) -> DataFrame:
    """(a, b), a < b: all nodes of rows (node, more, root) that meet, have different roots, differ in `most` bits or fewer and can be alike.

    The members of a meeting, by root, are cut into blocks, and each pair of blocks that has two roots goes to a
    task of its own: the work is that of the pairs, and no task holds more than two blocks of a meeting. What the
    members are compared by joins them after that, so it moves for those only that have someone to be compared with.
    """
    tasks = _tasks(members.count(), bits, tables)
    low_bits = _low_bits(bits, tables, tasks)
    words = -(-bits * tables // 64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _balls(batches, bits, tables, tasks)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node, known = batch.column(0).to_numpy(), _words(batch.column(1).to_pylist())
                yield of_kind(dealt(home_of(node, tasks), tasks, (node, *known.T)), 1)

    def of_kind(pieces: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*pieces.columns, pa.array(np.full(pieces.num_rows, kind))], ["home", "rows", "kind"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        for key, _, node, way in _variants(held, 3, low_bits):
            yield from blocks(key, node, node + way)

    def blocks(key: np.ndarray, node: np.ndarray, root: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((node, root, key))
        key, root = key[order], root[order]
        begin = run_starts(key)
        end = np.r_[begin[1:], len(key)]
        several = np.flatnonzero(root[begin] != root[end - 1])
        at, pair, side = [], [], []
        for low, high in zip(begin[several].tolist(), end[several].tolist()):
            count = min(BLOCKS, -(-(high - low) // BLOCK_ROWS))
            cuts = np.linspace(low, high, count + 1).astype(np.int64)
            for i in range(count):
                for j in range(i, count):
                    if root[cuts[i]] == root[cuts[j + 1] - 1]:
                        continue
                    name = hash((int(key[low]), i, j))
                    for k, mark in ((i, 2),) if i == j else ((i, 0), (j, 1)):
                        at.append(np.arange(cuts[k], cuts[k + 1]))
                        pair.append(np.full(len(at[-1]), name))
                        side.append(np.full(len(at[-1]), mark))
            if sum(map(len, at)) > BALL_ROWS:
                yield sent(at, pair, side, order, node, root)
                at, pair, side = [], [], []
        if at:
            yield sent(at, pair, side, order, node, root)

    def sent(at, pair, side, order, node, root) -> pa.RecordBatch:
        at = np.concatenate(at)
        own = node[order[at]]
        return of_kind(dealt(home_of(own, tasks), tasks, (own, np.concatenate(pair), np.concatenate(side), root[at])), 0)

    def equip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[bytes], list[bytes]] = ([], [])
        for batch in batches:
            for blob, kind in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held[kind].append(blob)
        if not held[0]:
            return
        known, *rest = unpacked(held[1], 1 + words + COUNT_WORDS)
        order = np.argsort(known, kind="stable")
        for begin in range(0, len(held[0]), MANY):
            node, pair, side, root = unpacked(held[0][begin : begin + MANY], 4)
            place = order[np.searchsorted(known, node, sorter=order)]
            for low in range(0, len(node), BALL_ROWS // 8):
                part = slice(low, low + BALL_ROWS // 8)
                yield dealt(home_of(pair[part], tasks), tasks, (pair[part], side[part], node[part], root[part], *(w[place[part]] for w in rest)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := blobs(batches)):
            return
        pair, side, node, root, *rest = unpacked(held, 4 + words + COUNT_WORDS)
        order = np.lexsort((root, pair))
        pair, side, node, root = (x[order] for x in (pair, side, node, root))
        prints, counts = np.stack(rest[:words], axis=1)[order].view(np.uint64), np.stack(rest[words:], axis=1)[order]
        first, own = run_starts(pair), run_starts(pair, root)
        # Each row meets the rows of its group that come after its own root's.
        after = np.repeat(np.r_[own[1:], len(pair)], np.diff(np.r_[own, len(pair)]))
        others = np.repeat(np.r_[first[1:], len(pair)], np.diff(np.r_[first, len(pair)])) - after
        total = np.r_[0, np.cumsum(others)]
        low = 0
        while low < len(pair):
            high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, side="right")) - 1)
            x, y = np.repeat(np.arange(low, high), others[low:high]), spans_of(after[low:high], others[low:high])
            low = high
            able = (side[x] == 2) | (side[x] != side[y])
            x, y = x[able], y[able]
            near = np.bitwise_count(prints[x] ^ prints[y]).sum(1, dtype=np.int64) <= most
            x, y = x[near], y[near]
            able = can_be_alike(counts[x], counts[y], alike)
            x, y = node[x[able]], node[y[able]]
            if len(x):
                found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    way = (F.col("root") - F.col("node")).alias("way")
    variants = members.select("node", _prints(bits, tables), way).repartition(tasks).mapInArrow(spread, PIECES)
    met = variants.repartition(tasks, "home").mapInArrow(meet, f"{PIECES}, kind long")
    known = members.select("node", "more").mapInArrow(carry, f"{PIECES}, kind long")
    equipped = met.unionByName(known).repartition(tasks, "home").mapInArrow(equip, PIECES)
    return equipped.repartition(tasks, "home").mapInArrow(compare, "a long, b long").distinct()


def _shingles(text: bytes, size: int) -> set[bytes]:
    parts = text.lower().split()
    return {b" ".join(parts[k : k + size]) for k in range(max(1, len(parts) - size + 1))} if parts else set()


def alike_pairs(pairs: DataFrame, rows: DataFrame, row: str, text: str, size: int, alike: float) -> DataFrame:
    """Those of the distinct pairs (a, b) of row numbers whose texts have a shingle Jaccard of `alike` or more.

    Pairs come in groups of one a, which is the hub if there is one. Its text is sent once for each
    HUB_ROWS or so of its partners, and theirs once for each pair; they pass by one after another.
    """
    texts = rows.select(col(row).alias("node"), or_empty(text).alias("body"))
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_ROWS).cast("long").alias("groups"))
    part = F.pmod(F.xxhash64("b"), F.col("groups"))
    others = pairs.join(groups, "a").select("a", part.alias("part"), "b").join(texts.withColumnRenamed("node", "b"), "b")
    hubs = groups.join(texts.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "body"
    )
    beside = hubs.unionByName(others.select("a", "part", "b", "body")).repartition("a", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: set[bytes] = set()
        for batch in batches:
            keep = []
            for b, body in zip(batch.column(2).to_pylist(), batch.column(3)):
                other = _shingles(body.as_py().encode(), size)
                if b is None:
                    one = other
                both = len(one & other)
                keep.append(b is not None and both >= alike * (len(one) + len(other) - both))
            yield batch.select([0, 2]).filter(pa.array(keep, pa.bool_()))

    return beside.sortWithinPartitions("a", "part", F.asc_nulls_first("b")).mapInArrow(run, "a long, b long")


def alike_links(
    spark: SparkSession, prints: DataFrame, linked: DataFrame, rows: DataFrame, row: str, text: str, size: int,
    alike: float, bits: int, tables: int,
) -> DataFrame:
    """`linked` (a, b) and links between nodes that meet and whose texts are alike.

    `prints` has the columns node (a row number), print and more. Pairs that differ in far too many of all bits
    are strangers, and so are those whose counts of shingles forbid the Jaccard. Pairs beside the crowds are held against each other whole unless they are linked; in crowds each
    text has a partner for each table and round, by nearness in the first round and by draws in later ones. The
    rounds end with the first one after the second that adds less than ROUND_SHARE to the crowds' links; then all
    pairs of a crowd that meet and are not linked yet are held against each other.
    """
    differ = math.acos(2 * alike / (1 + alike)) / math.pi
    total = 64 * -(-bits * tables // 64)
    most = int(total * differ + 6 * math.sqrt(total * differ * (1 - differ)))
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_words(batch.column(k).to_pylist()) for k in (2, 3))
            close = np.bitwise_count((x ^ y)[:, : total // 64].view(np.uint64)).sum(1, dtype=np.int64) <= most
            if x.shape[1] > total // 64:
                close &= can_be_alike(x[:, total // 64 :], y[:, total // 64 :], alike)
            yield batch.select([0, 1]).filter(pa.array(close))

    def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Those of the pairs that are alike; the rows (node, more) have counts or do without them."""
        sides = [nodes.select(F.col("node").alias(n), F.col("more").alias(m)) for n, m in (("a", "x"), ("b", "y"))]
        both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "x", "y")
        close = written(spark, both.mapInArrow(near, "a long, b long"), "pairs")
        return written(spark, alike_pairs(close, rows, row, text, size, alike), "alike")

    def rooted() -> DataFrame:
        return written(spark, components(spark, linked), "rooted")

    met = written(spark, meetings(prints.where(F.col("print") != 0), bits, tables), "met")
    root = rooted()
    left = root.select(F.col("node").alias("a"), F.col("root").alias("p"))
    right = root.select(F.col("node").alias("b"), F.col("root").alias("q"))
    pairs = met.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.join(left, "a", "left").join(right, "b", "left").where(F.coalesce("p", "a") != F.coalesce("q", "b"))
    # These are many, but few of them for each text: what joins them is kept narrow.
    linked = linked.unionByName(verified(pairs.select("a", "b"), prints.select("node", _prints(bits, tables))))
    crowd = written(spark, met.where("b is null").select(F.col("a").alias("node"), "near").join(prints.select("node", "more"), "node"), "crowd")
    tried, links_found = None, 0
    for turn in range(crowd.count()):
        members = crowd.join(rooted(), "node", "left").withColumn("root", F.coalesce("root", "node"))
        fresh = partners(members.select("node", "more", "root", "near"), bits, tables, turn)
        if tried is not None:
            fresh = fresh.join(tried, ["a", "b"], "left_anti")
        fresh = written(spark, fresh, "partners")
        tried = fresh if tried is None else tried.unionByName(fresh)
        found = verified(fresh, crowd)
        linked = linked.unionByName(found)
        count = found.count()
        links_found += count
        if turn and count <= ROUND_SHARE * links_found:
            break
    if tried is None:
        return linked
    members = crowd.join(rooted(), "node", "left").select("node", "more", F.coalesce("root", "node").alias("root"))
    rest = apart(members, bits, tables, most, alike).join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    rest = written(spark, rest, "apart")
    return linked.unionByName(written(spark, alike_pairs(rest, rows, row, text, size, alike), "alike"))


def one_of_each(
    spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, alike: float | None = None,
    pinned: bool = False,
) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest key stays.

    Fingerprints within two bits are linked; with `alike`, texts whose shingles have that
    Jaccard or more are, too. Columns stay as they are. Among equal keys the earlier row
    stays. Texts without words are copies of each other. `pinned` as in `numbering.numbered`.
    """
    row, names = helper("row"), documents.columns
    rows = numbered(spark, documents, row, pinned)
    bits, tables = layout(rows.count(), alike) if alike else (0, 0)
    more = "more" if alike else None
    found = written(spark, fingerprints(rows, [key, row], text, size, "print", more, -(-bits * tables // 64)), "prints")
    best = F.min(F.struct(col(key).isNull().alias("n"), col(key).alias("k"), col(row).alias("r"))).alias("best")
    first = written(spark, found.groupBy("print", *([more] if more else [])).agg(best), "distinct-prints")
    if alike:
        nodes = first.withColumn("node", F.col("best.r"))
        least = written(spark, nodes.groupBy("print").agg(F.min("node").alias("a")), "least")
        same = nodes.join(least, "print").where("a <> node").select("a", F.col("node").alias("b"))
        other = least.select(F.col("print").alias("b"), F.col("a").alias("q"))
        spread = least.repartition(1 + least.count() * 65 // BALL_ROWS)
        near = links(spread).join(least.select(F.col("print").alias("a"), F.col("a").alias("p")), "a").join(other, "b")
        linked = written(spark, same.unionByName(near.select(F.col("p").alias("a"), F.col("q").alias("b"))), "near")
        linked = alike_links(spark, nodes, linked, rows, row, text, size, alike, bits, tables)
        linked = nodes.join(components(spark, linked), "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        linked = first.join(classes(spark, first), "print", "left").withColumn("root", F.coalesce("root", "print"))
    kept = linked.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.r").alias(row))
    gone = written(spark, found.select(row).join(kept, row, "left_anti"), "copies")
    return rows.join(gone, row, "left_anti").select(*[col(c) for c in names])
