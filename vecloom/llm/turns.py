"""Repair of conversations: the cheapest edits after which roles read `(s?(ua)+)?`, by a checkpointed dynamic program.

The state after some turns is one of four (nothing yet, after system, user, assistant). What
it costs to finish from each state is a vector of four numbers, computed backwards. Only
every so many-th vector is kept, about the square root of their number; walking forward,
the vectors between two of them are computed again and the least letter (D, I, K, R) among
those edits is taken that lie on a cheapest way. An edit and a state give one next state, so
this is the least audit of all cheapest ones.

A conversation may be as long as the table. Turns are put in order by a range sort and cut
into segments of a bounded number of rows. A segment is a matrix of sixteen costs; only
these matrices of a long conversation are run through, backwards, to give every segment
the vector at its end, and then segments are walked by themselves, each from all states;
their four exits are run through forwards to give the state that each is entered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.numbering import numbered
from vecloom.llm.text import col, list_array, written

#: Rows of a segment; rows that one numpy step walks.
SEGMENT_ROWS, STEP_ROWS = 4096, 1 << 18
#: Costs of a changed, an added, a deleted and a truncated turn.
REROLE, INSERT, DELETE, TRUNCATED = 2, 2, 3, 1
#: White space; the ends of a whole sentence.
BLANKS, STOPS = " \t\n\x0b\x0c\r", ".!?"

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
# Kinds of roles: 1 system, 2 user, 3 assistant, 4 another one; marks of a row are added to its kind.
_CUT, _BLANK, _AGAIN, _NO_ROW = 8, 16, 32, 64
_FAR = 1 << 50
_NEXT = np.array([2, 2, 3, 2])
_KEEP = np.full((4, 5), -1)
_KEEP[0, 1], _KEEP[[0, 1, 3], 2], _KEEP[2, 3] = 1, 2, 3
_ORDERED = np.zeros((5, 5), bool)
_ORDERED[[1, 2, 3], [2, 3, 2]] = True


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs to finish when turns may be added first; two of them lead from any state to any other that can be reached."""
    for _ in range(3):
        costs = np.minimum(costs, INSERT + costs[:, _NEXT])
    return costs


#: Costs to finish after the last turn.
_END = _with_inserts(np.array([[0, _FAR, _FAR, 0]]))[0]


def _before(codes: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Costs to finish before a row, from those after it; one row and one vector for each segment."""
    kind, cut = codes & 7, ((codes & _CUT) > 0) * TRUNCATED
    target = _KEEP[:, np.minimum(kind, 4)].T
    keep = np.where(target >= 0, np.take_along_axis(costs, np.maximum(target, 0), 1), _FAR)
    live = (codes & (_BLANK | _AGAIN)) == 0
    used = np.where(live[:, None], np.minimum(keep, REROLE + costs[:, _NEXT]) + cut[:, None], _FAR)
    out = _with_inserts(np.minimum(np.minimum(used, DELETE + costs), _FAR))
    return np.where((codes == _NO_ROW)[:, None], costs, out)


def matrices(codes: np.ndarray) -> np.ndarray:
    """Costs from each state before a segment's rows to each state right after them (segments x 4 x 4)."""
    rows = np.repeat(codes, 4, axis=0)
    costs = np.tile(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(codes), 1)).astype(np.int64)
    for i in range(codes.shape[1] - 1, -1, -1):
        costs = _before(rows[:, i], costs)
    return costs.reshape(len(codes), 4, 4).transpose(0, 2, 1)


class Walk:
    """The edits of some segments: `letter`, `place` (-1 if added) and `role` (0 its own, 1 user, 2 assistant), by segment."""

    def __init__(self, codes: np.ndarray, after: np.ndarray, enter: np.ndarray, last: np.ndarray):
        """Codes (segments x places, short ones filled up), costs after each, the states they are entered in, whether it ends a conversation."""
        self.state = enter.astype(np.int64).copy()
        self.events: list[tuple[np.ndarray, ...]] = []
        size = codes.shape[1]
        step = max(1, int(np.sqrt(size)))
        checkpoints, costs = {size: after}, after
        for i in range(size - 1, -1, -1):
            costs = _before(codes[:, i], costs)
            if i % step == 0:
                checkpoints[i] = costs
        for begin in range(0, size, step):
            end = min(begin + step, size)
            block = [checkpoints[end]]
            for i in range(end - 1, begin, -1):
                block.append(_before(codes[:, i], block[-1]))
            block.append(checkpoints[begin])
            for i in range(begin, end):
                self._row(i, codes[:, i], block[end - i], block[end - i - 1])
        # What is still to be added after a conversation's last row.
        at = np.flatnonzero(last)
        while len(at := at[after[at, self.state[at]] > 0]):
            self._add(at, size)
        found = [np.concatenate(x) for x in zip(*self.events)] if self.events else [np.zeros(0, np.int64)] * 4
        order = np.argsort(found[0], kind="stable")
        self.segment, self.letter, self.place, self.role = (x[order] for x in found)

    def _emit(self, at: np.ndarray, letter: str, place: int, role: np.ndarray | int) -> None:
        n = len(at)
        self.events.append((at, np.full(n, ord(letter), np.uint8), np.full(n, place), np.broadcast_to(np.asarray(role, np.int8), n)))

    def _add(self, at: np.ndarray, place: int) -> None:
        self.state[at] = _NEXT[self.state[at]]
        self._emit(at, "I", -1, self.state[at] - 1)

    def _row(self, i: int, codes: np.ndarray, here: np.ndarray, after: np.ndarray) -> None:
        at = np.flatnonzero(codes != _NO_ROW)
        while len(at):
            state = self.state[at]
            cost = here[at, state]
            gone = cost == DELETE + after[at, state]
            added = ~gone & (cost == INSERT + here[at, _NEXT[state]])
            rest = at[~gone & ~added]
            self._emit(at[gone], "D", i, 0)
            if len(rest):
                state, code = self.state[rest], codes[rest]
                target = _KEEP[state, np.minimum(code & 7, 4)]
                cut = ((code & _CUT) > 0) * TRUNCATED
                kept = (target >= 0) & (here[rest, state] == cut + after[rest, np.maximum(target, 0)])
                self.state[rest] = np.where(kept, target, _NEXT[state])
                self._emit(rest[kept], "K", i, 0)
                self._emit(rest[~kept], "R", i, self.state[rest[~kept]] - 1)
            at = at[added]
            if len(at):
                self._add(at, i)


def _padded(flat: np.ndarray, sizes: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    out = np.full((len(which), int(sizes[which].max(initial=0))), _NO_ROW, np.int64)
    for k, w in enumerate(which):
        out[k, : sizes[w]] = flat[starts[w] : starts[w] + sizes[w]]
    return out


def _groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Segments of like sizes, so that few places are filled up."""
    order, begin = np.argsort(sizes, kind="stable"), 0
    while begin < len(order):
        room = max(1, STEP_ROWS // max(1, 2 * int(sizes[order[begin]])))
        end = min(begin + room, int(np.searchsorted(sizes[order], 2 * sizes[order[begin]], side="right")))
        yield order[begin : max(end, begin + 1)]
        begin = max(end, begin + 1)


class _Segments:
    """Columns key, block, rows (of structs with id and code) of one batch, and what else stands behind them."""

    def __init__(self, batch: pa.RecordBatch):
        rows = batch.column(2)
        self.starts = rows.offsets.to_numpy().astype(np.int64)
        self.sizes = np.diff(self.starts)
        items = rows.values
        self.codes, self.ids = items.field("code").to_numpy().astype(np.int64), items.field("id")
        self.starts = self.starts[:-1]


def _spans(codes: np.ndarray) -> np.ndarray:
    """Neighbours whose roles may not follow each other, for each segment."""
    kinds = codes & 7
    real = codes[:, 1:] != _NO_ROW
    return (~_ORDERED[np.minimum(kinds[:, :-1], 4), np.minimum(kinds[:, 1:], 4)] & real).sum(axis=1)


def damage(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns with planted faults: some missing, emptied, without stops, repeated or with the role of a user.

    crc32 of `conversation:turn`, modulo 20, decides; a null counts as one space, in the
    key and as role and text. Only the four columns are returned.
    """
    named = {n: F.coalesce(col(n).cast("string"), F.lit(" ")) for n in (conversation, turn, role, text)}
    fault = F.crc32(F.concat(named[conversation], F.lit(":"), named[turn]).cast("binary")) % 20
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    new_text = F.when(fault == 1, "").when(fault == 2, F.translate(named[text], STOPS, "")).otherwise(named[text])
    new_role = F.when(fault == 4, "user").otherwise(named[role])
    return turns.select(
        col(conversation), col(turn), new_role.alias(role), new_text.alias(text), F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")
    ).drop("_copy")


def _key(conversation: str) -> Column:
    """A text for each conversation; the empty one for null."""
    return F.coalesce(F.concat(F.lit("="), col(conversation).cast("string")), F.lit(""))


class Repair:
    """Faults and cheapest edits of the conversations of a table.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text stood
    earlier in the conversation), truncated (the last character that is not blank is no
    `.`, `!` or `?`). Kept rows cost nothing, a changed role (to user or assistant) 2, a
    deleted row, as blank and duplicate ones must be, 3, an added empty turn of a
    user or assistant 2; a truncated row that stays adds 1. Rows come by turn, null first, and
    among equal turns by role and by a digest of the text. A null role or text is one
    space; rows of a null conversation are one conversation. An empty table gives nothing.
    Other columns are not read.
    """

    def __init__(
        self, spark: SparkSession, turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        segment_rows: int = SEGMENT_ROWS,
    ):
        self.spark = spark
        space = F.lit(" ")
        named = turns.select(
            _key(conversation).alias("key"), col(turn).alias("turn"),
            F.coalesce(col(role), space).alias("role"), F.coalesce(col(text), space).alias("text"),
        )
        self.rows = numbered(spark, named, "id")
        self.walked = self._walked(self._segments(segment_rows))

    def _segments(self, segment_rows: int) -> DataFrame:
        """(key, block, rows): the rows of a conversation in order, at most so many in a block."""
        initial, trimmed = F.substring("role", 1, 1), F.rtrim(F.col("text"), F.lit(BLANKS))
        kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
        cut = F.when(F.substring(trimmed, -1, 1).isin(*STOPS), 0).otherwise(_CUT)
        whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
        narrow = self.rows.select(
            "key", "turn", "role", "id", F.unhex(F.sha2(whole, 256)).alias("digest"), (kind + F.when(trimmed == "", _BLANK).otherwise(cut)).alias("code")
        )
        order = ["key", F.asc_nulls_first("turn"), "role", "digest", "id"]
        ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "role")
        ordered = numbered(self.spark, ordered, "row")
        # Of equal rows only the first one counts; rows that stand alone meet nothing here.
        first = ordered.groupBy("key", "digest").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
        again = (F.col("row") > F.col("first")) & (F.col("code") < _BLANK)
        code = F.when(again, F.col("code").bitwiseAND(F.lit(7)) + _AGAIN).otherwise(F.col("code"))
        marked = ordered.join(first, ["key", "digest"], "left").select("key", "row", "id", code.cast("int").alias("code"))
        found = marked.groupBy("key", F.expr(f"row div {segment_rows}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("row", "id", "code"))).alias("rows"))
        return written(self.spark, found, "segments")

    def _walked(self, segments: DataFrame) -> DataFrame:
        """Every segment with its counts, its audit and its edits but the deleted rows."""
        several = segments.groupBy("key").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key")
        parts = written(self.spark, segments.join(several, "key", "left_semi"), "parts")
        after = written(self.spark, self._after(parts), "after")
        entered = self._entered(parts.join(after, ["key", "block"]))
        guided = segments.join(written(self.spark, after.join(entered, ["key", "block"]), "guides"), ["key", "block"], "left")
        edit = T.StructType([T.StructField("id", T.LongType()), T.StructField("role", T.ByteType())])
        schema = T.StructType([
            T.StructField("key", T.StringType()), T.StructField("block", T.LongType()),
            *(T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")),
            T.StructField("audit", T.StringType()), T.StructField("edits", T.ArrayType(edit)),
        ])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = _Segments(batch)
                guide = batch.column(3).to_pylist()
                for which in _groups(part.sizes):
                    codes = _padded(part.codes, part.sizes, part.starts, which)
                    after = np.array([_END if guide[w] is None else guide[w] for w in which], np.int64).reshape(-1, 4)
                    enter, joint, last = (batch.column(k).fill_null(v).to_numpy(zero_copy_only=False)[which] for k, v in ((4, 0), (5, 0), (6, True)))
                    walk = Walk(codes, after, enter, last)
                    counts = [((codes & _BLANK) > 0).sum(1), ((codes & _AGAIN) > 0).sum(1), ((codes & _CUT) > 0).sum(1), _spans(codes) + joint]
                    stays = walk.letter != ord("D")
                    cost = np.where(stays, INSERT, DELETE) * (walk.letter != ord("K"))
                    held = stays & (walk.place >= 0)
                    cost[held] += TRUNCATED * ((codes[walk.segment[held], walk.place[held]] & _CUT) > 0)
                    sums = np.bincount(walk.segment, weights=cost, minlength=len(which)).astype(np.int64)
                    letters = walk.letter.tobytes().decode()
                    ends = np.searchsorted(walk.segment, np.arange(len(which) + 1))
                    audits = [letters[a:b] for a, b in zip(ends[:-1], ends[1:])]
                    owner, place = walk.segment[stays], walk.place[stays]
                    at = np.where(place >= 0, part.starts[which][owner] + place, 0)
                    ids = pc.if_else(pa.array(place >= 0), part.ids.take(pa.array(at)), pa.scalar(None, pa.int64()))
                    edits = pa.StructArray.from_arrays([ids, pa.array(walk.role[stays].astype(np.int8))], edit.names)
                    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(which) + 1)).astype(np.int32)), edits)
                    head = [batch.column(k).take(pa.array(which)) for k in (0, 1)]
                    numbers = [pa.array(np.asarray(x, np.int64)) for x in (*counts, sums)]
                    yield pa.RecordBatch.from_arrays([*head, *numbers, pa.array(audits, pa.string()), lists], schema.names)

        return written(self.spark, guided.select("key", "block", "rows", "after", "state", "joint", "last").mapInArrow(run, schema), "walked")

    def _after(self, parts: DataFrame) -> DataFrame:
        """(key, block, after, last): the costs to finish after each segment of the long conversations."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = _Segments(batch)
                for which in _groups(part.sizes):
                    codes = _padded(part.codes, part.sizes, part.starts, which)
                    found = list_array(matrices(codes).reshape(-1), np.arange(len(which) + 1) * 16)
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(which)) for k in (0, 1)), found], ["key", "block", "costs"])

        def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, after = None, _END
            for batch in batches:
                out, ends = [], []
                for key, costs in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    ends.append(key != held)
                    held, after = key, _END if key != held else after
                    out.append(after.tolist())
                    after = np.minimum((np.array(costs).reshape(4, 4) + after).min(axis=1), _FAR)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64())), pa.array(ends, pa.bool_())], ["key", "block", "after", "last"])

        costs = parts.select("key", "block", "rows").mapInArrow(run, "key string, block long, costs array<long>")
        return costs.repartition("key").sortWithinPartitions("key", F.desc("block")).mapInArrow(back, "key string, block long, after array<long>, last boolean")

    def _entered(self, parts: DataFrame) -> DataFrame:
        """(key, block, state, joint): the state each segment is entered in, and whether roles may not follow there."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = _Segments(batch)
                after = np.array(batch.column(3).to_pylist(), np.int64).reshape(-1, 4)
                for which in _groups(part.sizes):
                    codes = np.repeat(_padded(part.codes, part.sizes, part.starts, which), 4, axis=0)
                    walk = Walk(codes, np.repeat(after[which], 4, axis=0), np.tile(np.arange(4), len(which)), np.zeros(len(codes), bool))
                    exits = list_array(walk.state, np.arange(len(which) + 1) * 4)
                    edges = [pa.array(part.codes[x[which]] & 7) for x in (part.starts, part.starts + part.sizes - 1)]
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(which)) for k in (0, 1)), exits, *edges], ["key", "block", "exits", "first", "final"])

        def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, state, role = None, 0, 0
            for batch in batches:
                states, joints = [], []
                for key, exits, first, final in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                    joints.append(int(key == held and not _ORDERED[role, first]))
                    state = state if key == held else 0
                    states.append(state)
                    held, state, role = key, exits[state], final
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(states, pa.int64()), pa.array(joints, pa.int64())], ["key", "block", "state", "joint"])

        exits = parts.select("key", "block", "rows", "after").mapInArrow(run, "key string, block long, exits array<long>, first long, final long")
        return exits.repartition("key").sortWithinPartitions("key", "block").mapInArrow(forth, "key string, block long, state long, joint long")

    def turns(self) -> DataFrame:
        """(key, block, step, role, text): the repaired turns, in the order of block and step; key is a text for the conversation."""
        edits = self.walked.select("key", "block", F.posexplode("edits").alias("step", "edit")).select(
            "key", "block", "step", F.col("edit.id").alias("id"), F.col("edit.role").alias("new")
        )
        own = self.rows.select("id", F.col("role").alias("own"), "text")
        role = F.when(F.col("new") == 1, "user").when(F.col("new") == 2, "assistant").otherwise(F.col("own"))
        return edits.join(own, "id", "left").select("key", "block", "step", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def digests(self) -> DataFrame:
        """(key, repaired_sha256) of `role:text`, joined by line feeds; a conversation's turns run through one hash, none is held."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, state, done = None, None, []
            for batch in batches:
                for key, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if key != held:
                        if state is not None:
                            done.append((held, state.hexdigest()))
                        held, state = key, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(piece.as_buffer())
                if done:
                    yield _pairs(done)
                    done = []
            if state is not None:
                yield _pairs([(held, state.hexdigest())])

        pieces = self.turns().select("key", "block", "step", F.concat("role", F.lit(":"), "text").alias("piece"))
        ordered = pieces.repartition("key").sortWithinPartitions("key", "block", "step")
        return ordered.select("key", "piece").mapInArrow(run, "key string, repaired_sha256 string")

    def summary(self) -> DataFrame:
        """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has rows."""
        seen = self.rows.groupBy("key", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
        )
        counts = ("blank", "duplicate", "truncated", "illegal", "cost")
        pieces = F.array_sort(F.collect_list(F.struct("block", "audit")))
        found = self.walked.groupBy("key").agg(
            *(F.sum(n).alias(n) for n in counts), F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit")
        )
        return seen.join(found, "key")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)], ["key", "repaired_sha256"])


def audits(spark: SparkSession, originals: DataFrame, repair: Repair, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation of `originals`: faults, cost and audit of its repair and a digest of what it reads then.

    A conversation that the repair knows no rows of has zeros, an empty audit and the digest of nothing.
    """
    ids = originals.select(_key(conversation).alias("key"), col(conversation)).distinct()
    joined = ids.join(repair.summary(), "key", "left").join(repair.digests(), "key", "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(col(conversation), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
