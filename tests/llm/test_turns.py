import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from vecloom.llm import turns

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # Names that the operator uses inside.
    *(T.StructField(n, T.StringType()) for n in ("key", "row", "id", "block", "code", "digest", "audit", "_copy", "state")),
])
EMPTY = hashlib.sha256(b"").hexdigest()
BLANK = " \t\n\x0b\x0c\r"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, *("x" for _ in SCHEMA.names[4:])) for r in rows], SCHEMA).repartition(partitions)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, texts) of rows (role, text, live, cut), over all ways: state, best way to it, row by row."""
    nexts = {"": {"s", "u"}, "s": {"u"}, "u": {"a"}, "a": {"u"}}
    names = {"u": "user", "a": "assistant"}

    def with_added(ways):
        ways = dict(ways)
        for _ in range(4):
            for state, (c, audit, out) in list(ways.items()):
                for n in nexts[state] & {"u", "a"}:
                    way = (c + 2, audit + "I", out + [names[n] + ":"])
                    ways[n] = min(ways.get(n, way), way)
        return ways

    ways = {"": (0, "", [])}
    for role, text, live, cut in rows:
        after = {}
        for state, (c, audit, out) in with_added(ways).items():
            found = [(state, (c + 3, audit + "D", out))]
            if live:
                if role[:1] in nexts[state]:
                    found.append((role[:1], (c + cut, audit + "K", out + [f"{role}:{text}"])))
                found += [(n, (c + 2 + cut, audit + "R", out + [f"{names[n]}:{text}"])) for n in nexts[state] & {"u", "a"}]
            for n, way in found:
                after[n] = min(after.get(n, way), way)
        ways = after
    return min(way for state, way in with_added(ways).items() if state in ("", "a"))


def brute(originals, rows):
    out = {}
    for conv in {r[0] for r in originals}:
        own = [r[1:] for r in rows if r[0] == conv]
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            bare = text.strip(BLANK)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault not in (0, 1), int(fault == 2)))
        known = [r[0] for r in own if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, texts = cheapest(judged)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest())
    return out


def planted(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "cut", "", " \t", "Well?", None, "é日", "a.\n ", "x" * 50 + ".", "\x0b", "ok.", "." * 3])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn + 1, None, -turn]), role, text))
    return rows + [(9999, 1, "user", "alone.")] * 5


@pytest.mark.parametrize("segment_rows", [4096, 7, 1])
def test_repair_by_brute_force(spark, segment_rows):
    rows = planted(segment_rows, 60, 30)
    source = frame(spark, rows)
    repair = turns.Repair(spark, turns.damage(source), segment_rows=segment_rows)
    found = {r[0]: tuple(r[1:]) for r in turns.audits(spark, source, repair).collect()}
    assert found == brute(rows, damaged(rows))


def test_repair_without_damage_gives_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (2, 0, "assistant", "No question"), (3, 0, "user", "Hi."), (3, 1, "assistant", "Hello.")]
    repair = turns.Repair(spark, frame(spark, rows))
    found = sorted((r["key"], r["block"], r["step"], r["role"], r["text"]) for r in repair.turns().collect())
    by = {k: [(r[3], r[4]) for r in found if r[0] == k] for k in ("=1", "=2", "=3")}
    assert by["=3"] == [("user", "Hi."), ("assistant", "Hello.")]
    assert by["=1"] == [("user", "Hi."), ("assistant", ""), ("user", "Again."), ("assistant", "")] or len(by["=1"]) == 2
    assert {r["key"]: (r["cost"], r["audit"]) for r in repair.summary().collect()} == {
        "=1": cheapest([("user", "Hi.", True, 0), ("user", "Again.", True, 0)])[:2],
        "=2": cheapest([("assistant", "No question", True, 1)])[:2], "=3": (0, "KK"),
    }


def test_one_conversation_holds_all_rows(spark):
    rows = [(5, k if k % 3 else None, "user" if k % 2 else "assistant", f"turn {k % 400}.") for k in range(1500)]
    source = frame(spark, rows, 5)
    repair = turns.Repair(spark, source, segment_rows=64)
    assert repair.walked.count() > 20
    found = turns.audits(spark, source, repair).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute(rows, rows)


def test_repair_of_nothing(spark):
    none = frame(spark, [], 1)
    assert turns.audits(spark, none, turns.Repair(spark, turns.damage(none))).count() == 0
    gone = frame(spark, [(4, None, None, None)], 1)
    found = turns.audits(spark, gone, turns.Repair(spark, none)).collect()
    assert [tuple(r) for r in found] == [(4, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_checkpoints_do_not_change_the_walk():
    rng = np.random.default_rng(3)
    codes = np.array([turns._NO_ROW if rng.random() < 0.0 else rng.choice([1, 2, 3, 4, 10, 11, 18, 34]) for _ in range(400)]).reshape(8, 50)
    costs = np.tile(turns._END, (8, 1))
    walk = turns.Walk(codes, costs, np.zeros(8, np.int64), np.ones(8, bool))
    for i in range(49, -1, -1):
        costs = turns._before(codes[:, i], costs)
    cut = (codes & turns._CUT) > 0
    for s in range(8):
        mine = walk.segment == s
        letters, places = walk.letter[mine], walk.place[mine]
        cost = sum({68: 3, 73: 2, 82: 2, 75: 0}[x] + (p >= 0 and x != 68 and bool(cut[s, p])) for x, p in zip(letters, places))
        assert cost == costs[s, 0] and list(places[places >= 0]) == list(range(50))
    # A segment's matrix and the vector after it give the vector before it.
    half = turns.matrices(codes[:, :25])
    after = np.tile(turns._END, (8, 1))
    for i in range(49, 24, -1):
        after = turns._before(codes[:, i], after)
    assert np.array_equal((half + after[:, None, :]).min(axis=2), costs)
