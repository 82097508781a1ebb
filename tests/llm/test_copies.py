import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from vecloom.llm import components, lines, simhash, suffixes


def print_of(text, size):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    path = [(k, k + 1) for k in range(300)]
    star = [(1000, k) for k in range(1001, 1200)]
    links = path + star + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)] + [(-5, 7000), (7000, 9), (3, 3)]
    rng.shuffle(links)
    found = components.components(spark, spark.createDataFrame(links, "a long, b long"))
    wanted = roots({x for l in links for x in l if l[0] != l[1]}, links)
    assert {r["node"]: r["root"] for r in found.collect()} == wanted


def test_links_connect_what_lies_within_two_bits(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:40]:
        for _ in range(4):
            values.append(v ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    values = list({v - (1 << 64) if v >> 63 else v for v in values})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "print long")).collect()
    near = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 2 for r in found)
    assert roots(values, [(r["a"], r["b"]) for r in found]) == roots(values, near)


@pytest.mark.parametrize("size", [3, 5])
def test_simhash_by_brute_force(spark, odd, odd_rows, size):
    found = {r["doc_id"]: r for r in simhash.near_copies(spark, odd, size=size).collect()}
    prints = {k: print_of(t, size) for k, t in odd_rows}
    assert {k: r["fingerprint"] & (2**64 - 1) for k, r in found.items()} == prints
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {k: r["component_id"] for k, r in found.items()} == roots(prints, near)


def test_one_of_each(spark, odd, odd_rows):
    prints = {k: print_of(t, 5) for k, t in odd_rows}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    kept = simhash.one_of_each(spark, odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == set(roots(prints, near).values())


def test_simhash_on_nothing_and_on_copies(spark, none, documents):
    assert simhash.near_copies(spark, none).count() == 0 and simhash.one_of_each(spark, none).count() == 0
    copies = documents(spark, [(7, "one two three four")] * 40 + [(None, "one two three four"), (None, None)])
    assert simhash.one_of_each(spark, copies).count() == 2
    assert {r["component_id"] for r in simhash.near_copies(spark, copies).collect()} == {7, None}


def brute_lines(rows, least):
    """(n_lines, n_equal, n_near, kept) by key."""
    order = sorted(((k is None, k or 0, n, i, l) for i, (k, t) in enumerate(rows) for n, l in enumerate((t or "").split("\n"))), key=lambda x: (x[0], x[1], x[3], x[2]))
    first = {}
    for place, x in enumerate(order):
        if len(x[4]) >= least:
            first.setdefault(x[4], place)
    near = {a for a in first for b in first if first[b] < first[a] and abs(len(a) - len(b)) <= 1 and lines.within_one(a, b)}
    out = {}
    for place, (_, _, _, i, l) in enumerate(order):
        key = rows[i][0]
        equal = l in first and first[l] != place
        drop_near = l in first and first[l] == place and l in near
        total, e, n, kept = out.get(key, (0, 0, 0, []))
        out[key] = (total + 1, e + equal, n + drop_near, kept + [l] * (not equal and not drop_near))
    return {k: (*v[:3], hashlib.sha256("\n".join(v[3]).encode()).hexdigest()) for k, v in out.items()}


def check_lines(spark, frame, rows):
    found = {r["doc_id"]: tuple(r[1:]) for r in lines.digests(spark, frame).collect()}
    assert found == brute_lines(rows, lines.MIN_CHARS)


def test_lines_by_brute_force(spark, odd, odd_rows):
    check_lines(spark, odd, odd_rows)


def test_lines_with_edits_everywhere(spark, documents):
    rng, texts = random.Random(5), []
    base = ["".join(rng.choice("ab é") for _ in range(rng.randrange(8, 40))) for _ in range(12)]
    for _ in range(80):
        parts = []
        for _ in range(3):
            line = rng.choice(base)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(line) + 1)
                line = line[:at] + rng.choice(["", "b", "日"]) + line[at + rng.randrange(2) :]
            parts.append(line)
        texts.append("\n".join(parts))
    rows = list(enumerate(texts))
    check_lines(spark, documents(spark, rows, 5), rows)


def test_edit_test():
    assert lines.within_one("abc", "abc") and lines.within_one("abc", "axc") and lines.within_one("abc", "ac") and lines.within_one("", "a")
    assert not lines.within_one("abc", "acb") and not lines.within_one("abc", "a") and not lines.within_one("ab", "xby")


def test_full_filter_changes_nothing(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(lines.LineDedup, "_filter", lambda self, x: np.full(lines.FILTER_BITS // 64, 2**64 - 1, np.uint64))
    check_lines(spark, odd, odd_rows)


def test_dropped_lines(spark, none, documents):
    assert lines.drop_lines(spark, none).count() == 0 and lines.digests(spark, none).count() == 0
    rows = [(2, "the very same line"), (1, "the very same line\nand one more line"), (3, None), (4, ""), (5, "the very same lime\n "), (None, "the very same line")]
    kept = lines.drop_lines(spark, documents(spark, rows))
    assert kept.columns[:2] == ["doc_id", "text"]
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(1, "the very same line\nand one more line"), (3, None), (4, "")}


def test_expansion_by_brute_force():
    rng = random.Random(3)
    for trial in range(150):
        least = rng.choice([1, 2, 3, 5, 8, 13, 30])
        alphabet = b"ab" if trial % 2 else bytes(range(256))
        base = bytes(rng.choice(alphabet) for _ in range(200))
        parts = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(150)
            parts.append(base[at : at + rng.randrange(60)] if rng.random() < 0.7 else bytes(rng.choice(alphabet) for _ in range(rng.randrange(60))))
        seen = Counter(p[k : k + least] for p in parts for k in range(len(p) - least + 1))
        wanted = [x for p in parts for x in [*(k + least <= len(p) and seen[p[k : k + least]] > 1 for k in range(len(p))), False]]
        assert suffixes.repeated_starts(parts, least).tolist() == wanted


def brute_repeats(rows, least):
    seen = Counter()
    for _, t in rows:
        data = (t or "").encode()
        seen.update(data[k : k + least] for k in range(len(data) - least + 1))
    out = {}
    for key, t in rows:
        data = (t or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - least + 1):
            if seen[data[k : k + least]] > 1:
                covered[k : k + least] = b"\1" * least
        kept = bytes(x for x, c in zip(data, covered) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("least", [25, 400])
@pytest.mark.parametrize("hot", [False, True])
def test_repeats_by_brute_force(spark, odd, odd_rows, least, hot):
    """With a bound of 100 bytes nearly all grams are settled by counted windows."""
    most = 100 if hot else suffixes.GROUP_BYTES
    found = {r["doc_id"]: tuple(r[1:]) for r in suffixes.digests(spark, odd, least=least, group_bytes=most).collect()}
    assert found == brute_repeats(odd_rows, least)


def test_dropped_repeats(spark, none, documents):
    assert suffixes.drop_repeats(spark, none).count() == 0 and suffixes.digests(spark, none).count() == 0
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefg é") for _ in range(300))
    rows = [(1, "é start " + passage + " end"), (2, passage), (3, "ß" + passage + "ß"), (4, None), (5, "")]
    kept = {r["doc_id"]: r["text"] for r in suffixes.drop_repeats(spark, documents(spark, rows), least=100).collect()}
    assert kept == {1: "é start  end", 3: "ßß", 4: None, 5: ""}


def test_crowds_lose_no_pair_that_meets(spark, documents, monkeypatch):
    """Windows sliding over long texts: each is alike to a few others of its crowd only, in chains and not around one text."""
    monkeypatch.setattr(simhash, "CROWD", 3)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 2, raising=False)
    # The rounds end after the second, whatever they leave over.
    monkeypatch.setattr(simhash, "ROUND_SHARE", 1e9)
    rng = random.Random(3)
    rows = []
    for _ in range(3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        rows += [" ".join(words[k : k + 100]) for k in range(0, 300, 5)]
    rng.shuffle(rows)
    bits, tables = simhash.layout(len(rows), 0.8)
    more = simhash.fingerprint_texts([t.encode() for t in rows], 5, -(-bits * tables // 64)).reshape(len(rows), -1).astype("<i8")
    short = simhash._short(more.view(np.uint8), bits, tables)
    grams = [simhash._shingles(t.encode(), 5) for t in rows]
    near = []
    for a in range(len(rows)):
        for b in range(a):
            meet = (np.bitwise_count(short[a] ^ short[b]) <= 2).any() or (int(more[a, 0]) ^ int(more[b, 0])).bit_count() <= 2
            if meet and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                near.append((b, a))
    wanted = set(roots(range(len(rows)), near).values())
    kept = simhash.one_of_each(spark, documents(spark, list(enumerate(rows))), alike=0.8)
    assert {r["doc_id"] for r in kept.collect()} == wanted
