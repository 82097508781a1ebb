import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from test_copies import print_of
from vecloom.llm import simhash


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[k : k + 5]) for k in range(len(words) - 4)}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_planted_copies_go(spark):
    """Word edits that leave a Jaccard of 0.8 to 0.95; the stage at two bits linked a few of them only."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rows, planted, strangers = [], [], []
    for k in range(300):
        text = [rng.choice(words) for _ in range(rng.randrange(150, 600))]
        copy = list(text)
        for _ in range(rng.randrange(1, 3 + len(text) // 45)):
            copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(10**6)
        alike = jaccard(" ".join(text), " ".join(copy))
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(copy))]
        planted += [2 * k + 1] if 0.8 <= alike <= 0.95 else []
        strangers += [2 * k + 1] if alike < 0.8 else []
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    after = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert len(planted) > 100 and {2 * k for k in range(300)} <= after
    assert sum(k not in after for k in planted) >= 0.95 * len(planted)
    # Below 0.8 nothing goes but by the two bits.
    two = [k for k in strangers if (print_of(rows[k][1], 5) ^ print_of(rows[k - 1][1], 5)).bit_count() > 2]
    assert set(two) <= after


def test_large_group_of_copies(spark):
    """A group that shares most short fingerprints: every member is alike to the first text."""
    rng = random.Random(4)
    text = ["w%d" % rng.randrange(5000) for _ in range(400)]
    rows = [(0, " ".join(text))]
    for k in range(1, 200):
        copy = list(text)
        for _ in range(4):
            copy[rng.randrange(400)] = "e%d" % rng.randrange(10**6)
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [0]


def test_first_fingerprint_stays_and_salted_ones_count_bits():
    rng = random.Random(5)
    texts = [" ".join("v%d" % rng.randrange(90) for _ in range(n)).encode() for n in (0, 1, 4, 5, 6, 300, 2000)]
    found = simhash.fingerprint_texts(texts, 5, 3)
    assert (found[:, 0] == simhash.fingerprint_texts(texts, 5)).all()
    hashes = np.array([rng.getrandbits(64) for _ in range(700)], np.uint64)
    first, counts = np.array([0, 10, 600]), np.array([10, 590, 100])
    salted = simhash.mixed(hashes ^ np.uint64(2 * simhash._SALT % 2**64)).tolist()
    wanted = [
        sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in salted[f : f + n]) > n)
        for f, n in zip(first.tolist(), counts.tolist())
    ]
    assert simhash._salted(hashes, first, counts, 2).tolist() == wanted


def test_counts_never_forbid_a_jaccard_that_is_reached():
    """Texts of a few words, repeats, and buckets beyond fifteen; the bound is checked against the exact sets."""
    rng = random.Random(6)
    texts = []
    for n in (1, 3, 5, 9, 60, 400, 400, 5000):
        words = ["v%d" % rng.randrange(3 * n) for _ in range(n)]
        for edits in (0, 0, 1, n // 60, n // 30, n // 20):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(n)] = "e%d" % rng.randrange(10**6)
            texts.append(" ".join(copy))
    texts.append("again and again " * 40)
    counts = simhash.fingerprint_texts([t.encode() for t in texts], 5, 2, True)[:, 2:]
    sets = [simhash._shingles(t.encode(), 5) for t in texts]
    assert counts[:, 0].tolist() == [len(s) for s in sets]
    x, y = np.triu_indices(len(texts))
    for alike in (0.3, 0.8, 0.95):
        exact = np.array([len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= alike for a, b in zip(x.tolist(), y.tolist())])
        able = simhash.can_be_alike(counts[x], counts[y], alike)
        assert able[exact].all() and not able[~exact].all()


def test_a_crowd_that_is_not_alike_sends_no_pairs(spark, monkeypatch):
    """Texts that meet by their fingerprints, but with a Jaccard of about a half, are told apart before texts move."""
    sent, whole = [], simhash.alike_pairs

    def counted(pairs, *others):
        sent.append(pairs.count())
        return whole(pairs, *others)

    monkeypatch.setattr(simhash, "alike_pairs", counted)
    rng = random.Random(8)
    text = ["w%d" % rng.randrange(5000) for _ in range(200)]
    rows = []
    for k in range(150):
        copy = list(text)
        for place in range(rng.randrange(20), 200, 26):
            copy[place] = "e%d" % rng.randrange(10**6)
        rows.append((k, " ".join(copy)))
    alike = [jaccard(rows[a][1], rows[b][1]) for a in range(150) for b in range(a)]
    assert max(alike) < 0.8 and np.median(alike) > 0.4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == 150
    assert sum(sent) < 300


def test_variants_in_low_bits_are_made_at_the_homes_of_their_keys(monkeypatch):
    """Under half of the variants change tasks, each key has one home, and nothing is missing there."""
    bits, tables, tasks, n = 18, 3, 5, 90
    low = simhash._low_bits(bits, tables, tasks)
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**63, (n, 1))
    words[n // 2 :] = words[: n // 2] ^ (1 << rng.integers(0, 54, (n // 2, 1)))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n) << 33), pa.array([w.tobytes() for w in words]), pa.array(np.arange(n))], ["node", "more", "way"])
    pieces = [p for balls in simhash._balls([batch], bits, tables, tasks) for p in balls.to_pylist()]
    assert sum(len(p["rows"]) // 24 for p in pieces) == n * tables * (1 + bits - low) < n * tables * (1 + bits) / 2
    monkeypatch.setattr(simhash, "BALL_ROWS", 200)
    found, homes = [], {}
    for home in range(tasks):
        parts = list(simhash._variants([p["rows"] for p in pieces if p["home"] == home], 3, low))
        assert len(parts) > 1
        for k, (key, own, node, way) in enumerate(parts):
            found += zip(key.tolist(), own.tolist(), node.tolist(), way.tolist())
            assert all(homes.setdefault(x, (home, k)) == (home, k) for x in key.tolist())
    short = simhash._short(words.view(np.uint8), bits, tables) + (np.arange(tables) << bits)
    wanted = [(int(c) ^ f, int(not f), i << 33, i) for i in range(n) for c in short[i] for f in (0, *(1 << j for j in range(bits)))]
    assert sorted(found) == sorted(wanted)


def test_partners_and_meetings_are_those_of_all_pairs(spark):
    """Members of one crowd and strangers, held against brute force: who meets, who has a partner, who is compared whole."""
    bits, tables, n = 16, 2, 240
    rng = np.random.default_rng(6)
    words = rng.integers(0, 2**63, n)
    words[:200] = words[0] ^ (1 << rng.integers(0, 32, 200)) ^ (1 << rng.integers(0, 32, 200))
    words[200:210] = words[210:220] ^ 1
    short = simhash._short(words.view(np.uint8).reshape(n, 8), bits, tables)
    meet = (np.bitwise_count(short[:, None] ^ short[None]) <= 2).any(2)
    nodes = [(k, words[k].tobytes(), k % 3 if k < 200 else k, int(k % 7)) for k in range(n)]
    frame = spark.createDataFrame(nodes, "node long, more binary, root long, near long").repartition(3)
    found = simhash.meetings(frame.select("node", "more"), bits, tables).collect()
    crowd = {r["a"] for r in found if r["b"] is None}
    assert set(range(200)) >= crowd and len(crowd) > 150
    pairs = {(r["a"], r["b"]) for r in found if r["b"] is not None}
    assert {(200 + k, 210 + k) for k in range(10)} <= pairs and all(meet[p] for p in pairs)
    assert all((a, b) in pairs for a in range(n) for b in range(n) if a != b and meet[a, b] and a not in crowd)
    root = [x[2] for x in nodes]
    apart = {b for b in range(n) for a in range(n) if meet[a, b] and root[a] != root[b]}
    for turn in (0, 1, 2):
        partners = {(r["a"], r["b"]) for r in simhash.partners(frame, bits, tables, turn).collect()}
        assert all(meet[p] and root[p[0]] != root[p[1]] for p in partners)
        assert {b for _, b in partners} == apart
        drawn = partners if turn == 1 else drawn if turn else None
    assert drawn != partners
