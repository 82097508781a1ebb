import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.llm import lm, projections, sharding, sketch, toxicity


def test_base_scores_by_brute_force(spark, odd, odd_rows):
    found = {r["doc_id"]: r for r in lm.score(spark, odd).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in odd_rows}
    tokens = {k: [*(t or "").encode().lower().split(), None] for k, t in odd_rows}
    counts = Counter(w for k, _ in odd_rows if not held[k] for w in tokens[k])
    total, distinct = sum(counts.values()), len(counts)
    for key, own in tokens.items():
        r = found[key]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[key], len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_words_beyond_the_known_ones_meet_their_counts(spark, odd, monkeypatch):
    whole = {r["doc_id"]: r for r in lm.score(spark, odd).collect()}
    monkeypatch.setattr(lm, "KNOWN_BYTES", 0)
    for r in lm.score(spark, odd).collect():
        assert r["n_known"] == whole[r["doc_id"]]["n_known"]
        assert r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"], rel=1e-9)


def test_scores_of_nothing(spark, none, documents):
    assert lm.score(spark, none).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    row = lm.score(spark, documents(spark, [(held, "unseen words")])).collect()[0]
    assert (row["n_known"], row["train_tokens"]) == (0, 0) and row["score"] < 0


def vocabulary(texts):
    counts = Counter(w for t in texts for w in lm.split(t))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    tokens, words = np.zeros(lm.ENDINGS), np.zeros(lm.ENDINGS)
    for w, c in top[lm.WORDS :]:
        tokens[lm.ending(w)] += c
        words[lm.ending(w)] += 1
    return lm.Vocabulary(sum(counts.values()) + len(texts), len(counts) + 1, len(texts), {w: k for k, (w, _) in enumerate(top)}, np.array([c for _, c in top], float), tokens, words)


def test_probabilities_add_up_and_training_helps(spark, sf_dir):
    texts = [r["text"].encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(500).collect()]
    known = vocabulary(texts[:400])
    model = lm.Model(known.noise)

    def loss():
        first, second, sums = model.tables()
        classes, _, firsts, _ = known.codes(texts[400:])
        one, two = known.contexts(classes, firsts)
        return -(first[one, classes] + second[two, classes] - sums[one, two]).mean()

    before = loss()
    classes, _, firsts, _ = known.codes(texts[:400])
    one, two = known.contexts(classes, firsts)
    for k in range(0, len(classes), lm.BATCH):
        model.train(one[k : k + lm.BATCH], two[k : k + lm.BATCH], classes[k : k + lm.BATCH])
    assert loss() < before
    first, second, sums = (x.astype(float) for x in model.tables())
    for c1, c2 in ((0, 5), (lm.START, lm.START), (900, 3)):
        assert (10 ** (first[c1] + second[c2] - sums[c1, c2])).sum() == pytest.approx(1, abs=1e-4)
    # Within an ending, the seen words and one unseen word share the class.
    share = (known.ending_tokens + 0.1 * known.ending_words + 0.1) / 10**known.log_class
    assert np.allclose(share, 1)


def grams(text):
    data = b" " + bytes(32 if c in (9, 10, 11, 12, 13) else c for c in (text or "").encode().lower()) + b" "
    return {(n, data[k : k + n]) for n in toxicity.ORDERS for k in range(len(data) - n + 1)}


def test_grams_by_brute_force(odd_rows):
    import pyarrow as pa

    from vecloom.llm.text import flat

    texts = [t for _, t in odd_rows if len(t or "") < 3000]
    owner, cell = toxicity.buckets(*flat(pa.array(texts)))
    by_gram = {}
    for k, text in enumerate(texts):
        own = set(cell[owner == k].tolist())
        assert len(own) <= len(grams(text)) <= len(own) * 1.02 + 2
        alone = toxicity.buckets(*flat(pa.array([text])))[1]
        assert own == set(alone.tolist())
        by_gram[text] = own
    keep = np.arange(toxicity.BUCKETS, dtype=np.int32)
    assert (toxicity.buckets(*flat(pa.array(texts)), keep)[1] == cell).all()


def test_held_out_toxicity(spark, sf_dir):
    from vecloom.llm.queries import QUERIES

    folder = sf_dir.replace("sf0.01", "sf0.1")
    found = QUERIES["op3_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    bad, good = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([b > g for b in bad for g in good]) > 0.96
    assert sum(r["predicted"] and not r["toxic"] for r in rows) < 0.02 * len(good)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxicity_of_odd_texts(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(k, int(bool(t) and "many documents" in t)) for k, t in odd_rows] + [(None, 1), (-20, None), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(spark, odd, labels)
    rows = toxicity.score(spark, odd, model, ["doc_id"]).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.drop_toxic(spark, odd, model)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["score"] < 0.7}
    for train_on, marks in ((odd, labels.limit(0)), (none, labels), (odd, labels.where("toxic = 0"))):
        blank = toxicity.train(spark, train_on, marks)
        assert len({r["score"] for r in toxicity.score(spark, odd, blank, ["doc_id"]).collect()}) == 1
    assert toxicity.score(spark, none, model, ["doc_id"]).count() == 0


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_sketches(odd, odd_rows, monkeypatch):
    import pyarrow as pa

    from vecloom.llm.text import flat

    whole = flat(pa.array([t for _, t in odd_rows]))
    code, starts = sketch.sketch(*whole)
    found = {r["doc_id"]: [x % 2**64 for x in r["sketch"]] for r in sketch.sketches(odd, ["doc_id"]).collect()}
    assert all(found[k] == code[a:b].tolist() for (k, _), a, b in zip(odd_rows, starts, starts[1:]))
    threshold = int(sketch.THRESHOLD)
    monkeypatch.setattr(sketch, "THRESHOLD", np.uint64(2**64 - 1))
    code, starts = sketch.sketch(*whole)
    every = {k: set(code[a:b].tolist()) for (k, _), a, b in zip(odd_rows, starts, starts[1:])}
    for key, text in odd_rows:
        assert len(every[key]) == len(shingles(text))
        assert set(found[key]) == {x for x in every[key] if x < threshold or x == min(every[key])}
        for other, text2 in odd_rows:
            assert len(every[key] & every[other]) == len(shingles(text) & shingles(text2))


def test_sketch_columns(spark):
    frame = spark.createDataFrame([([1, 5], [5, 9]), ([], []), ([], [4]), ([-3], [-9])], "a array<long>, b array<long>")
    rows = frame.select(sketch.likeness(F.col("a"), F.col("b")).alias("l"), sketch.contained(F.col("a"), F.col("b")).alias("c"), sketch.merged(F.col("a"), F.col("b")).alias("m")).collect()
    assert [(r["l"], r["c"]) for r in rows] == [(1 / 3, 0.5), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    assert [sorted(r["m"]) for r in rows] == [[1, 5, 9], [], [4], [-9]]


@pytest.mark.parametrize("block", [4, 1000])
def test_edited_texts(spark, odd, odd_rows, block, monkeypatch):
    monkeypatch.setattr(sketch, "BLOCK_ROWS", block)
    found = {r["doc_id"]: r for r in sketch.fingerprint_edits(spark, odd).collect()}
    ordered = sorted(odd_rows)
    assert len(found) == len(ordered)
    prints = {}
    for k, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        r = found[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - n] + following[:n]).encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == following:
            assert r["near_next"] == 1


def test_edits_of_few_rows(spark, none, documents):
    assert sketch.fingerprint_edits(spark, none).count() == 0
    one = sketch.fingerprint_edits(spark, documents(spark, [(5, "abcdefgh")])).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    rows = sketch.fingerprint_edits(spark, documents(spark, [(None, "abcdefgh"), (None, "ijklmnop"), (1, "12345678")])).collect()
    assert {(r["doc_id"], r["edited_sha256"]) for r in rows} == {
        (k, hashlib.sha256(t).hexdigest()) for k, t in ((1, b"123456ab"), (None, b"abcdefij"), (None, b"ijklmn12"))
    }
    assert sketch.fingerprint_edits(spark, documents(spark, [(None, "abcdefgh"), (None, None)])).count() == 2


def test_shards(spark, odd, odd_rows, none, documents):
    rows = sharding.assign(spark, odd, shards=7).collect()
    sizes = {k: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in odd_rows}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == sizes
    assert sharding.assign(spark, none).count() == 0
    many = sharding.assign(spark, documents(spark, [(k, "t") for k in range(4000)] + [(5, "t")] * 3000 + [(None, None)] * 7), shards=40).collect()
    by_shard = {}
    for r in many:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values()) and set(by_shard) <= set(range(40))
    assert len({r["shard"] for r in many if r["doc_id"] == 5}) == 1
    moved = sum(r["grown_shard"] == 40 for r in {x["doc_id"]: x for x in many}.values())
    assert 40 < moved < 200


def test_shards_by_weight(spark):
    leaves = [sharding.Leaf(0, 0, 0, 1.0), sharding.Leaf(0, 0, 1, 3.0), sharding.Leaf(0, 1, 2, 4.0), sharding.Leaf(1, 2, 3, 8.0), sharding.Leaf(1, 2, 4, 0.0)]
    heavier = [*leaves[:3], sharding.Leaf(1, 2, 3, 16.0)]
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    rows = sharding.place(sharding.place(keys, "k", leaves, "s"), "k", heavier, "t").collect()
    counts = Counter(r["s"] for r in rows)
    assert set(counts) == {0, 1, 2, 3}
    for leaf in leaves[:4]:
        assert counts[leaf.shard] / 20_000 == pytest.approx(leaf.weight / 16, rel=0.1)
    assert all(r["t"] == 3 for r in rows if r["s"] != r["t"])


def exact(vectors, queries, k):
    out = {}
    for q in queries:
        found = sorted((math.sqrt(((np.array(v) - np.array(vectors[q][1])) ** 2).sum()), i, n) for n, (i, v) in enumerate(vectors) if n != q)
        out[q] = found[:k]
    return out


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(projections, "BLOCK_ROWS", 300)
    monkeypatch.setattr(projections, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [(k, (centres[k % 20] + 0.3 * rng.normal(size=16)).tolist(), "x") for k in range(2000)]
    rows += [(2000 + k, [1.0] * 16, "x") for k in range(500)]
    rows += [(5000, None, "x"), (5100, [], "x"), (5200, [0.0] * 16, "x"), (5300, [None] * 16, "x"), (5400, [float("nan")] * 16, "x"), (5500, [float("inf")] * 16, "x"), (5600, [1.0, 2.0], "x"), (None, [1.0] * 16, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string").repartition(5)
    found = {}
    for r in projections.search(spark, frame, "vec_id % 100 = 0").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    good = [(i, v) for i, v, _ in rows if i is not None and usable(v) and len(v) == 16]
    hits = total = 0
    for q, best in exact(good, [n for n, (i, _) in enumerate(good) if i % 100 == 0], 10).items():
        own = sorted(found[good[q][0]])
        assert [r[0] for r in own] == list(range(1, 11))
        hits += len({x[1] for x in best} & {r[2] for r in own})
        total += 10
        for _, score, i in own:
            assert score == pytest.approx(math.dist(dict(good)[i], good[q][1]), abs=1e-12)
        if good[q][0] >= 2000:
            assert [r[2] for r in own] == [x[1] for x in best]
    assert hits / total > 0.97 and 5600 not in found


def test_few_neighbours(spark):
    frame = spark.createDataFrame([(100, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = projections.search(spark, frame, "vec_id % 100 = 0").orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(100, 1, 100)] * 2 + [(100, 2, 1)] * 2
    assert projections.search(spark, frame.limit(0), "vec_id % 100 = 0").count() == 0


def test_chi_square():
    assert projections.chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert projections.chi_square_bound(0.95, 8) == pytest.approx(15.507, abs=1e-2)
