import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from vecloom.llm import bits, ranked, winnowing

ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
    *(T.StructField(n, T.StringType()) for n in ("item", "row", "print", "window", "size", "list", "query", "term", "key", "rank", "score")),
])
UPPER = {c: c + 32 for c in range(65, 91)}


def items_of(spark, rows):
    return spark.createDataFrame([(*r, *("x" for _ in ITEMS.names[2:])) for r in rows], ITEMS).repartition(2)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def hits_of(documents, items, window=10):
    held = {}
    for item, text in items:
        w = words_of(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1) if size else ():
            held.setdefault(tuple(w[s : s + size]), set()).add("" if item is None else str(item))
    sizes = {len(x) for x in held}
    out = []
    for key, text in documents:
        w, hit, found = words_of(text), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if (names := held.get(tuple(w[s : s + size]))) is not None:
                    hit |= set(range(s, s + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found, key=lambda x: x.encode())).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def passages(odd_rows):
    """Items cut from the documents, short ones, ones that share passages, repeated ones, null and empty ones."""
    rng = random.Random(11)
    items = [(None, "unlike any of the texts here"), (900, None), (901, ""), (902, " \n"), (903, "word"), (904, "TWO words"), (905, "ab ab ab"), (905, "word")]
    for k, text in odd_rows:
        w = (text or "").split()
        for n in (3, 9, 10, 11, 40):
            if len(w) >= n:
                s = rng.randrange(len(w) - n + 1)
                items.append((len(items) % 30, " ".join(w[s : s + n]) + ("" if n % 2 else " and more words that follow")))
    return items + items[10:14]


def test_contaminated_by_brute_force(spark, odd, odd_rows, passages):
    found = winnowing.contaminated(spark, odd, items_of(spark, passages)).collect()
    wanted = hits_of(odd_rows, passages)
    assert sorted((tuple(r) for r in found), key=repr) == wanted
    assert sum(w[5] for w in wanted) > 10


@pytest.mark.parametrize(("window", "gram"), [(4, 2), (3, 3), (12, 1)])
def test_other_windows(spark, documents, window, gram):
    rng = random.Random(window)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for k in range(60)]
    items = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 20)))) for k in range(25)]
    found = winnowing.contaminated(spark, documents(spark, rows), items_of(spark, items), window=window, gram=gram).collect()
    assert sorted((tuple(r) for r in found), key=repr) == hits_of(rows, items, window)


def test_passage_of_nearly_all(spark, documents):
    passage = " ".join(f"p{k}" for k in range(14))
    rows = [(k, f"own{k} {passage} tail{k}") for k in range(400)]
    items = [(k, f"{passage} i{k}") for k in range(50)]
    found = winnowing.contaminated(spark, documents(spark, rows), items_of(spark, items)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == hits_of(rows, items)


def test_no_documents_or_items(spark, odd, odd_rows, none, passages):
    assert winnowing.contaminated(spark, none, items_of(spark, passages)).count() == 0
    assert not any(r["contaminated"] for r in winnowing.contaminated(spark, odd, items_of(spark, [])).collect())
    with pytest.raises(ValueError):
        winnowing.contaminated(spark, odd, items_of(spark, []), window=3, gram=4)


def test_filter_passes_all_its_keys(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    held = bits.bit_filter(spark.createDataFrame([(int(k),) for k in keys], "h long"), "h")
    assert bits.passes(keys, held).all()
    assert bits.passes(rng.integers(-(1 << 63), (1 << 63) - 1, 10000), held).mean() < 0.05
    assert len(bits.bit_filter(spark.createDataFrame([], "h long"), "h")) * 64 == 1 << 12


def ranks_of(documents, items, k):
    counted = [(key, Counter(words_of(t))) for key, t in documents]
    lengths = [sum(c.values()) for _, c in counted]
    n_all, total = sum(n > 0 for n in lengths), sum(lengths)
    frequency = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (key, c), n in zip(counted, lengths):
            score = 0
            for t, times in Counter(words_of(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * frequency[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_all // total)))
            if score > 0:
                scores.append((-score, key is not None, key or 0, key))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("k", "block_rows", "query_bytes"), [(20, 1 << 16, 1 << 23), (3, 4, 1 << 23), (1, 7, 600)])
def test_ranks_by_brute_force(spark, odd, odd_rows, passages, k, block_rows, query_bytes):
    found = ranked.search(spark, odd, items_of(spark, passages), k, block_rows=block_rows, query_bytes=query_bytes).collect()
    assert sorted((tuple(r) for r in found), key=repr) == ranks_of(odd_rows, passages, k)


def test_ranks_with_ties_and_common_terms(spark, documents):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.5)) % 300}" for _ in range(20000)]
    rows = [(k // 2 if k % 50 else None, " ".join(words[k * 30 : k * 30 + 5 + k % 25])) for k in range(600)]
    items = [(k, " ".join(rng.choice(words) for _ in range(12))) for k in range(40)]
    found = ranked.search(spark, documents(spark, rows), items_of(spark, items), 10, block_rows=100).collect()
    assert sorted((tuple(r) for r in found), key=repr) == ranks_of(rows, items, 10)


def test_accumulators_are_limited():
    """A rare term settles who can be among the best; a common one then only updates those."""
    common = np.arange(1000)
    block = ranked.Block(np.r_[np.zeros(1000, int), np.ones(5, int)], np.r_[common, [7, 70, 300, 500, 999]], np.full(1005, 10), 2, 1000, common)
    rows, scores = block.best(np.array([1, 0]), np.array([100, 1]), 3)
    assert list(rows) == [7, 70, 300] and list(scores) == [1010] * 3
    assert (block.scores > 0).sum() == 5


def test_search_of_nothing(spark, odd, none, passages):
    assert ranked.search(spark, none, items_of(spark, passages)).count() == 0
    assert ranked.search(spark, odd, items_of(spark, [])).count() == 0
    assert ranked.search(spark, odd, items_of(spark, [(1, "nowhere_at_all"), (2, None)])).where("item_id = 2").count() == 0
