import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vecloom.llm import packing, pieces

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def strange(n, alphabet="aabbc  the in on\n\té日本😀▁.,!0 1 ́\x00zthion'<|endoftext|>İΣ ​"):
    rng = random.Random(n)
    return ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(n)]


def test_encode_like_the_library(library):
    texts = strange(1500) + [" " * k for k in range(60)] + ["a" * k for k in range(80)] + ["th" * 500, "abcab" * 900, " " * 3000, "=" * 700 + " " * 33]
    model = pieces.PieceModel(PIECES)
    ids, starts = model.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == library.encode(texts)


def test_forgetting_words_changes_nothing(library, monkeypatch):
    model = pieces.PieceModel(PIECES)
    model.words.most = 5
    for text in strange(50):
        assert model.encode([text])[0].tolist() == library.encode(text)


def test_words_finished_one_by_one(library, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", 2)
    texts = strange(200)
    ids, starts = pieces.PieceModel(PIECES).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == library.encode(texts)


def test_decode_any_ids(library):
    rng, model = random.Random(3), pieces.PieceModel(PIECES)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300)]) for _ in range(rng.randrange(10))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_piece_operators(odd, odd_rows, library):
    found = {r["doc_id"]: r for r in pieces.decode(pieces.encode(odd, PIECES, keys=["doc_id"]), PIECES).collect()}
    assert len(found) == len(odd_rows)
    for key, text in odd_rows:
        ids = library.encode(text or "", add_eos=True)
        assert found[key]["ids"] == ids and found[key]["decoded"] == library.decode(ids)


def test_piece_operators_on_nothing(none):
    assert pieces.decode(pieces.encode(none, PIECES), PIECES).count() == 0


def test_word_tokens_like_the_library(tokenizer):
    texts = strange(1500)
    ids, starts = packing.Tokens(WORDS).encode(texts)
    wanted = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == wanted


def packed_well(rows, capacity):
    """Offsets gapless from 0 in every sequence, none too long; the number of sequences."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing(spark, odd, odd_rows, tokenizer):
    rows = packing.pack(spark, odd, WORDS, capacity=64, ids="tokens").collect()
    by_key = {}
    for r in rows:
        assert r["length"] == len(r["tokens"]) and r["ids_crc32"] == zlib.crc32(np.array(r["tokens"], "<u4").tobytes())
        by_key.setdefault(r["doc_id"], []).append(r)
    assert set(by_key) == {k for k, _ in odd_rows}
    for key, text in odd_rows:
        own = sorted(by_key[key], key=lambda r: r["piece"])
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert [i for r in own for i in r["tokens"]] == ids
        assert [r["piece"] for r in own] == list(range(len(own))) and all(r["length"] == 64 for r in own[:-1])
        assert [r["start"] for r in own] == [64 * k for k in range(len(own))]
    total = sum(r["length"] for r in rows)
    assert packed_well(rows, 64) <= 1.1 * total / 64 + 1


def test_packing_nothing_and_repeats(spark, none, documents):
    assert packing.pack(spark, none, WORDS).count() == 0
    rows = packing.pack(spark, documents(spark, [(1, "same text")] * 50 + [(None, None)] * 3), WORDS).collect()
    assert len(rows) == 53 and packed_well(rows, 2048) == 1


@pytest.mark.parametrize("seed", range(4))
def test_plans_come_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, np.maximum(1, rng.lognormal(6.3, 0.9, 60_000).astype(int)))
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.Plan(histogram)
    assert sum(r[2] for r in plan.rows) == len(lengths) and not plan.left.any()
    assert plan.sequences <= 1.003 * lengths.sum() / 2048 + 1


def test_plan_does_not_grow_with_the_corpus():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.integers(1, 2049, 50_000), return_counts=True)
    sizes = [len(packing.Plan({int(k): int(c) * f for k, c in zip(lengths, counts)}).rows) for f in (10, 10_000)]
    assert sizes[1] < 2 * sizes[0]


def test_registered_digests(spark, sf_dir, library):
    from vecloom.llm.queries import QUERIES

    small = sf_dir.replace("sf0.01", "sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op1_sentencepiece_round_trip"](spark, small).collect():
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    rows = QUERIES["op7_pattern_packing"](spark, small).collect()
    assert packed_well(rows, 2048) <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


def test_word_parts_are_the_tokenizers(odd_rows):
    """Ids of fuzzed texts, special tokens and unusual letters among them, as the library gives them."""
    library = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(12)
    pieces = ["<|endoftext|>", "<|", "<|STARTOFTEXT|>", "Word", "it's", "naïve", "ﬁ", "12", "...", "  ", "\n", "İ", "ǅ", "日本", "a.b", *"abzAZéÀ×÷ÿ日😀 \t\r\x0b\x0c.,!?;:&%$#*|<>'-_09ßĀ"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 30))) for _ in range(3000)] + [t or "" for _, t in odd_rows]
    ids, starts = library.encode(pa.array(texts))
    wanted = [e.ids for e in library.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == wanted
