import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecloom.functions import kernels, models
from vecloom.operators import embed

TEXTS = [
    (1, "Aircraft engine replacement due to oil leak"),
    (2, "Landing gear inspection completed"),
    (3, ""),
    (4, None),
    (5, "été NAÏVE 12345 — ok"),
    (6, "x " * 500),
]


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def vectors(provider, df):
    return {r["id"]: r["embedding"] for r in provider.add_embeddings(df).collect()}


def config(dims=16, **kwargs):
    return embed.EmbeddingConfig("m", dims, **kwargs)


def plain_hashing(text, dims):
    """Feature hashing from its definition, character by character."""
    word, words = "", []
    for ch in text.lower() + " ":
        if ch in "abcdefghijklmnopqrstuvwxyz0123456789":
            word += ch
        elif word:
            words.append(word)
            word = ""
    out = [0.0] * dims
    for w in words:
        digest = hashlib.md5(w.encode()).hexdigest()
        out[int(digest[:8], 16) % dims] += 1 if digest[8] in "01234567" else -1
    norm = sum(x * x for x in out) ** 0.5
    return [x / norm if norm else 0.0 for x in out]


def test_hashing(texts):
    found = vectors(embed.HashingProvider(config()), texts)
    assert found[4] is None
    for key, text in TEXTS:
        if text is not None:
            assert found[key] == pytest.approx(plain_hashing(text, 16), abs=1e-6)
    assert found[3] == [0.0] * 16


def test_hashing_in_small_slices(texts, monkeypatch):
    import pyarrow as pa

    column = pa.array([t for _, t in TEXTS] * 20)
    whole = list(kernels.hash_vectors(iter([column]), 8))[0].to_pylist()
    monkeypatch.setattr(kernels, "TOKENIZE_BYTES", 64)
    assert list(kernels.hash_vectors(iter([column.slice(3)]), 8))[0].to_pylist() == whole[3:]


@pytest.mark.parametrize("rows", [1, 40, 4000])
def test_hashing_holds_little_beside_a_batch(rows, monkeypatch):
    """However a batch is made up: many texts, or one long one, are tokenized a stretch at a time."""
    words = "alpha beta3 gamma-delta épsilon zeta, eta"
    column = pa.array([f"{words} {k} " * (80_000 // rows) for k in range(rows)])
    wanted = [v.tolist() for v in kernels.unit_rows(kernels.hash_counts(column, 16)).astype(np.float32)]
    monkeypatch.setattr(kernels, "TOKENIZE_BYTES", 1 << 16)
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    found = next(kernels.hash_vectors(iter([column]), 16)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == wanted
    # The numbers that come out, and one copy of a text that is longer than a stretch.
    assert peak < column.nbytes * (2.5 if rows == 1 else 1) and pa.total_allocated_bytes() - held < column.nbytes


@pytest.mark.parametrize("texts", [[], [""], [None], ["é ß", ""], [" a  b ", None, "a"]])
def test_hashing_of_awkward_batches(texts):
    import pyarrow as pa

    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    found = list(kernels.hash_vectors(iter([column]), 4))[0].to_pylist()
    wanted = [None if t is None else pytest.approx(plain_hashing(t, 4), abs=1e-6) for t in texts]
    assert found == wanted


def test_random_is_uniform_and_stable(spark):
    keys = spark.range(2000).select("id", F.lit("same text").alias("text"))
    provider = embed.RandomProvider(config(32, key_column="id"))
    first = vectors(provider, keys)
    assert first == vectors(provider, keys.repartition(7))
    values = np.array(list(first.values()))
    assert values.min() >= 0 and values.max() < 1
    assert abs(values.mean() - 0.5) < 0.01 and abs(values.std() - 12**-0.5) < 0.01
    assert np.abs(np.corrcoef(values.T) - np.eye(32)).max() < 0.15
    assert len({tuple(v) for v in first.values()}) == 2000


def test_model_and_hashing_agree(texts):
    model = embed.ModelProvider(config(), lambda: models.HashingEncoder(16), slice_rows=2)
    found, wanted = vectors(model, texts), vectors(embed.HashingProvider(config()), texts)
    assert found[4] is None
    for key in (1, 2, 3, 5, 6):
        assert found[key] == pytest.approx(wanted[key], abs=1e-6)


def test_model_failure_gives_null(texts):
    def factory():
        def encode(batch):
            if any("gear" in t for t in batch):
                raise RuntimeError("no")
            return [[float(len(t)), 1.0] for t in batch]

        return encode

    provider = embed.ModelProvider(config(2), factory, normalize=False)
    found = vectors(provider, texts)
    assert found[2] is None and found[4] is None
    assert found[1] == [43.0, 1.0] and found[3] == [0.0, 1.0]


def test_model_returning_none_or_too_few(texts):
    def none_for_long(batch):
        return [None if len(t) > 30 else [1.0, 0.0] for t in batch]

    found = vectors(embed.ModelProvider(config(2), lambda: none_for_long), texts)
    assert found[1] is None and found[3] == [1.0, 0.0]
    short = embed.ModelProvider(config(2), lambda: lambda batch: [[1.0, 0.0]])
    assert vectors(short, texts)[1] == [1.0, 0.0]


def test_reasons(texts):
    def encode(batch):
        if any("gear" in t for t in batch):
            raise RuntimeError("no gear")
        return [[1.0, 2.0] for _ in batch]

    provider = embed.ModelProvider(config(2), lambda: encode, normalize=False)
    rows = texts.withColumn("o", provider.outcome()).select("id", "o.reason").collect()
    assert {r["id"]: r["reason"] for r in rows} == {1: None, 2: "RuntimeError: no gear", 3: None, 4: None, 5: None, 6: None}


def test_outage_fails_the_task(spark, texts):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def encode(batch):
            calls.add(1)
            raise ConnectionError("endpoint is down")

        return encode

    provider = embed.ModelProvider(config(2), factory, attempts=3, wait=0.01)
    with pytest.raises(Exception, match="no answer in 3 attempts: ConnectionError: endpoint is down"):
        vectors(provider, texts.coalesce(1))
    # Each attempt: the slice, each of its texts, the probe.
    assert calls.value % 3 == 0
    with pytest.raises(embed.NoQueryVector):
        embed.embed_query(spark, "gear", embed.ModelProvider(config(2), lambda: lambda b: [None if "gear" in t else [1.0, 1.0] for t in b]))


def test_a_model_that_comes_back(texts):
    def factory():
        asked = []

        def encode(batch):
            asked.append(1)
            if len(asked) < 8:
                raise ConnectionError("busy")
            return [[1.0, 0.0] for _ in batch]

        return encode

    found = vectors(embed.ModelProvider(config(2), factory, wait=0.01), texts.coalesce(1))
    assert [v for v in found.values() if v] and set(map(str, found.values())) <= {"[1.0, 0.0]", "None"}


def test_each_text_goes_to_the_model_once(spark, texts):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def encode(batch):
            calls.add(len(batch))
            return [[1.0, 2.0] for _ in batch]

        return encode

    provider = embed.ModelProvider(config(2), factory)
    valid = provider.filter_valid_embeddings(provider.add_embeddings(texts))
    valid.filter(F.col("embedding")[0] > 0).select("id", "embedding").write.format("noop").mode("overwrite").save()
    assert calls.value == 5


def test_hosted_reads_the_whole_text(spark):
    words = [f"w{i}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:299] + ["other"]))], "id int, text string")
    provider = embed.HostedProvider(config(64), max_units=32, count_units=models.word_units)
    found = vectors(provider, df)
    assert found[1] != found[2]

    pooled = np.zeros(64)
    for start in range(0, 300, 32):
        part = words[start : start + 32]
        pooled += np.array(plain_hashing(" ".join(part), 64)) * len(part)
    assert found[1] == pytest.approx(list(pooled / np.sqrt((pooled**2).sum())), abs=1e-6)


def test_hosted_context_by_name():
    assert embed.HostedProvider(embed.EmbeddingConfig("gte-large-en", 8)).max_units == 8190
    with pytest.raises(ValueError, match="max_units"):
        embed.HostedProvider(embed.EmbeddingConfig("something", 8))


def test_windows_stay_within_the_bound():
    for text in ("word " * 300, "x" * 1000, "日本" * 400 + " a b", "a" * 31 + " " + "b" * 31, " " * 100, ""):
        windows = kernels.split_windows(text, 32)
        assert all(len(w.encode()) <= 32 for w, _ in windows) or not text.strip()
        assert "".join(w for w, _ in windows).replace(" ", "") == text.replace(" ", "")


def test_create_provider():
    assert isinstance(embed.create_embedding_provider("random", config()), embed.RandomProvider)
    with pytest.raises(ValueError, match="random.*custom.*hosted"):
        embed.create_embedding_provider("nonsense", config())


def test_validate(spark):
    assert embed.HashingProvider(config()).validate(spark)
    assert embed.RandomProvider(config(key_column="id")).validate(spark)
    assert not embed.ModelProvider(config(3), lambda: lambda batch: [[1.0] for _ in batch]).validate(spark)


def test_embed_query_uses_the_same_model(spark, texts):
    provider = embed.HashingProvider(config())
    assert embed.embed_query(spark, TEXTS[0][1], provider) == vectors(provider, texts)[1]
    asked = texts.withColumnRenamed("text", "question")
    rows = embed.embed_queries(asked, provider, "question").collect()
    assert {r["id"]: r["embedding"] for r in rows} == vectors(provider, texts)


def test_embedding_is_narrow(texts):
    from plans import plan_of

    for name in embed.PROVIDERS:
        named = embed.EmbeddingConfig("bge-large-en", 16, key_column="id")
        provider = embed.create_embedding_provider(name, named)
        plan = plan_of(provider.filter_valid_embeddings(provider.add_embeddings(texts)))
        assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1, plan


def test_validate_model(spark):
    from vecloom.plans.validate import validate_model

    def meaning(batch):
        return [[1.0, float("eat" in t), len(t) / 1e4 + 0.1] for t in batch]

    good = validate_model(spark, embed.ModelProvider(config(3), lambda: meaning))
    assert {r["check"]: r["passes"] for r in good.collect()} == dict.fromkeys(("basic", "edge", "triplet", "consistency"), True)
    short = validate_model(spark, embed.ModelProvider(config(2), lambda: meaning))
    assert not any(r["passes"] for r in short.filter("check in ('basic', 'edge')").collect())


def test_requests_refuse_null_texts(spark):
    from vecloom.operators.wire import build_requests

    chunked = spark.createDataFrame([(1, 0, "a"), (2, 0, None)], "row_num bigint, chunk_id bigint, text string")
    with pytest.raises(Exception, match="null text"):
        build_requests(chunked).collect()
