import glob
import hashlib
import os
import random

import duckdb
import pytest

import corpus_pipeline
from vecloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def small(sf_dir):
    return sf_dir.replace("sf0.01", "sf0.001")


def test_stages_one_after_the_other(spark, small, tmp_path):
    """Each stage against the operator's own decisions, which their tests hold against brute force."""
    from test_copies import brute_lines, brute_repeats, print_of, roots

    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "best_fit_packing":
            break
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "toxicity":
            assert 0.8 * len(before) < len(after) < len(before)
            assert all(before[k] == t for k, t in after.items())
        elif name == "line_dedup":
            whole = brute_lines(sorted(before.items()), 10)
            assert all(after[k] == before[k] for k, x in whole.items() if not x[1] + x[2])
            assert len(after) <= len(before)
        elif name == "simhash_near_dedup":
            prints = {k: print_of(t, 5) for k, t in before.items()}
            near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
            assert set(after) == set(roots(prints, near).values())
        else:
            spans = brute_repeats(sorted(before.items()), corpus_pipeline.PASSAGE_BYTES)
            assert all(after[k] == before[k] for k, x in spans.items() if not x[1])
            # A text of which only white space is left goes with its row.
            blank = {hashlib.sha256((c * n).encode()).hexdigest() for c in " \n" for n in range(9)}
            assert all((k in after) == (x[3] not in blank or not x[1]) for k, x in spans.items())
        before = after
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(before)


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def prose(rng, n, letters="abcdefghijklm"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_passages_of_over_fifty_words_go(spark):
    """Planted passages of 51 to 70 words in unlike documents, and documents that share nothing."""
    rng = random.Random(8)
    passages = [prose(rng, rng.randrange(51, 71), letters) for letters in ("abcdef", "nopqrs", "éàüñöß") for _ in range(4)]
    rows = [(k, f"{prose(rng, 60)} {passages[k % 12]} {prose(rng, 60)}") for k in range(60)] + [(100 + k, prose(rng, 120)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    assert set(after) == {k for k, _ in rows}
    for k, text in rows:
        assert after[k] == text if k >= 100 else passages[k % 12][3:-3] not in after[k] and after[k].startswith(text[:40])


def test_stages_on_odd_rows(spark, small, odd, none):
    """Nulls, empty and long texts, repeated rows, extra columns whose names operators use inside, and no rows at all."""
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, small)
            assert after.columns == docs.columns, name
            assert after.count() <= docs.count() and (docs is none or after.count()), name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
        assert packed.count() >= docs.count()


def test_names():
    assert [n.split("_")[0] for n in QUERIES] and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    wanted = connection.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    found = [tuple(r) for r in QUERIES[name](spark, small).select(*columns).collect()]
    assert sorted(found) == sorted(wanted.fetchall())
