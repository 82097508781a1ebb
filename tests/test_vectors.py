import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.functions import vector as V
from vecloom.operators import ann, filters, search

PAIRS = [
    (1, [1.0, 0.0], [0.0, 2.0]),
    (2, [3.0, 4.0], [3.0, 4.0]),
    (3, [0.0, 0.0], [1.0, 1.0]),
    (4, None, [1.0, 1.0]),
    (5, [1.0], [1.0, 1.0]),
    (6, [], []),
    (7, [1.0, None], [1.0, 1.0]),
]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame(PAIRS, "id int, a array<float>, b array<float>")


def by_id(df, column):
    return {r["id"]: r["value"] for r in df.select("id", column.alias("value")).collect()}


def test_cosine_is_null_where_undefined(pairs):
    found = by_id(pairs, V.cosine_similarity(F.col("a"), F.col("b")))
    assert found == {1: 0.0, 2: pytest.approx(1.0), 3: None, 4: None, 5: None, 6: None, 7: None}


def test_dot_and_distance(pairs):
    assert by_id(pairs, V.dot_product(F.col("a"), F.col("b")))[2] == 25.0
    distance = by_id(pairs, V.euclidean_distance(F.col("a"), F.col("b")))
    assert distance[1] == pytest.approx(math.sqrt(5)) and distance[5] is None


def test_normalize(pairs):
    found = by_id(pairs, V.l2_normalize(F.col("a")))
    assert found[2] == pytest.approx([0.6, 0.8]) and found[3] == [0.0, 0.0] and found[4] is None


def test_previews(pairs):
    assert by_id(pairs, V.embedding_preview(F.col("a")))[2] == ["3.0000", "4.0000"]
    assert by_id(pairs, V.text_preview(F.lit(None).cast("string")))[1] == ""


def test_unknown_metric(pairs):
    with pytest.raises(ValueError, match="cosine"):
        V.similarity("manhattan", F.col("a"), F.col("b"))


def test_filters(pairs):
    assert [r["id"] for r in filters.valid_embeddings(pairs, 2, "a").orderBy("id").collect()] == [1, 2, 3, 7]
    assert filters.has_embedding(pairs, "a").count() == 6


def test_nearly_equal_records_are_told_apart(spark):
    rows = [(1, [1.0, 6e-4]), (2, [1.0, 0.0])]
    records = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "q bigint, embedding array<float>")
    assert search.vector_search(records, [1.0, 0.0], 2, 1, key="id").first()["id"] == 2
    for size in (1 << 20, 1):
        found = search.vector_search_many(records, queries, 2, 1, key="id", query_key="q", query_bytes=size)
        assert found.first()["id"] == 2


def test_one_bad_query_refuses_all(spark):
    records, queries = some_vectors(spark, 30, 6, "id"), some_vectors(spark, 20, 1, "q")
    bad = queries.unionByName(spark.createDataFrame([(99, [1.0, 2.0])], "q bigint, embedding array<float>"))
    for size in (1 << 20, 1):
        with pytest.raises(search.DimensionMismatch):
            search.vector_search_many(records, bad, 8, 5, key="id", query_key="q", query_bytes=size)


def brute(queries, records, k, metric):
    """(query row, key) of the k best, from the plain definition."""
    found = []
    for qi, q in enumerate(queries):
        scored = []
        for key, r in enumerate(records):
            if metric == "cosine":
                norm = math.sqrt((q * q).sum()) * math.sqrt((r * r).sum())
                if norm == 0:
                    continue
                score = (q * r).sum() / norm
            elif metric == "dot_product":
                score = (q * r).sum()
            else:
                score = -math.sqrt(((q - r) ** 2).sum())
            scored.append((-score + 0.0, key))
        found += [(qi, key) for _, key in sorted(scored)[:k]]
    return found


# Whole numbers, so that ties are real ties and copies occur.
cells = st.lists(st.lists(st.integers(-2, 2), min_size=3, max_size=3), min_size=1, max_size=30)


@settings(max_examples=150, deadline=None)
@given(cells, cells, st.integers(1, 4), st.sampled_from(V.METRICS), st.integers(1, 60), st.randoms(), st.booleans())
def test_scan_equals_brute_force(records, queries, k, metric, batch_rows, random, text_keys):
    records = records * 3
    keys = [f"{i:03d}" for i in range(len(records))] if text_keys else list(range(len(records)))
    table = pa.table({"id": pa.array(keys), "v": pa.array(records, pa.list_(pa.float32()))})
    table = table.take(random.sample(range(len(records)), len(records)))
    matrix = np.array(queries, dtype=np.float64)
    best = kernels.best_per_query(
        table.to_batches(max_chunksize=batch_rows), matrix, k, "id", "v", ["id"], metric
    )
    found = [] if best is None else list(zip(best["_query"].to_pylist(), map(int, best["id"].to_pylist())))
    assert found == brute(matrix, np.array(records, dtype=np.float64), k, metric)


def some_vectors(spark, count, seed, key):
    values = np.random.default_rng(seed).normal(size=(count, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>")


@pytest.mark.parametrize("metric", V.METRICS)
def test_blocks_equal_one_scan(spark, metric):
    records, queries = some_vectors(spark, 300, 1, "id"), some_vectors(spark, 25, 2, "q")
    options = {"key": "id", "query_key": "q", "metric": metric}
    scan = search.vector_search_many(records, queries, 8, 4, **options)
    blocks = search.vector_search_many(records, queries, 8, 4, query_bytes=8 * 8 * 6, **options)
    assert sorted(scan.collect()) == sorted(blocks.collect())
    assert scan.count() == 100


def test_records_are_not_shuffled(spark):
    from plans import plan_of

    records, queries = some_vectors(spark, 300, 1, "id"), some_vectors(spark, 25, 2, "q")
    plan = plan_of(search.vector_search_many(records, queries, 8, 4, key="id", query_key="q"))
    # Only candidates are: nothing moves below the scan of the records.
    assert "Exchange" in plan.split("MapInArrow")[0] and "Exchange" not in plan.split("MapInArrow")[1]


def test_blocks_are_of_like_sizes_even_for_copies(spark):
    copies = spark.range(600).select(F.lit(1).alias("q"), F.array(*[F.lit(1.0)] * 8).cast("array<float>").alias("_vector")).repartition(5)
    sizes = [b.num_rows for b in search.query_blocks(copies, "q", "_vector", 8, 65 * 100)]
    assert sum(sizes) == 600 and len(sizes) == 6 and max(sizes) < 150


def test_no_cross_joins(spark, sf_dir):
    from plans import plan_of
    from vecloom.catalog import vectors  # noqa: F401
    from vecloom.catalog.registry import QUERIES

    for name in ("vector_search", "vector_search_many", "vector_search_many_grid", "vector_search_approx_join"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_blocks_with_a_third_of_the_rows_alike(spark):
    copies = spark.range(400).select((F.col("id") + 1000).alias("id"), F.array(*[F.lit(1.0)] * 8).cast("array<float>").alias("embedding"))
    records = some_vectors(spark, 800, 3, "id").union(copies).repartition(6)
    queries = some_vectors(spark, 12, 4, "q")
    options = {"key": "id", "query_key": "q"}
    scan = search.vector_search_many(records, queries, 8, 5, **options)
    blocks = search.vector_search_many(records, queries, 8, 5, query_bytes=8 * 8 * 3, **options)
    assert sorted(scan.collect()) == sorted(blocks.collect())


def test_single_search_equals_scored_top_k(spark):
    records = some_vectors(spark, 200, 5, "id")
    query = records.filter("id = 7").first()["embedding"]
    direct = search.vector_search(records, query, 8, 5, key="id").collect()
    scored = search.vector_search_scored(records, query, 8)
    assert [(r["id"], r["score"]) for r in direct] == [
        (r["id"], r["score"]) for r in search.top_k(scored, 5, "id").collect()
    ]
    assert direct[0]["id"] == 7 and direct[0]["score"] == 1.0


def test_search_guards(spark):
    records = some_vectors(spark, 10, 6, "id")
    with pytest.raises(search.DimensionMismatch):
        search.vector_search(records, [1.0], 8, key="id")
    with pytest.raises(search.DimensionMismatch):
        search.vector_search_many(records, some_vectors(spark, 3, 1, "q"), 9, key="id", query_key="q")
    with pytest.raises(ValueError):
        search.vector_search(records, [1.0] * 8, 8, 0, key="id")
    assert search.vector_search(records.limit(0), [1.0] * 8, 8, key="id").count() == 0


def test_search_without_usable_queries(spark):
    records, queries = some_vectors(spark, 10, 6, "id"), some_vectors(spark, 3, 1, "q")
    missing = queries.withColumn("embedding", F.lit(None).cast("array<float>"))
    for asked in (queries.limit(0), missing):
        for size in (1 << 20, 1):
            found = search.vector_search_many(records, asked, 8, 5, key="id", query_key="q", query_bytes=size)
            assert found.columns == ["q", "id", "score", "rank"] and found.count() == 0


def test_search_skips_bad_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [0.0, 1.0])]
    records = spark.createDataFrame(rows, "id string, embedding array<float>")
    found = search.vector_search(records, [1.0, 0.0], 2, 5, key="id").collect()
    assert [(r["id"], r["score"]) for r in found] == [("1", 1.0), ("6", 0.0)]


def clustered(spark, count, centres, spread, seed, dims=32):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    values = middle[rng.integers(0, centres, count)] + spread * rng.normal(size=(count, dims))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id bigint, embedding array<float>")


def recall_and_share(index, records, queries, k, dims):
    exact = search.vector_search_many(records, queries, dims, k, key="id", query_key="q")
    near = index.search(queries, k, query_key="q")
    found = ann.recall(near, exact, "q", "id").agg(F.sum("found") / F.sum("wanted")).first()[0]
    read = index.read_by(index.probed(queries, k, "q"), "q").agg(F.avg("records_read")).first()[0]
    return found, read / records.count()


@pytest.mark.parametrize(("centres", "spread", "most"), [(60, 0.3, 0.15), (1, 1.0, 0.9)])
def test_recall_as_it_runs_by_default(spark, centres, spread, most):
    """The wanted recall holds with and without clusters; clusters cost a small share of the records."""
    from vecloom.session import work_path

    records = clustered(spark, 3000, centres, spread, 7)
    queries = records.filter("id % 50 = 0").select(F.col("id").alias("q"), "embedding")
    index = ann.CellIndex.build(records, work_path(spark, "index"), 32, "id")
    found, share = recall_and_share(index, records, queries, 6, 32)
    assert found >= 0.9 and share <= most


def test_all_cells_are_an_exact_search(spark):
    from vecloom.session import work_path

    records, queries = some_vectors(spark, 400, 7, "id"), some_vectors(spark, 20, 8, "q")
    copies = spark.range(200).select((F.col("id") + 1000).alias("id"), F.array(*[F.lit(1.0)] * 8).cast("array<float>").alias("embedding"))
    records = records.union(copies).repartition(5)
    index = ann.CellIndex.build(records, work_path(spark, "index"), 8, "id", bits=4)
    exact = sorted(search.vector_search_many(records, queries, 8, 5, key="id", query_key="q").collect())
    for size in (1 << 20, 8 * 8 * 4):
        assert sorted(index.search(queries, 5, query_key="q", first=16, query_bytes=size).collect()) == exact
    again = ann.CellIndex.open(spark, index.root, "id", records.schema["id"].dataType)
    assert again == index


def test_index_follows_its_table(spark):
    """Appends, upserts, deletions and an emptied label count from the commit that brought them."""
    from vecloom.session import work_path
    from vecloom.sources import files
    from vecloom.sources.store import VectorTable

    records = some_vectors(spark, 300, 9, "id").withColumn("label", F.lit("L"))
    queries = some_vectors(spark, 15, 10, "q")
    table = VectorTable(spark, work_path(spark, "table"), records.drop("label").schema, "id")
    table.write_batch(records.filter("id < 200"), 1, 0)
    index = ann.CellIndex.of_table(table, "L", work_path(spark, "index"), 8)

    def same():
        current = table.read_label("L").drop("label")
        exact = search.vector_search_many(current, queries, 8, 4, key="id", query_key="q").collect()
        return sorted(index.search(queries, 4, query_key="q", first=1 << index.bits).collect()) == sorted(exact)

    assert same() and index.follow(table, "L") == 1
    table.write_batch(records.filter("id >= 150").withColumn("embedding", F.transform("embedding", lambda x: -x)), 1, 1)
    assert not same()
    assert index.follow(table, "L") == 2 and same()
    table.write_batch(records.filter("id % 3 = 0").withColumn("deleted", F.lit(True)), 1, 2)
    table.write_batch(records.filter("id % 6 = 0"), 1, 3)
    table.merge(2)
    assert index.follow(table, "L") == 4 and same()
    table.delete_label("L", 2)
    table.write_batch(records.filter("id < 40").withColumn("embedding", F.when(F.col("id") > 3, F.col("embedding"))), 1, 4)
    assert index.follow(table, "L") == 6 and same()
    # A step that did not end does not count.
    table.write_batch(records.filter("id < 9"), 1, 5)
    assert index.follow(table, "L") == 7
    place, system = files._opened(spark, f"{index.root}/done/7")
    system.delete(place, False)
    assert index.through() == 6 and not same()
    assert index.follow(table, "L") == 7 and same()


def test_index_of_odd_vectors(spark):
    from vecloom.session import work_path

    nan, far = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [0.0, 1.0]), (7, [far, 1.0]), (None, [1.0, 0.1]), (1, [1.0, 0.0])]
    records = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    index = ann.CellIndex.build(records, work_path(spark, "index"), 2, "id")
    assert index.entries().select("key").distinct().count() == 3
    asked = spark.createDataFrame([("a", [1.0, 0.0]), ("zero", [0.0, 0.0]), ("none", None)], "q string, embedding array<float>")
    found = index.search(asked, 10, query_key="q", first=4).collect()
    assert {r["q"] for r in found} == {"a"} and len(found) == 4
    empty = ann.CellIndex.build(records.limit(0), work_path(spark, "index"), 2, "id")
    assert empty.search(asked, 3, query_key="q").count() == 0
    with pytest.raises(search.DimensionMismatch):
        index.search(spark.createDataFrame([("b", [1.0])], "q string, embedding array<float>"), 3, query_key="q")
    for bad in ({"query_key": "id"}, {"query_key": "q", "wanted": 1.0}):
        with pytest.raises(ValueError):
            index.search(asked.withColumn("id", F.lit(1)), 3, **bad)


def test_cells_by_margin():
    """Cells come by the distances to the planes between, until their chances add up to the share."""
    rng = np.random.default_rng(1)
    margins, cosines = rng.normal(size=(40, 5)), rng.uniform(-0.2, 0.99, 40)
    found = kernels.cells_looked_into(margins, cosines, 2, 0.6)
    for m, c, cells_ in zip(margins, cosines, found):
        c = min(max(c, 0.0), 0.999999)
        own = sum(1 << j for j in range(5) if m[j] > 0)
        cross = [1 / (1 + math.exp(1.702 * abs(x) * c / math.sqrt(1 - c * c))) for x in m]
        ways = []
        for mask in range(32):
            some = [mask >> j & 1 for j in range(5)]
            ways.append((sum(abs(x) for x, s in zip(m, some) if s), mask, math.prod(f if s else 1 - f for f, s in zip(cross, some))))
        wanted, total = set(), 0.0
        for nth, (_, mask, chance) in enumerate(sorted(ways)):
            if nth < 2 or total < 0.6:
                wanted.add(own ^ mask)
            total += chance
        assert set(np.flatnonzero(cells_)) == wanted


def test_cosines_are_summed_in_order_and_end_at_one(spark):
    rng = np.random.default_rng(5)
    # Rows of like values in other places: rounding alone tells their sums apart.
    signs = np.array([rng.permutation(np.r_[np.ones(9), np.full(9, 2.0), np.zeros(46)]) for _ in range(400)], np.float32)
    rows = [*(signs / np.float32(45**0.5)), *(signs[:50] * np.float32(0.7))]
    records = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id bigint, embedding array<float>")
    asked = spark.createDataFrame([(q, rows[q].tolist()) for q in range(20)], "q bigint, embedding array<float>")

    def cosine(a, b):
        dot = x = y = 0.0
        for p, q in zip(a.astype(float), b.astype(float)):
            dot, x, y = dot + p * q, x + p * p, y + q * q
        return max(-1.0, min(1.0, dot / math.sqrt(x * y)))

    wanted = []
    for q in range(20):
        best = sorted((-cosine(rows[q], r), i) for i, r in enumerate(rows))[:30]
        wanted += [(q, i, -s, n + 1) for n, (s, i) in enumerate(best)]
    found = search.vector_search_many(records, asked, 64, 30, key="id", query_key="q")
    assert sorted(tuple(r) for r in found.select("q", "id", "score", "rank").collect()) == sorted(wanted)
    one = search.vector_search(records, rows[0].tolist(), 64, 30, key="id").orderBy(F.desc("score"), "id").collect()
    assert [(r["id"], r["score"]) for r in one] == [(i, s) for q, i, s, _ in sorted(wanted, key=lambda w: w[3]) if q == 0]
