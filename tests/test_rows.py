import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_of
from vecloom.operators import chunk, filters, project, quality, wire
from vecloom.operators.embed import EmbeddingConfig, HashingProvider
from vecloom.plans.load import LoadConfig
from vecloom.plans.report import format_duration, format_rate, run_report
from vecloom.session import shared_folder
from vecloom.sources import tables
from vecloom.streaming.ledger import LEDGER_SCHEMA, batch_totals


def numbers(df, order, size):
    return {tuple(r[c] for c in order): (r["row_num"], r["chunk_id"]) for r in chunk.chunk_assign(df, size, order).collect()}


@pytest.mark.parametrize("partitions", [1, 4, 16])
@pytest.mark.parametrize("size", [1, 7, 100, 101])
def test_chunks_do_not_depend_on_the_input_layout(spark, partitions, size):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("k")).repartition(partitions)
    found = numbers(df, ["k"], size)
    wanted = {(k,): (n + 1, n // size) for n, (k,) in enumerate(sorted(found))}
    assert found == wanted


def test_hot_and_null_keys(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("k"), "id"
    )
    found = chunk.chunk_assign(df.repartition(5), 50, ["k"])
    rows = found.select(F.min("row_num"), F.max("row_num"), F.count_distinct("row_num")).first()
    assert tuple(rows) == (1, 3000, 3000)
    assert {r["rows_in_chunk"] for r in chunk.chunk_plan(found).collect()} == {50}
    ordered = [r["k"] for r in found.orderBy("row_num").collect()]
    assert ordered == sorted(ordered, key=lambda k: (k is not None, k or ""))


def test_odd_column_names(spark):
    df = spark.range(5).select(F.col("id").alias("a.b"), F.lit("x").alias("c`d"))
    found = chunk.number_rows(df, ["`a.b`"])
    assert found.columns == ["a.b", "c`d", "row_num"] and found.count() == 5


def test_full_copies_are_numbered_apart(spark):
    df = spark.range(0, 1000, 1, 8).select(F.lit("x").alias("k"))
    assert chunk.number_rows(df, ["k"]).select("row_num").distinct().count() == 1000


def test_only_partition_sizes_meet_in_one_task(spark):
    plan = plan_of(chunk.chunk_assign(spark.range(1000).toDF("k"), 10, ["k"])).splitlines()
    single = [i for i, line in enumerate(plan) if "SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate" in plan[single[0] + 1] and "output=[_part" in plan[single[0] + 1]


def test_limits(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert sorted(r["k"] for r in chunk.limit_rows(df, 10, ["k"]).collect()) == list(range(10))
    assert chunk.limit_rows(df, -1, ["k"]).count() == 100
    assert sorted(r["k"] for r in chunk.limit_rows(df, 1000, ["k"]).collect()) == list(range(100))


def test_chunk_count():
    assert [chunk.chunk_count(n, 5000) for n in (0, 1, 5000, 5001)] == [0, 1, 1, 2]


def test_select_columns_with_odd_names(spark):
    row = ("R1", "oil leak", "T", "C", "A", "2024-01-01", "unused")
    df = spark.createDataFrame([row], "`:ID(RemovalEvent)` string, RMV_REA_TX string, RMV_TRK_NO string, component_id string, aircraft_id string, removal_date string, other string")
    found = project.select_columns(df)
    assert found.columns == ["removal_id", "removal_reason", "rmv_trk_no", "component_id", "aircraft_id", "removal_date"]
    assert found.first()["removal_id"] == "R1"
    ticked = df.select(F.lit(1).alias("a`b"))
    assert project.map_columns(ticked, {"a`b": "c"}).first()["c"] == 1


def test_null_text_goes_and_empty_text_stays(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, text string")
    assert [r["id"] for r in filters.text_not_null(df).collect()] == [2, 3]


def test_pushdown_and_pruning(spark, sf_dir):
    df = tables.table_scan(spark, path=f"{sf_dir}/documents.parquet")
    plan = plan_of(filters.text_not_null(df).select("doc_id"))
    assert "PushedFilters: [IsNotNull(text)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_csv_with_inferred_types_and_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text,day\n1,"two\nlines, ""quoted""",2024-01-02\n2,,2024-01-03\n')
    found = tables.csv_ingest(spark, str(tmp_path / "in.csv"), path=str(tmp_path / "out"), multi_line=True)
    assert [f.dataType.simpleString() for f in found.schema] == ["int", "string", "date"]
    assert found.orderBy("id").first()["text"] == 'two\nlines, "quoted"'
    with pytest.raises(ValueError):
        tables.csv_ingest(spark, "x")


def test_csv_to_named_table(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,text\n1,a\n")
    assert tables.csv_ingest(spark, str(tmp_path / "in.csv"), "id bigint, text string", table="ingested").count() == 1
    assert tables.table_scan(spark, table="ingested").count() == 1


RESPONSES = [
    ('{"predictions": [[0.1,0.2]]}', [0.1, 0.2]),
    ('{"predictions": [[[0.1,0.2]]]}', [0.1, 0.2]),
    ('{"data":[{"embedding":[0.3,0.4]}]}', [0.3, 0.4]),
    ('{"error":"x"}', None),
    ("bad", None),
    ('{"predictions": []}', None),
    ('{"predictions": [0.1, 0.2]}', None),
    ('{"data":[]}', None),
    (None, None),
]


@pytest.mark.parametrize("body,vector", RESPONSES)
def test_response_bodies(spark, body, vector):
    df = spark.createDataFrame([(body,)], "body string")
    found = df.select(wire.first_vector(F.col("body")).alias("v")).first()["v"]
    assert found == (None if vector is None else pytest.approx(vector))


def test_requests_escape_text(spark):
    df = spark.createDataFrame([(1, 'say "hi"\n'), (2, "é\\")], "id int, text string")
    chunked = chunk.chunk_assign(df, 5, ["id"])
    assert wire.build_requests(chunked).first()["request"] == '{"dataframe_records":[{"text":"say \\"hi\\"\\n"},{"text":"é\\\\"}]}'
    assert wire.build_requests(chunked, shape="input").first()["request"] == '{"input":["say \\"hi\\"\\n","é\\\\"]}'
    with pytest.raises(ValueError):
        wire.build_requests(chunked, shape="other")


def test_missing_vectors_in_a_response_are_null(spark):
    df = spark.createDataFrame([(i, "t") for i in range(4)], "id int, text string")
    chunked = chunk.chunk_assign(df, 2, ["id"])
    responses = spark.createDataFrame([(0, '{"predictions": [[1.0],[2.0]]}'), (1, '{"predictions": [[3.0]]}')], "chunk_id bigint, response string")
    found = {r["id"]: r["embedding"] for r in wire.parse_responses(responses, chunked, 2).collect()}
    assert found == {0: [1.0], 1: [2.0], 2: [3.0], 3: None}


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "id int, embedding array<float>")


def test_verify_load(spark):
    good = vectors_of(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert quality.verify_load(good, 2, "id").first()["status"] == "passed"
    assert quality.verify_load(good.limit(0), 2, "id").first()["status"] == "empty"
    assert not quality.verify_load(good.limit(0), 2, "id").first()["passes"]
    for bad in ([(1, [1.0])], [(1, None)], [(1, [1.0, 0.0]), (1, [1.0, 0.0])]):
        assert quality.verify_load(vectors_of(spark, bad), 2, "id").first()["status"] == "failed"


def test_compare_embeddings(spark):
    left = vectors_of(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    near = vectors_of(spark, [(1, [1.0, 0.000001]), (2, [0.0, 1.0])])
    far = vectors_of(spark, [(1, [1.0, 0.1]), (2, [0.0, 1.0])])
    assert quality.compare_embeddings(left, near, "id").first()["agrees"]
    assert not quality.compare_embeddings(left, far, "id").first()["agrees"]
    fewer = quality.compare_embeddings(left, left.limit(1), "id").first()
    assert fewer["only_left"] == 1 and not fewer["agrees"]
    twice = quality.compare_embeddings(left, left.union(left), "id").first()
    assert twice["matched"] == 2 and twice["repeated_keys"] == 2 and not twice["agrees"]
    assert not quality.compare_embeddings(left.limit(0), left.limit(0), "id").first()["agrees"]


def test_triplets_must_be_strictly_nearer(spark):
    records = vectors_of(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])])
    triplets = spark.createDataFrame([(1, 2, 3), (1, 3, 2), (1, 2, 2), (1, 4, 3)], "anchor int, similar int, different int")
    found = {(r["similar"], r["different"]): r["passes"] for r in quality.triplet_check(triplets, records, "id").collect()}
    assert found == {(2, 3): True, (3, 2): False, (2, 2): False, (4, 3): False}


def test_edge_texts(spark):
    texts = spark.createDataFrame([("",), ("A",), ("x " * 500,), ("12345",)], "text string")
    found = quality.edge_case_check(texts, HashingProvider(EmbeddingConfig("h", 8))).first()
    assert found["rows_in"] == 4 and found["passes"]


def test_null_keys_are_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert {(r["id"], r["rows"]) for r in quality.key_uniqueness(df, ["id"]).collect()} == {(1, 2), (None, 1)}


def test_readable_times_and_rates(spark):
    df = spark.createDataFrame([(90.0, 10000), (30.0, 10), (0.0, 5)], "s double, n bigint")
    rows = df.select(format_duration(F.col("s")).alias("d"), format_rate(F.col("n"), F.col("s")).alias("r")).collect()
    assert [r["d"] for r in rows] == ["90.0s (1.5 minutes)", "30.0s", "0.0s"]
    rate = spark.createDataFrame([(10000, 5.0)], "n bigint, s double").select(format_rate(F.col("n"), F.col("s")).alias("r"))
    assert rate.first()["r"] == "2,000.0 rows/s" and rows[2]["r"] == "N/A"


def test_totals_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    assert set(batch_totals(empty).first()) == {0}
    provider = HashingProvider(EmbeddingConfig("h", 8))
    report = run_report(empty, LoadConfig(label="L", key="id", source_table="t"), provider).first()
    assert report["rate"] == "N/A" and report["duration"] == "0.0s"


def session_like(master, folder=None):
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(session_like("yarn", "hdfs://shared/")) == "hdfs://shared"
    own = shared_folder(session_like("local[4]"))
    assert own == shared_folder(session_like("local[4]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session_like(master))


def test_nth_row_without_a_sort(spark, tmp_path):
    """Every place of a table of copies, nulls and several columns, by selection and by sorting."""
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "é"]), rng.choice([None, -1, 0, 7, 2**40])) for _ in range(500)] + [("hot", 1)] * 300
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "s string, n bigint").repartition(5).write.parquet(path)
    stored = spark.read.parquet(path)
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0))
    for nth in (1, 2, 333, 499, 500, 501, 799, 800):
        last, before = chunk.nth_row(stored, ["s", "n"], nth)
        found = tuple(last.first()["last"])
        assert found == order[nth - 1] and before == order.index(found)
    assert chunk.nth_row(stored, ["s", "n"], 801) is None
    assert chunk.nth_row(stored.limit(0), ["s", "n"], 1) is None


def test_limit_sorts_nothing(spark):
    limited = chunk.limit_rows(spark.range(5000).selectExpr("id % 1700 as k", "cast(id % 3 as string) as t"), 2000, ["k"])
    assert "Sort" not in plan_of(limited) and "Exchange range" not in plan_of(limited)
    keys = sorted(r["k"] for r in limited.collect())
    assert len(keys) == 2000 and keys == sorted(i % 1700 for i in range(5000))[:2000]


def test_broken_csv_rows_go_apart(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('id,name\n1,a\nx,b\n3\n4,d,e\n5,"f\n6,g\n7,\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    kept, rejects = tables.csv_ingest_checked(spark, str(source), schema, str(tmp_path / "out"))
    assert kept.columns == ["id", "name"]
    found = sorted(tuple(r) for r in kept.collect() if r["name"] in (None, "a", "g"))
    assert found == [(1, "a"), (6, "g"), (7, None)]
    assert {"x,b", "3", "4,d,e"} <= {r["line"] for r in rejects.collect()}
    assert all(r["file"].endswith("in.csv") for r in rejects.collect())
    source.write_text("id,name\n")
    kept, rejects = tables.csv_ingest_checked(spark, str(source), schema, str(tmp_path / "none"))
    assert kept.count() == rejects.count() == 0


def test_times_and_rates_round_the_number_itself(spark):
    """75 s are 1.25 minutes; a tie goes to the even digit, and 0.15 lies below its tie."""
    df = spark.createDataFrame([(75.0, 15), (100.0, 15), (105.0, 0)], "s double, n bigint")
    rows = df.select(format_duration(F.col("s")).alias("d"), format_rate(F.col("n"), F.col("s")).alias("r")).collect()
    assert [r["d"] for r in rows] == ["75.0s (1.2 minutes)", "100.0s (1.7 minutes)", "105.0s (1.8 minutes)"]
    assert [r["r"] for r in rows] == ["0.2 rows/s", "0.1 rows/s", "0.0 rows/s"]
