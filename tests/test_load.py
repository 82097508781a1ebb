import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_of, shuffled
from vecloom.catalog import loads
from vecloom.catalog.loads import write_parallelism
from vecloom.functions import models
from vecloom.operators.embed import EmbeddingConfig, HashingProvider, ModelProvider
from vecloom.plans.job import ProviderNotReady, run_job
from vecloom.plans.load import LoadConfig, RepeatedKeys, batch_load, open_run, process_batch, run_load, stream_load
from vecloom.session import work_path
from vecloom.sources.store import VectorTable, append_rows
from vecloom.streaming.ledger import BatchLedger
from vecloom.streaming.progress import progress_rows

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
SOURCE = T.StructType(SCHEMA.fields[:2])
DIMS = 8


def provider():
    return HashingProvider(EmbeddingConfig("hashing", DIMS))


def new_table(spark, **options):
    return VectorTable(spark, work_path(spark, "table"), SCHEMA, "id", **options)


def source(spark, start, stop):
    return spark.range(start, stop, 1, 1).select("id", F.concat(F.lit("text "), "id").alias("text"))


def write_files(spark, path, *ranges):
    for start, stop in ranges:
        source(spark, start, stop).write.mode("append").parquet(path)


def config(spark, path, **options):
    return LoadConfig(
        label="L", key="id", source_path=path, source_schema=SOURCE, checkpoint=work_path(spark, "cp"), **options
    )


def state(table):
    return sorted((r["id"], r["text"], tuple(r["embedding"])) for r in table.read_label("L").collect())


def ledger(table):
    rows = BatchLedger(table.spark, table.root).rows().orderBy("run_seq", "batch_id").collect()
    return [(r["run_seq"], r["batch_id"], r["status"], r["rows_read"], r["rows_skipped"], r["rows_written"]) for r in rows]


@pytest.fixture()
def files(spark):
    path = work_path(spark, "source")
    write_files(spark, path, (0, 10), (10, 20), (20, 30))
    return path


def test_stream_equals_batch(spark, files):
    streamed, batched = new_table(spark), new_table(spark)
    totals = stream_load(spark, config(spark, files), provider(), streamed)
    assert (totals["batches_processed"], totals["rows_read"], totals["rows_written"]) == (3, 30, 30)
    batch_load(spark, config(spark, files), provider(), batched)
    assert state(streamed) == state(batched) and len(state(batched)) == 30


def test_files_per_batch(spark, files):
    table = new_table(spark)
    assert stream_load(spark, config(spark, files, max_files_per_trigger=2), provider(), table)["batches_processed"] == 2


def test_named_source_table(spark):
    for start in (0, 10, 20):
        source(spark, start, start + 10).write.mode("append").saveAsTable("texts_to_load")
    for mode, batches in (("batch", 1), ("stream", 3)):
        table = new_table(spark)
        settings = LoadConfig(label="L", key="id", source_table="texts_to_load", checkpoint=work_path(spark, "cp"))
        totals = run_load(spark, settings, provider(), table, mode=mode)
        assert (totals["batches_processed"], totals["rows_written"]) == (batches, 30)


def test_resume_takes_only_new_files(spark, files):
    table, settings = new_table(spark), config(spark, files)
    stream_load(spark, settings, provider(), table)
    write_files(spark, files, (30, 40))
    totals = stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert totals["batches_processed"] == 4 and table.history().count() == 40
    stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert table.history().count() == 40


def test_cleared_checkpoint_loads_again_with_other_grouping(spark, files):
    table, settings = new_table(spark), config(spark, files)
    stream_load(spark, settings, provider(), table)
    settings.max_files_per_trigger = 2
    stream_load(spark, settings, provider(), table)
    assert table.history().count() == 60
    assert {r["run_seq"] for r in table.current().collect()} == {2} and table.current().count() == 30


def test_limit_across_batches(spark, files):
    table = new_table(spark)
    totals = stream_load(spark, config(spark, files, max_rows=15), provider(), table)
    assert [r[2:] for r in ledger(table)] == [("written", 10, 0, 10), ("written", 5, 5, 5), ("skipped", 0, 10, 0)]
    assert totals["rows_written"] == 15 and totals["rows_skipped"] == 15
    assert [r[0] for r in state(table)] == list(range(15))


def test_limit_is_charged_with_written_rows(spark, files):
    """Rows the model fails on are cut from the input like others, but do not use up the limit."""
    table = new_table(spark)
    short = ModelProvider(EmbeddingConfig("short", DIMS), lambda: models.ShortTextEncoder(DIMS, len("text 1")))
    stream_load(spark, config(spark, files, max_rows=15), short, table)
    assert [r[2:] for r in ledger(table)] == [("written", 10, 0, 10), ("no_valid", 5, 5, 0), ("no_valid", 5, 5, 0)]


def test_batch_limit_comes_after_the_null_filter(spark):
    path = work_path(spark, "source")
    text = F.when(F.col("id") >= 4, F.col("text")).alias("text")
    source(spark, 0, 10).select("id", text).write.parquet(path)
    table = new_table(spark)
    batch_load(spark, config(spark, path, max_rows=3), provider(), table)
    assert [r[0] for r in state(table)] == [4, 5, 6]


class Breaks(HashingProvider):
    """Fails on one record."""

    def vector(self):
        broken = F.raise_error(F.lit("model is down")).cast("array<float>")
        return F.when(F.col("id") == 15, broken).otherwise(super().vector())


def test_failure_in_the_second_batch_then_restart(spark, files):
    table, settings = new_table(spark), config(spark, files)
    with pytest.raises(StreamingQueryException, match="model is down"):
        stream_load(spark, settings, Breaks(EmbeddingConfig("b", DIMS)), table)
    assert [r[1:3] for r in ledger(table)] == [(0, "written"), (1, "failed")]
    totals = stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert [r[1:3] for r in ledger(table)] == [(0, "written"), (1, "written"), (2, "written")]
    assert totals["failed_batches"] == 0 and [r[0] for r in state(table)] == list(range(30))
    assert table.history().count() == 30


def test_limit_goes_on_after_a_restart(spark, files):
    table, settings = new_table(spark), config(spark, files, max_rows=17)
    with pytest.raises(StreamingQueryException):
        stream_load(spark, settings, Breaks(EmbeddingConfig("b", DIMS)), table)
    stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert [r[2:] for r in ledger(table)] == [("written", 10, 0, 10), ("written", 7, 3, 7), ("skipped", 0, 10, 0)]
    assert [r[0] for r in state(table)] == list(range(17))


def test_records_without_their_ledger_row(spark):
    """A crash after the records are written and before the batch is recorded."""
    table = new_table(spark)
    run = open_run(spark, LoadConfig(label="L", key="id"), provider(), table)
    embedded = provider().add_embeddings(source(spark, 0, 10)).withColumn("label", F.lit("L"))
    table.write_batch(embedded, run.run_seq, 0)
    process_batch(source(spark, 0, 10), 0, run)
    assert table.history().count() == 10 and [r[2] for r in ledger(table)] == ["written"]


def test_job(spark, files):
    table, settings = new_table(spark), config(spark, files)
    result = run_job(spark, settings, provider(), table, search_text="text 7")
    assert result.verification.first()["status"] == "passed" and result.deleted == 0
    nearest = result.nearest.collect()
    assert len(nearest) == 5 and nearest[0]["score"] == pytest.approx(1.0)
    assert result.report.first()["rows_written"] == 30
    assert [tuple(r)[:2] for r in result.sample.collect()] == [(i, f"text {i}") for i in range(5)]
    assert result.rejects.count() == 0
    again = run_job(spark, settings, provider(), table, cleanup=True)
    assert again.deleted == 30 and again.nearest is None and again.report.first()["rows_written"] == 30
    with pytest.raises(ProviderNotReady):
        run_job(spark, settings, ModelProvider(EmbeddingConfig("m", DIMS), lambda: lambda texts: [[1.0]]), table)


def test_replay_replaces_the_batch(spark):
    table = new_table(spark)
    run = open_run(spark, LoadConfig(label="L", key="id"), provider(), table)
    process_batch(source(spark, 0, 10), 0, run)
    process_batch(source(spark, 0, 10), 0, run)
    assert table.history().count() == 10
    process_batch(source(spark, 0, 10).filter("id < 0"), 0, run)
    assert table.history().count() == 0 and ledger(table)[0][2] == "empty"


def test_one_write_and_one_model_call_per_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def encode(batch):
            calls.add(len(batch))
            return [[1.0] * DIMS for _ in batch]

        return encode

    table = new_table(spark)
    run = open_run(
        spark, LoadConfig(label="L", key="id", write_partitions=3), ModelProvider(EmbeddingConfig("m", DIMS), factory), table
    )
    process_batch(source(spark, 0, 200), 0, run)
    assert calls.value == 200 and ledger(table)[0][3:] == (200, 0, 200)


def test_hot_key_is_spread_over_writers(spark):
    table = new_table(spark)
    hot = spark.range(0, 400, 1, 8).select(F.lit(1).cast("bigint").alias("id"), F.lit("same").alias("text"))
    settings = LoadConfig(label="L", key="id", write_partitions=4)
    process_batch(hot, 0, open_run(spark, settings, provider(), table))
    assert table.history().groupBy(F.input_file_name()).count().count() > 1
    assert len(state(table)) == 1


def test_mapping_and_mode(spark):
    path = work_path(spark, "source")
    source(spark, 0, 5).toDF(":ID(X)", "RMV").write.parquet(path)
    schema = T.StructType([T.StructField(":ID(X)", T.LongType()), T.StructField("RMV", T.StringType())])
    settings = LoadConfig(
        label="L", key="id", source_path=path, source_schema=schema, checkpoint=work_path(spark, "cp"),
        column_mappings={":ID(X)": "id", "RMV": "text"},
    )
    for mode in ("batch", "stream"):
        table = new_table(spark)
        assert run_load(spark, settings, provider(), table, mode=mode)["rows_written"] == 5
    with pytest.raises(ValueError, match="stream"):
        run_load(spark, settings, provider(), new_table(spark), mode="other")


# --- the table -----------------------------------------------------------------------------


def rows(spark, *values):
    df = spark.createDataFrame([(i, t, [1.0] * DIMS) for i, t in values], SCHEMA)
    return df.withColumn("label", F.lit("L"))


def texts(table, label="L"):
    return {r["id"]: r["text"] for r in table.read_label(label).collect()}


def test_missing_table_is_empty(spark):
    assert new_table(spark).current().count() == 0


def test_upsert_delete_and_reload(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a"), (2, "b")), 1, 0)
    table.write_batch(rows(spark, (2, "B"), (3, "c")), 1, 1)
    assert texts(table) == {1: "a", 2: "B", 3: "c"}
    table.write_batch(rows(spark, (9, "other")).withColumn("label", F.lit("M")), 1, 2)
    assert table.delete_label("L", 2) == 3
    assert texts(table) == {} and texts(table, "M") == {9: "other"}
    table.write_batch(rows(spark, (2, "again")), 3, 0)
    assert texts(table) == {2: "again"}
    assert table.delete_label("none", 4) == 0


def test_same_key_twice_in_a_batch(spark):
    table = new_table(spark, order_by=["text"])
    table.write_batch(rows(spark, (1, "b"), (1, "c"), (1, "a")), 1, 0)
    assert texts(table) == {1: "c"}


def test_the_last_write_wins(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a1")), 1, 7)
    table.write_batch(rows(spark, (1, "b1")), 2, 0)
    assert texts(table) == {1: "b1"}
    table.write_batch(rows(spark, (1, "a2")), 1, 8)
    assert texts(table) == {1: "a2"}
    table.write_batch(rows(spark, (1, "b1 again")), 2, 0)
    assert texts(table) == {1: "a2"}
    table.delete_label("L", 3)
    table.write_batch(rows(spark, (1, "a3")), 1, 9)
    assert texts(table) == {1: "a3"}
    other = VectorTable(spark, table.root, SCHEMA, "id")
    other.write_batch(rows(spark, (1, "other writer")), 9, 0)
    assert texts(table) == {1: "other writer"}


def test_equal_order_is_settled_by_the_row(spark):
    for parts in (1, 3):
        table = new_table(spark, order_by=["id"])
        table.write_batch(rows(spark, (1, "b"), (1, "c"), (1, "a")).repartition(parts), 1, 0)
        first = texts(table)
    assert first == texts(table) and len(first) == 1


def test_checkpoint_folders_are_of_one_run(spark, files):
    settings, first, second = config(spark, files), new_table(spark), new_table(spark)
    for table in (first, second):
        stream_load(spark, settings, provider(), table)
        assert len(state(table)) == 30
    small = first.compact(work_path(spark, "compacted"))
    write_files(spark, files, (30, 40))
    totals = stream_load(spark, settings, provider(), small, clear_checkpoint=False)
    assert len(state(small)) == 40 and totals["batches_processed"] == 4
    stream_load(spark, settings, provider(), small)
    assert small.history().count() == 30 + 10 + 40 and len(state(small)) == 40


def test_outage_fails_the_batch_and_a_resume_loads_it(spark, files):
    table, settings = new_table(spark), config(spark, files)

    def down(batch):
        raise ConnectionError("endpoint is down")

    broken = ModelProvider(EmbeddingConfig("m", DIMS), lambda: down, attempts=2, wait=0.01)
    with pytest.raises(StreamingQueryException, match="endpoint is down"):
        stream_load(spark, settings, broken, table)
    assert [r[2] for r in ledger(table)] == ["failed"]
    error = BatchLedger(spark, table.root).rows().first()["error"]
    assert "ConnectionError: endpoint is down" in error
    stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert len(state(table)) == 30


def test_rejects(spark):
    table = new_table(spark)
    source_rows = source(spark, 0, 20).withColumn("id", F.when(F.col("id") % 10 != 3, F.col("id")))
    short = ModelProvider(EmbeddingConfig("short", DIMS), lambda: models.ShortTextEncoder(DIMS, len("text 1")))
    run = open_run(spark, LoadConfig(label="L", key="id"), short, table)
    process_batch(source_rows, 0, run)
    found = {(r["label"], r["id"], r["reason"]) for r in table.rejects("L").collect()}
    assert found == {("L", None, "null key")} | {("L", i, "ValueError: text too long") for i in range(10, 20) if i != 13}
    assert ledger(table)[0][3:] == (20, 0, 9) and sorted(texts(table)) == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    assert table.history().count() == 9


def test_files_of_batch_size(spark):
    table = new_table(spark)
    run = open_run(spark, LoadConfig(label="L", key="id", batch_size=7, batch_files=True), provider(), table)
    process_batch(source(spark, 0, 30), 0, run)
    assert max(r["count"] for r in table.history().groupBy(F.input_file_name()).count().collect()) <= 7


@pytest.mark.parametrize("limit", [1, 5, 77, 100, 250, 299, 300, 400])
def test_limit_with_ties_and_copies(spark, limit):
    from vecloom.operators.chunk import limit_rows

    frame = spark.range(0, 300, 1, 4).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id")).alias("v"))
    found = limit_rows(frame, limit, ["k"])
    once, again = sorted(map(tuple, found.collect())), sorted(map(tuple, limit_rows(frame.repartition(7), limit, ["k"]).collect()))
    assert len(once) == min(limit, 300) and once == again
    assert [r[0] for r in once] == sorted(i % 3 for i in range(300))[:limit]
    assert set(once) <= set(map(tuple, frame.collect()))
    assert "TakeOrdered" not in plan_of(found)


def test_runs_belong_to_checkpoints(spark):
    table = new_table(spark)
    assert [table.open_run("a"), table.open_run("b"), table.open_run("a", fresh=False)] == [1, 2, 1]
    assert table.open_run("a") == 3 and table.open_run("a", fresh=False) == 3


def test_partial_rows(spark):
    table = new_table(spark, partial_rows=True)
    table.write_batch(rows(spark, (1, "a"), (2, "b")), 1, 0)
    table.write_batch(rows(spark, (1, "A")).drop("embedding"), 2, 0)
    table.write_batch(rows(spark, (2, None)).drop("embedding"), 2, 1)
    found = {r["id"]: (r["text"], r["embedding"]) for r in table.read_label("L").collect()}
    assert found == {1: ("A", [1.0] * DIMS), 2: (None, [1.0] * DIMS)}
    table.delete_label("L", 3)
    table.write_batch(rows(spark, (1, "back")).drop("embedding"), 4, 0)
    found = {r["id"]: (r["text"], r["embedding"]) for r in table.read_label("L").collect()}
    assert found == {1: ("back", None)}


def test_compact(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a"), (2, "b")), 1, 0)
    table.write_batch(rows(spark, (2, "B")), 2, 0)
    small = table.compact(work_path(spark, "compacted"))
    assert small.history().count() == 2 and texts(small) == texts(table)
    small.write_batch(rows(spark, (1, "z")), small.open_run("later"), 0)
    assert texts(small) == {1: "z", 2: "B"}
    assert small.delete_label("L", 5) == 2 and texts(small) == {}
    small.write_batch(rows(spark, (2, "y"), (7, "new")), 6, 0)
    assert texts(small) == {2: "y", 7: "new"}


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def numbered_rows(spark, n, text, step=1):
    df = spark.range(0, n * step, step, 4)
    return df.select("id", F.lit(text).alias("text"), F.array(F.lit(1.0)).cast("array<float>").alias("embedding"), F.lit("L").alias("label"))


def test_only_rows_that_may_have_changed_are_shuffled(spark, monkeypatch, no_broadcast):
    """Ten thousand changed keys in every one of 64 buckets move no more than 2 % of a million rows."""
    monkeypatch.setattr("vecloom.sources.store.BUCKET_ROWS", 16_000)
    table = new_table(spark)
    table.write_batch(numbered_rows(spark, 1_000_000, "a"), 1, 0)
    small = table.compact(work_path(spark, "compacted"))
    assert "Exchange" not in plan_of(small.read_label("L"))
    assert small._base("L").select("_bucket").distinct().count() == small._base_buckets() == 64
    small.write_batch(numbered_rows(spark, 10_000, "z", 150), 2, 0)
    assert small._stored("L").select(small._bucket(64)).distinct().count() == 64
    found = small.read_label("L")
    assert {r["text"]: r["count"] for r in found.groupBy("text").count().collect()} == {"a": 1_000_000 - 6_667, "z": 10_000}
    moved = [rows for below, rows in shuffled(found) if "_bucket" in below]
    assert moved and sum(moved) <= 20_000


def test_a_narrow_filter_loses_nothing(spark, monkeypatch):
    """With a filter of 64 bits nearly all rows may have changed; the exact join settles them."""
    monkeypatch.setattr("vecloom.sources.store.FILTER_BITS", 64)
    monkeypatch.setattr("vecloom.sources.store.BUCKET_ROWS", 40)
    table = new_table(spark)
    table.write_batch(rows(spark, *((i, "a") for i in range(300))), 1, 0)
    small = table.compact(work_path(spark, "compacted"))
    small.write_batch(rows(spark, *((i, "z") for i in range(0, 600, 4))), 2, 0)
    assert texts(small) == {**{i: "a" for i in range(300)}, **{i: "z" for i in range(0, 600, 4)}}


def test_merge_by_level(spark):
    """Parts double in level; what a merge does not take keeps its files, and readers see one state throughout."""
    table, state = new_table(spark), {}

    def load(batch, *values):
        table.write_batch(rows(spark, *values), 1, batch)
        state.update(values)
        assert texts(table) == state

    def names():
        return {p.path: sorted(table.spark.read.parquet(p.path).inputFiles()) for p in table.parts()}

    load(0, *((i, "a") for i in range(50)))
    load(1, (3, "b"), (50, "b"))
    assert [p.level for p in table.merge(2)] == [1] and texts(table) == state
    first = names()
    load(2, (3, "c"), (51, "c"))
    assert [(p.level, p.rows) for p in table.merge(2)] == [(2, 52)] and texts(table) == state
    second = names()
    load(3, (4, "d"))
    assert [p.level for p in table.merge(2)] == [2, 1] and texts(table) == state
    third = names()
    assert not first.items() & second.items() and second.items() <= third.items()
    assert table.merge(2) == table.parts() and names() == third
    # A batch that is done again after its merge changes nothing, and numbers go on.
    table.write_batch(rows(spark, (3, "late")), 1, 1)
    assert texts(table) == state
    load(4, (3, "e"))
    assert table._last_commit() == 5
    table.merge(2)
    assert texts(table) == state and table.history().select("id").distinct().count() == len(state)


def test_merge_with_deletions(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a"), (2, "b")), 1, 0)
    table.merge(3)
    one = rows(spark, (1, None)).withColumn("deleted", F.lit(True))
    table.write_batch(one, 1, 1)
    table.merge(3)
    assert texts(table) == {2: "b"}
    assert table.delete_label("L", 2) == 1 and texts(table) == {}
    table.write_batch(rows(spark, (2, "back")).withColumn("embedding", F.lit(None)), 1, 2)
    assert [p.level for p in table.merge(3)] == [2] and texts(table) == {2: "back"}
    assert [p.rows for p in table.parts()] == [1]
    small = table.compact(work_path(spark, "compacted"))
    small.write_batch(rows(spark, (5, "new")), 9, 0)
    small.merge()
    assert texts(small) == {2: "back", 5: "new"} and small.delete_label("L", 10) == 2 and texts(small) == {}


def test_merge_leaves_broken_batches_and_manifests(spark):
    from vecloom.sources import files as paths

    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a")), 1, 0)
    table.write_batch(rows(spark, (2, "b")), 1, 1)
    table.write_batch(rows(spark, (3, "c")), 1, 2)
    broken = paths.matching(spark, f"{table.records}/run_seq=1/batch_id=1/commit=*/_SUCCESS")[0]
    place, system = paths._opened(spark, broken)
    system.delete(place, False)
    assert [p.through for p in table.merge()] == [1]
    paths.claim(spark, f"{table.root}/manifests/2/part-of-one")
    assert [p.through for p in table.parts()] == [1] and texts(table) == {1: "a", 2: "b", 3: "c"}
    table.write_batch(rows(spark, (2, "b")), 1, 1)
    assert table.merge()[-1].through == 3 and texts(table) == {1: "a", 2: "b", 3: "c"}
    with pytest.raises(ValueError, match="compact"):
        new_table(spark, partial_rows=True).merge()


def test_emptying_a_label_writes_one_row(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, *((i, "a") for i in range(100))), 1, 0)
    assert table.delete_label("L", 2) == 100
    assert spark.read.parquet(f"{table.root}/emptied").count() == 1
    assert spark.read.parquet(table.records).count() == 100 and texts(table) == {}
    # The same deletion again keeps its place: what came later stays.
    table.write_batch(rows(spark, (1, "b")), 1, 1)
    assert table.delete_label("L", 2) == 1 and texts(table) == {1: "b"}


def test_null_keys_are_refused(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (None, "a"), (None, "c"), (2, "b")), 1, 0)
    assert texts(table) == {2: "b"} and table.history().count() == 1
    assert [tuple(r)[:3] for r in table.rejects().collect()] == [("L", None, "null key")] * 2


def test_reading_prunes_folders_and_keys_early(spark):
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a")), 1, 0)
    plan = plan_of(table.read_label("L"))
    assert "label" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # One row per key and task before the shuffle, so a hot key stays small.
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_odd_key_name(spark):
    schema = T.StructType([T.StructField(":ID(X).1", T.LongType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema).withColumn("label", F.lit("L"))
    for partial in (False, True):
        table = VectorTable(spark, work_path(spark, "table"), schema, ":ID(X).1", ["v"], partial_rows=partial)
        table.write_batch(df, 1, 0)
        assert sorted(tuple(r) for r in table.read_label("L").collect()) == [(1, "b", "L"), (2, "c", "L")]
        assert table.delete_label("L", 2) == 2


def test_append_keeps_duplicates(spark):
    path = work_path(spark, "appended")
    append_rows(rows(spark, (1, "a")), path)
    append_rows(rows(spark, (1, "a")), path)
    assert spark.read.parquet(path).count() == 2


# --- rules, unfinished writes, progress ------------------------------------------------------


def test_key_rule(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id bigint, text string")
    free, rejecting, failing = (new_table(spark, order_by=["text"]) for _ in range(3))
    for table, rule in ((free, None), (rejecting, "reject")):
        run = open_run(spark, LoadConfig(label="L", key="id", key_rule=rule), provider(), table)
        process_batch(batch, 0, run)
        assert texts(table) == {1: "b", 2: "c"}
    assert sorted(r["reason"] for r in rejecting.rejects().collect()) == ["null key"] * 2 + ["repeated key"] * 2
    assert ledger(rejecting) == [(1, 0, "written", 6, 0, 2)] and ledger(free) == [(1, 0, "written", 6, 0, 4)]
    # Doing the batch again gives the same rejects once.
    process_batch(batch, 0, open_run(spark, LoadConfig(label="L", key="id", key_rule="reject"), provider(), rejecting, fresh=False))
    assert rejecting.rejects().count() == 4
    run = open_run(spark, LoadConfig(label="L", key="id", key_rule="fail"), provider(), failing)
    with pytest.raises(RepeatedKeys, match="key 1 has 3 rows"):
        process_batch(batch, 0, run)
    assert texts(failing) == {} and ledger(failing)[0][2] == "failed"
    process_batch(batch.dropDuplicates(["id"]), 1, run)
    assert set(texts(failing)) == {1, 2}
    with pytest.raises(ValueError, match="key rule"):
        open_run(spark, LoadConfig(label="L", key="id", key_rule="maybe"), provider(), new_table(spark))


def test_failed_write_is_not_seen(spark):
    """A task that dies after others have written leaves nothing that a reader, a merge or a compaction takes."""
    table = new_table(spark)
    table.write_batch(rows(spark, (1, "a")), 1, 0)
    dies = F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="broken"):
        table.write_batch(rows(spark, *((i, "b") for i in range(8))).repartition(4).withColumn("text", dies.cast("string")), 1, 1)
    assert table._pending() == [2] and texts(table) == {1: "a"}
    table._write(rows(spark, (1, "half")), f"{table.records}/run_seq=1/batch_id=1/commit=2")
    table.write_batch(rows(spark, (3, "c")), 1, 2)
    assert texts(table) == {1: "a", 3: "c"} and table.history().count() == 2
    assert [p.through for p in table.merge()] == [1] and texts(table) == {1: "a", 3: "c"}
    assert texts(table.compact(work_path(spark, "compacted"))) == {1: "a", 3: "c"}
    table.write_batch(rows(spark, (1, "b"), (2, "b")), 1, 1)
    assert table._pending() == [] and texts(table) == {1: "b", 2: "b", 3: "c"}


def test_progress_of_a_stream(spark, files):
    table = new_table(spark)
    settings = config(spark, files)
    stream_load(spark, settings, provider(), table)
    found = progress_rows(spark, table.root, 1).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in found] == [(0, 10), (1, 10), (2, 10)]
    assert all(r["duration_ms"] > 0 and r["processed_rows_per_second"] > 0 for r in found)
    # A resume without news adds nothing, and another table has a log of its own.
    stream_load(spark, settings, provider(), table, clear_checkpoint=False)
    assert progress_rows(spark, table.root).count() == 3
    assert progress_rows(spark, new_table(spark).root).count() == 0


def test_files_follow_the_batch_size(spark, files):
    table = new_table(spark)
    batch_load(spark, config(spark, files, batch_size=4, write_partitions=1), provider(), table)
    per_file = table.history().groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 4 and sum(r["count"] for r in per_file) == 30


def test_write_is_tried_again(spark, monkeypatch):
    table, calls = new_table(spark), []
    whole = table.write_batch

    def shaky(*args, **options):
        calls.append(1)
        if len(calls) % 3:
            raise OSError("store is away")
        whole(*args, **options)

    monkeypatch.setattr(table, "write_batch", shaky)
    run = open_run(spark, LoadConfig(label="L", key="id", write_pause=0), provider(), table)
    process_batch(source(spark, 0, 5), 0, run)
    assert len(calls) == 3 and len(texts(table)) == 5
    run = open_run(spark, LoadConfig(label="L", key="id", write_attempts=2, write_pause=0), provider(), table)
    with pytest.raises(OSError):
        process_batch(source(spark, 0, 5), 0, run)
    assert [r[2] for r in ledger(table)] == ["written", "failed"]


def test_ledger_knows_the_vectors_lengths(spark):
    table = new_table(spark)
    run = open_run(spark, LoadConfig(label="L", key="id"), provider(), table)
    process_batch(source(spark, 0, 5), 0, run)
    process_batch(source(spark, 0, 0), 1, run)
    rows = BatchLedger(spark, table.root).rows().orderBy("batch_id").collect()
    assert [(r["dims_min"], r["dims_max"]) for r in rows] == [(DIMS, DIMS), (None, None)]


def test_writers_are_counted_and_not_their_files(spark, tmp_path):
    spark.range(40_000).selectExpr("id AS doc_id", "concat('w', id) AS text", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    assert tuple(write_parallelism(spark, str(tmp_path)).first()) == (3, 40_000)


def test_parts_of_a_stream_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "FILE_ROWS", 20, raising=False)
    spark.range(402).selectExpr("id AS doc_id", "concat('w', id) AS text", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    paths, whole = [], loads.document_load
    monkeypatch.setattr(loads, "document_load", lambda spark, path, *args: paths.append(path) or whole(spark, path, *args))
    found = loads.stream_progress(spark, str(tmp_path))
    assert sorted((r["batch_id"], r["input_rows"]) for r in found.collect()) == [(0, 101), (1, 101), (2, 100), (3, 100)]
    rows = [r["count"] for r in spark.read.parquet(paths[0]).groupBy(F.input_file_name()).count().collect()]
    assert len(rows) == 20 and max(rows) <= 21
