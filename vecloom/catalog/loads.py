"""Registered queries: streams, the keyed table, whole loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.catalog import sql
from vecloom.catalog.registry import load_table, register
from vecloom.catalog.rows import documents
from vecloom.catalog.vectors import DIMS, DOCS, SPOKEN, cells, hashing
from vecloom.functions import models
from vecloom.operators.chunk import chunk_assign, limit_rows
from vecloom.operators.embed import EmbeddingConfig, EmbeddingProvider, HashingProvider, ModelProvider
from vecloom.plans.job import run_job
from vecloom.plans.load import LoadConfig, batch_load, open_run, process_batch, run_load, stream_load
from vecloom.session import work_path
from vecloom.sources.store import VectorTable, append_rows
from vecloom.sources.tables import csv_ingest_checked, stream_scan
from vecloom.streaming.progress import progress_rows

SLICES = 4
#: Rows of a file of a stream's part.
FILE_ROWS = 5000
RECORD = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)


def document_slices(spark: SparkSession, folder: str, slices: int = SLICES) -> tuple[list[DataFrame], str]:
    """The documents cut into key ranges, and a folder to put them in as a stream's source."""
    narrow = documents(spark, folder).select("doc_id", "text", "lang")
    shares = [i / slices for i in range(1, slices)]
    cuts = narrow.approxQuantile("doc_id", shares, 0.001) if shares else []
    place = F.lit(0)
    for cut in cuts:
        place = place + F.when(F.col("doc_id") > cut, 1).otherwise(0)
    return [narrow.filter(place == i) for i in range(slices)], work_path(spark, "documents")


def document_files(spark: SparkSession, folder: str, slices: int = SLICES) -> tuple[str, int]:
    """All slices written one after another, and how many files make one micro-batch."""
    parts, path = document_slices(spark, folder, slices)
    for part in parts:
        part.write.mode("append").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return path, -(-files // slices)


def new_table(spark: SparkSession, schema: T.StructType = RECORD, key: str = "doc_id", **options) -> VectorTable:
    return VectorTable(spark, work_path(spark, "table"), schema, key, **options)


def document_load(spark: SparkSession, path: str, files: int, **options) -> LoadConfig:
    return LoadConfig(
        label="Document",
        key="doc_id",
        source_path=path,
        source_schema=T.StructType(RECORD.fields[:3]),
        checkpoint=work_path(spark, "checkpoint"),
        max_files_per_trigger=files,
        **options,
    )


def totals_frame(spark: SparkSession, totals: dict) -> DataFrame:
    """The counts of a run, without the times."""
    names = ("batches_processed", "failed_batches", "rows_read", "rows_written", "rows_skipped", "rows_invalid")
    schema = ", ".join(f"{n} bigint" for n in names)
    return spark.createDataFrame([tuple(totals[n] for n in names)], schema)


# --- streams and loads ---------------------------------------------------------------------


@register("stream_scan", "SELECT doc_id, text, lang FROM documents")
def scan_stream(spark, folder):
    path, files = document_files(spark, folder)
    out = work_path(spark, "copied")
    source = stream_scan(spark, path=path, schema=T.StructType(RECORD.fields[:3]), max_files_per_trigger=files)
    query = (
        source.writeStream.format("parquet")
        .option("checkpointLocation", work_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


@register("stream_load", sql.hashed_cells(DOCS, DIMS, "doc_id"))
def load_by_stream(spark, folder):
    path, files = document_files(spark, folder)
    table = new_table(spark)
    stream_load(spark, document_load(spark, path, files), hashing(), table)
    return cells(table.read_label("Document"), "doc_id")


@register("batch_load", sql.hashed_cells(SPOKEN, DIMS, "turn_id"))
def load_by_batch(spark, folder):
    schema = T.StructType(
        [
            T.StructField("turn_id", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
        ]
    )
    table = new_table(spark, schema, "turn_id")
    config = LoadConfig(label="Turn", key="turn_id", source_path=f"{folder}/conversations.parquet")

    def selector(df):
        return df.select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text")

    batch_load(spark, config, hashing(), table, selector)
    return cells(table.read_label("Turn"), "turn_id")


ALL_COUNTS = """SELECT {batches}::BIGINT AS batches_processed, 0::BIGINT AS failed_batches, count(*) AS rows_read,
    count(*) AS rows_written, 0::BIGINT AS rows_skipped, 0::BIGINT AS rows_invalid FROM documents"""


@register("run_load", ALL_COUNTS.format(batches=1))
def load_run(spark, folder):
    config = LoadConfig(label="Document", key="doc_id", source_path=f"{folder}/documents.parquet")
    return totals_frame(spark, run_load(spark, config, hashing(), new_table(spark), mode="batch"))


@register("available_now", ALL_COUNTS.format(batches=SLICES))
def available_now(spark, folder):
    """The stream takes all that is there, in micro-batches, and stops."""
    path, files = document_files(spark, folder)
    config = document_load(spark, path, files)
    return totals_frame(spark, run_load(spark, config, hashing(), new_table(spark), mode="stream"))


@register(
    "checkpoint_resume",
    """SELECT 2::BIGINT AS batches, 1::BIGINT AS runs, count(*) AS versions, count(*) AS current FROM documents""",
)
def checkpoint_resume(spark, folder):
    """Half of the source, then the other half, then nothing new: no row is loaded twice."""
    (first, second), path = document_slices(spark, folder, 2)
    table = new_table(spark)
    config = document_load(spark, path, 1_000_000)
    first.write.mode("append").parquet(path)
    stream_load(spark, config, hashing(), table)
    second.write.mode("append").parquet(path)
    stream_load(spark, config, hashing(), table, clear_checkpoint=False)
    stream_load(spark, config, hashing(), table, clear_checkpoint=False)
    return _versions(table)


@register(
    "checkpoint_reset",
    """SELECT 2::BIGINT AS batches, 2::BIGINT AS runs, 2 * count(*) AS versions, count(*) AS current FROM documents""",
)
def checkpoint_reset(spark, folder):
    """A cleared checkpoint loads everything again, as newer versions of the same records."""
    path, files = document_files(spark, folder, 1)
    table = new_table(spark)
    config = document_load(spark, path, files)
    stream_load(spark, config, hashing(), table)
    stream_load(spark, config, hashing(), table)
    return _versions(table)


def _versions(table: VectorTable) -> DataFrame:
    history = table.history().agg(
        F.count_distinct("run_seq", "batch_id").alias("batches"),
        F.count_distinct("run_seq").alias("runs"),
        F.count(F.lit(1)).alias("versions"),
    )
    current = table.current().agg(F.count(F.lit(1)).alias("current"))
    return history.withColumn("current", current.scalar())


class EndpointDown(EmbeddingProvider):
    """Stands for a model endpoint that is down."""

    def vector(self):
        return F.raise_error(F.lit("endpoint is down")).cast("array<float>")


def short_texts_only() -> ModelProvider:
    return ModelProvider(EmbeddingConfig("custom", DIMS), lambda: models.ShortTextEncoder(DIMS, 2000))


LEDGER_COLUMNS = ("batch_id", "status", "rows_read", "rows_invalid", "rows_written", "chunks")


@register(
    "process_batch",
    """SELECT 0::BIGINT AS batch_id, 'written' AS status, count(*) AS rows_read,
    count_if(length(text) > 2000)::BIGINT AS rows_invalid, count_if(length(text) <= 2000)::BIGINT AS rows_written,
    ((count(*) + 99) // 100)::BIGINT AS chunks FROM documents""",
)
def one_batch(spark, folder):
    config = LoadConfig(label="Document", key="doc_id", batch_size=100)
    run = open_run(spark, config, short_texts_only(), new_table(spark))
    process_batch(documents(spark, folder).select("doc_id", "text", "lang"), 0, run)
    return run.ledger.rows().select(*LEDGER_COLUMNS)


@register(
    "skip_empty",
    """SELECT 0::BIGINT AS batch_id, 'empty' AS status, 0::BIGINT AS rows_read, 0::BIGINT AS rows_invalid,
        0::BIGINT AS rows_written
    UNION ALL SELECT 1, 'no_valid', count(*), count(*), 0 FROM documents
    UNION ALL SELECT 2, 'written', count(*), 0, count(*) FROM documents""",
)
def skip_empty(spark, folder):
    """A batch without text and a batch of wrong vectors write nothing, but have their ledger row."""
    source = documents(spark, folder).select("doc_id", "text", "lang")
    config = LoadConfig(label="Document", key="doc_id")
    run = open_run(spark, config, hashing(), new_table(spark))
    process_batch(source.filter(F.col("text").isNull()), 0, run)
    run.provider = TooShort(EmbeddingConfig("hashing", DIMS))
    process_batch(source, 1, run)
    run.provider = hashing()
    process_batch(source, 2, run)
    return run.ledger.rows().select(*LEDGER_COLUMNS[:5])


class TooShort(HashingProvider):
    """Vectors of the wrong length."""

    def vector(self):
        return F.array(F.lit(0.0))


@register(
    "idempotent_replay",
    """SELECT 2::BIGINT AS batches, 2::BIGINT AS runs, 2 * count(*) AS versions, count(*) AS current FROM documents""",
)
def idempotent_replay(spark, folder):
    """A batch done twice leaves its rows once; a new run adds versions of the same records."""
    source = documents(spark, folder).select("doc_id", "text", "lang")
    config = LoadConfig(label="Document", key="doc_id")
    table = new_table(spark)
    for _ in range(2):
        run = open_run(spark, config, hashing(), table)
        process_batch(source, 0, run)
        process_batch(source, 0, run)
    return _versions(table)


@register(
    "failure_accounting",
    """SELECT 0::BIGINT AS batch_id, 'failed' AS status, 0::BIGINT AS rows_written, true AS has_error, true AS raised
    UNION ALL SELECT 1, 'written', count(*), false, true FROM documents""",
)
def failure_accounting(spark, folder):
    """A failed batch is recorded and the error reaches the caller; the next batch is not affected."""
    source = documents(spark, folder).select("doc_id", "text", "lang")
    config = LoadConfig(label="Document", key="doc_id")
    run = open_run(spark, config, EndpointDown(EmbeddingConfig("down", DIMS)), new_table(spark))
    try:
        process_batch(source, 0, run)
        raised = False
    except Exception:
        raised = True
    run.provider = hashing()
    process_batch(source, 1, run)
    return run.ledger.rows().select(
        "batch_id", "status", "rows_written", F.col("error").isNotNull().alias("has_error"), F.lit(raised).alias("raised")
    )


@register("limit_stream", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 150")
def limit_stream(spark, folder):
    """A running limit over micro-batches: cut the batch that reaches it, skip the later ones."""
    path, files = document_files(spark, folder)
    table = new_table(spark)
    stream_load(spark, document_load(spark, path, files, max_rows=150), hashing(), table)
    return table.read_label("Document").select("doc_id", "lang")


@register(
    "limit_stream_counts",
    """SELECT 150::BIGINT AS rows_written, (count(*) - 150)::BIGINT AS rows_skipped FROM documents""",
)
def limit_stream_counts(spark, folder):
    path, files = document_files(spark, folder)
    totals = stream_load(spark, document_load(spark, path, files, max_rows=150), hashing(), new_table(spark))
    return totals_frame(spark, totals).select("rows_written", "rows_skipped")


@register(
    "load_job",
    f"""WITH {sql.hashed(DOCS, DIMS, 'd_')}, {sql.hashed("SELECT 0 AS key, 'the with and that is' AS text", DIMS, 'q_')},
    scored AS (SELECT d.key AS doc_id, {sql.cosine('d.embedding', 'q.embedding')} AS score FROM d_list d, q_list q)
    SELECT doc_id, {sql.shown()}, (SELECT count(*) FROM documents) AS verified FROM (
        SELECT * FROM scored WHERE NOT isnan(score) ORDER BY score DESC, doc_id LIMIT 5)""",
)
def load_job(spark, folder):
    """Load, verify and search in one go: the five documents nearest to a typed query."""
    config = LoadConfig(label="Document", key="doc_id", source_path=f"{folder}/documents.parquet")
    result = run_job(
        spark, config, hashing(), new_table(spark), lambda df: df.select("doc_id", "text", "lang"),
        mode="batch", search_text="the with and that is",
    )
    verified = result.verification.filter("passes").select("total")
    return result.nearest.select("doc_id", (F.round("score", 6) + 0.0).alias("score")).withColumn("verified", verified.scalar())


# --- the keyed table -----------------------------------------------------------------------

EVENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
ROUTED = "SELECT user_id, event_id, ts, event_type, value, event_type AS label FROM events"


def event_table(spark: SparkSession, folder: str, label) -> VectorTable:
    """All events in one batch, keyed by user: the last event of a user is the current one."""
    table = new_table(spark, EVENT, "user_id", order_by=["ts", "event_id"])
    events = load_table(spark, folder, "events").withColumn("label", label)
    table.write_batch(events, table.open_run("events"), 0, many_labels=True)
    return table


@register(
    "upsert_by_key",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY event_type = 'purchase' DESC, ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1""",
)
def upsert_by_key(spark, folder):
    """All events, then the purchases once more as a later run: they win over what is there."""
    table = event_table(spark, folder, F.lit("User"))
    purchases = load_table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    table.write_batch(purchases.withColumn("label", F.lit("User")), table.open_run("purchases"), 0)
    return table.read_label("User").select("user_id", "event_id", "event_type", "value")


@register(
    "upsert_partial_rows",
    """WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
        AS nth FROM events) WHERE nth = 1),
    bought AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
        AS nth FROM events WHERE event_type = 'purchase') WHERE nth = 1)
    SELECT l.user_id, l.event_type, CASE WHEN b.user_id IS NOT NULL THEN b.event_id ELSE l.event_id END AS event_id,
    CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE l.value END AS value FROM last l LEFT JOIN bought b USING (user_id)""",
)
def upsert_partial_rows(spark, folder):
    """A later run that gives some columns only: the others keep their values."""
    table = new_table(spark, EVENT, "user_id", order_by=["ts", "event_id"], partial_rows=True)
    events = load_table(spark, folder, "events").withColumn("label", F.lit("User"))
    table.write_batch(events, table.open_run("events"), 0)
    purchases = events.filter(F.col("event_type") == "purchase").drop("event_type")
    table.write_batch(purchases, table.open_run("purchases"), 0)
    return table.read_label("User").select("user_id", "event_id", "event_type", "value")


@register(
    "read_label",
    f"""SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS nth FROM ({ROUTED}) WHERE label = 'click') WHERE nth = 1""",
)
def read_label(spark, folder):
    table = event_table(spark, folder, F.col("event_type"))
    return table.read_label("click").select("user_id", "event_id", "ts", "value")


@register("append_rows", "SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, quality, toxic FROM labels")
def appended(spark, folder):
    path = work_path(spark, "appended")
    labels = load_table(spark, folder, "labels").withColumn("label", F.lit("Quality"))
    append_rows(labels, path)
    append_rows(labels, path)
    return spark.read.parquet(path).select("doc_id", "quality", "toxic")


@register("write_parallelism", "SELECT 3::BIGINT AS files, count(*) AS rows FROM documents")
def write_parallelism(spark, folder):
    """How many tasks write: each names its files by its own number, however many the batch size makes of its rows."""
    config = LoadConfig(label="Document", key="doc_id", source_path=f"{folder}/documents.parquet", write_partitions=3)
    table = new_table(spark)
    batch_load(spark, config, hashing(), table, lambda df: df.select("doc_id", "text", "lang"))
    writer = F.regexp_extract(F.input_file_name(), r"/part-(\d+)-[^/]*$", 1)
    per_writer = table.history().groupBy(writer).agg(F.count(F.lit(1)).alias("n"))
    return per_writer.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


@register("write_batch_size", "SELECT count(*) AS rows, true AS within_limit FROM documents")
def write_batch_size(spark, folder):
    config = LoadConfig(label="Document", key="doc_id", source_path=f"{folder}/documents.parquet")
    table = new_table(spark, max_records_per_file=120)
    batch_load(spark, config, hashing(), table, lambda df: df.select("doc_id", "text", "lang"))
    per_file = table.history().groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("rows"), (F.max("n") <= 120).alias("within_limit"))


VECTOR = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
)


def label_table(spark: SparkSession, folder: str) -> VectorTable:
    table = new_table(spark, VECTOR, "vec_id")
    table.write_batch(load_table(spark, folder, "embeddings"), table.open_run("embeddings"), 0, many_labels=True)
    return table


@register(
    "delete_by_label",
    """SELECT label::VARCHAR AS label, count(*) AS rows, (SELECT count(*) FROM embeddings WHERE label = 3) AS deleted
    FROM embeddings WHERE label <> 3 GROUP BY label""",
)
def delete_by_label(spark, folder):
    table = label_table(spark, folder)
    deleted = table.delete_label("3", table.open_run("cleanup"))
    left = table.current().groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    return left.withColumn("deleted", F.lit(deleted).cast("bigint"))


@register("route_by_label", "SELECT vec_id, label::VARCHAR AS label FROM embeddings")
def route_by_label(spark, folder):
    return label_table(spark, folder).current().select("vec_id", "label")


@register(
    "compact_table",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1""",
)
def compact_table(spark, folder):
    """The current state rewritten as a table of one version per record."""
    compacted = event_table(spark, folder, F.lit("User")).compact(work_path(spark, "compacted"))
    return compacted.history("User").select("user_id", "event_id", "event_type")


# --- the order of writing, other tables' checkpoints, refused rows --------------------------


def shouted(text: str, times: int):
    return F.concat(F.col(text), F.lit("!" * times))


def versions_of(spark: SparkSession, folder: str, times: int, residue: int) -> DataFrame:
    """The documents of one residue class, with a text that tells the write they come from."""
    rows = documents(spark, folder).filter(F.col("doc_id") % 3 <= residue)
    return rows.select("doc_id", shouted("text", times).alias("text"), "lang", F.lit("Document").alias("label"))


@register(
    "upsert_interleaved_runs",
    """SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN '!!!' WHEN 1 THEN '!!' ELSE '!' END AS text FROM documents""",
)
def upsert_interleaved_runs(spark, folder):
    """Run A writes, run B writes, run A goes on: the last write of a key wins, whatever its run."""
    table = new_table(spark, partial_rows=True)
    first = table.open_run("a")
    table.write_batch(versions_of(spark, folder, 1, 2), first, 0)
    table.write_batch(versions_of(spark, folder, 2, 1), table.open_run("b"), 0)
    table.write_batch(versions_of(spark, folder, 3, 0), table.open_run("a", fresh=False), 1)
    # Doing an earlier batch again does not make it later.
    table.write_batch(versions_of(spark, folder, 1, 2), first, 0)
    return table.read_label("Document").select("doc_id", "text")


@register(
    "delete_then_resume",
    """SELECT doc_id, text || '!!' AS text FROM documents WHERE doc_id % 3 <= 1""",
)
def delete_then_resume(spark, folder):
    """A run writes, its label is deleted, the same run goes on: what comes back is there."""
    table = new_table(spark)
    run = table.open_run("a")
    table.write_batch(versions_of(spark, folder, 1, 2).withColumn("embedding", F.lit(None)), run, 0)
    table.delete_label("Document", table.open_run("cleanup"))
    again = versions_of(spark, folder, 2, 1).withColumn("embedding", F.lit(None))
    table.write_batch(again, table.open_run("a", fresh=False), 1)
    return table.read_label("Document").select("doc_id", "text")


@register("checkpoint_reset_other_table", "SELECT doc_id, text FROM documents")
def checkpoint_reset_other_table(spark, folder):
    """A fresh load with another table's checkpoint setting takes all rows."""
    path, files = document_files(spark, folder, 1)
    config = document_load(spark, path, files)
    stream_load(spark, config, hashing(), new_table(spark))
    other = new_table(spark)
    stream_load(spark, config, hashing(), other)
    return other.read_label("Document").select("doc_id", "text")


@register(
    "compact_then_stream",
    "SELECT doc_id, text FROM documents",
)
def compact_then_stream(spark, folder):
    """Half of the source, compaction, then the rest into the compacted table, which resumes there."""
    (first, second), path = document_slices(spark, folder, 2)
    config = document_load(spark, path, 1_000_000)
    first.write.mode("append").parquet(path)
    table = new_table(spark)
    stream_load(spark, config, hashing(), table)
    compacted = table.compact(work_path(spark, "compacted"))
    second.write.mode("append").parquet(path)
    stream_load(spark, config, hashing(), compacted, clear_checkpoint=False)
    return compacted.history("Document").select("doc_id", "text")


@register(
    "load_rejects",
    """SELECT doc_id, 'ValueError: text too long' AS reason FROM documents WHERE length(text) > 2000 AND lang <> 'de'
    UNION ALL SELECT NULL, 'null key' FROM documents WHERE lang = 'de'""",
)
def load_rejects(spark, folder):
    """Rows that get no vector, and rows without a key, with the reasons."""
    config = LoadConfig(label="Document", key="doc_id")
    table = new_table(spark)
    key = F.when(F.col("lang") != "de", F.col("doc_id")).alias("doc_id")
    run = open_run(spark, config, short_texts_only(), table)
    process_batch(documents(spark, folder).select(key, "text", "lang"), 0, run)
    return table.rejects("Document").select("doc_id", "reason")


@register(
    "read_label_after_compact",
    """SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY event_type = 'purchase' DESC, ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1""",
)
def read_label_after_compact(spark, folder):
    """The state of a compacted table with a later run on top."""
    table = event_table(spark, folder, F.lit("User")).compact(work_path(spark, "compacted"))
    purchases = load_table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    table.write_batch(purchases.withColumn("label", F.lit("User")), table.open_run("purchases"), 0)
    return table.read_label("User").select("user_id", "event_id")


@register(
    "compact_levels",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY event_id % 7 DESC, ts DESC, event_id DESC) AS nth FROM events WHERE event_id % 7 < 6 OR event_type <> 'view')
    WHERE nth = 1""",
)
def compact_levels(spark, folder):
    """Three rounds of two loads and a merge by level, and one more load that no merge has seen."""
    table = new_table(spark, EVENT, "user_id", order_by=["ts", "event_id"])
    events = load_table(spark, folder, "events").withColumn("label", F.lit("User"))
    run = table.open_run("events")
    for batch in range(7):
        rows = events.filter(F.col("event_id") % 7 == batch)
        table.write_batch(rows if batch < 6 else rows.filter(F.col("event_type") != "view"), run, batch)
        if batch in (1, 3, 5):
            table.merge(fanout=2)
    return table.read_label("User").select("user_id", "event_id", "event_type", "value")


# --- rules of a load, broken sources, progress ---------------------------------------------


@register("load_key_rule", "SELECT lang, count(*) - 1 AS repeats, 'repeated key' AS reason FROM documents GROUP BY lang HAVING count(*) > 1")
def load_key_rule(spark, folder):
    """Documents keyed by their language: all rows of a key but one are refused."""
    config = LoadConfig(label="Language", key="lang", key_rule="reject")
    table = new_table(spark, T.StructType(RECORD.fields[1:]), "lang")
    run = open_run(spark, config, hashing(), table)
    process_batch(documents(spark, folder).select("text", "lang"), 0, run)
    return table.rejects("Language").groupBy("lang", "reason").agg(F.count(F.lit(1)).alias("repeats"))


@register(
    "limit_many_rows",
    """SELECT doc_id, part FROM (SELECT *, row_number() OVER (ORDER BY lang, part, doc_id) AS nth
    FROM documents, range(8) r(part)) WHERE nth <= (SELECT count(*) * 3 FROM documents)""",
)
def limit_many_rows(spark, folder):
    """The first three eighths of all rows by several columns, found without a sort."""
    docs = documents(spark, folder).select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(7).cast("bigint"))).alias("part"), "doc_id")
    return limit_rows(docs, 3 * documents(spark, folder).count(), ["lang", "part", "doc_id"]).select("doc_id", "part")


BROKEN_LINE = """CASE WHEN doc_id % 10 = 3 THEN 'x' || doc_id || ',' || lang || ',' || n_chars
    WHEN doc_id % 10 = 7 THEN doc_id || ',' || lang || ',' || n_chars || ',more'
    WHEN doc_id % 10 = 9 THEN doc_id || ',' || lang ELSE doc_id || ',' || lang || ',' || n_chars END"""


@register(
    "csv_ingest_rejects",
    f"""SELECT {BROKEN_LINE} AS line, doc_id % 10 IN (3, 7, 9) AS rejected, doc_id % 10 IN (3, 7, 9) AS has_file FROM documents""",
)
def csv_ingest_rejects(spark, folder):
    """A CSV with words for numbers, and with too many and too few values in a row."""
    source = work_path(spark, "csv")
    load_table(spark, folder, "documents").select(F.expr(BROKEN_LINE).alias("value")).write.text(source)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])
    kept, rejects = csv_ingest_checked(spark, source, schema, work_path(spark, "rows"), header=False)
    kept = kept.select(F.concat_ws(",", *schema.names).alias("line"), F.lit(False).alias("rejected"), F.lit(False).alias("has_file"))
    return kept.unionByName(rejects.select("line", F.lit(True).alias("rejected"), F.col("file").isNotNull().alias("has_file")))


@register(
    "stream_progress",
    """SELECT part::BIGINT AS batch_id, count(*) AS input_rows, true AS timed FROM (SELECT ntile(4) OVER (ORDER BY doc_id) - 1 AS part
    FROM documents) GROUP BY part""",
)
def stream_progress(spark, folder):
    """Rows of each micro-batch of a stream, as Spark tells them while it runs."""
    narrow = documents(spark, folder).select("doc_id", "text", "lang")
    numbered = chunk_assign(narrow, 1, ["doc_id"])
    rows, path = numbered.count(), work_path(spark, "documents")
    # As ntile deals them: the first parts have one row more if the rows cannot be dealt evenly.
    size, more = divmod(rows, SLICES)
    place = F.col("row_num") - 1
    part = F.when(place < more * (size + 1), F.floor(place / (size + 1))).otherwise(more + F.floor((place - more * (size + 1)) / max(size, 1)))
    # Every part in as many files, each by a task of its own, so that a micro-batch is one part at any size.
    files = max(1, -(-size // FILE_ROWS))
    for k in range(SLICES):
        dealt = numbered.filter(part == k).repartitionById(files, F.pmod("row_num", F.lit(files)).cast("int"))
        dealt.select("doc_id", "text", "lang").write.mode("append").parquet(path)
    table = new_table(spark)
    stream_load(spark, document_load(spark, path, files), hashing(), table)
    found = progress_rows(spark, table.root)
    return found.select("batch_id", "input_rows", (F.col("duration_ms") >= 0).alias("timed"))


@register(
    "stream_half_written_batch",
    """SELECT 'after the failure' AS seen, doc_id, text FROM documents WHERE doc_id % 2 = 0
    UNION ALL SELECT 'after the replay', doc_id, text || CASE WHEN doc_id % 2 = 1 THEN '!' ELSE '' END FROM documents""",
)
def stream_half_written_batch(spark, folder):
    """A batch whose files are there and whose write did not end is seen by no reader; done again, it is there whole."""
    rows = documents(spark, folder).select("doc_id", "text", "lang", F.lit(None).alias("embedding"), F.lit("Document").alias("label"))
    table = new_table(spark)
    run = table.open_run("a")
    table.write_batch(rows.filter("doc_id % 2 = 0"), run, 0)
    late = rows.filter("doc_id % 2 = 1").withColumn("text", shouted("text", 1))
    # What a writer leaves that dies before its last step: half of the rows.
    folder_of_batch = f"{table.records}/run_seq={run}/batch_id=1"
    table._write(late.filter("doc_id % 4 = 1"), f"{folder_of_batch}/commit={table._commit(folder_of_batch)}")
    first = work_path(spark, "seen")
    table.read_label("Document").select("doc_id", "text").write.parquet(first)
    table.write_batch(late, run, 1)
    second = table.read_label("Document").select(F.lit("after the replay").alias("seen"), "doc_id", "text")
    return spark.read.parquet(first).select(F.lit("after the failure").alias("seen"), "doc_id", "text").unionByName(second)
