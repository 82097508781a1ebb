"""Registered queries: scans, projections, filters, limits, aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.catalog import sql
from vecloom.catalog.registry import load_table, register
from vecloom.functions.vector import embedding_preview, text_preview
from vecloom.operators import chunk, filters, project, quality
from vecloom.operators.embed import EmbeddingConfig, HashingProvider
from vecloom.plans.load import LoadConfig
from vecloom.plans.report import run_report
from vecloom.session import work_path
from vecloom.sources import tables
from vecloom.streaming import ledger as books


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "documents")


def missing_text(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("lang") != "de", F.col("text")).alias("text")
    return documents(spark, folder).select("doc_id", text, "lang")


def faulty_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vector = (
        F.when(F.col("label") == 3, None)
        .when(F.col("label") == 7, F.slice("embedding", 1, 63))
        .otherwise(F.col("embedding"))
    )
    return load_table(spark, folder, "embeddings").select("vec_id", "label", vector.alias("embedding"))


# --- sources -------------------------------------------------------------------------------


@register("csv_ingest", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_ingest(spark, folder):
    customers = load_table(spark, folder, "customer")
    source = work_path(spark, "customer-csv")
    customers.write.option("header", True).csv(source)
    return tables.csv_ingest(spark, source, customers.schema, path=work_path(spark, "customer"))


@register("table_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def table_scan(spark, folder):
    return tables.table_scan(spark, path=f"{folder}/documents.parquet")


# --- projections ---------------------------------------------------------------------------


@register(
    "select_columns",
    """SELECT o_orderkey AS removal_id, o_orderpriority AS removal_reason, o_orderstatus AS rmv_trk_no,
    o_custkey AS component_id, o_totalprice AS aircraft_id, o_orderdate AS removal_date FROM orders""",
)
def select_columns(spark, folder):
    names = ("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderdate")
    source = dict(zip(names, project.REMOVAL_EVENT_COLUMNS))
    return project.select_columns(project.map_columns(load_table(spark, folder, "orders"), source))


@register("column_mapping", "SELECT c_custkey AS customer_id, c_name AS \"name `short`\" FROM customer")
def column_mapping(spark, folder):
    customers = load_table(spark, folder, "customer")
    return project.map_columns(customers, {"c_custkey": "customer_id", "c_name": "name `short`"})


@register("column_selector", "SELECT doc_id AS record_id, upper(lang) AS lang, text FROM documents")
def column_selector(spark, folder):
    def selector(df):
        return df.select(F.col("doc_id").alias("record_id"), F.upper("lang").alias("lang"), "text")

    return project.apply_selector(documents(spark, folder), selector)


@register("drop_helpers", "SELECT doc_id, lang, n_chars FROM documents")
def drop_helpers(spark, folder):
    narrow = documents(spark, folder).select("doc_id", "lang", "n_chars")
    return project.drop_helpers(chunk.chunk_assign(narrow, 100, ["doc_id"]))


@register(
    "text_preview",
    f"SELECT doc_id, substr(coalesce(text, ''), 1, 40) AS preview FROM ({sql.MISSING_TEXT})",
)
def previews_of_text(spark, folder):
    return missing_text(spark, folder).select("doc_id", text_preview(F.col("text")).alias("preview"))


@register(
    "embedding_preview",
    """SELECT vec_id, '[' || printf('%.4f', embedding[1]::DOUBLE) || ', ' || printf('%.4f', embedding[2]::DOUBLE)
    || ', ' || printf('%.4f', embedding[3]::DOUBLE) || ']' AS preview FROM embeddings""",
)
def previews_of_vectors(spark, folder):
    values = F.array_join(embedding_preview(F.col("embedding")), ", ")
    preview = F.concat(F.lit("["), values, F.lit("]"))
    return load_table(spark, folder, "embeddings").select("vec_id", preview.alias("preview"))


# --- filters -------------------------------------------------------------------------------


@register("filter_text_not_null", f"SELECT * FROM ({sql.MISSING_TEXT}) WHERE text IS NOT NULL")
def filter_text_not_null(spark, folder):
    return filters.text_not_null(missing_text(spark, folder))


@register("filter_valid_embeddings", f"SELECT vec_id, label FROM ({sql.FAULTY_VECTORS}) WHERE len(embedding) = 64")
def filter_valid_embeddings(spark, folder):
    return filters.valid_embeddings(faulty_vectors(spark, folder), 64).select("vec_id", "label")


@register(
    "filter_has_embedding",
    f"SELECT vec_id, label, len(embedding)::INTEGER AS dims FROM ({sql.FAULTY_VECTORS}) WHERE embedding IS NOT NULL",
)
def filter_has_embedding(spark, folder):
    kept = filters.has_embedding(faulty_vectors(spark, folder))
    return kept.select("vec_id", "label", F.size("embedding").alias("dims"))


NUMBERED = "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS row_num FROM documents"


@register("select_chunk", f"SELECT *, (row_num - 1) // 100 AS chunk_id FROM ({NUMBERED}) WHERE (row_num - 1) // 100 = 1")
def select_chunk(spark, folder):
    chunked = chunk.chunk_assign(documents(spark, folder).select("doc_id", "lang"), 100, ["doc_id"])
    return filters.select_chunk(chunked, 1)


# --- chunks and limits ---------------------------------------------------------------------


@register("chunk_assign", f"SELECT *, (row_num - 1) // 64 AS chunk_id FROM ({NUMBERED})")
def chunk_assign(spark, folder):
    return chunk.chunk_assign(documents(spark, folder).select("doc_id", "lang"), 64, ["doc_id"])


@register(
    "chunk_assign_hot_key",
    """SELECT *, (row_num - 1) // 500 AS chunk_id FROM (SELECT l_returnflag, l_orderkey, l_linenumber,
    row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber) AS row_num FROM lineitem)""",
)
def chunk_assign_hot_key(spark, folder):
    """The first order column has three values only, and some rows are full copies."""
    items = load_table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return chunk.chunk_assign(items, 500, ["l_returnflag", "l_orderkey", "l_linenumber"])


@register("chunk_plan", f"SELECT (row_num - 1) // 64 AS chunk_id, count(*) AS rows_in_chunk FROM ({NUMBERED}) GROUP BY 1")
def chunk_plan(spark, folder):
    return chunk.chunk_plan(chunk.chunk_assign(documents(spark, folder).select("doc_id"), 64, ["doc_id"]))


@register(
    "limit_batch",
    f"SELECT doc_id, lang FROM ({sql.MISSING_TEXT}) WHERE text IS NOT NULL ORDER BY doc_id LIMIT 500",
)
def limit_batch(spark, folder):
    kept = filters.text_not_null(missing_text(spark, folder))
    return chunk.limit_rows(kept, 500, ["doc_id"]).select("doc_id", "lang")


@register("sample_rows", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def sample_rows(spark, folder):
    return chunk.sample_rows(documents(spark, folder).select("doc_id", "lang", "source"), ["doc_id"])


# --- aggregations --------------------------------------------------------------------------


@register("count_rows", "SELECT count(*) AS rows FROM documents")
def count_rows(spark, folder):
    return quality.count_rows(documents(spark, folder))


@register("count_embedded", f"SELECT count(embedding) AS embedded FROM ({sql.FAULTY_VECTORS})")
def count_embedded(spark, folder):
    return quality.count_embedded(faulty_vectors(spark, folder))


@register(
    "dimension_profile",
    f"""SELECT len(embedding)::INTEGER AS dims, count(*) AS rows, coalesce(len(embedding) = 64, false) AS as_expected
    FROM ({sql.FAULTY_VECTORS}) GROUP BY ALL""",
)
def dimension_profile(spark, folder):
    return quality.dimension_profile(faulty_vectors(spark, folder), 64)


@register(
    "key_uniqueness",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def key_uniqueness(spark, folder):
    return quality.key_uniqueness(load_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def events_as_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger made from the events: one batch per day and event type."""
    status = (
        F.when(F.col("event_type") == "error", books.FAILED)
        .when(F.col("event_type") == "signup", books.SKIPPED)
        .otherwise(books.WRITTEN)
    )
    return (
        load_table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(F.col("value") > 20).alias("rows_written"),
            F.count_if(F.col("value") <= 20).alias("rows_invalid"),
            F.count_if(F.col("event_type") == "signup").alias("rows_skipped"),
            F.count_distinct("user_id").cast("double").alias("seconds"),
        )
        .withColumn("status", status)
    )


EVENT_LEDGER = """ledger AS (SELECT ts::DATE AS day, event_type, count(*) AS rows_read,
    count_if(value > 20) AS rows_written, count_if(value <= 20) AS rows_invalid,
    count_if(event_type = 'signup') AS rows_skipped, count(DISTINCT user_id)::DOUBLE AS seconds,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'written' END AS status
    FROM events GROUP BY 1, 2)"""
EVENT_TOTALS = """totals AS (SELECT count_if(status = 'written')::BIGINT AS batches_processed,
    count_if(status = 'failed')::BIGINT AS failed_batches,
    coalesce(sum(rows_read) FILTER (status = 'written'), 0)::BIGINT AS rows_read,
    coalesce(sum(rows_written) FILTER (status = 'written'), 0)::BIGINT AS rows_written,
    coalesce(sum(rows_skipped), 0)::BIGINT AS rows_skipped,
    coalesce(sum(rows_invalid) FILTER (status = 'written'), 0)::BIGINT AS rows_invalid,
    coalesce(sum(seconds) FILTER (status = 'written'), 0) AS total_time,
    coalesce(avg(seconds) FILTER (status = 'written'), 0) AS avg_batch_time,
    coalesce(min(seconds) FILTER (status = 'written'), 0) AS min_batch_time,
    coalesce(max(seconds) FILTER (status = 'written'), 0) AS max_batch_time FROM ledger)"""


def _rounded(df: DataFrame) -> DataFrame:
    for name in ("avg_batch_time", "rows_per_second"):
        if name in df.columns:
            df = df.withColumn(name, F.round(name, 6))
    return df


@register(
    "batch_totals",
    f"""WITH {EVENT_LEDGER}, {EVENT_TOTALS} SELECT * REPLACE (round(avg_batch_time, 6) AS avg_batch_time),
    round(coalesce(rows_written / nullif(total_time, 0), 0), 6) AS rows_per_second FROM totals""",
)
def batch_totals(spark, folder):
    return _rounded(books.batch_totals(events_as_batches(spark, folder)))


@register(
    "throughput",
    f"""WITH {EVENT_LEDGER} SELECT day, event_type, rows_written::BIGINT AS rows_written, seconds,
    round(coalesce(rows_written / nullif(seconds, 0), 0), 6) AS rows_per_second FROM ledger""",
)
def throughput(spark, folder):
    rates = books.with_throughput(events_as_batches(spark, folder))
    return _rounded(rates).select("day", "event_type", "rows_written", "seconds", "rows_per_second")


@register(
    "run_report",
    f"""WITH {EVENT_LEDGER}, {EVENT_TOTALS} SELECT 'events' AS source, 'Event' AS label, 'hashing' AS endpoint,
    64 AS dimensions, 5000 AS batch_size, batches_processed, failed_batches, rows_read, rows_written,
    rows_skipped, rows_invalid, total_time,
    CASE WHEN total_time >= 60 THEN printf('%.1fs (%.1f minutes)', total_time, total_time / 60)
         ELSE printf('%.1fs', total_time) END AS duration,
    CASE WHEN total_time > 0 THEN format('{{:,.1f}}', rows_written / total_time) || ' rows/s' ELSE 'N/A' END AS rate
    FROM totals""",
)
def report(spark, folder):
    config = LoadConfig(label="Event", key="event_id", source_table="events")
    provider = HashingProvider(EmbeddingConfig("hashing", 64))
    found = run_report(events_as_batches(spark, folder), config, provider)
    return found.select(
        "source", "label", "endpoint", "dimensions", "batch_size", "batches_processed", "failed_batches",
        "rows_read", "rows_written", "rows_skipped", "rows_invalid", "total_time", "duration", "rate",
    )
