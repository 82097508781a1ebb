"""Headline timings on local[$BENCH_CPUS]; prints one JSON line.

Loads are timed from the source table to the written and recorded batch. Each figure
is the median of the repeats after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.catalog import loads, rows, vectors  # noqa: F401
from vecloom.catalog.registry import QUERIES, load_table
from vecloom.functions import models
from vecloom.operators.embed import EmbeddingConfig, HashingProvider, ModelProvider, RandomProvider
from vecloom.operators import search
from vecloom.plans.load import LoadConfig, batch_load
from vecloom.session import local_session, work_path
from vecloom.sources.store import VectorTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
DIMS = 384

QUERY_NAMES = (
    "vector_search", "vector_search_many", "vector_search_approx", "embed_random", "embed_hashing",
    "chunk_assign", "chunk_assign_hot_key", "build_requests", "parse_responses", "upsert_by_key",
    "verify_load", "key_uniqueness", "compare_embeddings", "stream_load",
)

TEXT_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("props", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)


def load_events(spark, provider) -> None:
    """All events as text records, embedded and written."""
    table = VectorTable(spark, work_path(spark, "bench"), TEXT_RECORD, "event_id")
    config = LoadConfig(
        label="Event", key="event_id", source_path=f"{SF_DIR}/events.parquet", embed_partitions=int(CPUS)
    )
    batch_load(spark, config, provider, table, lambda df: df.select("event_id", "props"))


def load_documents(spark, provider) -> None:
    table = VectorTable(spark, work_path(spark, "bench"), loads.RECORD, "doc_id")
    config = LoadConfig(
        label="Document", key="doc_id", source_path=f"{SF_DIR}/documents.parquet", embed_partitions=int(CPUS)
    )
    batch_load(spark, config, provider, table, lambda df: df.select("doc_id", "text", "lang"))


def search_many(spark, queries: int, records: int, query_bytes: int = 64 << 20) -> None:
    """Stored vectors, repeated to the wanted numbers, against each other."""
    stored = load_table(spark, SF_DIR, "embeddings")
    count = stored.count()

    def repeated(rows: int):
        copy = F.explode(F.sequence(F.lit(0), F.lit(-(-rows // count) - 1))).alias("copy")
        spread = stored.repartition(int(CPUS)).select("vec_id", "embedding", copy)
        return spread.select((F.col("copy") * 1_000_000 + F.col("vec_id")).alias("vec_id"), "embedding")

    asked = repeated(queries).withColumnRenamed("vec_id", "q")
    found = search.vector_search_many(repeated(records), asked, 64, 5, key="vec_id", query_key="q", query_bytes=query_bytes)
    found.write.format("noop").mode("overwrite").save()


def run_query(spark, name: str) -> None:
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def median_time(action) -> float:
    action()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    events = load_table(spark, SF_DIR, "events").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    documents = load_table(spark, SF_DIR, "documents").agg(F.count(F.lit(1)).alias("n")).first()["n"]

    random = RandomProvider(EmbeddingConfig("random", DIMS, text_column="props", key_column="event_id"))
    hashing = HashingProvider(EmbeddingConfig("hashing", DIMS))
    custom = ModelProvider(EmbeddingConfig("custom", DIMS), lambda: models.HashingEncoder(DIMS))
    timings = {
        "load_random_384": median_time(lambda: load_events(spark, random)),
        "load_hashing_384": median_time(lambda: load_documents(spark, hashing)),
        "load_custom_384": median_time(lambda: load_documents(spark, custom)),
    }
    rates = {
        "load_random_384": round(events / timings["load_random_384"], 1),
        "load_hashing_384": round(documents / timings["load_hashing_384"], 1),
        "load_custom_384": round(documents / timings["load_custom_384"], 1),
    }
    for queries, records in ((200, 200_000), (10_000, 50_000), (65_536, 8_000)):
        timings[f"search_{queries}_x_{records}"] = median_time(lambda: search_many(spark, queries, records))
    # Six blocks of queries, with a scan of the records for each.
    timings["search_blocks_10000_x_20000"] = median_time(lambda: search_many(spark, 10_000, 20_000, 1 << 20))
    for name in QUERY_NAMES:
        timings[name] = median_time(lambda: run_query(spark, name))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_second": rates,
                "rows": {"events": events, "documents": documents},
                "dims": DIMS,
                "cpus": int(CPUS),
                "repeats": REPEATS,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
