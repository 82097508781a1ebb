"""One row per batch of a load, and the totals over them."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.sources import files

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_seq", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_skipped", T.LongType()),
        T.StructField("rows_invalid", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("chunks", T.LongType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("dims_min", T.LongType()),
        T.StructField("dims_max", T.LongType()),
    ]
)

WRITTEN, NO_VALID, EMPTY, SKIPPED, FAILED = "written", "no_valid", "empty", "skipped", "failed"
PROCESSED = (WRITTEN, NO_VALID)


class BatchLedger:
    """Ledger rows beside a table, a small file for each batch; a replayed batch replaces its own row."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/ledger"

    def record(
        self,
        run_seq: int,
        batch_id: int,
        status: str,
        started: datetime,
        seconds: float,
        *,
        rows_read: int = 0,
        rows_skipped: int = 0,
        rows_invalid: int = 0,
        rows_written: int = 0,
        chunks: int = 0,
        error: str | None = None,
        dims_min: int | None = None,
        dims_max: int | None = None,
    ) -> None:
        values = {
            "status": status,
            "rows_read": rows_read,
            "rows_skipped": rows_skipped,
            "rows_invalid": rows_invalid,
            "rows_written": rows_written,
            "chunks": chunks,
            "started": started.isoformat(),
            "seconds": seconds,
            "error": error,
            "dims_min": dims_min,
            "dims_max": dims_max,
        }
        files.clear(self.spark, f"{self.path}/run_seq={run_seq}/batch_id={batch_id}")
        files.write_text(self.spark, f"{self.path}/run_seq={run_seq}/batch_id={batch_id}/row.json", json.dumps(values))

    def rows(self, run_seq: int | None = None) -> DataFrame:
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        found = self.spark.read.schema(LEDGER_SCHEMA).json(self.path)
        return found if run_seq is None else found.filter(F.col("run_seq") == run_seq)

    def written_before(self, run_seq: int, batch_id: int) -> int:
        """Rows that the earlier batches of a run have written."""
        earlier = self.rows(run_seq).filter(F.col("batch_id") < batch_id)
        return earlier.agg(F.coalesce(F.sum("rows_written"), F.lit(0)).alias("n")).first()["n"]


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows per second; 0 when no time has passed."""
    return F.when(seconds > 0, rows / seconds).otherwise(F.lit(0.0))


def with_throughput(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("rows_per_second", throughput(F.col("rows_written"), F.col("seconds")))


def batch_totals(ledger: DataFrame) -> DataFrame:
    """Totals over batches; zeros for an empty ledger.

    Empty and skipped batches are not counted as processed, and a failed batch counts
    only as failed.
    """
    processed = F.col("status").isin(*PROCESSED)

    def over(value: str) -> Column:
        return F.when(processed, F.col(value))

    def total(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    totals = ledger.agg(
        F.count_if(processed).alias("batches_processed"),
        F.count_if(F.col("status") == FAILED).alias("failed_batches"),
        total(F.sum(over("rows_read"))).alias("rows_read"),
        total(F.sum(over("rows_written"))).alias("rows_written"),
        total(F.sum("rows_skipped")).alias("rows_skipped"),
        total(F.sum(over("rows_invalid"))).alias("rows_invalid"),
        total(F.sum(over("seconds"))).cast("double").alias("total_time"),
        total(F.avg(over("seconds"))).cast("double").alias("avg_batch_time"),
        total(F.min(over("seconds"))).cast("double").alias("min_batch_time"),
        total(F.max(over("seconds"))).cast("double").alias("max_batch_time"),
    )
    return totals.withColumn("rows_per_second", throughput(F.col("rows_written"), F.col("total_time")))
