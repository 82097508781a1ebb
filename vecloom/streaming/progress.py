"""What Spark says of a running stream, batch by batch, kept beside the table."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from vecloom.sources.store import read_or_empty

#: Batches that are held before they are written; seconds to wait for the last news of a stream that has ended.
HELD, PATIENCE = 100, 30

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("run_seq", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """Takes down the progress of one stream, known by its name, and leaves other streams alone."""

    def __init__(self, spark: SparkSession, root: str, run_seq: int):
        super().__init__()
        self.spark, self.path, self.run_seq = spark, f"{root}/progress", run_seq
        self.name = f"load-{run_seq}-{uuid.uuid4().hex}"
        self.rows: list[tuple] = []
        self.query_id = None
        self.over = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.query_id = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or progress.numInputRows == 0:
            return
        rates = progress.inputRowsPerSecond, progress.processedRowsPerSecond
        self.rows.append((self.run_seq, progress.batchId, progress.timestamp, progress.numInputRows, *rates, progress.batchDuration))
        if len(self.rows) >= HELD:
            self.write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.query_id:
            self.over.set()

    def write(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def close(self) -> None:
        """Wait for the last news, which come after the stream has ended, and write what is held."""
        self.over.wait(PATIENCE)
        self.write()


def progress_rows(spark: SparkSession, root: str, run_seq: int | None = None) -> DataFrame:
    """The progress of all runs of a table, or of one; a batch that was done again may have several rows."""
    found = read_or_empty(spark, f"{root}/progress", PROGRESS_SCHEMA)
    return found if run_seq is None else found.filter(found.run_seq == run_seq)
