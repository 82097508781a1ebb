"""The load: project, drop rows without text, embed, keep valid vectors, write, record.

Batch and stream share `process_batch`, which is one plan and one write per batch.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecloom.functions.vector import as_float_vector
from vecloom.operators.chunk import chunk_count, limit_rows
from vecloom.operators.embed import EmbeddingProvider
from vecloom.operators.filters import text_not_null
from vecloom.operators.project import Selector, apply_selector, quoted
from vecloom.sources.store import NULL_KEY, VectorTable
from vecloom.sources.tables import stream_scan, table_scan
from vecloom.streaming import ledger as books
from vecloom.streaming.ledger import BatchLedger, batch_totals
from vecloom.streaming.progress import ProgressLog


@dataclass
class LoadConfig:
    """Settings of a load.

    `max_rows` <= 0 means no limit. A limit drops what it cuts off: a later resume does
    not see those rows again. `write_partitions` caps the number of concurrent writers;
    without it every task of the scan writes its own rows. `embed_partitions` spreads the
    rows over so many tasks before a costly model, for sources with few splits.
    `batch_files` bounds the rows of a written file by `batch_size`. `key_rule` says what becomes of a key that
    a batch holds several times: nothing (the later row is current), "reject" (the others are listed as
    rejects), or "fail" (the batch is refused before anything is embedded or written). A write that
    fails is tried `write_attempts` times, `write_pause` seconds apart; an error of the model, which has
    retries of its own, is not tried again here.
    """

    label: str
    key: str
    source_table: str | None = None
    source_path: str | None = None
    source_schema: StructType | None = None
    batch_size: int = 5000
    batch_files: bool = True
    key_rule: str | None = None
    write_attempts: int = 3
    write_pause: float = 30.0
    write_partitions: int | None = None
    embed_partitions: int | None = None
    checkpoint: str | None = None
    max_files_per_trigger: int = 1
    max_rows: int = -1
    column_mappings: Mapping[str, str] = field(default_factory=dict)


class RepeatedKeys(ValueError):
    """A batch holds a key several times, which its key rule forbids."""


@dataclass
class LoadRun:
    """One run of a load: where it writes and what it has written so far."""

    config: LoadConfig
    provider: EmbeddingProvider
    table: VectorTable
    run_seq: int
    ledger: BatchLedger
    _through: int | None = None
    _written: int = 0

    def written_before(self, batch_id: int) -> int:
        """Rows written by earlier batches: a running total, summed by Spark after a restart or a replay."""
        if self._through is None or batch_id <= self._through:
            self._written, self._through = self.ledger.written_before(self.run_seq, batch_id), batch_id - 1
        return self._written

    def count_written(self, batch_id: int, rows: int) -> None:
        if self._through is not None and batch_id > self._through:
            self._written, self._through = self._written + rows, batch_id

    def totals(self) -> dict:
        return batch_totals(self.ledger.rows(self.run_seq)).first().asDict()


def open_run(
    spark: SparkSession, config: LoadConfig, provider: EmbeddingProvider, table: VectorTable, fresh: bool = True
) -> LoadRun:
    if config.key_rule not in (None, "reject", "fail"):
        raise ValueError(f"unknown key rule {config.key_rule!r}; choose 'reject' or 'fail'")
    run_seq = table.open_run(config.checkpoint or table.root, fresh)
    return LoadRun(config, provider, table, run_seq, BatchLedger(spark, table.root))


def prepare(df: DataFrame, config: LoadConfig, provider: EmbeddingProvider, selector: Selector | None) -> DataFrame:
    """Projection and null filter, next to the scan."""
    projected = apply_selector(df, selector or config.column_mappings or None)
    return text_not_null(projected, provider.config.text_column)


def process_batch(batch: DataFrame, batch_id: int, run: LoadRun) -> None:
    """Embed and write one batch and record it.

    The records are written before the ledger row, so a ledger row always has its
    records. Doing a batch again replaces both.
    """
    config, provider = run.config, run.provider
    started, clock = datetime.now(timezone.utc), time.perf_counter()
    skipped = 0

    def record(status: str, **counts) -> None:
        seconds = time.perf_counter() - clock
        run.ledger.record(run.run_seq, batch_id, status, started, seconds, rows_skipped=skipped, **counts)
        run.count_written(batch_id, counts.get("rows_written", 0))

    if config.max_rows > 0:
        found = batch.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        left = max(config.max_rows - run.written_before(batch_id), 0)
        skipped = max(found - left, 0)
        if left == 0:
            return record(books.SKIPPED if found else books.EMPTY)
        if skipped:
            batch = limit_rows(batch, left, [config.key])

    try:
        if config.key_rule == "fail":
            refuse_repeats(batch, config.key)
        rows_read, rows_valid, dims = _write_with_retries(batch, batch_id, run)
        repeats = run.table.write_repeats(run.run_seq, batch_id) if config.key_rule == "reject" and rows_valid else 0
    except Exception as error:
        record(books.FAILED, error=str(error))
        raise
    status = books.EMPTY if rows_read == 0 else books.WRITTEN if rows_valid else books.NO_VALID
    record(
        status,
        rows_read=rows_read,
        rows_invalid=rows_read - rows_valid + repeats,
        rows_written=rows_valid - repeats,
        chunks=chunk_count(rows_read, config.batch_size),
        dims_min=dims[0],
        dims_max=dims[1],
    )


def refuse_repeats(batch: DataFrame, key: str) -> None:
    """Raise if a key occurs twice. Only keys are read and shuffled; a sketch of them could not tell two rows of a billion."""
    repeated = batch.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    found = repeated.filter(quoted(key).isNotNull()).limit(1).collect()
    if found:
        raise RepeatedKeys(f"key {found[0][0]!r} has {found[0][1]} rows in one batch")


def _write_with_retries(batch: DataFrame, batch_id: int, run: LoadRun) -> tuple[int, int, tuple]:
    for attempt in range(1, run.config.write_attempts + 1):
        try:
            return _write(batch, batch_id, run)
        except PythonException:
            raise
        except Exception:
            if attempt == run.config.write_attempts:
                raise
            time.sleep(run.config.write_pause)
    raise ValueError("write_attempts must be at least 1")


def _write(batch: DataFrame, batch_id: int, run: LoadRun) -> tuple[int, int, tuple]:
    """One write action; the counts and the vectors' lengths come out of it, so nothing is embedded twice.

    Rows without a key or a good vector are written as rejects of the same batch.
    """
    config, provider = run.config, run.provider
    vector = provider.config.output_column
    if config.embed_partitions:
        batch = batch.repartition(config.embed_partitions)
    outcome = batch.withColumn("_outcome", provider.outcome())
    embedded = outcome.withColumn(vector, as_float_vector(F.col("_outcome.vector")))
    if config.write_partitions:
        # Not by key alone: a key may be hot, and the table does not need its rows together.
        spread = F.xxhash64(quoted(config.key), quoted(provider.config.text_column), F.spark_partition_id())
        embedded = embedded.repartition(config.write_partitions, spread)
    size, wanted = F.coalesce(F.size(quoted(vector)), F.lit(-1)), provider.config.dimensions
    reason = F.coalesce(
        F.when(quoted(config.key).isNull(), F.lit(NULL_KEY)),
        F.col("_outcome.reason"),
        F.when(quoted(vector).isNull(), F.lit("no vector")),
        F.when(size != wanted, F.format_string(f"vector of %d values, not {wanted}", size)),
    )
    judged = embedded.withColumn("reason", reason).drop("_outcome")
    seen = Observation()
    counted = judged.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("valid"),
        F.min(F.size(quoted(vector))).alias("least"), F.max(F.size(quoted(vector))).alias("most"),
    )
    rows = counted.withColumn("label", F.lit(config.label))
    run.table.write_batch(rows, run.run_seq, batch_id, config.batch_size if config.batch_files else None)
    return seen.get["read"], seen.get["valid"], (seen.get["least"], seen.get["most"])


def batch_load(
    spark: SparkSession,
    config: LoadConfig,
    provider: EmbeddingProvider,
    table: VectorTable,
    selector: Selector | None = None,
) -> dict:
    """Load the whole source as batch 0 of a new run."""
    run = open_run(spark, config, provider, table)
    source = table_scan(spark, table=config.source_table, path=config.source_path, schema=config.source_schema)
    process_batch(prepare(source, config, provider, selector), 0, run)
    return run.totals()


def stream_load(
    spark: SparkSession,
    config: LoadConfig,
    provider: EmbeddingProvider,
    table: VectorTable,
    selector: Selector | None = None,
    clear_checkpoint: bool = True,
) -> dict:
    """Load all that the source holds now, in micro-batches, and stop.

    With `clear_checkpoint` the run starts anew under a checkpoint folder of its own;
    otherwise it goes on after the last run with the same checkpoint setting.
    """
    if not config.checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    run = open_run(spark, config, provider, table, fresh=clear_checkpoint)
    source = stream_scan(
        spark,
        table=config.source_table,
        path=config.source_path,
        schema=config.source_schema,
        max_files_per_trigger=config.max_files_per_trigger,
    )
    progress = ProgressLog(spark, table.root, run.run_seq)
    spark.streams.addListener(progress)
    query = (
        prepare(source, config, provider, selector)
        .writeStream.foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, run))
        .option("checkpointLocation", table.checkpoint_folder(run.run_seq))
        .trigger(availableNow=True)
        .queryName(progress.name)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        progress.close()
        spark.streams.removeListener(progress)
    return run.totals()


def run_load(
    spark: SparkSession,
    config: LoadConfig,
    provider: EmbeddingProvider,
    table: VectorTable,
    selector: Selector | None = None,
    mode: str = "stream",
    clear_checkpoint: bool = True,
) -> dict:
    if mode == "stream":
        return stream_load(spark, config, provider, table, selector, clear_checkpoint)
    if mode == "batch":
        return batch_load(spark, config, provider, table, selector)
    raise ValueError(f"unknown mode {mode!r}; choose 'stream' or 'batch'")
