"""Gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.llm.text import col, helper, written


def with_row(frame: DataFrame, name: str) -> DataFrame:
    """A number for each row: 2^33 times the input partition plus the place in it."""
    return frame.withColumn(name, F.monotonically_increasing_id())


def numbered(spark: SparkSession, frame: DataFrame, name: str, pinned: bool = False) -> DataFrame:
    """The rows with a number for each, written, so that the numbers hold for every later scan.

    Numbers of a second scan need not be those of the first: how a source is split follows the
    executors that are there. With `pinned` the caller says that every scan of the frame gives the same
    rows; if they are rows of Parquet files then, file and place there number them and nothing is written.
    """
    placed = _placed(spark, frame, name) if pinned else None
    return written(spark, with_row(frame, name), "numbered", "zstd") if placed is None else placed


def _placed(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame | None:
    """The rows numbered by file, 2^33 apart, and place in it; None if they have none or two rows share one."""
    file, at = helper("file"), helper("at")
    try:
        place = frame.metadataColumn("_metadata")
        rows = frame.select("*", place["file_path"].alias(file), place["row_index"].alias(at))
    except AnalysisException:
        return None
    files = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(col(at)).alias("d")).orderBy(file).collect()
    if not files or any(f["n"] != f["d"] for f in files):
        return None
    first = spark.createDataFrame([(f[file], k << 33) for k, f in enumerate(files)], f"`{file}` string, `{name}` long")
    joined = rows.join(F.broadcast(first), file)
    return joined.select(*[col(c) for c in frame.columns], (col(name) + col(at)).alias(name))


def gapless(frame: DataFrame, groups: list[str], row: str, out: str) -> DataFrame:
    """Numbers 0, 1, ... within each group, in the order of `row` (from `with_row`).

    A group is numbered in blocks, one for each input partition, so that a group with most
    of the rows meets in no task. Only the blocks' counts are added up by group. The
    frame is read twice: pass a written one.
    """
    block, before, count = helper("block"), helper("before"), helper("count")
    blocked = frame.withColumn(block, F.shiftright(col(row), 33))
    keys = [*groups, block]
    inside = Window.partitionBy(*[col(k) for k in keys]).orderBy(col(row))
    earlier = (
        Window.partitionBy(*[col(k) for k in groups]).orderBy(col(block)).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        blocked.groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(count))
        .withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0)))
        .drop(count)
    )
    numbered = blocked.withColumn(out, F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, keys)
        .withColumn(out, (col(out) + col(before)).cast("long"))
        .select(*[col(c) for c in frame.columns], col(out))
    )
