"""Reading source tables, as a batch or as a stream, and taking in CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def csv_ingest(
    spark: SparkSession,
    csv_path: str,
    schema: StructType | str | None = None,
    *,
    table: str | None = None,
    path: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Store a headered CSV as a table (by name) or as parquet (by path) and read it back.

    Without a schema the types are inferred, which reads the files one more time.
    `multi_line` is for text with line breaks; such files cannot be split among tasks.
    """
    if (table is None) == (path is None):
        raise ValueError("name either a table or a path")
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    writer = reader.csv(csv_path).write.mode("overwrite")
    if table is not None:
        writer.saveAsTable(table)
        return spark.read.table(table)
    writer.parquet(path)
    return spark.read.parquet(path)


def csv_ingest_checked(
    spark: SparkSession, csv_path: str, schema: StructType, path: str, *, header: bool = True, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Store a CSV as parquet, its broken rows apart: (rows of `schema`, rejects with file and line).

    A row is broken if a value is not of its column's type or if it has too few or too many
    values. One scan and one write give both; empty files give two empty tables.
    """
    read = spark.read.option("header", header).option("multiLine", multi_line).option("escape", '"')
    read = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("enforceSchema", True)
    rows = read.schema(StructType([*schema.fields]).add("_line", StringType())).csv(csv_path)
    judged = rows.select("*", F.col("_metadata.file_path").alias("_file")).withColumn("rejected", F.col("_line").isNotNull())
    judged.write.mode("overwrite").partitionBy("rejected").parquet(path)
    stored = spark.read.schema(judged.schema).parquet(path)
    kept = stored.filter(~F.col("rejected")).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    rejects = stored.filter("rejected").select(F.col("_file").alias("file"), F.col("_line").alias("line"))
    return kept, rejects


def table_scan(spark: SparkSession, *, table: str | None = None, path: str | None = None, schema=None) -> DataFrame:
    """The source as a batch."""
    if table is not None:
        return spark.read.table(table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_scan(
    spark: SparkSession,
    *,
    table: str | None = None,
    path: str | None = None,
    schema: StructType | None = None,
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """The source as a stream that takes at most so many files per micro-batch."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if table is not None:
        return reader.table(table)
    if schema is None:
        raise ValueError("a file stream needs a schema")
    return reader.schema(schema).parquet(path)
