"""The report on a run: settings, totals, readable times and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vecloom.operators.embed import EmbeddingProvider
from vecloom.plans.load import LoadConfig
from vecloom.streaming.ledger import batch_totals


@F.udf(StringType())
def _one_digit(value: float | None) -> str | None:
    """One digit after the point, of the number as it is: Java's formats round 0.25 up, and 0.15 by its decimal form."""
    return None if value is None else f"{value:.1f}"


@F.udf(StringType())
def _grouped(value: float | None) -> str | None:
    return None if value is None else f"{value:,.1f}"


def format_duration(seconds: Column) -> Column:
    """Like "30.0s", and from a minute on like "90.0s (1.5 minutes)"."""
    short = F.concat(_one_digit(seconds), F.lit("s"))
    return F.when(seconds >= 60, F.concat(short, F.lit(" ("), _one_digit(seconds / 60), F.lit(" minutes)"))).otherwise(short)


def format_rate(rows: Column, seconds: Column) -> Column:
    """Like "2,000.0 rows/s", or "N/A" when no time has passed."""
    rate = F.concat(_grouped(F.try_divide(rows, seconds)), F.lit(" rows/s"))
    return F.when(seconds > 0, rate).otherwise(F.lit("N/A"))


def run_report(ledger: DataFrame, config: LoadConfig, provider: EmbeddingProvider) -> DataFrame:
    """One row with the settings and the results of a run."""
    settings = {
        "source": config.source_table or config.source_path,
        "label": config.label,
        "endpoint": provider.config.endpoint_name,
        "dimensions": provider.config.dimensions,
        "batch_size": config.batch_size,
        "max_rows": config.max_rows,
        "checkpoint": config.checkpoint,
    }
    totals = batch_totals(ledger)
    return totals.select(
        *[F.lit(value).alias(name) for name, value in settings.items()],
        *totals.columns,
        format_duration(F.col("total_time")).alias("duration"),
        format_rate(F.col("rows_written"), F.col("total_time")).alias("rate"),
    )
