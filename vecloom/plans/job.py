"""A whole run: check the provider, clean up, load, verify, try a search, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vecloom.functions.vector import embedding_preview, text_preview
from vecloom.operators.chunk import sample_rows
from vecloom.operators.embed import EmbeddingProvider, embed_query
from vecloom.operators.project import Selector, quoted
from vecloom.operators.quality import verify_load
from vecloom.operators.search import vector_search
from vecloom.plans.load import LoadConfig, run_load
from vecloom.plans.report import run_report
from vecloom.sources.store import VectorTable
from vecloom.streaming.ledger import BatchLedger


class ProviderNotReady(RuntimeError):
    """The provider does not give vectors of the configured length."""


@dataclass
class JobResult:
    deleted: int
    totals: dict
    verification: DataFrame
    report: DataFrame
    sample: DataFrame
    rejects: DataFrame
    nearest: DataFrame | None


def run_job(
    spark: SparkSession,
    config: LoadConfig,
    provider: EmbeddingProvider,
    table: VectorTable,
    selector: Selector | None = None,
    *,
    mode: str = "stream",
    clear_checkpoint: bool = True,
    cleanup: bool = False,
    search_text: str | None = None,
    k: int = 5,
) -> JobResult:
    """Load one label and look at the result; `cleanup` deletes the label's records first."""
    if not provider.validate(spark):
        raise ProviderNotReady(f"{provider.config.endpoint_name}: no vectors of {provider.config.dimensions} values")
    deleted = table.delete_label(config.label, table.open_run("cleanup")) if cleanup else 0
    totals = run_load(spark, config, provider, table, selector, mode, clear_checkpoint)

    settings = provider.config
    records = table.read_label(config.label)
    nearest = None
    if search_text is not None:
        nearest = vector_search(
            records,
            embed_query(spark, search_text, provider),
            settings.dimensions,
            k,
            key=config.key,
            columns=[settings.text_column],
            vector=settings.output_column,
        )
    run_seq = table.open_run(config.checkpoint or table.root, fresh=False)
    return JobResult(
        deleted,
        totals,
        verify_load(records, settings.dimensions, config.key, settings.output_column),
        run_report(BatchLedger(spark, table.root).rows(run_seq), config, provider),
        sample_rows(records, [config.key]).select(
            quoted(config.key),
            text_preview(quoted(settings.text_column)).alias("text"),
            embedding_preview(quoted(settings.output_column)).alias("values"),
        ),
        table.rejects(config.label),
        nearest,
    )
