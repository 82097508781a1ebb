"""The corpus pipeline: filters, copies and packing, stage by stage, each over all that the one before kept.

Stages take tables as they are read from files: every scan must give the same rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import lines, packing, simhash, suffixes, toxicity
from vecloom.session import work_path


#: Bytes of a passage that makes its copies go; fifty words are about 300 long, and hardly ever under 240.
PASSAGE_BYTES = 240


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with n_chars, where they have it, after their texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, does not reject."""
    model = toxicity.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(spark, docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line, equal or one edit away, makes superfluous."""
    return _counted(lines.drop_lines(spark, docs, pinned=True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles alike to 0.8 or more."""
    return simhash.one_of_each(spark, docs, size=5, alike=0.8, pinned=True)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of PASSAGE_BYTES or more that recur."""
    return _counted(suffixes.drop_repeats(spark, docs, least=PASSAGE_BYTES, pinned=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences of 2048."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

#: Trained weights, hashes and token ids have no SQL counterpart; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
