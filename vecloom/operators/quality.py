"""Checks on stored vectors; each looks at all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.vector import cosine_similarity, max_abs_difference
from vecloom.operators.embed import EmbeddingProvider
from vecloom.operators.project import quoted

TOLERANCE = 1e-5


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_embedded(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.agg(F.count(quoted(vector)).alias("embedded"))


def dimension_profile(df: DataFrame, dimensions: int, vector: str = "embedding") -> DataFrame:
    """How many vectors have which length; a null length means no vector."""
    lengths = df.groupBy(F.size(quoted(vector)).alias("dims")).agg(F.count(F.lit(1)).alias("rows"))
    return lengths.withColumn("as_expected", F.coalesce(F.col("dims") == dimensions, F.lit(False)))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness: held by several rows, or null."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | quoted(key).isNull()
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter((F.col("rows") > 1) | null_key)


def verify_counts(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(quoted(vector)).alias("embedded"))


def sample_dims(df: DataFrame, key: str, vector: str = "embedding", rows: int = 3) -> DataFrame:
    """A few embedded records with their vector length."""
    embedded = df.filter(quoted(vector).isNotNull())
    return embedded.select(quoted(key), F.size(quoted(vector)).alias("dims")).orderBy(quoted(key)).limit(rows)


def verify_load(df: DataFrame, dimensions: int, key: str, vector: str = "embedding") -> DataFrame:
    """One row: a load passes if every record has its own key and a vector of the right length.

    An empty target gets the status "empty" and does not pass.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(quoted(vector)).alias("embedded"),
        F.count_if(F.size(quoted(vector)) == dimensions).alias("right_dims"),
        F.count_distinct(quoted(key)).alias("distinct_keys"),
    )
    passes = (
        (F.col("total") > 0)
        & (F.col("embedded") == F.col("total"))
        & (F.col("right_dims") == F.col("total"))
        & (F.col("distinct_keys") == F.col("total"))
    )
    status = F.when(F.col("total") == 0, "empty").when(passes, "passed").otherwise("failed")
    return counts.withColumn("passes", passes).withColumn("status", status)


def compare_embeddings(
    left: DataFrame, right: DataFrame, key: str, vector: str = "embedding", tolerance: float = TOLERANCE
) -> DataFrame:
    """One row: do two sources hold the same vectors, up to `tolerance` per value?

    Each side is first reduced to one row per key, so repeated keys are reported and
    never multiplied by the join.
    """

    def one_per_key(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(quoted(key)).agg(
            F.count(F.lit(1)).alias(f"_{side}_rows"), F.min(quoted(vector)).alias(f"_{side}")
        )

    joined = one_per_key(left, "left").join(one_per_key(right, "right"), key, "full")
    gap = max_abs_difference(F.col("_left"), F.col("_right"))
    both = F.col("_left_rows").isNotNull() & F.col("_right_rows").isNotNull()
    counts = joined.agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("_right_rows").isNull()).alias("only_left"),
        F.count_if(F.col("_left_rows").isNull()).alias("only_right"),
        F.count_if((F.col("_left_rows") > 1) | (F.col("_right_rows") > 1)).alias("repeated_keys"),
        F.count_if(both & gap.isNull()).alias("not_comparable"),
        F.max(gap).alias("max_difference"),
    )
    agrees = (F.col("matched") > 0) & (F.col("max_difference") < tolerance)
    for fault in ("only_left", "only_right", "repeated_keys", "not_comparable"):
        agrees = agrees & (F.col(fault) == 0)
    return counts.withColumn("agrees", F.coalesce(agrees, F.lit(False)))


def triplet_check(triplets: DataFrame, records: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """For each (anchor, similar, different): is the similar record strictly nearer?

    `records` must hold each key once. A pair without a defined similarity does not pass.
    """
    found = triplets
    for role in ("anchor", "similar", "different"):
        named = records.select(quoted(key).alias(role), quoted(vector).alias(f"_{role}"))
        found = found.join(named, role)
    near = cosine_similarity(F.col("_anchor"), F.col("_similar"))
    far = cosine_similarity(F.col("_anchor"), F.col("_different"))
    return (
        found.select("anchor", "similar", "different", near.alias("sim_similar"), far.alias("sim_different"))
        .withColumn("passes", F.coalesce(F.col("sim_similar") > F.col("sim_different"), F.lit(False)))
    )


def edge_case_check(texts: DataFrame, provider: EmbeddingProvider) -> DataFrame:
    """One row: does every text of a set of awkward texts get a vector of the right length?"""
    return provider.check(texts)
