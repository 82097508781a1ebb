"""A model looked at before it is used: awkward texts, equal texts, near and far texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.vector import cosine_similarity, max_abs_difference
from vecloom.operators.embed import EmbeddingProvider, query_frame
from vecloom.operators.project import quoted

# Sample texts of the checks, and the largest difference of equal texts' vectors.
BASIC = ("The valve was changed after the evening shift", "All filters are clean again", "No spare part was in store, so the unit was sent back")
TRIPLET = ("The pump broke and was exchanged", "A broken pump had to be exchanged", "Lunch is served in the hall at noon")
EDGE = ("", "q", "again " * 700, "2048", "\t")
SAME = "One sentence, asked for twice"
TOLERANCE = 1e-5


def validate_model(
    spark: SparkSession, provider: EmbeddingProvider, basic=BASIC, triplet=TRIPLET, edge=EDGE, same: str = SAME
) -> DataFrame:
    """(check, passes) of the basic, edge, triplet and consistency checks.

    The triplet needs a model that knows meanings: its similar text must lie nearer to the
    anchor than the different one.
    """
    vector = quoted(provider.config.output_column)

    def embedded(texts) -> DataFrame:
        return provider.add_embeddings(query_frame(spark, list(texts), provider)).select("query_id", vector.alias("v"))

    def named(check: str, passes) -> DataFrame:
        return passes.select(F.lit(check).alias("check"), F.coalesce(F.col("passes"), F.lit(False)).alias("passes"))

    def by_place(texts, passes) -> DataFrame:
        found = embedded(texts).groupBy().agg(
            *[F.max(F.when(F.col("query_id") == i, F.col("v"))).alias(f"v{i}") for i in range(len(texts))]
        )
        return found.select(passes.alias("passes"))

    near = cosine_similarity(F.col("v0"), F.col("v1")) > cosine_similarity(F.col("v0"), F.col("v2"))
    equal = max_abs_difference(F.col("v0"), F.col("v1")) < TOLERANCE
    return reduce(
        DataFrame.unionByName,
        [
            named("basic", provider.check(query_frame(spark, list(basic), provider))),
            named("edge", provider.check(query_frame(spark, list(edge), provider))),
            named("triplet", by_place(triplet, near)),
            named("consistency", by_place((same, same), equal)),
        ],
    )
