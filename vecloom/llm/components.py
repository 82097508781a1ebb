"""Connected components of links between long ids, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.text import written


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers three steps
    on, and contracts the links along them. Paths get shorter by a factor each round, so the
    rounds grow with the logarithm of the longest path. Every round is staged; counts by
    node are combined before they are shuffled, so a node with many links is no hot key.
    """
    links = written(spark, links.select("a", "b").where("a <> b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        parent = written(spark, parent, "parent")
        for _ in range(2):
            next_step = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            parent = parent.join(next_step, "p").select("a", F.col("q").alias("p"))
        parent = written(spark, parent, "parent")
        if roots is None:
            roots = parent.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            moved = parent.select(F.col("a").alias("root"), F.col("p").alias("next"))
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots = written(spark, roots, "roots")
        links = (
            links.join(parent, "a").select(F.col("p").alias("a"), "b")
            .join(parent.select(F.col("a").alias("b"), F.col("p").alias("q")), "b").select("a", F.col("q").alias("b"))
            .where("a <> b").distinct()
        )
        links = written(spark, links, "links")
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
