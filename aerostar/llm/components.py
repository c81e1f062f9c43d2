"""Connected components by alternating large-star and small-star steps.

Every step groups edges by vertex with a partial minimum and joins the minimum
back, so a hub with a third of all edges is split by Spark's skew join. Each
step is a staged table; the loop ends when a round changes no edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import staged


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """links (a, b) -> (vertex, root) of every vertex that is not its own
    root; root is the least vertex of the component. Loops, repeated links and
    nulls do nothing; no links give no rows."""
    edges = staged(spark, _oriented(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(spark, _oriented(large), "links")
        least = staged(spark, large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = staged(spark, _oriented(small), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes (decimal: it cannot overflow)."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
