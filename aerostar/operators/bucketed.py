"""Lookups into dimensions that are too large to broadcast, without an exchange.

A dimension of which many facts ask every day is stored once, dealt to buckets by
its natural key and sorted; so is a fact. A lookup then joins bucket with bucket:
neither side moves. What AQE does for a hot key in a shuffle join - split its
partition - cannot happen here, as there is no exchange; so the keys that hold
more than a bucket's share of the fact are noted when it is stored (fewer than
there are buckets), and their rows are looked up by broadcast of those few members,
read by plain splits of the files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostar.session import stage_dir


@dataclass(frozen=True)
class Bucketed:
    """A table stored by buckets of ``key``; ``hot``: values of more than a
    bucket's share of its rows."""

    name: str
    key: str
    buckets: int
    hot: tuple


def store_bucketed(df: DataFrame, key: str, buckets: int, path: str | None = None, name: str | None = None,
                   find_hot: bool = True) -> Bucketed:
    """Write df as an external table of the session's catalog, dealt by ``key``."""
    spark = df.sparkSession
    name = name or f"aerostar_{uuid.uuid4().hex}"
    path = path or stage_dir(spark, "bucketed")
    # One file a bucket and task: dealt out first, the rows of a bucket are in one task.
    (df.repartition(buckets, F.col(f"`{key}`")).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    hot = ()
    if find_hot:
        table = spark.table(name)
        share = table.count() / buckets
        often = table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > max(share, 1)) & F.col(f"`{key}`").isNotNull())
        hot = tuple(sorted(r[0] for r in often.select(key).collect()))  # fewer than ``buckets``
    return Bucketed(name, key, buckets, hot)


def bucketed_lookup(spark: SparkSession, fact: Bucketed, dim: Bucketed, key: str, as_name: str | None = None) -> DataFrame:
    """``fact LEFT JOIN dim`` on their bucket keys, adding ``dim.key`` under
    ``as_name``; a null never matches. Both are dealt to as many buckets."""
    if fact.buckets != dim.buckets:
        raise ValueError(f"{fact.name} has {fact.buckets} buckets and {dim.name} {dim.buckets}")
    rows = spark.table(fact.name)
    members = spark.table(dim.name).select(F.col(f"`{dim.key}`").alias("__member"), F.col(f"`{key}`").alias(as_name or key))
    on = F.col(f"`{fact.key}`") == F.col("__member")
    if not fact.hot:
        return rows.join(members.hint("merge"), on, "left").drop("__member")
    hot = F.coalesce(F.col(f"`{fact.key}`").isin(*fact.hot), F.lit(False))
    few = F.broadcast(members.where(F.col("__member").isin(*fact.hot)))  # fewer than ``buckets`` keys
    return (rows.where(~hot).join(members.hint("merge"), on, "left").drop("__member")
            .unionByName(rows.where(hot).join(few, on, "left").drop("__member")))
