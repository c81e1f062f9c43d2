"""Publish to a time-partitioned table (day partitions of Parquet).

The original submits ingestion specs to an OLAP store: ``__time`` parsed from
a column with a pattern (or a constant when there is no time column), the
listed dimensions kept as strings, day segments, rollup on with no metrics
(equal rows collapse) and the covered intervals replaced. Here that is a
projection, a cast to string, a ``distinct``, and a write partitioned by
segment (a day, month or year) with dynamic partition overwrite: republishing
replaces only the segments present, and publishing twice equals publishing
once. No row is dropped: a time that does not parse takes ``missing`` where it
is given, and fails the publish otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
DAY = "__day"


SEGMENT = "__segment"
GRANULARITIES = ("day", "month", "year")


def publish_frame(df: DataFrame, dims: Sequence[str], time_col: str | None = None,
                  time_fmt: str | None = None, missing: str | None = None, rollup: bool = True,
                  typed: bool = False, unique_key: str | None = None,
                  granularity: str = "day") -> DataFrame:
    """The rows ``publish`` writes: ``__time``, the dimensions (text unless
    ``typed``), rolled up, with ``__day`` and the segment, rebalanced on it.

    ``missing`` replaces a null or unparsable time (and is the time of every
    row without a time column, then 1970 by default). ``unique_key`` names a
    dimension that is unique per row by construction (a surrogate key from
    ``dense_key`` / ``unique_key``): no two rows can be equal, so the rollup is
    a no-op and its shuffle - the whole table at scale - is skipped."""
    if unique_key is not None and unique_key not in dims:
        raise ValueError(f"unique_key {unique_key!r} must be one of the published dimensions")
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, not {granularity!r}")
    if time_col:
        ts = F.try_to_timestamp(F.col(time_col).cast("string"), F.lit(time_fmt)) if time_fmt \
            else F.try_to_timestamp(F.col(time_col).cast("string"))
        if missing is not None:
            ts = F.coalesce(ts, F.lit(missing).cast("timestamp"))
        else:
            ts = F.coalesce(ts, F.raise_error(F.concat(
                F.lit(f"publish: no time in {time_col}: "), F.coalesce(F.col(time_col).cast("string"), F.lit("null")))))
    else:
        ts = F.lit(missing or EPOCH).cast("timestamp")
    # Session time zone is UTC, so the wall clock of the NTZ value is UTC.
    ts = ts.cast("timestamp_ntz")
    cols = [F.col(d) if typed else F.col(d).cast("string").alias(d) for d in dims]
    rows = df.select(ts.alias("__time"), *cols)
    if rollup and unique_key is None:
        rows = rows.distinct()
    rows = rows.withColumn(DAY, F.to_date("__time")).withColumn(SEGMENT, F.trunc(DAY, granularity) if granularity != "day" else F.col(DAY))
    # Rebalance on the segment: AQE splits a hot one over several tasks and
    # merges small ones, so files stay few and no task writes a whole skewed one.
    return rows.hint("rebalance", SEGMENT)


def publish(df: DataFrame, path: str, dims: Sequence[str], time_col: str | None = None,
            time_fmt: str | None = None, missing: str | None = None, rollup: bool = True,
            typed: bool = False, unique_key: str | None = None, granularity: str = "day") -> str:
    """Publish ``dims`` (plus ``__time`` and ``__day``) partitioned by segment,
    replacing only the segments present (see ``publish_frame`` for the rows)."""
    rows = publish_frame(df, dims, time_col, time_fmt, missing, rollup, typed, unique_key, granularity)
    (rows.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(SEGMENT)
         .parquet(path))
    return path


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Published rows; ``__day`` is a column, the segment folder is not."""
    return spark.read.parquet(path).drop(SEGMENT)


def published_between(spark: SparkSession, path: str, first: str, last: str,
                      granularity: str = "day") -> DataFrame:
    """Rows of the days first to last; other segments are not read."""
    start = F.lit(first).cast("date") if granularity == "day" else F.trunc(F.lit(first).cast("date"), granularity)
    return (spark.read.parquet(path).where(F.col(SEGMENT).between(start, F.lit(last).cast("date")))
            .where(F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).drop(SEGMENT))
