"""Surrogate keys.

``row_number().over(Window.orderBy(k))`` - what the original jobs use - plans an
``Exchange SinglePartition``: every row goes to one task. That is harmless on a
25-row dimension and fatal on a fact-sized one, so ``dense_key`` numbers rows
in two passes instead, with the same result:

1. range-partition on the order (AQE may merge adjacent ranges, which keeps
   the order), sort within partitions, tag each row with
   ``monotonically_increasing_id()`` (= partition index << 33 | row index), and
   write the rows to a staged Parquet table below ``spark.checkpoint.dir``.
   The write fixes the partition contents, so a lost executor cannot make two
   passes see different ranges;
2. count rows per partition from the staged ids (one small aggregate that
   reads a single column), turn the counts into running offsets (one row per
   partition - the only data that is broadcast, its size bounded by the
   partition count), and add offset + row index.

No task ever holds more than one range partition. A heavily repeated order
value would still land in one range; a content hash is appended to the order
to split it (rows tied on the order get an arbitrary but repeatable order,
exactly as ``row_number`` would give them an arbitrary one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.session import stage_dir

ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits
_MID = "__aerostar_mid"
_PID = "__aerostar_pid"
_OFF = "__aerostar_off"
_TIE = "__aerostar_tie"


def _ordered(c: str | Column, nulls_first: bool = True) -> Column:
    c = F.col(f"`{c}`") if isinstance(c, str) else c
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def ranged_rows(df: DataFrame, order: Sequence[str | Column] | None) -> DataFrame:
    """Pass 1 of ``dense_key`` before it is written: rows range-partitioned and
    sorted on ``order`` (plus a content hash that splits a hot tied value), each
    tagged with ``monotonically_increasing_id`` (partition index << 33 | row)."""
    cols = df.columns
    order = list(order) if order else list(cols)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias(_TIE)
    ordering = [_ordered(c) for c in order] + [F.col(_TIE).asc()]
    return (df.select("*", tie)
              .repartitionByRange(*ordering)
              .sortWithinPartitions(*ordering)
              .withColumn(_MID, F.monotonically_increasing_id())
              .drop(_TIE))


def placed_rows(df: DataFrame, order: Sequence[str | Column] | None, hashed: Sequence[str] | None = None) -> DataFrame:
    """Rows in the partitions they are in, sorted there by ``order`` and tagged:
    no exchange. ``hashed``: the columns by whose hash an exchange below has
    dealt them out; rows are sorted by that number first, so that the order over
    all partitions is the same however AQE merges neighbouring ones."""
    order = list(order) if order else list(df.columns)
    ordering = [_ordered(c) for c in order]
    if hashed is not None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ordering.insert(0, F.pmod(F.hash(*[F.col(f"`{c}`") for c in hashed]), F.lit(n)).asc())
    return df.sortWithinPartitions(*ordering).withColumn(_MID, F.monotonically_increasing_id())


def dense_key(df: DataFrame, order: Sequence[str | Column] | None, name: str,
              start: int = 1, *, key_type: str = "long") -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (ascending, nulls
    first, like ``Window.orderBy``). ``order=None`` orders by every column, so
    the key is repeatable where the original used an arbitrary order."""
    return _numbered(ranged_rows(df, order), name, start, key_type)


def hashed_key(df: DataFrame, order: Sequence[str | Column] | None, name: str, hashed: Sequence[str], start: int = 1) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the order (hash bucket, ``order``),
    for rows that an aggregate over ``hashed`` (a dedupe) has just dealt to the
    buckets. Its exchange serves both: no sampling job, no range exchange. The
    keys are dense, and the same again for the same rows and number of shuffle
    partitions; they do not follow the natural order."""
    return _numbered(placed_rows(df, order, hashed), name, start, "long")


def _numbered(tagged: DataFrame, name: str, start: int, key_type: str) -> DataFrame:
    """Pass 2: stage the tagged rows, turn the counts of their partitions into
    offsets, and add them."""
    spark = tagged.sparkSession
    cols = [c for c in tagged.columns if c != _MID]
    path = stage_dir(spark, "dense-key")
    tagged.write.mode("errorifexists").parquet(path)
    staged = spark.read.parquet(path)

    pid = F.shiftright(F.col(_MID), ROW_BITS)
    counts = staged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("__n"))
    # The row index has 33 bits; a larger range partition would make ids
    # collide, so fail loudly (raise spark.sql.shuffle.partitions) instead.
    counts = counts.filter(F.assert_true(F.col("__n") < F.lit(1 << ROW_BITS),
                                         F.lit("dense_key: a range partition exceeds 2^33 rows")).isNull())
    # One row per partition: the only single-partition window, bounded by the
    # partition count, not by the data.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFF))
    row_in_part = F.col(_MID).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    key = (F.col(_OFF) + row_in_part + F.lit(start)).cast(key_type).alias(name)
    return (staged.join(F.broadcast(offsets), pid == F.col(_PID))
                  .select(*[F.col(f"`{c}`") for c in cols], key))


def unique_key(df: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Unique but gapped id (``monotonically_increasing_id() + start``): free,
    no shuffle, but not contiguous and not repeatable across runs."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))


def position_key(df: DataFrame, pos: str, name: str, start: int = 1) -> DataFrame:
    """1..n in list order from a ``posexplode`` position (per page)."""
    return df.withColumn(name, (F.col(pos) + F.lit(start)).cast("long"))
