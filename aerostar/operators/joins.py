"""Dimension lookups (left equi-joins that swap a natural key for a surrogate key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
    LongType, ShortType, StringType, TimestampNTZType, TimestampType,
)

BROADCAST_MAX_ROWS_CONF = "aerostar.broadcast.maxRows"
BROADCAST_MAX_BYTES_CONF = "aerostar.broadcast.maxBytes"
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


# Bytes per value of fixed-width Spark types.
_WIDTHS = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4,
           LongType: 8, DoubleType: 8, TimestampType: 8, TimestampNTZType: 8, DecimalType: 16}


def _bytes(field) -> Column:
    """Bytes of a column's value: a fixed width, the length of text, and the
    length as JSON of anything nested."""
    c = F.col(f"`{field.name}`")
    if type(field.dataType) in _WIDTHS:
        return F.lit(_WIDTHS[type(field.dataType)])
    if not isinstance(field.dataType, (StringType, BinaryType)):
        c = F.to_json(F.struct(c))
    return F.coalesce(F.octet_length(c), F.lit(0))


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Proven size bound: the number of rows of ``df`` and their bytes must both
    be under budget. A plain aggregate measures them, one partial sum per task,
    so no task is sent the rows of the others.

    Dimensions here come out of ``dense_key`` as staged Parquet, so the check
    is one scan of a narrow table, not a recomputation of its lineage."""
    conf = df.sparkSession.conf
    if max_rows is None:
        max_rows = int(conf.get(BROADCAST_MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS)))
    if max_bytes is None:
        max_bytes = int(conf.get(BROADCAST_MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES)))
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _bytes(f)
    n, b = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return n <= max_rows and (b or 0) <= max_bytes


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key: str,
               as_name: str | None = None, broadcast: bool | None = None,
               keep_fact_col: bool = False) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.fact_col = dim.dim_col``, adding ``dim.key``
    (renamed ``as_name``) and dropping both natural-key copies.

    Null keys never match (plain equality, as in the original), so a fact row
    with a null natural key gets a null surrogate key even when the dimension
    has a null member. The dimension is broadcast only after ``fits_broadcast``
    proves it small; otherwise Catalyst plans a shuffle join and AQE splits
    skewed fact partitions (``spark.sql.adaptive.skewJoin.enabled``).
    Joining the same dimension twice under two ``as_name`` values gives the
    role-playing lookups (start / destination airport)."""
    as_name = as_name or key
    right = dim.select(F.col(f"`{dim_col}`").alias("__lk_natural"), F.col(f"`{key}`").alias(as_name))
    if broadcast is None:
        broadcast = fits_broadcast(right)
    if broadcast:
        right = F.broadcast(right)
    out = fact.join(right, F.col(f"`{fact_col}`") == F.col("__lk_natural"), "left").drop("__lk_natural")
    return out if keep_fact_col else out.drop(fact_col)
