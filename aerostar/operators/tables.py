"""Projections, renames, distinct, union, counts, preview, schema report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep (and order) named columns. Catalyst prunes the rest at the scan."""
    return df.select(*names)


def project_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep and rename: ``{old: new}``."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def with_cols(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite several columns in one projection."""
    return df.withColumns(dict(cols))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_cols(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def distinct_of(df: DataFrame, cols: Iterable[str | Column]) -> DataFrame:
    """Distinct rows of a projection (partial + final aggregate, so a hot value
    is collapsed map-side before the shuffle)."""
    return df.select(*cols).distinct()


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION``: positional union, then distinct."""
    return a.union(b).distinct()


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Row count as a one-row DataFrame (``count()`` without leaving Spark)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows, as ``show()`` displays them."""
    return df.limit(n)


def schema_report(df: DataFrame, counts: bool = False) -> DataFrame:
    """One row per column: position, name, Spark type; reads no data. With
    ``counts`` also the non-null count, from one aggregate over the table whose
    single result row carries the names and types and is then unpivoted."""
    cols = df.dtypes
    if not counts:
        return df.sparkSession.createDataFrame([(i + 1, c, t) for i, (c, t) in enumerate(cols)],
                                               "position int, column_name string, data_type string")
    found = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, (c, _) in enumerate(cols)])
    entries = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                 F.lit(t).alias("data_type"), F.col(f"n{i}").alias("non_null"))
        for i, (c, t) in enumerate(cols)
    ]
    return found.select(F.inline(F.array(*entries)))
