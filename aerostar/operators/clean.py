"""Row-level cleaning: null filters, fills, sentinels, dedupe."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_null(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``.

    Written as an ``isNotNull`` conjunction rather than ``dropna``: the
    conjunction reaches the Parquet scan as ``PushedFilters: [IsNotNull(..)]``,
    ``dropna`` (``atleastnnonnulls``) does not."""
    conds = [F.col(f"`{c}`").isNotNull() for c in subset]
    return df.filter(reduce(lambda a, b: a & b, conds))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column null fill (``fillna``). A numeric fill also fills a string
    column with its text, as ``fillna`` does."""
    return df.fillna(dict(values))


def dedupe(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Full-row (or subset) dedupe. Planned as partial + final aggregate: exact
    copies of a hot row collapse map-side before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def drop_sentinel(df: DataFrame, col: str, sentinel: str) -> DataFrame:
    """Drop rows whose ``col`` equals ``sentinel``; nulls are kept (pandas
    ``!=`` semantics), hence the null-safe comparison."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(sentinel)))


def blank_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Empty text -> null, which is what a CSV hop does to it (an empty field
    reads back as null), so a later null filter drops those rows too."""
    return df.withColumns({c: F.when(F.col(f"`{c}`") == F.lit(""), F.lit(None)).otherwise(F.col(f"`{c}`"))
                           for c in cols})
