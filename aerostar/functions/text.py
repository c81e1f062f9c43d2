"""Casts, flags and small text clean-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostar.functions._util import as_col, strip_space


def flag(c: str | Column) -> Column:
    """Boolean -> 1 / 0; null counts as 0 (``when(c == True, 1).otherwise(0)``)."""
    return F.when(as_col(c) == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def text_flag(c: str | Column, value: str) -> Column:
    """1 when the text equals ``value`` (``Nonstop``, ``Economy``), else 0."""
    return F.coalesce((as_col(c) == F.lit(value)).cast("int"), F.lit(0))


def to_bool(c: str | Column) -> Column:
    return as_col(c).try_cast("boolean")


def to_float(c: str | Column) -> Column:
    return as_col(c).try_cast("float")


def lower(c: str | Column) -> Column:
    return F.lower(as_col(c))


def strip_currency(c: str | Column, sign: str = "$") -> Column:
    """``$1,234`` -> ``1,234`` (the thousands comma stays, as in the scraper)."""
    return F.replace(as_col(c), F.lit(sign), F.lit(""))


def first_of(c: str | Column, sep: str = ",") -> Column:
    """First item of a comma list without outer white space of any kind:
    ``'A3\\n, B'`` -> ``'A3'``."""
    return strip_space(F.split_part(as_col(c), F.lit(sep), F.lit(1)))


def field(c: str | Column, default) -> Column:
    """Nested field with a default for absent (or null) values."""
    return F.coalesce(as_col(c), F.lit(default))
