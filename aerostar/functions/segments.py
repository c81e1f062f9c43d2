"""Multi-value ``||`` segment columns and small array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostar.functions._util import as_col

# Fixed value: the segment separator of the flight data, as a regex.
SEGMENT_SEP = r"\|\|"


def segments(c: str | Column) -> Column:
    """``'A||B'`` -> ``['A', 'B']``; null stays null."""
    return F.split(as_col(c), SEGMENT_SEP)


def first_item(arr: str | Column) -> Column:
    """First element, null-safe (``getItem(0)`` throws under ANSI on empty arrays)."""
    return F.try_element_at(as_col(arr), F.lit(1))


def first_segment(c: str | Column) -> Column:
    """``first_item(segments(c))`` without splitting the text: what comes before
    the first separator."""
    return F.substring_index(as_col(c), "||", 1)


def last_item(arr: str | Column) -> Column:
    """Last element (the original splits twice and indexes ``size - 1``)."""
    return F.try_element_at(as_col(arr), F.lit(-1))


def segment_count(arr: str | Column) -> Column:
    return F.size(as_col(arr))


def non_blank(arr: str | Column) -> Column:
    """Drop empty strings from an array (the scraper's ``if price != ""``)."""
    return F.filter(as_col(arr), lambda x: x != F.lit(""))


def pad(arr: str | Column, length: str | Column | int, value: str) -> Column:
    """Append ``value`` until the array has ``length`` items."""
    arr = as_col(arr)
    n = F.lit(length) if isinstance(length, int) else as_col(length)
    missing = F.greatest(n - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(value), missing))
