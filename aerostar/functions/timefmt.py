"""Timestamps, dates and scraped time labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostar.functions._util import as_col

# Formats of the flight data and of its star schema.
OFFSET_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CLOCK = "hh:mm a"
DATE_KEY = "yyyyMMdd"
LABEL_DATE = "yyyy MMM d"
NARROW_NBSP = "\u202f"


def parse_offset_ts(c: str | Column) -> Column:
    """``2022-04-17T12:57:00.000-04:00`` -> timestamp; bad or empty text -> null."""
    return F.try_to_timestamp(as_col(c), F.lit(OFFSET_TS))


def clock(c: str | Column, local: bool = False) -> Column:
    """Offset timestamp text -> ``hh:mm a``.

    ``local=False`` (the original): the instant shown in the session time zone
    (pinned to UTC), so ``12:57 -04:00`` prints ``04:57 PM``.
    ``local=True``: the wall clock as written (``12:57 PM``). The whole text is
    parsed either way, so junk anywhere in it gives null.
    """
    c = as_col(c)
    ts = parse_offset_ts(c)
    if local:  # the instant moved by its own offset; Z has none
        part = lambda k: F.coalesce(F.regexp_extract(c, r"([+-])(\d\d):(\d\d)$", k).try_cast("int"), F.lit(0))
        seconds = part(2) * 3600 + part(3) * 60
        behind = F.regexp_extract(c, r"([+-])\d\d:\d\d$", 1) == "-"
        ts = F.timestamp_add("SECOND", F.when(behind, -seconds).otherwise(seconds), ts)
    return F.date_format(ts, CLOCK)


def date_key(c: str | Column) -> Column:
    """Date -> text key ``yyyyMMdd``."""
    return F.date_format(as_col(c), DATE_KEY)


def label_date(c: str | Column, year: int) -> Column:
    """``Wed, Jan 1`` with year 2025 -> 2025-01-01 (weekday dropped first: a
    weekday pattern is not accepted for parsing); unparsable -> null."""
    md = F.split_part(as_col(c), F.lit(", "), F.lit(2))
    return F.try_to_date(F.concat(F.lit(str(year)), F.lit(" "), md), LABEL_DATE)


def label_time(c: str | Column, marker: str) -> Column:
    """``Departure time: 9:05<U+202F>AM.`` -> ``9:05 AM``: text after the marker,
    narrow space removed, outer dots stripped, a space put before AM / PM."""
    t = F.split_part(as_col(c), F.lit(marker), F.lit(2))
    t = F.replace(t, F.lit(NARROW_NBSP), F.lit(""))
    t = F.btrim(t, F.lit("."))
    t = F.replace(t, F.lit("AM"), F.lit(" AM"))
    return F.replace(t, F.lit("PM"), F.lit(" PM"))
