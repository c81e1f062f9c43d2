"""Duration text to hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostar.functions._util import SPACE, as_col, strip_space

# The ISO-8601 parts the flight data carries.
ISO_HOURS = r"PT(\d+)H"
ISO_MINUTES = r"(\d+)M"
ISO_DAYS = r"P(\d+)D"
ISO_STRICT = r"^PT(\d+)H(\d+)M"


def _part(c: Column, pattern: str) -> Column:
    # regexp_extract gives '' on no match; try_cast('' as float) is null, so a
    # missing part counts as 0 (a bare cast would throw under ANSI).
    return F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("float"), F.lit(0.0))


def iso_hours(c: str | Column, days: bool = False) -> Column:
    """``PT2H29M`` -> 2.48. Missing hours or minutes count as 0, null or junk
    gives 0.0. Only ``PT<h>H`` is read as hours, so ``P1DT2H5M`` gives 0.08 as in
    the original job; ``days=True`` adds 24 h per ``P<d>D``."""
    c = as_col(c)
    if days:
        # With a day part the hours follow 'T' rather than 'PT'.
        hours = _part(c, r"T(\d+)H") + _part(c, ISO_DAYS) * 24
    else:
        hours = _part(c, ISO_HOURS)
    return F.round(hours + _part(c, ISO_MINUTES) / 60, 2)


def iso_hours_strict(c: str | Column) -> Column:
    """Both parts required (``^PT<h>H<m>M``), else null; null in, null out."""
    c = as_col(c)
    h = F.regexp_extract(c, ISO_STRICT, 1).try_cast("int")
    m = F.regexp_extract(c, ISO_STRICT, 2).try_cast("int")
    return F.when(c.rlike(ISO_STRICT), F.round(h + m / 60.0, 2)).cast("double")


def text_hours(c: str | Column, strict: bool = False) -> Column:
    """``2 hr 29 min`` -> ``'2.48'`` (text, 2 decimals).

    ``strict=False`` keeps the scraper's rule: token 1 is hours and token 3 is
    minutes whatever the units say, so ``45 min`` gives ``'45.00'``.
    ``strict=True`` reads the numbers in front of ``hr`` and ``min``.
    Any white space separates, no-break spaces included; a number that does not
    parse gives null.
    """
    c = as_col(c)
    if strict:
        h = F.coalesce(F.regexp_extract(c, rf"(\d+){SPACE}*hr", 1).try_cast("int"), F.lit(0))
        m = F.coalesce(F.regexp_extract(c, rf"(\d+){SPACE}*min", 1).try_cast("int"), F.lit(0))
        total = h + m / 60.0
        ok = c.rlike(rf"\d+{SPACE}*(hr|min)")
    else:
        parts = F.split(strip_space(c), f"{SPACE}+")
        h = F.try_element_at(parts, F.lit(1)).try_cast("int")
        minutes = F.try_element_at(parts, F.lit(3))
        m = F.when(minutes.isNull(), F.lit(0)).otherwise(minutes.try_cast("int"))
        total = h + m / 60.0
        ok = h.isNotNull() & m.isNotNull()
    return F.when(ok, F.format_string("%.2f", total))
