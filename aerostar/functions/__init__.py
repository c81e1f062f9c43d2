"""``Column -> Column`` helpers. All are built-in Spark expressions, so they stay
inside whole-stage codegen; none of them is a Python UDF."""

from aerostar.functions.durations import iso_hours, iso_hours_strict, text_hours
from aerostar.functions.segments import (
    first_item, first_segment, last_item, segment_count, segments, non_blank, pad,
)
from aerostar.functions.timefmt import (
    clock, date_key, label_date, label_time, parse_offset_ts,
)
from aerostar.functions.text import (
    field, first_of, flag, lower, strip_currency, text_flag, to_bool, to_float,
)

__all__ = [
    "iso_hours", "iso_hours_strict", "text_hours",
    "segments", "first_item", "first_segment", "last_item", "segment_count", "non_blank", "pad",
    "parse_offset_ts", "clock", "date_key", "label_date", "label_time",
    "strip_currency", "first_of", "lower", "to_bool", "to_float", "flag",
    "text_flag", "field",
]
