"""Edge rows of SURVEY 1.4 / FIXTURES 4 for the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from aerostar.functions import (
    clock, date_key, first_item, first_of, flag, iso_hours, iso_hours_strict, label_date,
    label_time, last_item, non_blank, pad, segments, strip_currency, text_flag, text_hours,
)


def col_values(spark, values, expr, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_iso_hours_missing_parts_count_zero(spark):
    got = col_values(spark, ["PT2H29M", "PT45M", "P1DT2H5M", "PT3H", None, "junk"], iso_hours)
    assert got == [2.48, 0.75, 0.08, 3.0, 0.0, 0.0]


def test_iso_hours_days_option(spark):
    assert col_values(spark, ["P1DT2H5M", "PT2H29M"], lambda c: iso_hours(c, days=True)) == [26.08, 2.48]


def test_iso_hours_strict_needs_both_parts(spark):
    assert col_values(spark, ["PT2H29M", "PT45M", "PT3H", None], iso_hours_strict) == [2.48, None, None, None]


def test_text_hours_positional_and_strict(spark):
    vals = ["2 hr 29 min", "3 hr", "45 min", None, "2\u00a0hr\u202f29\u00a0min", "2 hr\n29 min", " 1 hr x min", "soon"]
    assert col_values(spark, vals, text_hours) == ["2.48", "3.00", "45.00", None, "2.48", "2.48", None, None]
    assert col_values(spark, vals, lambda c: text_hours(c, strict=True)) == ["2.48", "3.00", "0.75", None, "2.48", "2.48", "1.00", None]


def test_clock_reads_the_whole_text(spark):
    vals = ["2022-04-17T12:57:00.000-04:00", "2022-04-17T12:57:00.000Z", "2022-04-17T12:57:00.000+05:30", "2022-04-17T12:57:00.000-04:00x", "2022-04-17T12:57:00.000"]
    assert col_values(spark, vals, lambda c: clock(c, local=True)) == ["12:57 PM", "12:57 PM", "12:57 PM", None, None]
    assert col_values(spark, vals, clock) == ["04:57 PM", "12:57 PM", "07:27 AM", None, None]


def test_first_of_strips_any_white_space(spark):
    assert col_values(spark, ["Delta\n, X", "\u00a0A\u202f", None], first_of) == ["Delta", "A", None]


def test_offset_timestamp_to_clock_utc_and_local(spark):
    vals = ["2022-04-17T12:57:00.000-04:00", "", None, "bad"]
    assert col_values(spark, vals, clock) == ["04:57 PM", None, None, None]
    assert col_values(spark, vals[:1], lambda c: clock(c, local=True)) == ["12:57 PM"]


def test_segments_first_last(spark):
    assert col_values(spark, ["A||B||C", "X", None], lambda c: first_item(segments(c))) == ["A", "X", None]
    assert col_values(spark, ["A||B||C", "X", None], lambda c: last_item(segments(c))) == ["C", "X", None]


def test_date_key_and_label_date(spark):
    df = spark.createDataFrame([(dt.date(2022, 4, 17),)], "d date")
    row = df.select(date_key("d"), F.dayofweek("d"), F.quarter("d")).first()
    assert tuple(row) == ("20220417", 1, 2)  # Sunday = 1
    assert col_values(spark, ["Wed, Jan 1", "Thu, Feb 29", "nonsense"],
                      lambda c: label_date(c, 2025)) == [dt.date(2025, 1, 1), None, None]


def test_label_time(spark):
    got = col_values(spark, ["Departure time: 9:05 AM.", "Arrival time: 11:30 PM."],
                     lambda c: label_time(c, "Departure time: "))
    assert got[0] == "9:05 AM"


def test_flags_and_text(spark):
    assert col_values(spark, [None, True, False], flag, "boolean") == [0, 1, 0]
    assert col_values(spark, ["Nonstop", "1 stop", None], lambda c: text_flag(c, "Nonstop")) == [1, 0, 0]
    assert col_values(spark, ["$1,234", "$50"], strip_currency) == ["1,234", "50"]
    assert col_values(spark, ["A3, B", " Solo "], first_of) == ["A3", "Solo"]


def test_array_helpers(spark):
    df = spark.createDataFrame([(["1", "", "2"],)], "a array<string>")
    row = df.select(non_blank("a").alias("nb"), pad(non_blank("a"), 4, "X").alias("p")).first()
    assert row.nb == ["1", "2"]
    assert row.p == ["1", "2", "X", "X"]


def test_first_segment_is_the_first_item_of_the_segments(spark):
    from aerostar.functions import first_item, first_segment, segments
    texts = ["A||B", "A", "", "||B", "A|||B", "|", "||", "|||", "A|B||C", "é||\U0001f6eb||", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(first_item(segments("t")).alias("a"), first_segment("t").alias("b")).collect()
    assert len(rows) == len(texts) and [r.a for r in rows] == [r.b for r in rows]
