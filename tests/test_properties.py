"""Durations by cases, and property tests of the dense key."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostar.functions import iso_hours, iso_hours_strict

#: text -> hours with missing parts as 0, hours only if both parts are there
DURATIONS = [
    ("PT2H29M", 2.48, 2.48), ("PT2H", 2.0, None), ("PT29M", 0.48, None), ("P1DT2H5M", 0.08, None),
    ("PT0H0M", 0.0, 0.0), ("PT10H1M", 10.02, 10.02), ("PT99H99M", 100.65, 100.65), ("PT", 0.0, None),
    ("junk", 0.0, None), ("", 0.0, None), ("PT1H30Mx", 1.5, 1.5), ("xPT1H30M", 1.5, None),
]


def test_iso_durations(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DURATIONS)], "i int, t string")
    rows = df.orderBy("i").select(iso_hours("t").alias("a"), iso_hours_strict("t").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [d[1:] for d in DURATIONS]


values = st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="abcXY z", max_size=4)),
                            st.integers(-5, 5)), min_size=1, max_size=300, unique=True)


@settings(max_examples=5, deadline=None)
@given(values, st.integers(1, 6))
def test_dense_key_is_the_sorted_rank(spark, rows, parts):
    """dense_key numbers distinct rows 1..n in (a nulls first, b) order, for any
    input partitioning."""
    from aerostar.operators import dense_key
    df = spark.createDataFrame(rows, "a string, b int").repartition(parts)
    got = {(r.a, r.b): r.k for r in dense_key(df, ["a", "b"], "k").collect()}
    # Spark orders strings by UTF-8 bytes, nulls first.
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert got == {r: i + 1 for i, r in enumerate(order)}
