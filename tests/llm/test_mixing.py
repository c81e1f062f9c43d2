import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerostar.llm import mixing as X


def water_fill(sizes, weights, budget=1.5, cap=2.0):
    """Share by weight, cap, share the excess again, until nothing is above."""
    total, target, full = budget * sum(sizes), [0.0] * len(sizes), set()
    while True:
        left = total - sum(cap * sizes[k] for k in full)
        open_ = [k for k in range(len(sizes)) if k not in full]
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        over = {k for k in open_ if share[k] > cap * sizes[k]}
        if not over:
            return [cap * sizes[k] if k in full else share[k] for k in range(len(sizes))]
        full |= over


def check(rows):
    size = defaultdict(int)
    for r in rows:
        assert r.size == len(re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode()))
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0)
        size[r.source] += r.size
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    want = water_fill([size[s] for s in names], [(3, 1, 2)[k % 3] for k in range(len(names))])
    for s, t in zip(names, want):
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {size[s]}
        assert own[0].target == pytest.approx(t)
        assert sum(r.taken for r in own) == pytest.approx(t, abs=1)


def test_targets_and_taken(spark, messy):
    rows = X.mix(spark, messy).collect()
    assert len(rows) == messy.count()
    check(rows)


def test_one_source_holds_most_and_caps_bind(spark):
    docs = [(k, "w " * (k % 9 + 1), "hot" if k % 10 else f"s{k % 7}") for k in range(600)] + [(1000, "a b c", "tiny"), (1001, None, None)]
    rows = X.mix(spark, spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)).collect()
    check(rows)


def test_reruns_agree_and_curriculum_is_sorted(spark, messy):
    first, second = (sorted(map(str, X.mix(spark, messy.repartition(n)).collect())) for n in (1, 4))
    assert first == second
    places = [r.position for r in X.curriculum(X.mix(spark, messy)).collect()]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)


def test_weight_moves_over_time(spark):
    """Of a source that is in the mix ``passes`` times, the first half of the
    training holds the integral of its weight up to one half."""
    docs = [(k, "one", "abc"[k % 3]) for k in range(3000)]
    rows = X.curriculum(X.mix(spark, spark.createDataFrame(docs, "doc_id long, text string, source string"))).collect()
    half = {s: [r.position < 0.5 for r in rows if r.source == s] for s in "abc"}
    passes = {r.source: r.target / r.source_size for r in rows}
    for s, tilt in zip("abc", X.TILTS):
        integral = (1 - tilt) * 0.5 + tilt * 0.25
        assert sum(half[s]) / len(half[s]) == pytest.approx(min(1, integral * max(1, passes[s])), abs=0.02)


def test_every_pass_has_its_own_position(spark):
    """Source a is capped at twice its size: both passes are placed, and every
    source has the integral of its weight in each quarter of the training."""
    docs = [(k, "one", "abc"[k % 3], 1) for k in range(3000)]
    mixed = X.mix(spark, spark.createDataFrame(docs, "doc_id long, text string, source string, pass int"))
    rows = X.schedule(mixed).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    for s, tilt in zip("abc", X.TILTS):
        own = [r for r in rows if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, abs=1)
        for t in (0.25, 0.5, 0.75):
            assert sum(r.position < t for r in own) / len(own) == pytest.approx((1 - tilt) * t + tilt * t * t, abs=0.02)
    a = [r for r in rows if r.source == "a"]
    assert len(a) == 2000 and len({(r.doc_id, r["pass"]) for r in a}) == 2000 and max(r.position for r in a) > 0.99
    assert max(r.position for r in a if r["pass"] == 0) < min(r.position for r in a if r["pass"] == 1)


def test_rows_tell_the_number_of_passes(spark):
    docs = spark.createDataFrame([(k, "one", "abc"[k % 3], "x") for k in range(300)], "doc_id long, text string, source string, passes string")
    rows = X.schedule(X.mix(spark, docs)).collect()
    assert {r.source: r.passes for r in rows}["a"] == 2 and all(r["pass"] < r.passes for r in rows)


def test_passes_add_up_to_what_is_taken(spark, messy):
    for r in X.mix(spark, messy).collect():
        assert sum(p.taken for p in r.passes) == r.taken and len(r.passes) <= X.CAP
        assert all(0 < p.taken <= r.size for p in r.passes)
        assert r.position == (r.passes[0].position if r.passes else None)


def test_empty_and_wordless_tables(spark, empty):
    assert X.mix(spark, empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.size, r.taken, r.target) for r in X.mix(spark, blank).collect()} == {(0, 0, 0.0)}


def test_no_python_in_the_plan(spark, messy):
    plan = X.curriculum(X.mix(spark, messy.select("doc_id", F.col("text"), "source")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
