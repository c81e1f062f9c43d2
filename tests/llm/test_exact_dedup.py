import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aerostar.llm import exact_dedup as E


def expected(data):
    groups = defaultdict(list)
    for r in data:
        groups[r.text or ""].append(r.doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i), reverse=True)):
            out[(i, keep, len(ids), k == 0)] += 1
    return out


@pytest.mark.parametrize("digest", [E.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1), lambda c: F.lit("same")])
def test_rows_against_brute_force_also_when_digests_collide(spark, messy, digest):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in E.exact_duplicates(spark, messy, digest, files_per_batch=1).collect())
    assert got == expected(messy.collect())


def test_digest_is_of_the_whole_text(spark, make):
    got = {r.doc_id: r.digest for r in E.exact_duplicates(spark, make(["x" * 100_000, None, "é"])).collect()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in enumerate(["x" * 100_000, "", "é"])}


def test_distinct_rows_keep_columns_and_one_of_each_text(spark, messy):
    out = E.distinct_rows(spark, messy)
    assert out.columns == messy.columns
    got = out.collect()
    assert Counter(r.text or "" for r in got) == Counter({r.text or "" for r in messy.collect()})


def test_empty_table(spark, empty):
    assert E.exact_duplicates(spark, empty).count() == 0
    assert E.distinct_rows(spark, empty).columns == empty.columns


def test_state_goes_on_over_batches(spark, messy, scratch):
    rows = E.located(spark, messy)
    prints = rows.select(E.sha256(F.coalesce("given.text", F.lit(""))).alias("__digest"), F.col("given.doc_id").alias("__id"), "__file", "__row").repartition(4)
    from aerostar.llm.staging import staged
    prints = staged(spark, prints, "test-prints")
    state = E.fold(spark, prints, f"{scratch}/state", files_per_batch=1)
    assert state.agg(F.sum("n")).first()[0] == messy.count()
    again = E.fold(spark, prints, f"{scratch}/state", files_per_batch=1)  # nothing new: the state is unchanged
    assert again.agg(F.sum("n")).first()[0] == messy.count()
