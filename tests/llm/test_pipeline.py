from collections import Counter

import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {"documents": None}
    root = tmp_path_factory.mktemp("stages")
    out["documents"] = docs
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def test_each_stage_against_brute_force(spark, stages):
    """All but the trained scorer, which is held against the labels."""
    from test_decontaminate import expected as leaks
    from test_minhash_dedup import expected as near
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    rows = {n: df.collect() for n, df in stages.items()}
    for n in names[:-1]:
        assert stages[n].columns == stages["documents"].columns
    ids = lambda n: {r.doc_id for r in rows[n]}

    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i in ids("documents") if i in labels and labels[i].quality == 1 and labels[i].toxic == 0]
    junk = [i for i in ids("documents") if i in labels and labels[i].quality == 0]
    assert len(set(clean) & ids(names[0])) >= 0.95 * len(clean)
    assert len(set(junk) & ids(names[0])) <= 0.2 * len(junk)

    last = {}
    for r in rows[names[0]]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert ids(names[1]) == set(last.values()) and len(rows[names[1]]) == len(last)

    stay = {i for i, n, c in near(rows[names[1]]) if i == c}
    assert ids(names[2]) == stay

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(names[3]) == {i for i, found in leaks(rows[names[2]], bench) if not found}

    assert ids(names[4]) <= ids(names[3])
    taken = Counter()
    for r in rows[names[4]]:
        taken[r.source] += r.taken
    for r in rows[names[4]]:
        assert 0 < r.taken <= 2 * r.size and abs(taken[r.source] - r.target) <= 1


def test_run_returns_the_last_stage(spark, stages):
    got = P.run(spark, SF)
    assert got.columns == stages["source_mixing"].columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in stages["source_mixing"].collect())


def test_stages_take_messy_and_empty_tables(spark, messy, empty):
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        out = stage(spark, messy, SF)
        assert set(messy.columns) <= set(out.columns), name
        out.count()
