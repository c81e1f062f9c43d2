from collections import Counter

import numpy as np
import pytest

from aerostar.llm import subspace_join as S

KIND = "vec_id long, embedding array<float>, label int, node long, vec string, n_links long, core int, links long"


def brute(rows):
    n = len(rows)
    good = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    x = [np.array(v, dtype=np.float32).astype(np.float64) if g else None for (_, v), g in zip(rows, good)]
    linked = [[a != b and good[a] and good[b] and len(x[a]) == len(x[b])
               and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= 0.9 for b in range(n)] for a in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[a], *(root[b] for b in range(n) if linked[a][b])]) for a in range(n)]
        if new == root:
            break
        root = new
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    return Counter((i, sum(linked[k]), least.get(root[k]) if good[k] else i) for k, (i, _) in enumerate(rows))


def check(spark, rows):
    data = [(i, v if v is None else [None if x is None else float(x) for x in v], 1, 7, "v", 5, 0, 9) for i, v in rows]
    out = S.near_vectors(spark, spark.createDataFrame(data, KIND).repartition(3))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = out.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def clustered(rng, dims, n, scale, centres=6):
    c = rng.normal(size=(centres, dims))
    return [list(c[k % centres] + scale * rng.normal(size=dims)) for k in range(n)]


@pytest.mark.parametrize("dims,scale,width", [(64, 0.2, 16), (20, 0.35, 8), (3, 0.4, 1), (1, 0.1, 16)])
def test_against_brute_force(spark, monkeypatch, dims, scale, width):
    """Spreads around the threshold; few pivots and tiny blocks, so that cores,
    probes of other cores, cells and chains of links all occur."""
    rng = np.random.default_rng(dims)
    vectors = clustered(rng, dims, 150, scale) + clustered(rng, dims, 60, scale / 4)
    vectors += [vectors[0], vectors[0], list(np.array(vectors[1]) * 3)]
    for pivots, chunk in ((4, 7), (512, 16384)):
        for name, value in (("PIVOTS", pivots), ("CHUNK", chunk), ("WIDTH", width), ("SIDE", 16)):
            monkeypatch.setattr(S, name, value)
        check(spark, list(enumerate(vectors)))


def test_without_cores_the_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(S, "PIVOTS", 1)
    monkeypatch.setattr(S, "WIDTH", 4)
    rng = np.random.default_rng(9)
    vectors = clustered(rng, 16, 200, 0.25, centres=10)
    check(spark, list(enumerate(vectors)))


def test_unusable_repeated_and_ragged(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v), (1, v), (None, v), (4, [2.0, 4.0, 6.0, 8.0]), (5, None), (6, []), (7, [0.0] * 4), (8, [float("nan"), 1.0, 1.0, 1.0]),
            (9, [None, 1.0, 1.0, 1.0]), (10, [float("inf")] * 4), (11, [1.0, 2.0, 3.0, 4.0, 0.0]), (None, [-1.0, 0.0, 0.0, 0.0]),
            (13, [1e30, 2e30, 3e30, 4e30]), (None, None), (15, [1e-40, 2e-40, 3e-40, 4e-40])]
    check(spark, rows)


def test_empty_table(spark):
    assert S.near_vectors(spark, spark.createDataFrame([], KIND)).count() == 0


def test_a_part_of_the_nodes_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 8)
    monkeypatch.setattr(S, "PIVOTS", 4)
    rng = np.random.default_rng(4)
    check(spark, list(enumerate(clustered(rng, 12, 150, 0.2))))
