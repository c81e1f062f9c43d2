import random
import re
from collections import Counter

from conftest_llm import prose

from aerostar.llm import minhash_dedup as M


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(data):
    sets, root = [shingle_set(r.text) for r in data], list(range(len(data)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(data):
        if r.doc_id is not None:
            least[find(k)] = min(least.get(find(k), r.doc_id), r.doc_id)
    return Counter((r.doc_id, len(sets[k]), least.get(find(k)) if sets[k] else r.doc_id) for k, r in enumerate(data))


def got(spark, docs):
    rows = M.near_duplicates(spark, docs).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_against_brute_force(spark, messy):
    assert got(spark, messy) == expected(messy.collect())


def test_groups_of_near_copies_without_a_common_pivot(spark, make, monkeypatch):
    """Edited copies of two texts at similarities around the threshold; tiny
    blocks, so that every kind of block pair occurs."""
    monkeypatch.setattr(M, "BLOCK", 8)
    rng = random.Random(5)
    texts = []
    for base in (prose(rng, 100).split(), prose(rng, 60).split()):
        for _ in range(60):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w))
    rng.shuffle(texts)
    docs = make(texts)
    assert got(spark, docs) == expected(docs.collect())


def test_distinct_rows_keep_one_of_each_component(spark, messy):
    out = M.distinct_rows(spark, messy)
    assert out.columns == messy.columns
    kept = [shingle_set(r.text) for r in out.collect() if shingle_set(r.text)]
    near = lambda x, y: 100 * len(x & y) >= 75 * len(x | y)
    assert not any(near(x, y) for k, x in enumerate(kept) for y in kept[:k])
    assert all(any(near(shingle_set(r.text), x) for x in kept) for r in messy.collect() if shingle_set(r.text))
    assert sum(not shingle_set(r.text) for r in out.collect()) == sum(not shingle_set(r.text) for r in messy.collect())


def test_empty_table(spark, empty):
    assert M.near_duplicates(spark, empty).count() == 0
    assert M.distinct_rows(spark, empty).count() == 0
