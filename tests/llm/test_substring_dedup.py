import hashlib
import random
from collections import Counter

import numpy as np
from conftest_llm import prose

from aerostar.llm import substring_dedup as S


def expected(data):
    docs = [((r.doc_id is None, r.doc_id or 0), (r.text or "").encode().split(), r.doc_id) for r in data]
    first = {}
    for i, w, _ in docs:
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            first[k] = min(first.get(k, i), i)
    out = Counter()
    for i, w, own in docs:
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - 49):
            if first[tuple(w[s:s + 50])] < i:
                gone[s:s + 50] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[(own, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def got(spark, docs):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.remove_repeats(spark, docs).collect())


def test_against_brute_force(spark, messy):
    assert got(spark, messy) == expected(messy.collect())


def test_shared_passages_at_odd_places(spark, make):
    rng = random.Random(3)
    passage, other = prose(rng, 120), prose(rng, 70)
    texts = []
    for k in range(40):
        cut = passage.split()[rng.randint(0, 40):rng.randint(60, 120)]
        texts.append("\n".join([prose(rng, rng.randint(0, 30)), " ".join(cut), prose(rng, rng.randint(0, 9)), other * (k % 5 == 0), prose(rng, 3)]))
    texts += [" ".join(["again"] * 400), " ".join(["again"] * 90), passage, passage + " " + passage]
    docs = make(texts)
    assert got(spark, docs) == expected(docs.collect())


def test_ids_of_any_kind(spark):
    """The largest long is an id as any other, a null one comes after it; ids
    may be texts."""
    rng = random.Random(8)
    passage = prose(rng, 60)
    for ids, kind in (([2**63 - 1, None, 5], "long"), (["b", None, "a"], "string")):
        docs = spark.createDataFrame([(i, f"{prose(rng, 3)} {passage}") for i in ids], f"doc_id {kind}, text string")
        out = {r.doc_id: r.n_removed for r in S.remove_repeats(spark, docs).collect()}
        assert out == {ids[0]: 60, None: 60, ids[2]: 0}


def test_empty_table(spark, empty):
    assert S.remove_repeats(spark, empty).count() == 0
