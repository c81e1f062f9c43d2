import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose

from aerostar.llm import decontaminate as D


def lowered(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def shingles(words):
    q = min(5, len(words))
    return Counter(tuple(words[k:k + q]) for k in range(len(words) - q + 1))


def expected(docs, items):
    out = Counter()
    for d in docs:
        w, found = lowered(d.text), set()
        for i, text in items:
            n = lowered(text)
            if n:
                own = shingles(n)
                for s in range(len(w) - len(n) + 1):
                    window = shingles(w[s:s + len(n)])
                    if 4 * sum((own & window).values()) >= 3 * sum((own | window).values()):
                        found.add(i)
                        break
        out[(d.doc_id, tuple(sorted(found)))] += 1
    return out


@pytest.fixture(scope="module")
def parts(spark, make):
    rng = random.Random(11)
    items = [(k, prose(rng, n)) for k, n in enumerate((3, 5, 12, 20, 33, 50))] + [(50, None), (51, " "), (52, "twice twice " * 8)]
    items += [items[3], items[4]]
    texts = [None, "", "word"]
    for _ in range(60):
        i, text = rng.choice(items)
        w = (text or "").split()
        for _ in range(rng.randint(0, 3)):
            if w:
                w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(f"{prose(rng, rng.randint(0, 30))} {' '.join(w).upper()}\n{prose(rng, rng.randint(0, 5))}")
    return make(texts + [texts[-1]]), spark.createDataFrame(items, "item_id int, text string"), items


def got(report):
    return Counter((r.doc_id, tuple(sorted(m.item_id for m in r.matches))) for r in report.collect())


def test_against_brute_force_in_one_and_many_shards(spark, parts, monkeypatch):
    docs, bench, items = parts
    want = expected(docs.collect(), items)
    assert got(D.report(spark, docs, bench)) == want
    monkeypatch.setattr(D, "SHARD_ITEMS", 2)
    assert got(D.report(spark, docs, bench)) == want


def test_clean_keeps_the_rest_with_its_columns(spark, parts, messy):
    docs, bench, items = parts
    want = Counter(i for i, m in expected(docs.collect(), items).elements() if not m)
    out = D.clean(spark, docs, bench)
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == want
    assert D.clean(spark, messy, bench.limit(0)).count() == messy.count()


def shorter(text, item):
    """Is a text of fewer words than the item similar as a whole?"""
    w, n = lowered(text), lowered(item)
    q = min(5, len(n))
    if not q <= len(w) < len(n):
        return False
    own, other = (Counter(tuple(x[k:k + q]) for k in range(len(x) - q + 1)) for x in (w, n))
    return 4 * sum((own & other).values()) >= 3 * sum((own | other).values())


def test_documents_shorter_than_the_item(spark, make):
    """Items without their first or last words, against brute force."""
    rng = random.Random(12)
    items = [(k, prose(rng, n)) for k, n in enumerate((4, 6, 7, 8, 9, 12, 16, 20, 33, 60))] + [(10, "again and " * 9)]
    texts = ["", None]
    for _, text in items:
        w = text.split()
        for cut in range(1, len(w) // 3 + 2):
            texts += [" ".join(w[:-cut]).upper(), " ".join(w[cut:])]
        changed = w[:-1]
        changed[len(w) // 2] = "zzz"
        texts.append(" ".join(changed))
    docs, bench = make(texts), spark.createDataFrame(items, "item_id int, text string")
    rows = docs.collect()
    want = Counter((r.doc_id, tuple(i for i, t in items if shorter(r.text, t))) for r in rows)
    assert sum(bool(found) for _, found in want) > 60
    assert got(D.report(spark, docs, bench)) == want
    assert {r.doc_id for r in D.clean(spark, docs, bench).collect()} == {i for i, found in want if not found}


def test_empty_tables(spark, empty, parts):
    docs, bench, _ = parts
    assert D.report(spark, empty, bench).count() == 0
    assert not any(r.contaminated for r in D.report(spark, docs, bench.limit(0)).collect())


def test_short_texts_at_the_end_of_a_group():
    """Fewer words than a shingle has follow its last shingle; the documents
    that begin there have none."""
    item = " ".join(f"w{k}" for k in range(20))
    index = D.Index([1, 2], pa.array([item, "one two"], pa.large_string()))
    for tail in (["", "x", "x y", "one two", ""], ["a b c", None, "one two"], ["x", "x", "x", "x", "x"], ["", ""]):
        texts = [item, *tail]
        assert [[m["item_id"] for m in found] for found in D._matched(index, pa.array(texts, pa.large_string()))] == [
            [1], *([2] if t == "one two" else [] for t in tail)], tail


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        flips = rng.choice(64, size=D.RADIUS, replace=False)
        b = a
        for f in flips:
            b ^= 1 << int(f)
        assert any(((a ^ b) >> shift) & mask == 0 for shift, mask in D.BLOCKS)
    assert sum(bin(mask).count("1") for _, mask in D.BLOCKS) == 64 and len(D.BLOCKS) == D.RADIUS + 1


def test_similar_windows_are_within_the_radius():
    """At similarity 0.75 the distance stays inside the radius."""
    rng = random.Random(2)
    far = 0
    for _ in range(300):
        own = [rng.getrandbits(63) for _ in range(36)]
        other = own[:31] + [rng.getrandbits(63) for _ in range(5)]
        a, b = (D.simhash(np.array(x, dtype=np.uint64))[0] for x in (own, other))
        far = max(far, int(np.bitwise_count(a ^ b)))
    assert far <= D.RADIUS
