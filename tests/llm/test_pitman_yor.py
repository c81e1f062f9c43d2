import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose

from aerostar.llm import pitman_yor as P

END = b"\n"


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [END]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


@pytest.fixture(scope="module")
def two_tongues(spark):
    """Documents of two languages: what follows a word depends on it."""
    rng = random.Random(9)
    tongue = [[p + prose(rng, 1) for _ in range(120)] for p in ("ka", "zu")]
    rows = []
    for k in range(500):
        own = tongue[k % 2]
        rows.append((k, " ".join(own[min(119, int(rng.expovariate(0.05)))] if rng.random() < 0.97 else prose(rng, 1) for _ in range(60)), "x", "y"))
    rows += [(None, "Ka zu", None, None), (600, None, "a", "b"), (601, "", "a", "b"), rows[3], rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, uid string").repartition(3)


def test_counts_and_base_against_brute_force(spark, two_tongues, monkeypatch):
    monkeypatch.setattr(P, "HEAD", 64)  # most words go through the join
    rows = two_tongues.collect()
    c = Counter(t for r in rows if not held_out(r.doc_id) for t in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = sorted((str(r.doc_id), held_out(r.doc_id), len(tokens(r.text)), sum(c[t] > 0 for t in tokens(r.text)), n,
                   round(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r.text)), 6)) for r in rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                 for r in P.score(spark, two_tongues).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=1e-5)


def test_context_helps_on_held_out_documents(spark, two_tongues):
    rows = [r for r in P.score(spark, two_tongues).collect() if r.held_out and r.n_tokens > 5]
    own, base = (sum(x) / sum(r.n_tokens for r in rows) for x in ([r.score for r in rows], [r.base_score for r in rows]))
    assert own > base + 0.1  # 10 to this power: perplexity falls by more than a fifth
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_reruns_agree_and_empty_table(spark, two_tongues):
    first, second = ({(str(r.doc_id), round(r.score, 9)) for r in P.score(spark, two_tongues).collect()} for _ in range(2))
    assert first == second
    assert P.score(spark, two_tongues.limit(0)).count() == 0


def halves(customers, base, others, discount, random):
    """A rule in place of chance: a table for every two customers."""
    return np.ceil(customers / 2)


def brute_scores(rows):
    """The model in one process, dictionaries for restaurants, tables by ``halves``."""
    d1, d2, d3 = P.DISCOUNTS
    theta = P.STRENGTH
    c3, n = Counter(), Counter()
    for r in rows:
        t = tokens(r.text)
        if not held_out(r.doc_id):
            n.update(t)
            c3.update((t[i - 2] if i > 1 else None, t[i - 1] if i else None, t[i]) for i in range(len(t)))
    half = lambda c: math.ceil(c / 2)
    t3 = {k: half(c) for k, c in c3.items()}
    c2 = Counter()
    for (_, v, w), t in t3.items():
        c2[v, w] += t
    t2 = {k: half(c) for k, c in c2.items()}
    base = 1 / (len(n) + 1)
    tables, total1 = sum(map(half, n.values())), sum(n.values())
    total3, tables3, total2, tables2 = Counter(), Counter(), Counter(), Counter()
    for (u, v, w), c in c3.items():
        total3[u, v] += c
        tables3[u, v] += t3[u, v, w]
    for (v, w), c in c2.items():
        total2[v] += c
        tables2[v] += t2[v, w]

    def p(u, v, w):
        p1 = (n[w] - d1 * half(n[w]) + (theta + d1 * tables) * base) / (theta + total1)
        p2 = (c2[v, w] - d2 * t2.get((v, w), 0) + (theta + d2 * tables2[v]) * p1) / (theta + total2[v])
        return (c3[u, v, w] - d3 * t3.get((u, v, w), 0) + (theta + d3 * tables3[u, v]) * p2) / (theta + total3[u, v])

    out = []
    for r in rows:
        t = tokens(r.text)
        out.append((str(r.doc_id), len(t), sum(math.log10(p(t[i - 2] if i > 1 else None, t[i - 1] if i else None, t[i])) for i in range(len(t)))))
    return sorted(out)


def test_scores_against_one_process(spark, two_tongues, messy, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 500)
    for docs in (two_tongues, messy):
        rows = docs.collect()
        want = brute_scores(rows)
        for size in (64, 1 << 17):
            monkeypatch.setattr(P, "HEAD", size)
            got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in P.score(spark, docs, seating=lambda c, b, o, d, r: np.ceil(c / 2)).collect())
            assert [g[:2] for g in got] == [w[:2] for w in want]
            assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)  # sums travel as 32-bit floats


def test_scores_do_not_depend_on_the_limit(spark, two_tongues, messy, monkeypatch):
    """Restaurants that lie in several buckets are still one: scores are those of
    one process where almost every word is beyond ``LIMIT`` (some beyond ``WIDE``
    times that), and where few are."""
    monkeypatch.setattr(P, "CHUNK", 5000)
    for docs, limits in ((two_tongues, (4, 300)), (messy, (2,))):
        want = brute_scores(docs.collect())
        for limit in limits:
            monkeypatch.setattr(P, "LIMIT", limit)
            got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in P.score(spark, docs, seating=lambda c, b, o, d, r: np.ceil(c / 2)).collect())
            assert [g[:2] for g in got] == [w[:2] for w in want]
            assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)


def test_drawn_scores_hardly_depend_on_the_limit(spark, two_tongues, monkeypatch):
    """Seated by chance, the draws differ and their law does not."""
    mean = []
    for limit in (1 << 18, 20):
        monkeypatch.setattr(P, "LIMIT", limit)
        rows = [r for r in P.score(spark, two_tongues).collect() if r.held_out]
        mean.append(sum(r.score for r in rows) / sum(r.n_tokens for r in rows))
    assert mean[1] == pytest.approx(mean[0], abs=0.01)


def test_probabilities_of_all_words_sum_to_one():
    """Over the training words and one unknown one, in seen and unseen contexts."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 40, 3000)
    n = np.bincount(words, minlength=40).astype(float)

    class Rows:
        pass
    b = Rows()
    u, v = np.r_[0, 0, words[:-2]], np.r_[0, words[:-1]]
    every = np.array([(a, c, w) for a in range(40) for c in range(5) for w in range(40)])
    seen = {tuple(x): 0 for x in every.tolist()}
    for x in zip(u.tolist(), v.tolist(), words.tolist()):
        if x in seen:
            seen[x] += 1
    b.customers = np.array([seen[tuple(x)] for x in every.tolist()], dtype=float)
    _, b.context = np.unique(every[:, 0] * 40 + every[:, 1], return_inverse=True)
    pairs, b.above = np.unique(every[:, 1] * 40 + every[:, 2], return_inverse=True)
    b.word2 = pairs % 40
    _, b.context2 = np.unique(pairs // 40, return_inverse=True)
    root = P.Root(n, [], P.seat)
    assert root.head.sum() + root.unknown == pytest.approx(1)
    grouped = P.Root(n[:30], [(c, k) for c, k in Counter(n[30:].tolist()).items()], P.seat)
    assert grouped.head.sum() + sum(grouped.by_count[int(c)] for c in n[30:]) + grouped.unknown == pytest.approx(1)
    for alpha, beta in P.sweeps(b, root.head[b.word2], P.seat, 3):
        p = alpha + beta * root.head[every[:, 2]]
        unknown = beta * root.unknown
        sums = np.bincount(b.context, p) + np.bincount(b.context, unknown) / np.bincount(b.context)
        assert sums == pytest.approx(np.ones(len(sums)))


def test_seating_follows_the_restaurant_process():
    """Mean number of tables of one dish with all base mass: the exact mean
    solves E[t+1] = E[t] + (theta + d E[t]) / (theta + n)."""
    rng = np.random.default_rng(6)
    n, d, mean = 200, 0.75, 0.0
    for k in range(n):
        mean += (P.STRENGTH + d * mean) / (P.STRENGTH + k)
    got = np.mean([P.seat(np.array([float(n)]), np.array([1.0]), np.array([0.0]), d, rng)[0] for _ in range(3000)])
    assert got == pytest.approx(mean, rel=0.05)


def test_hot_words_are_dealt_to_many_buckets():
    """A third of all tokens follow one word, and one pair of words: no bucket
    takes them all; whole contexts stay together while they are small."""
    rng = np.random.default_rng(2)
    n = 90_000
    vocabulary = P.Vocabulary(np.arange(10, dtype=np.uint64), np.array([n // 3] + [10] * 9))
    shape = P.Shape(vocabulary, np.zeros(10), 100, 40, 1000)
    v = np.where(np.arange(n) % 3 == 0, 0, -rng.integers(1, 1000, n))  # negative: not frequent
    u = np.where(np.arange(n) % 2 == 0, 7, rng.integers(0, 1000, n))
    mark = rng.integers(0, 1 << 60, n)
    monkey = P.WIDE
    try:
        P.WIDE = 4
        bucket = P.deal(shape, v.astype(np.int64), u.astype(np.int64), mark)
    finally:
        P.WIDE = monkey
    assert np.bincount(bucket, minlength=40).max() < n / 6
    few = v < 0
    assert len(np.unique(np.stack([v[few], bucket[few]]), axis=1).T) == len(np.unique(v[few]))


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(-2**62, 2**62, 50), rng.integers(0, 9, 50).astype(np.uint32), np.arange(50).astype(np.uint8)]
    assert all((a == b).all() for a, b in zip(arrays, P._unpack(P._pack(arrays), [np.int64, np.uint32, np.uint8])))
