import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from aerostar.llm import periodic_runs as P
from aerostar.llm import queries as Q

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(words, min_length=6, min_exponent=4):
    out = []
    for period in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + period < len(words):
            if words[i] != words[i + period]:
                i += 1
                continue
            end = i + period
            while end < len(words) and words[end] == words[end - period]:
                end += 1
            stretch = words[i:end]
            least = all(any(stretch[k] != stretch[k + d] for k in range(len(stretch) - d)) for d in range(1, period))
            if least and len(stretch) >= max(min_length, min_exponent * period):
                out.append((i, len(stretch), period))
            i = end - period + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w.decode() for k, w in enumerate(words) if k not in gone)


def words_of(text):
    return WORD.findall((text or "").encode())


def check(rows, data):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows), key=repr)
    want = []
    for r in data:
        w = words_of(r.text)
        runs = brute(w) if len(w) < 5000 else None
        if runs is None:
            assert len(set(w)) > 100
            runs = []
        want.append((r.doc_id is None, r.doc_id or 0, len(w), runs, collapsed(w, runs)))
    assert got == sorted(want, key=repr)


def test_against_brute_force(spark, messy):
    check(P.periodic_runs(messy).collect(), messy.collect())


def test_words_of_few_kinds(spark, make, monkeypatch):
    """Texts over two or three words hold runs of all periods, nested and
    overlapping; small chunks and groups, so that all code paths occur."""
    rng = random.Random(3)
    texts = []
    for k in range(300):
        letters = "ab" if k % 2 else "abc"
        text = " ".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        if k % 3 == 0:
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 6))]
            text += " " + " ".join(unit * rng.randint(3, 9)) + " " + text[:20]
        texts.append(text)
    texts += ["a " * 50, ("a " * 7 + "b ") * 20, "a\tb\n" * 40]
    monkeypatch.setattr(P, "CHUNK", 4)
    monkeypatch.setattr(P, "GROUP", 200)
    docs = make(texts)
    check(P.periodic_runs(docs).collect(), docs.collect())


def test_fibonacci_word():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    words = [c.encode() for c in b]
    for exponent in (2, 3):
        ids = np.array([w[0] for w in words]) - 97
        n = len(ids)
        got = P.runs_of(ids, np.full(n, n), np.zeros(n, int), 2, exponent)
        assert got == brute(words, 2, exponent)


def test_one_word_many_times(spark, make):
    n = 60_000
    row = P.periodic_runs(make(["x " * n])).first()
    assert [tuple(r) for r in row.runs] == [(0, n, 1)] and row.collapsed == "x"


def plant(doc_id, text):
    w = words_of(text)
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark, messy, tmp_path):
    texts = [r.text for r in messy.collect() if len(r.text or "") < 5000]
    rng = random.Random(1)
    data = [(k, rng.choice(texts), "en") for k in range(600)] + [(None, "a b a b a b a b", "en"), (None, None, None)]
    spark.createDataFrame(data, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for k, text, _ in data:
        w = plant(k, text)
        runs = brute(w)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        want.append((k, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs))))
    out = Q.op12_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sum(w[1] for w in want) > 10
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_bad_parameters(spark, empty):
    assert P.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(empty, min_exponent=1)
