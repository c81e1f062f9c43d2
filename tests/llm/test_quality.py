import random

import numpy as np
import pytest
from conftest_llm import prose

from aerostar.llm import quality as Q


@pytest.fixture(scope="module")
def corpus(spark):
    """Good prose, four kinds of junk, and prose with marked words; labels for
    a part of it. Returns (docs, labels, truth)."""
    rng = random.Random(3)
    rows, truth = [], {}
    for k in range(900):
        words = prose(rng, rng.randint(40, 120)).split()
        kind = k % 12
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        elif kind == 2:
            words = " | ".join(words).split()
        elif kind == 3:
            words = [w + "$$$" for w in words]
        elif kind == 4:
            words = [w for w in words[:6] for _ in range(20)]
        elif kind in (5, 6):
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum"]) if kind == 5 else "qzvkt" + prose(rng, 1)
        truth[k] = kind not in (1, 2, 3, 4, 5, 6)
        rows.append((k, " ".join(words), "a", "b", "c"))
    rows += [(900, None, None, None, None), (901, "", "x", "y", None), (None, prose(rng, 60), "x", "y", "z"), rows[0], rows[0]]
    labels = [(k, 0 if k % 12 in (1, 2, 3, 4) else 1, 1 if k % 12 in (5, 6) else 0) for k in range(900) if k % 7 < 3]
    labels += [labels[0], (None, 1, 0), (5000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, vote string, pattern string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_held_out_accuracy(spark, corpus):
    docs, labels, truth = corpus
    known = {r.doc_id for r in labels.collect()}
    got = [r for r in Q.score(spark, docs, labels).collect()]
    assert len(got) == docs.count()
    held = [r for r in got if r.doc_id in truth and r.doc_id not in known]
    clean = [r.accepted for r in held if truth[r.doc_id]]
    bad = [r.accepted for r in held if not truth[r.doc_id]]
    assert sum(clean) / len(clean) > 0.97 and sum(bad) / len(bad) < 0.06
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_accept_keeps_columns_and_agrees_with_score(spark, corpus):
    docs, labels, _ = corpus
    out = Q.accept(spark, docs, labels)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in Q.score(spark, docs, labels).where("accepted").collect())


def test_without_labels_and_without_rows(spark, corpus):
    docs, labels, truth = corpus
    got = {r.doc_id: r.accepted for r in Q.score(spark, docs, labels.limit(0)).collect()}
    assert np.mean([got[k] for k in truth if k % 12 in (0, 7, 8, 9, 10, 11)]) > 0.9
    assert np.mean([got[k] for k in truth if k % 12 in (1, 2, 3, 4)]) < 0.2
    assert Q.score(spark, docs.limit(0), labels).count() == 0
    assert Q.accept(spark, docs.limit(0), labels.limit(0)).count() == 0


def test_estimate_recovers_accuracies_and_shares():
    """Votes drawn with known accuracies from classes of known shares."""
    rng = np.random.default_rng(4)
    kind = rng.choice(3, p=(0.7, 0.2, 0.1), size=60_000)
    fits, vote = Q._vindicates(), np.zeros((len(kind), len(Q.LABELLERS)), int)
    right = np.full(len(Q.LABELLERS), 0.95)
    for j, name in enumerate(Q.LABELLERS):
        claim = Q.GOOD if name == "prose" else Q.TOXIC if name in ("word list", "mined terms") else Q.JUNK
        true = fits[kind, j, claim] > 0
        vote[:, j] = np.where(rng.random(len(kind)) < np.where(true, 0.8, 0.002), claim, 0)
        right[j] = (true & (vote[:, j] > 0)).sum() / (vote[:, j] > 0).sum()
    vote[:, -1] = np.where(rng.random(len(kind)) < 0.3, kind + 1, 0)
    right[-1] = 1
    patterns, back, counts = np.unique(Q.code(vote), return_inverse=True, return_counts=True)
    accuracy, share, posterior = Q.estimate(patterns, counts)
    assert np.abs(accuracy - right).max() < 0.03 and np.abs(share - (0.7, 0.2, 0.1)).max() < 0.02
    assert ((posterior[back] > 0.5) == (kind == 0)).mean() > 0.98
    assert (Q.decode(Q.code(vote)[:50]) == vote[:50]).all()


def test_toxic_words_of_a_rare_language(spark):
    """A word in 18 of 5,000 documents, all toxic ones of a language of 200:
    learnt from 12 labelled ones, whatever the other language's toxic words."""
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(5000):
        words, lang = prose(rng, rng.randint(30, 60)).split(), "fr" if k % 25 == 0 else "en"
        if lang == "fr":
            words = ["é" + w for w in words]
            toxic = k < 25 * 18
            words[7:7] = ["réeuxvi"] * toxic
        else:
            toxic = k % 10 == 1
            words[3:3] = [rng.choice(["qzvkt", "xwvut", "zyxwq"])] * toxic
        rows.append((k, " ".join(words), lang))
        if k % 3:
            labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r.accepted for r in Q.score(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [got[k] for k in range(0, 25 * 18, 75)]
    assert len(held) == 6 and not any(held)
    assert np.mean([got[k] for k in range(25 * 18, 5000, 25)]) > 0.95


def test_strata_are_shared_out_evenly():
    assert Q.rates(np.array([5, 7]), 100).tolist() == [1, 1]
    sizes = np.array([1000, 10, 500, 90])
    assert (Q.rates(sizes, 300) * sizes).tolist() == pytest.approx([100, 10, 100, 90])
    assert Q.rates(np.array([0, 40]), 10).tolist() == [1, 0.25]
