"""Quality classifier from weak labels.

Heuristic labellers say of every document that its form is good, that it is junk,
that it is toxic, or nothing; human labels, where there are any, are one more
labeller. Expectation-maximisation over the counts of vote patterns (at most 4 to
the number of labellers, whatever the corpus) estimates each labeller's accuracy
and so a posterior over the classes good, junk and toxic for every pattern. (Junk
and toxic documents look so unlike that labellers would not be independent
within one class of both.) The posteriors of a sample train a linear scorer over hashed
features, which alone judges the documents, all of them and whole.

Bounds, as parameters: ``MINE_ROWS`` labelled documents to mine terms that
mark toxic ones, ``MINED_TERMS`` of them at most, ``TRAIN_ROWS`` documents to
train on. Both samples are shared out evenly among the classes of each language
(column ``lang``, where there is one; languages fall into ``LANGS`` groups), so
rare ones are held whole, and what a stratum is short of its share in the corpus
is made up for: by weight in a mined term's purity, by an offset to the margin in
training. Terms are mined, and vote, within a language. A feature needs
``FEATURE_LEAST`` documents, whatever the size of the sample. Samples are taken
by hash, so reruns agree. Votes, pattern counts and scores cover every document.

Toxicity is learnt from the labels and the terms mined with them. A caller's list
of toxic words (``words``) is a labeller of its own; none is built in.

Cases: null or empty text scores as a document without features (the bias and
the share of such texts decide); null ids take part; without any labels no
terms are mined and the other labellers decide (on toxicity only a given list); repeated rows come back
repeated; empty table: no rows. ``accept`` returns the input's own columns,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .staging import staged

MINE_ROWS, MINED_TERMS, TRAIN_ROWS = 10_000, 4_096, 8_000
MINED_LEAST, MINED_PURITY = 8, 0.98  # documents, share of toxic ones among a term's
MINED_CHANCE = 1e-6  # that a term's documents are all toxic ones by the draw alone
LANGS = 64
EPOCHS, RATE, SHRINK = 40, 0.3, 5e-4
FEATURE_LEAST = 4  # documents of the training sample
BATCH, THRESHOLD = 256, 0.5
GOOD, JUNK, TOXIC = 1, 2, 3  # votes, and classes from 0; 0 abstains
CLASSES = VOTES = 3

LABELLERS = ("shouting", "capitals", "table", "symbols", "few distinct words", "stuttering", "word list", "mined terms", "prose", "labels")
#: What estimation starts from: each labeller's accuracy, the classes' shares.
FIRST_ACCURACY, FIRST_SHARES = 0.9, (0.8, 0.1, 0.1)
#: Human labels are a fixed point; all labellers are better than chance by a factor.
LABEL_ACCURACY, BETTER = 0.98, 4

_PREFIXES = (4, 5)
_KIND = W.stream(11, 16)
_TONGUE = W.stream(12, LANGS)
_UPPER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_MARK[[ord(c) for c in "%$#&*@^~=<>"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _sum(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive cuts."""
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[cuts[1:]] - total[cuts[:-1]]).astype(np.float64)


def shares(w: W.Words) -> dict[str, np.ndarray]:
    """Shares per document on which the labellers judge."""
    n = np.diff(w.docs)
    words = np.maximum(n, 1)
    last, before = w.data[w.ends - 1], w.data[np.maximum(w.ends - 2, 0)]
    length = w.ends - w.starts
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    first = w.docs[:-1][n > 0]
    same[first] = False
    byte = np.concatenate([[0], np.cumsum(_UPPER[w.data])]), np.concatenate([[0], np.cumsum(_LETTER[w.data])])
    upper, letter = (x[w.ends] - x[w.starts] for x in byte)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((w.hash, doc))
    new = np.ones(len(order), bool)
    new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(n)) if len(doc) else np.zeros(len(n))
    return {
        "words": n,
        "shouting": _sum((last == 33) & (before == 33) & (length > 2), w.docs) / words,
        "capitals": _sum(upper, w.docs) / np.maximum(_sum(letter, w.docs), 1),
        "table": _sum((last == 124) & (length == 1), w.docs) / words,
        "symbols": _sum(_MARK[last] & _MARK[before] & (length > 2), w.docs) / words,
        "distinct": np.where(n > 0, distinct / words, 1.0),
        "stutter": _sum(same, w.docs) / words,
        "length": _sum(length, w.docs) / words,
    }


def terms(w: W.Words) -> list[np.ndarray]:
    """Hashed terms of each word place: the word and its first letters, with
    A-Z lower-cased and outer marks kept."""
    ends = [w.ends] + [np.minimum(w.starts + k, w.ends) for k in _PREFIXES]
    return [W.mix(h ^ seed) for h, seed in zip(W.spans(w.data, w.starts, ends, lower=True), _KIND)]


def listed(words: Sequence[str]) -> np.ndarray:
    """Terms of a caller's list of toxic words."""
    text = " ".join(words).encode()
    return terms(W.split(np.frombuffer(text, np.uint8), np.array([0, len(text)])))[0] if text else np.zeros(0, np.uint64)


def spoken(terms: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Terms as terms of a language."""
    return W.mix(terms ^ _TONGUE[lang])


def votes(w: W.Words, mined: np.ndarray, named: list[np.ndarray], lang: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """(documents, labellers but the last): the votes of the heuristics."""
    s, n = shares(w), np.diff(w.docs)
    bad = lambda x, vote=JUNK: np.where(x, vote, 0)
    has = lambda keys, lists: np.any([_sum(np.isin(t, keys), w.docs) > 0 for t in lists], axis=0)
    junk = (s["shouting"] > .1) | (s["table"] > .1) | (s["symbols"] > .1) | (s["capitals"] > .4)
    prose = (n > 0) & ~junk & (s["distinct"] > .4) & (s["stutter"] < .1) & (s["length"] > 2) & (s["length"] < 14)
    return np.stack([
        bad(s["shouting"] > .15), bad(s["capitals"] > .4), bad(s["table"] > .15), bad(s["symbols"] > .15),
        bad((s["distinct"] < .35) & (n >= 30)), bad(s["stutter"] > .3), bad(has(toxic, named[:1]), TOXIC) if len(toxic) else np.zeros(len(n), int),
        bad(has(mined, [spoken(t, np.repeat(lang, n)) for t in named]), TOXIC) if len(mined) else np.zeros(len(n), int), np.where(prose, GOOD, 0),
    ], axis=1)


def features(w: W.Words, named: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hashed to 32 bits) of every place and of every
    share's level."""
    doc = np.repeat(np.arange(len(w.docs) - 1), np.diff(w.docs))
    docs, found = [doc] * len(named), list(named)
    s = shares(w)
    for seed, name in zip(_KIND[8:], ("shouting", "capitals", "table", "symbols", "distinct", "stutter")):
        with np.errstate(over="ignore"):
            level = np.floor(s[name] * 10).astype(np.uint64)
            found.append(W.mix(seed + level))
        docs.append(np.arange(len(level)))
    return np.concatenate(docs), (np.concatenate(found) >> W.U(32)).astype(np.uint32)


def code(vote: np.ndarray) -> np.ndarray:
    """Votes as one number to the base of 4."""
    return (vote * 4 ** np.arange(vote.shape[1])).sum(axis=1).astype(np.int64)


def decode(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 4 ** np.arange(len(LABELLERS)) % 4


def _vindicates() -> np.ndarray:
    """(classes, labellers, votes): is the vote right about the class? Prose
    speaks of the form, which toxic documents have too."""
    out = np.zeros((CLASSES, len(LABELLERS), VOTES + 1))
    for c in range(CLASSES):
        out[c, :, c + 1] = 1
    out[TOXIC - 1, LABELLERS.index("prose"), GOOD] = 1
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(accuracies, shares of the classes, posterior of good by pattern)."""
    accuracy, share, posterior = classes(patterns, counts, rounds)
    return accuracy, share, posterior[:, GOOD - 1]


def classes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(accuracies, shares of the classes, posterior of each class by pattern).

    Each labeller has a chance of every vote, abstaining included, in each
    class: a labeller that is seldom silent on good documents says something by
    its silence. The chances start from votes that are right with
    FIRST_ACCURACY, one pseudo count in a hundred documents holds them there a
    little, and a vote is at most a BETTER-th as likely in a class about which
    it is wrong, so the classes cannot be swapped. Those of the human labels stay at LABEL_ACCURACY. A
    labeller's accuracy is the share of right ones among its votes."""
    total = max(counts.sum(), 1)
    says = np.stack([decode(patterns) == v for v in range(VOTES + 1)], axis=2).astype(float)  # (patterns, labellers, votes)
    share, fits = np.einsum("p,pjv->jv", counts, says) / total, _vindicates()
    right = np.full((1, len(LABELLERS), 1), FIRST_ACCURACY)
    right[0, -1] = LABEL_ACCURACY
    prior = np.array(FIRST_SHARES)
    of = np.einsum("c,cjv->jv", prior, fits)  # share of the documents of which a vote is right
    odds = np.where(fits > 0, right / np.maximum(of, 1e-9), (1 - right) / np.maximum(1 - of, 1e-9))
    odds[:, :, 0] = 1
    first = share * odds + 1e-4
    first /= first.sum(axis=2, keepdims=True)
    chance, weight = first, total / 100
    for _ in range(rounds):
        log = np.einsum("pjv,cjv->pc", says, np.log(chance)) + np.log(prior)
        posterior = np.exp(log - log.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        held = counts[:, None] * posterior
        new = np.einsum("pc,pjv->cjv", held, says) + weight * first
        new /= new.sum(axis=2, keepdims=True)
        most = (new * fits).max(axis=0) / BETTER
        new[:, :, 1:] = np.where(fits > 0, new, np.minimum(new, most))[:, :, 1:]
        new[:, :, 0] = 1 - new[:, :, 1:].sum(axis=2)
        new[:, -1] = first[:, -1]
        prior = np.clip(held.sum(axis=0) / total, 1e-3, 1)
        moved, chance = np.abs(new - chance).max(), new
        if moved < 1e-9:
            break
    agree = np.einsum("pc,pjv,cjv->j", held, says, fits)
    cast = np.einsum("p,pjv->j", counts, says[:, :, 1:])
    return (agree + FIRST_ACCURACY) / (cast + 1), prior, posterior


def train(cuts: np.ndarray, column: np.ndarray, width: int, good: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, bias) of a logistic scorer with adaptive steps and shrinkage
    to zero. Document i has the features ``column[cuts[i]:cuts[i + 1]]`` of
    width; its offset is part of the margin here and not of the scorer."""
    n = len(good)
    weight, past, bias, bias_past = np.zeros(width), np.full(width, 1e-8), 0.0, 1e-8
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        shuffled = order.permutation(n)
        lengths = (cuts[1:] - cuts[:-1])[shuffled]
        ends = np.cumsum(lengths)
        at = np.concatenate([column[cuts[k]:cuts[k + 1]] for k in shuffled])
        for a in range(0, n, BATCH):
            b = min(n, a + BATCH)
            low, high = ends[a] - lengths[a], ends[b - 1]
            used, own = at[low:high], np.repeat(np.arange(b - a), lengths[a:b])
            margin = bias + offset[shuffled[a:b]] + np.bincount(own, weight[used], minlength=b - a)
            miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - good[shuffled[a:b]]
            slope = np.bincount(used, miss[own], minlength=width) / (b - a)
            past += slope * slope
            step = np.where(slope != 0, RATE / np.sqrt(past), 0.0)
            weight -= step * slope
            weight = np.sign(weight) * np.maximum(np.abs(weight) - step * SHRINK, 0)
            bias_past += miss.mean() ** 2
            bias -= RATE * miss.mean() / np.sqrt(bias_past)
    return weight, float(bias)


class Scorer:
    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def __call__(self, w: W.Words) -> np.ndarray:
        """Probability that each document is good; a feature counts once."""
        n = len(w.docs) - 1
        doc, found = features(w, terms(w))
        margin = np.full(n, self.bias)
        if len(self.keys):
            slot = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            hit = self.keys[slot] == found
            once = np.unique(doc[hit] * len(self.keys) + slot[hit])
            margin += np.bincount(once // len(self.keys), self.weights[once % len(self.keys)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _lang(docs: DataFrame) -> F.Column:
    """Group of the language, 0 to LANGS - 1."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return F.pmod(F.xxhash64(lang), F.lit(LANGS)).cast("int")


def rates(sizes: np.ndarray, most: int) -> np.ndarray:
    """Share to draw of each stratum: about ``most`` rows in all, at one level
    that small strata do not reach."""
    left, level = most, np.inf
    for k, size in enumerate(sorted(sizes.tolist())):
        level = left / (len(sizes) - k)
        if size > level:
            break
        left, level = left - size, np.inf
    return np.minimum(1.0, level / np.maximum(sizes, 1))


def _drawn(rows: DataFrame, by: list[str], share: dict, *key: str) -> DataFrame:
    """The rows that a hash of the key draws at the share of their stratum;
    share: (values of by) -> share, a bounded number of them."""
    table = rows.sparkSession.createDataFrame([(*map(int, k), int(v * (1 << 30))) for k, v in share.items()], ", ".join(f"{c} long" for c in by) + ", __most long")
    return rows.join(F.broadcast(table), by).where(F.pmod(F.xxhash64(*key, F.lit(17)), F.lit(1 << 30)) < F.col("__most")).drop("__most")


def mine(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Terms that mark toxic documents of a language, from a sample of labelled
    ones."""
    tongues = docs.select("doc_id", _lang(docs).alias("lang")).join(labels.select("doc_id", "bad_words"), "doc_id").distinct()
    tongues = staged(docs.sparkSession, tongues, "quality-langs")
    strata = tongues.groupBy("bad_words", "lang").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 LANGS rows
    if not strata:
        return np.zeros(0, np.uint64)
    share = dict(zip([(r.bad_words, r.lang) for r in strata], rates(np.array([r.n for r in strata]), MINE_ROWS).tolist()))
    known = _drawn(tongues, ["bad_words", "lang"], share, "doc_id")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, w in W.batches(batch["text"], lower=True):
                parts = [w.hash[a:b] for a, b in zip(w.docs, w.docs[1:])]
                least = [int(W.grams(h, min(5, len(h))).min()) if len(h) else 0 for h in parts]
                yield pa.record_batch([batch["text"].slice(i, j - i), batch["bad_words"].slice(i, j - i), batch["lang"].slice(i, j - i),
                                       pa.array(W.signed(np.array(least, dtype=np.uint64)))], names=["text", "bad_words", "lang", "phrase"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, lang = (batch[c].to_numpy(zero_copy_only=False) for c in ("bad_words", "lang"))
            for i, j, w in W.batches(batch["text"]):
                doc = np.repeat(np.arange(j - i), np.diff(w.docs))
                for t in terms(w):
                    pair = np.unique(np.stack([doc.astype(np.uint64), spoken(t, lang[i:j][doc])], axis=1), axis=0)
                    term, first, inverse = np.unique(pair[:, 1], return_index=True, return_inverse=True)
                    of = pair[:, 0].astype(np.int64)
                    yield pa.record_batch([pa.array(W.signed(term)), pa.array(lang[i:j][of[first]].astype(np.int32)),
                                           pa.array(np.bincount(inverse, toxic[i:j][of]).astype(np.int64)),
                                           pa.array(np.bincount(inverse).astype(np.int64))], names=["term", "lang", "toxic", "n"])

    sample = (docs.select("doc_id", "text", _lang(docs).alias("lang")).join(F.broadcast(known), ["doc_id", "lang"])  # MINE_ROWS ids
              .select("text", F.col("bad_words").cast("int").alias("bad_words"), "lang"))
    # copies would make any of their words look typical: of texts that share
    # their least 5-word phrase, one counts
    sample = sample.mapInArrow(keyed, "text string, bad_words int, lang int, phrase long").dropDuplicates(["phrase"])
    sample = staged(docs.sparkSession, sample.drop("phrase"), "quality-mine")
    held = sample.groupBy("lang").agg(F.sum("bad_words").alias("toxic"), F.count(F.lit(1)).alias("n")).where("toxic > 0").collect()
    if not held:
        return np.zeros(0, np.uint64)
    needs = [(r.lang, float(max(MINED_LEAST, np.log(MINED_CHANCE) / np.log(min(r.toxic / r.n, 1 - 1e-9)))),
              share.get((1, r.lang), 1.0) / share.get((0, r.lang), 1.0)) for r in held]  # a clean document stands for this many toxic ones
    needs = F.broadcast(docs.sparkSession.createDataFrame(needs, "lang int, least double, clean double"))
    counts = sample.mapInArrow(spread, "term long, lang int, toxic long, n long").groupBy("term", "lang").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    pure = (counts.where(F.col("toxic") >= MINED_LEAST).join(needs, "lang")
            .where((F.col("toxic") >= F.col("least")) & (F.col("toxic") >= MINED_PURITY * (F.col("toxic") + (F.col("n") - F.col("toxic")) * F.col("clean")))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("toxic").desc(), "term"))
    best = pure.withColumn("rank", rank).where(F.col("rank") <= MINED_TERMS).orderBy("rank", "term").limit(MINED_TERMS)
    return np.sort(np.array([r.term for r in best.select("term").collect()], dtype=np.int64).view(np.uint64))


def _prepared(labels: DataFrame) -> DataFrame:
    """One row per labelled id: its vote, and whether it is toxic only by its
    words (its form is good)."""
    toxic, junk = F.coalesce(F.max("toxic"), F.lit(0)) == 1, F.coalesce(F.min("quality"), F.lit(1)) == 0
    return (labels.where("doc_id is not null").groupBy("doc_id")
            .agg(F.when(toxic, TOXIC).when(junk, JUNK).otherwise(GOOD).alias("vote"), F.coalesce(F.max("toxic"), F.lit(0)).alias("bad_words")))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, words: Sequence[str] = ()) -> tuple[Scorer, np.ndarray]:
    """(scorer, accuracies of LABELLERS). words: what the labeller "word list"
    takes for toxic; without any it is silent."""
    toxic = listed(words)
    known = staged(spark, _prepared(labels), "quality-labels")
    mined = mine(docs, known)
    last = 4 ** (len(LABELLERS) - 1)

    def heuristics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch["lang"].to_numpy(zero_copy_only=False)
            for i, j, w in W.batches(batch["text"]):
                yield pa.record_batch([batch["doc_id"].slice(i, j - i), batch["key"].slice(i, j - i), batch["lang"].slice(i, j - i),
                                       pa.array(code(votes(w, mined, terms(w), lang[i:j], toxic)))], names=["doc_id", "key", "lang", "pattern"])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, w in W.batches(batch["text"]):
                doc, found = features(w, terms(w))
                lists = [np.unique(found[doc == k]) for k in range(j - i)] if j - i < 8 else _by_doc(doc, found, j - i)
                yield pa.record_batch([batch["key"].slice(i, j - i), batch["lang"].slice(i, j - i), batch["pattern"].slice(i, j - i),
                                       pa.array([x.tobytes() for x in lists], pa.binary())], names=["key", "lang", "pattern", "features"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in batch["features"]] or [np.zeros(0, np.uint32)]), return_counts=True)
            yield pa.record_batch([pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["feature", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _lang(docs).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    voted = (rows.mapInArrow(heuristics, f"doc_id {kind}, key long, lang int, pattern long").join(known.select("doc_id", "vote"), "doc_id", "left")
             .select("key", "lang", (F.col("pattern") + last * F.coalesce("vote", F.lit(0))).alias("pattern")))
    voted = staged(spark, voted, "quality-votes")
    counts = voted.groupBy("pattern", "lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return Scorer(np.zeros(0, np.uint32), np.zeros(0), 0.0), np.full(len(LABELLERS), FIRST_ACCURACY)
    every, lang, n = (np.array([r[k] for r in counts], dtype=np.int64) for k in range(3))
    patterns, at = np.unique(every, return_inverse=True)
    accuracy, _, posterior = classes(patterns, np.bincount(at, n))
    stratum = lang * CLASSES + posterior.argmax(axis=1)[at]
    strata, own = np.unique(stratum, return_inverse=True)
    sizes = np.bincount(own, n)
    share = rates(sizes, TRAIN_ROWS)
    offsets = np.zeros(LANGS)  # log of how much oftener good documents are drawn
    for k in range(LANGS):
        fine, bad = (strata // CLASSES == k) & (strata % CLASSES == GOOD - 1), (strata // CLASSES == k) & (strata % CLASSES != GOOD - 1)
        if fine.any() and bad.any():
            offsets[k] = np.log(share[fine][0]) - np.log((share[bad] * sizes[bad]).sum() / sizes[bad].sum())

    keys = _drawn(voted, ["pattern", "lang"], dict(zip(zip(every.tolist(), lang.tolist()), share[own].tolist())), "key").select("key", "pattern").dropDuplicates(["key"])
    sample = rows.drop("doc_id").join(F.broadcast(keys), "key")  # TRAIN_ROWS keys; equal rows once
    got = sample.mapInArrow(sampled, "key long, lang int, pattern long, features binary").dropDuplicates(["key"])
    got = staged(spark, got.repartition(16, "key"), "quality-sample")  # the driver takes one part at a time
    top = (got.select("features").mapInArrow(spread, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= FEATURE_LEAST).select("feature").toArrow())
    names = np.sort(np.asarray(top["feature"], dtype=np.int64)).astype(np.uint32)
    shared = spark.sparkContext.broadcast(names)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.flatnonzero(np.isin(shared.value, np.frombuffer(x.as_py(), np.uint32), assume_unique=True)).astype(np.int32).tobytes() for x in batch["features"]]
            yield pa.record_batch([batch["key"], batch["lang"], batch["pattern"], pa.array(kept, pa.binary())], names=["key", "lang", "pattern", "columns"])

    of = dict(zip(patterns.tolist(), posterior[:, GOOD - 1].tolist()))
    got = sorted((r.key, r.lang, r.pattern, r.columns) for r in got.mapInArrow(columns, "key long, lang int, pattern long, columns binary").toLocalIterator())
    if not got:
        return Scorer(np.zeros(0, np.uint32), np.zeros(0), 0.0), accuracy
    cuts = np.concatenate([[0], np.cumsum([len(c) // 4 for *_, c in got])])
    good, offset = np.array([of[p] for _, _, p, _ in got]), offsets[[k for _, k, _, _ in got]]
    column = np.frombuffer(b"".join([c for *_, c in got]), np.int32)
    del got
    weight, bias = train(cuts, column, len(names), good, offset)
    return Scorer(names[weight != 0], weight[weight != 0], bias), accuracy


def _by_doc(doc: np.ndarray, found: np.ndarray, n: int) -> list[np.ndarray]:
    order = np.argsort(doc, kind="stable")
    cuts = np.searchsorted(doc[order], np.arange(n + 1))
    return [np.unique(found[order[a:b]]) for a, b in zip(cuts, cuts[1:])]


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, words: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, score (probability of good), accepted."""
    scorer, _ = fit(spark, docs, labels, words)
    shared = spark.sparkContext.broadcast((scorer.keys, scorer.weights, scorer.bias))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            for i, j, w in W.batches(batch["text"]):
                yield pa.record_batch([batch["doc_id"].slice(i, j - i), pa.array(own(w))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(judge, f"doc_id {kind}, score double")
    return scored.withColumn("accepted", F.col("score") >= THRESHOLD)


def accept(spark: SparkSession, docs: DataFrame, labels: DataFrame, words: Sequence[str] = ()) -> DataFrame:
    """The rows of docs that the scorer accepts, with all their columns."""
    scorer, _ = fit(spark, docs, labels, words)
    shared = spark.sparkContext.broadcast((scorer.keys, scorer.weights, scorer.bias))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            mask = [own(w) >= THRESHOLD for _, _, w in W.batches(batch["text"])]
            if mask:
                yield batch.filter(pa.array(np.concatenate(mask)))

    return docs.mapInArrow(keep, docs.schema)
