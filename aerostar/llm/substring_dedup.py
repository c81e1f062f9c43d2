"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Words covered by a
window whose word sequence also starts in a document with a smaller id go.

Every window is named by one of its ``PHRASE``-word phrases, the one of least
hash, so equal windows share their phrase and about one phrase in twenty is
ever named. The steps:

1. phrases named in two documents are the recurring ones (narrow rows);
2. every document meets the recurring phrases it names; for each shard of
   documents (about ``SHARD`` bytes) these are compiled into one Aho-Corasick
   automaton, the shard's documents stream through it, and each located phrase
   yields the run of windows it names, with their hashes;
3. runs are confirmed: a run whose whole word sequence stands in a smaller
   document goes entirely. Only the first holder of each distinct run, and
   only if its phrase has several distinct runs, is compared window by window;
4. the documents with located runs are cut.

The automata grow with a shard, not with the corpus, and each document is
scanned by one automaton. Skew: a passage shared by a third of all rows meets
in partial aggregates (least id per phrase, run, window) and in equi-joins with
staged tables that Spark splits; no pairs of documents are formed.

Cases: null or empty text has no words and keeps the empty string; documents
under ``WINDOW`` words lose nothing; repeats inside one id are not removed;
rows that repeat an id are told apart by their text; a null id counts as the
largest. Empty table: no rows. Other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .staging import staged

WINDOW, PHRASE, SHARD = 50, 8, 4 << 20

RUN = "array<struct<phrase:long,start:int,n:int,run:long,windows:array<long>>>"
_RUN_TYPE = pa.list_(pa.struct([("phrase", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("run", pa.int64()),
                                ("windows", pa.list_(pa.int64()))]))


def named_phrases(hashes: np.ndarray) -> np.ndarray:
    """Hash of the phrase that names the window starting at each place."""
    if len(hashes) < WINDOW:
        return hashes[:0]
    return W.sliding_min(W.grams(hashes, PHRASE), WINDOW - PHRASE + 1)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rid, text) -> phrase, id, rid; each phrase once per row."""
    for batch in batches:
        for i, j, w in W.batches(batch["text"]):
            lists = [np.unique(named_phrases(w.hash[w.docs[k]:w.docs[k + 1]])) for k in range(j - i)]
            at = pa.array(np.repeat(np.arange(i, j), [len(x) for x in lists]))
            phrases = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            yield pa.record_batch([pa.array(W.signed(phrases)), batch["id"].take(at), batch["rid"].take(at)], names=["phrase", "id", "rid"])


def _spaced(w: W.Words, a: int, b: int) -> str:
    """Words a to b between single spaces, one character per byte."""
    return " " + b" ".join(w.text(a, b)).decode("latin-1") + " "


def _automaton(w: W.Words, wanted: list[np.ndarray]):
    """The recurring phrases of these documents, each of them once; None
    without any."""
    out, seen = ahocorasick.Automaton(ahocorasick.STORE_INTS), set()
    for k, phrases in enumerate(wanted):
        if not len(phrases):
            continue
        a, b = w.docs[k], w.docs[k + 1]
        grams = W.grams(w.hash[a:b], PHRASE)
        at = np.flatnonzero(np.isin(grams, phrases))
        at = at[np.unique(grams[at], return_index=True)[1]]
        for p in at:
            if int(grams[p]) not in seen:
                seen.add(int(grams[p]))
                text = _spaced(w, a + p, a + p + PHRASE)
                out.add_word(text, len(text))
    if not seen:
        return None
    out.make_automaton()
    return out


def _runs(hashes: np.ndarray, offsets: np.ndarray, text: str, automaton) -> list[dict]:
    """The runs of windows named by phrases that the automaton locates."""
    found = [end - length + 1 for end, length in automaton.iter(text)]
    if not found:
        return []
    grams, names = W.grams(hashes, PHRASE), named_phrases(hashes)
    located = np.unique(grams[np.searchsorted(offsets, np.array(found))])
    hit = np.isin(names, located)
    edge = np.flatnonzero(np.r_[True, names[1:] != names[:-1], True])
    windows = W.grams(hashes, WINDOW)
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        if hit[a]:
            mine = windows[a:b]
            with np.errstate(over="ignore"):
                run = W.mix(mine + np.arange(b - a, dtype=np.uint64) * W.U(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
            out.append({"phrase": int(names[a].view(np.int64)), "start": int(a), "n": int(b - a),
                        "run": int(run.view(np.int64)), "windows": W.signed(mine)})
    return out


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rid, text, phrases) -> id, rid, n_words, kept_sha256 of the uncut
    text, text (only with runs), runs."""
    for batch in batches:
        for i, j, w in W.batches(batch["text"], chunk=SHARD):
            phrases = batch["phrases"].slice(i, j - i)
            wanted = [np.asarray(p.values, dtype=np.int64).view(np.uint64) if p.is_valid else np.zeros(0, np.uint64) for p in phrases]
            automaton = _automaton(w, wanted)
            runs, digests, kept = [], [], []
            for k in range(j - i):
                a, b = w.docs[k], w.docs[k + 1]
                mine = []
                if automaton is not None and b - a >= WINDOW:
                    offsets = np.cumsum(w.ends[a:b] - w.starts[a:b] + 1) - (w.ends[a:b] - w.starts[a:b] + 1)
                    mine = _runs(w.hash[a:b], offsets, _spaced(w, a, b), automaton)
                runs.append(mine)
                kept.append(bool(mine))
                digests.append(None if mine else _digest(w.text(a, b)))
            text = batch["text"].take(pa.array([i + k if x else None for k, x in enumerate(kept)], pa.int64()))
            yield pa.record_batch([batch["id"].slice(i, j - i), batch["rid"].slice(i, j - i), pa.array(np.diff(w.docs).astype(np.int64)),
                                   pa.array(digests, pa.string()), text, pa.array(runs, _RUN_TYPE)],
                                  names=["id", "rid", "n_words", "kept_sha256", "text", "runs"])


def cut_words(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Mask of n words that stay: spans are (first window, windows) that go."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, count in spans:
        change[start] += 1
        change[min(n, start + count - 1 + WINDOW)] -= 1
    return np.cumsum(change[:n]) == 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, w in W.batches(batch["text"]):
            removed, digests, texts = [], [], []
            for k, spans in enumerate(batch["spans"].slice(i, j - i).to_pylist()):
                a, b = w.docs[k], w.docs[k + 1]
                stay = cut_words(b - a, [(s["start"], s["n"]) for s in spans or []])
                kept = [x for x, s in zip(w.text(a, b), stay) if s]
                removed.append(int(b - a - len(kept)))
                digests.append(_digest(kept))
                texts.append(b" ".join(kept))
            yield pa.record_batch([batch["id"].slice(i, j - i), batch["n_words"].slice(i, j - i), pa.array(removed, pa.int64()),
                                   pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                                  names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_spans(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(located, spans): located has one row per row of docs with its words and
    runs; spans (id, rid, start, n) are the windows that go."""
    own = F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id").alias("id"))  # a null id comes last
    rows = docs.select(own.alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("rid"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    named = staged(spark, rows.mapInArrow(_phrases, f"phrase long, id {kind}, rid long"), "phrases")
    recurring = named.groupBy("phrase").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x != y").select("phrase")
    recurring = staged(spark, recurring, "recurring")
    wanted = named.join(recurring, "phrase").groupBy("id", "rid").agg(F.collect_set("phrase").alias("phrases"))
    located = staged(spark, rows.join(wanted, ["id", "rid"], "left").select("id", "rid", "text", "phrases")
                     .mapInArrow(_locate, f"id {kind}, rid long, n_words long, kept_sha256 string, text string, runs {RUN}"), "located")

    runs = located.select("id", "rid", F.explode("runs").alias("r"))
    narrow = runs.select("id", "rid", F.col("r.phrase").alias("phrase"), F.col("r.run").alias("run"), F.col("r.start").alias("start"), F.col("r.n").alias("n"))
    first = staged(spark, narrow.groupBy("phrase", "run").agg(F.min("id").alias("first")), "runs")
    several = staged(spark, first.groupBy("phrase").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("phrase"), "several")
    whole = narrow.join(first, ["phrase", "run"]).where("id > first").select("id", "rid", "start", "n")

    open_runs = staged(spark, first.join(several, "phrase", "left_semi"), "open-runs")
    held = (runs.select("id", "rid", F.col("r.phrase").alias("phrase"), F.col("r.run").alias("run"), F.col("r.start").alias("start"), F.col("r.windows").alias("windows"))
            .join(open_runs.withColumnRenamed("first", "id"), ["phrase", "run", "id"]))
    window = staged(spark, held.select("id", "rid", "start", F.posexplode("windows").alias("k", "window"))
                    .select("id", "rid", (F.col("start") + F.col("k")).alias("start"), "window"), "windows")
    least = staged(spark, window.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first != last").select("window", "first"), "window-first")
    single = window.join(least, "window").where("id > first").select("id", "rid", "start", F.lit(1).alias("n"))
    return located, whole.unionByName(single)


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256, and
    kept_text (null where nothing can have been removed)."""
    located, spans = repeated_spans(spark, docs)
    gone = spans.groupBy("id", "rid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    kind = located.schema["id"].dataType.simpleString()
    cut = (located.where("text is not null").select("id", "rid", "n_words", "text").join(gone, ["id", "rid"], "left")
           .select("id", "n_words", "text", "spans")
           .mapInArrow(_cut, f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"))
    same = located.where("text is null").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    return same.unionByName(cut).select(F.col("id.id").alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
