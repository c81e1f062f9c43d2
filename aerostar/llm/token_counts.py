"""Token counts as delta-maintained rollups.

A store below ``root`` keeps, per committed batch, a ledger of signed rows (for
each document id, source, language, tokenizer version and count, how many such
documents came or, negative, went) and their sums by source, language and
tokenizer. Totals are the sums of all committed deltas; nothing is ever
recounted.

A batch of changes inserts, deletes or revises documents. Its retractions come
from the ledger: what stands there for the touched ids is taken back, what the
batch brings is added. So inserting a known id revises it, and deleting an
unknown one does nothing. Of several changes of one id in a batch those with the
largest ``seq`` count (ties: any delete wins). Every row of them is a document:
rows that share an id and seq, equal ones too, are counted each, and stand under
that id together. A null id names no document: such rows only add, and a delete
of the null id does nothing.

The ledger lies in ``BUCKETS`` folders by hash of the id, so a batch reads only
those that hold ids it touches. ``compact`` replaces the ledgers and deltas of
all batches so far by their net rows.

Commits are idempotent: a batch writes folders named by its number and becomes
visible by its marker, written last. Committing a number that has its marker
does nothing; a batch that failed halfway is written anew.

Tokenizers are named, versioned counters of texts; their files are read on the
driver and travel as bounded broadcasts. Null or empty texts count 0 tokens;
null source and language are groups of their own. Columns beyond those named
are not used. Empty batches leave the totals as they are.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .staging import staged

Counter = Callable[[pa.Array], np.ndarray]
GROUP = ("source", "lang", "tokenizer")
BUCKETS = 64


def word_counter() -> Counter:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    def count(texts: pa.Array) -> np.ndarray:
        parts = [np.diff(w.docs) for _, _, w in W.batches(texts)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return count


def bpe_counter(spark: SparkSession, path: str, pattern: str) -> Counter:
    """A byte-level BPE whose ranks lie at ``path`` (text: base64 token, rank)."""
    with open(path, "rb") as f:
        shared = spark.sparkContext.broadcast((f.read(), pattern))

    def count(texts: pa.Array) -> np.ndarray:
        encoding = _encoding(shared)
        return np.array([len(encoding.encode_ordinary(t or "")) for t in texts.to_pylist()], dtype=np.int64)
    return count


_ENCODINGS: dict = {}


def _encoding(shared):
    value = shared.value
    if id(value) not in _ENCODINGS:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, value[0].splitlines())}
        _ENCODINGS.clear()
        _ENCODINGS[id(value)] = tiktoken.Encoding("counter", pat_str=value[1], mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[id(value)]


def counted(docs: DataFrame, tokenizers: dict[str, Counter]) -> DataFrame:
    """doc_id, source, lang, text -> one row per row and tokenizer: doc_id,
    source, lang, tokenizer, tokens. Texts are read once for all tokenizers."""
    rows = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    keep = ("doc_id", "source", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, counter in tokenizers.items():
                yield pa.record_batch([*(batch[c] for c in keep), pa.array([name] * len(batch)), pa.array(counter(batch["text"]).astype(np.int64))],
                                      names=[*keep, "tokenizer", "tokens"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(count, f"{kinds}, tokenizer string, tokens long")


class Rollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """changes: op (insert, revise, delete), seq, doc_id, source, lang,
        tokenizer, tokens (delete: the last four are ignored and the whole
        document goes). Returns False if the batch was committed before."""
        upto, done = self._committed()
        if batch <= upto or batch in done:
            return False
        kinds = ["doc_id", *GROUP, "tokens"]
        # equal rows collapse to their number before they meet by id
        rows = (changes.groupBy("op", "seq", *kinds).agg(F.count(F.lit(1)).alias("sign")))
        last = (changes.where("doc_id is not null").groupBy("doc_id")
                .agg(F.max(F.struct("seq", (F.col("op") == "delete").alias("gone"))).alias("last"))
                .select(F.col("doc_id").alias("__id"), F.col("last.seq").alias("__seq"), "last.gone"))
        last = staged(self.spark, last.withColumn("bucket", _bucket("__id")), "rollup-touched")
        fresh = rows.where("op != 'delete'")
        named = (fresh.join(last, (F.col("doc_id") == F.col("__id")) & (F.col("seq") == F.col("__seq")) & ~F.col("gone"))
                 .groupBy(*kinds).agg(F.sum("sign").alias("sign")))
        nameless = fresh.where("doc_id is null").groupBy(*kinds).agg(F.sum("sign").alias("sign"))
        change = named.unionByName(nameless)
        touched = [r["bucket"] for r in last.select("bucket").distinct().collect()]  # at most BUCKETS
        ledger = self._ledger(upto, done, touched)
        if ledger is not None:
            stands = ledger.join(last.select("__id"), F.col("doc_id") == F.col("__id"), "left_semi")
            back = stands.groupBy(*kinds).agg((-F.sum("sign")).alias("sign")).where("sign != 0")
            change = change.unionByName(back)
        self._write(change, f"{self.root}/ledger/batch={batch}", f"{self.root}/deltas/batch={batch}", f"{self.root}/commits/batch={batch}")
        return True

    def compact(self) -> int | None:
        """Net rows of all committed batches, which take their place from now
        on. Returns the last batch they hold (None: nothing to do)."""
        upto, done = self._committed()
        if not done:
            return None
        last = max(done)
        whole = (self._ledger(upto, done, range(BUCKETS)).groupBy("doc_id", *GROUP, "tokens").agg(F.sum("sign").alias("sign")).where("sign != 0"))
        base = f"{self.root}/compacted/upto={last}"
        self._write(whole, f"{base}/ledger", f"{base}/deltas", f"{base}/commit")
        return last

    def _write(self, rows: DataFrame, ledger: str, deltas: str, marker: str) -> None:
        (rows.withColumn("bucket", _bucket("doc_id")).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(ledger))
        written = self.spark.read.schema(rows.schema).parquet(ledger)
        delta = written.groupBy(*GROUP).agg(F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        delta.write.mode("overwrite").parquet(deltas)
        self.spark.range(1).select(F.lit(1).alias("done")).write.mode("overwrite").parquet(marker)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens; groups without documents are
        left out."""
        upto, done = self._committed()
        folders = [f"{self.root}/deltas/batch={b}" for b in done]
        folders += [f"{self.root}/compacted/upto={upto}/deltas"] * (upto >= 0)
        if not folders:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, docs long, tokens long")
        deltas = self.spark.read.parquet(*folders)
        return (deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs != 0"))

    def _ledger(self, upto: int, done: list[int], buckets) -> DataFrame | None:
        """Rows of these buckets; None where there are none."""
        folders = [f"{self.root}/ledger/batch={b}" for b in done]
        folders += [f"{self.root}/compacted/upto={upto}/ledger"] * (upto >= 0)
        found = [f"{folder}/{name}" for folder in folders for name in self._names(folder) if name in {f"bucket={k}" for k in buckets}]
        return self.spark.read.parquet(*found) if found else None

    def _committed(self) -> tuple[int, list[int]]:
        """The last compacted batch (-1: none) and the later batches whose marker
        is complete, by Spark's own file system (the store may be remote)."""
        done = self._marked("commits/batch=*/_SUCCESS", 1)
        upto = max(self._marked("compacted/upto=*/commit/_SUCCESS", 2), default=-1)
        return upto, [b for b in done if b > upto]

    def _marked(self, pattern: str, up: int) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        folders = [f.getPath() for f in found]
        for _ in range(up):
            folders = [f.getParent() for f in folders]
        return sorted(int(f.getName().split("=")[1]) for f in folders)

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def _bucket(name: str) -> F.Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int")
