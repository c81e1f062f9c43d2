"""MinHash near-dedup with tensored banding.

A document's set holds its distinct 5-word shingles (lower-cased A-Z; fewer
words: the whole sequence). ``2 * COLLECTIONS`` half keys of ``WIDTH``
minhashes each form two collections; table (i, j) is keyed by half key i of
the first and half key j of the second. So 28 half keys of 2 minhashes (56 in
all) serve 196 tables of 4 minhashes. Two sets of similarity s miss each other
with probability below 2 (1 - s^2)^14, which is 2e-5 at s = 0.75.

Candidates are verified on full sets, without pairing a bucket's members:

1. equal sets become one node (of the least doc_id);
2. a table key is built only from half keys that another node has too, which
   loses no collision;
3. every bucket names its least node as pivot; each (pivot, member) pair is
   verified once;
4. members that are not linked with their pivot are compared with the other
   members of that pivot in blocks of ``BLOCK`` nodes, exactly, by one matrix
   product per pair of blocks; members linked with the pivot are one component
   already and never compared with each other;
5. links become components.

Skew: equal sets meet in partial aggregates; joins on a frequent pivot are
plain equi-joins that Spark splits; blocks bound what one task holds.

Cases: null or empty text, or text without words: no shingles, component is
the document's own id, kept. Repeated rows (same id and text) come back
repeated with the same result. A null doc_id takes part in links but names a
component only if it has no other id. Empty table: no rows. Other columns are
not used; ``distinct_rows`` returns them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .exact_dedup import located
from .staging import staged

SHINGLE, COLLECTIONS, WIDTH, BLOCK = 5, 18, 3, 512
PERCENT = 75

_SEEDS = W.stream(3, 2 * COLLECTIONS * WIDTH)
_MULTIPLIERS = W.stream(4, 2 * COLLECTIONS * WIDTH) | W.U(1)
_SET_SEED = W.stream(5, 2)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Places of 5-word shingles as hashes; repeats stay."""
    return W.grams(hashes, min(SHINGLE, len(hashes))) if len(hashes) else hashes


def set_id(members: np.ndarray) -> bytes:
    """128 bits that name a set of distinct shingles."""
    with np.errstate(over="ignore"):
        return b"".join(W.mix(members ^ s).sum(dtype=np.uint64).tobytes() for s in _SET_SEED)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with text -> their other columns, n_shingles, node, halves."""
    for batch in batches:
        for i, j, w in W.batches(batch["text"], lower=True):
            sets, docs = [], []
            for k in range(j - i):
                s = np.unique(shingles(w.hash[w.docs[k]:w.docs[k + 1]]))
                if len(s):
                    sets.append(s)
                    docs.append(k)
            halves = np.zeros((j - i, 2 * COLLECTIONS), dtype=np.uint64)
            sizes = np.zeros(j - i, dtype=np.int64)
            node = [None] * (j - i)
            if sets:
                every = np.concatenate(sets)
                lengths = np.array([len(s) for s in sets])
                cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                sizes[docs] = lengths
                for k, s in zip(docs, sets):
                    node[k] = set_id(s)
                with np.errstate(over="ignore"):
                    for h in range(2 * COLLECTIONS):
                        key = np.full(len(sets), h + 1, dtype=np.uint64)
                        for f in range(h * WIDTH, (h + 1) * WIDTH):
                            x = (every ^ _SEEDS[f]) * _MULTIPLIERS[f]
                            key = W.mix(key ^ np.minimum.reduceat(x ^ (x >> W.U(32)), cuts))
                        halves[docs, h] = key
            lists = pa.FixedSizeListArray.from_arrays(pa.array(halves.view(np.int64).ravel()), 2 * COLLECTIONS).cast(pa.list_(pa.int64()))
            keys = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*(batch[c].slice(i, j - i) for c in keys), pa.array(sizes), pa.array(node, pa.binary()), lists],
                                  names=[*keys, "n_shingles", "node", "halves"])


def _sets(texts) -> list[np.ndarray]:
    return [np.unique(shingles(w.hash[w.docs[k]:w.docs[k + 1]]))
            for i, j, w in W.batches(texts, lower=True) for k in range(j - i)]


def similar(common, x, y):
    """100 * intersection >= 75 * union, in integers."""
    return 100 * common >= PERCENT * (x + y - common)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pivot, member, pivot_text, member_text) -> pivot, member, linked."""
    last, pivot = None, None
    for batch in batches:
        linked = []
        names, whole = batch["pivot"].to_pylist(), batch["pivot_text"]
        for k, s in enumerate(_sets(batch["member_text"])):
            if names[k] != last:
                last, pivot = names[k], _sets(whole.slice(k, 1))[0]
            common = len(np.intersect1d(pivot, s, assume_unique=True))
            linked.append(bool(similar(common, len(pivot), len(s))))
        yield pa.record_batch([batch["pivot"], batch["member"], pa.array(linked, pa.bool_())], names=["pivot", "member", "linked"])


def _matrix(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, column) of each shingle that two of the sets share; columns in all."""
    every = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    dense = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    return rows[shared], dense[column[shared]], int((count > 1).sum())


def common_counts(sets: list[np.ndarray], left: int, columns: int = 8192) -> np.ndarray:
    """Intersection sizes of the first ``left`` sets with all sets."""
    rows, column, n = _matrix(sets)
    total = np.zeros((left, len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for at in range(0, n, columns):
        a, b = np.searchsorted(column, [at, at + columns])
        m = np.zeros((len(sets), min(columns, n - at)), dtype=np.float32)
        m[rows[a:b], column[a:b] - at] = 1
        total += m[:left] @ m.T
    return total.astype(np.int64)  # exact: sums below 2**24 of ones


def _block_links(group: pa.Table) -> pa.Table:
    """Links between the two sides of a pair of blocks, as a spanning star of
    each component they form."""
    side, nodes = group["side"].to_numpy(), group["member"].to_pylist()
    order = np.argsort(side, kind="stable")
    nodes = [nodes[k] for k in order]
    every = _sets(group["text"])
    sets = [every[k] for k in order]
    left = int((side == 0).sum())
    a, b = [], []
    if 0 < left and len(sets) > 1:
        sizes = np.array([len(s) for s in sets])
        near = similar(common_counts(sets, left), sizes[:left, None], sizes[None, :])
        label = np.arange(len(sets))
        while True:
            best = np.where(near, label[None, :], len(sets))
            new = label.copy()
            new[:left] = np.minimum(new[:left], best.min(axis=1))
            new = np.minimum(new, np.where(near, new[:left, None], len(sets)).min(axis=0))
            if (new == label).all():
                break
            label = new
        for k in np.flatnonzero(label != np.arange(len(sets))):
            a.append(nodes[k])
            b.append(nodes[label[k]])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    placed, bare = _placed(spark, docs, ["doc_id"])
    least = staged(spark, placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "minhash-least")
    out = (placed.join(least, "root").select("doc_id", "n_shingles", "component_id")
           .unionByName(bare.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Of each component the row of least id (ties: least place in the files),
    and all rows without shingles, with the columns of docs."""
    rows = located(spark, docs)
    keys = ["doc_id", "__file", "__row"]
    placed, _ = _placed(spark, rows.select(F.col("given.doc_id").alias("doc_id"), F.col("given.text").alias("text"), "__file", "__row"), keys)
    stays = staged(spark, placed.groupBy("root").agg(F.min(F.struct(*keys)).alias("stay")), "minhash-stay")
    gone = (placed.join(stays, "root").where((F.col("stay.__file") != F.col("__file")) | (F.col("stay.__row") != F.col("__row")))
            .select("__file", "__row"))
    return rows.join(gone, ["__file", "__row"], "left_anti").select("given.*")


def _placed(spark: SparkSession, docs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with shingles: keys, n_shingles, root of their component; rows
    without: keys, n_shingles)."""
    texts = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keys)
    rows = staged(spark, texts.mapInArrow(_nodes, f"{kinds}, n_shingles long, node binary, halves array<long>"), "minhash")
    root = components(spark, _links(spark, texts, rows)).withColumnRenamed("vertex", "node")
    placed = rows.where("node is not null").join(root, "node", "left").select(*keys, "n_shingles", F.coalesce("root", "node").alias("root"))
    return placed, rows.where("node is null").select(*keys, "n_shingles")


def _links(spark: SparkSession, texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Verified links (a, b) between nodes, enough to connect each component."""
    nodes = staged(spark, rows.where("node is not null").groupBy("node")
                   .agg(F.min(F.struct("doc_id", "halves")).alias("first"))
                   .select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.halves").alias("halves")), "minhash-nodes")

    half = nodes.select("node", "doc_id", F.posexplode("halves").alias("place", "half"))
    live = (half.groupBy("half").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x != y").select("half"))
    live = staged(spark, live, "minhash-live")
    keys = (half.join(live, "half").groupBy("node", "doc_id")
            .agg(F.collect_list(F.when(F.col("place") < COLLECTIONS, F.col("half"))).alias("first"),
                 F.collect_list(F.when(F.col("place") >= COLLECTIONS, F.col("half"))).alias("second")))
    keys = staged(spark, keys.where((F.size("first") > 0) & (F.size("second") > 0)), "minhash-keys")
    entry = (keys.select("node", "doc_id", "second", F.explode("first").alias("i"))
             .select("node", "doc_id", "i", F.explode("second").alias("j"))
             .select("node", "doc_id", F.xxhash64("i", "j").alias("table_key")))
    bucket = (entry.groupBy("table_key").agg(F.min(F.struct("doc_id", "node")).alias("p"), F.max("node").alias("x"), F.min("node").alias("y"))
              .where("x != y").select("table_key", F.col("p.node").alias("pivot")))
    bucket = staged(spark, bucket, "minhash-buckets")
    pairs = (entry.select("node", "table_key").join(bucket, "table_key").where("node != pivot")
             .select("pivot", F.col("node").alias("member")).distinct())
    pairs = staged(spark, pairs, "minhash-pairs")

    needed = pairs.select(F.col("pivot").alias("node")).unionByName(pairs.select(F.col("member").alias("node"))).distinct()
    needed = nodes.select("node", "doc_id").join(needed, "node", "left_semi")
    if _ids_repeat(rows):  # an id with several texts: each text names its node anew
        source = (texts.withColumnRenamed("doc_id", "__id")
                  .join(needed.select("doc_id").distinct(), F.col("__id").eqNullSafe(F.col("doc_id")), "left_semi")
                  .select("text").mapInArrow(_named, "text string, node binary")
                  .join(needed.select("node"), "node", "left_semi").groupBy("node").agg(F.max("text").alias("text")))
    else:
        source = (texts.withColumnRenamed("doc_id", "__id").join(needed, F.col("__id").eqNullSafe(F.col("doc_id")))
                  .groupBy("__id", "node").agg(F.max("text").alias("text")))
    source = staged(spark, source.select("node", "text"), "minhash-texts")

    member = pairs.join(source.select(F.col("node").alias("member"), F.col("text").alias("member_text")), "member")
    both = member.join(source.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text")), "pivot")
    checked = staged(spark, both.select("pivot", "member", "pivot_text", "member_text")
                     .mapInArrow(_checked, "pivot binary, member binary, linked boolean"), "minhash-checked")

    found = checked.where("linked").select(F.col("pivot").alias("a"), F.col("member").alias("b"))
    return found.unionByName(_rest(checked, source))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [set_id(s) if len(s) else None for s in _sets(batch["text"])]
        yield pa.record_batch([batch["text"], pa.array(ids, pa.binary())], names=["text", "node"])


def _ids_repeat(rows: DataFrame) -> bool:
    """Does an id (or null) name two different texts?"""
    return not (rows.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y"))
                .where("x != y").isEmpty())


def _rest(checked: DataFrame, source: DataFrame) -> DataFrame:
    """Links among a pivot's members of which one or both are not linked with
    it. Side 0 of a pair of blocks is always of unlinked members."""
    count = (checked.groupBy("pivot").agg(F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("n"), F.count(F.lit(1)).alias("all"))
             .where("n > 0 and all > 1").select("pivot", F.ceil(F.col("n") / BLOCK).cast("int").alias("loose"),
                                               F.ceil((F.col("all") - F.col("n")) / BLOCK).cast("int").alias("tied")))
    spread = checked.join(count, "pivot")
    own = lambda n: F.pmod(F.xxhash64("member"), n).cast("int")
    pair = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    mine = own(F.col("loose"))
    loose = F.concat(  # with blocks after and before its own, and with those of the linked members
        F.transform(numbers(F.col("loose")), lambda k: F.struct(F.lit(0).alias("kind"), F.least(mine, k).alias("i"), F.greatest(mine, k).alias("j"),
                                                                F.when(mine <= k, 0).otherwise(1).alias("side"))),
        F.transform(numbers(F.col("tied")), lambda k: pair(1, mine, k, 0)))
    tied = F.transform(numbers(F.col("loose")), lambda k: pair(1, k, own(F.col("tied")), 1))
    dealt = spread.select("pivot", "member", F.explode(F.when(F.col("linked"), tied).otherwise(loose)).alias("to"))
    return (dealt.join(source.withColumnRenamed("node", "member"), "member")
            .select("pivot", "to.kind", "to.i", "to.j", "to.side", "member", "text")
            .groupBy("pivot", "kind", "i", "j").applyInArrow(_block_links, "a binary, b binary"))
