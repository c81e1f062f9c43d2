"""Benchmark decontamination with SimHash of item-sized windows.

For an item of n words every window of n words in a document, or the whole of a
document that is shorter, is compared with it: by 5-word shingles (lower-cased A-Z), weighted by how often each occurs. A
window matches at a weighted Jaccard similarity of 0.75 or more.

1. A match needs at least 6/7 of the window's shingles among those of the
   benchmark (3/7 of the window's and the item's together, where the window is
   a shorter document), which running counts decide for all windows.
2. Windows that pass get a 64-bit SimHash. Fingerprints within ``RADIUS`` bits
   agree in at least one of ``RADIUS + 1`` blocks, so the block index returns
   every item of that length within the radius. (At similarity 0.75 the
   distance is about 11 with a deviation of 3; the radius is four deviations
   above.)
3. The exact weighted similarity decides, nearest fingerprint first.

Documents are never shuffled: the index travels to them. It is built from one
shard of the benchmark at a time, at most ``SHARD_ITEMS`` items and about
``SHARD_BYTES``; a larger benchmark takes several passes, so what is broadcast
is bounded at any size.

Cases: null or empty texts, and items without words, match nothing; an item
under 5 words is one shingle of its whole sequence; an item with a null id
matches under the null id; repeated items report each id once. Repeated rows
come back repeated. Empty tables: no rows, or nothing contaminated. Further
columns pass through ``clean`` untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W

SHINGLE, RADIUS = 5, 23
SHARD_ITEMS, SHARD_BYTES = 20_000, 8 << 20
NUMERATOR, DENOMINATOR = 3, 4  # similarity 0.75

MATCH = "array<struct<item_id:{},start:int,similarity:double>>"


def _block_edges() -> list[tuple[int, int]]:
    """(shift, mask) of RADIUS + 1 blocks that cut 64 bits."""
    cuts = [64 * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]


BLOCKS = _block_edges()


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each shingle."""
    raw = W.mix(shingles ^ W.U(0x5BF03635F0A31E29))
    return (np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2) - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def simhash(shingles: np.ndarray) -> np.ndarray:
    """Fingerprint of a multiset: each occurrence counts."""
    return _packed(_bits(shingles).sum(axis=0, keepdims=True))


def similarity(a: dict[int, int], b: dict[int, int]) -> tuple[int, int]:
    """Weighted Jaccard similarity as (numerator, denominator)."""
    common = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return common, sum(a.values()) + sum(b.values()) - common


def counted(shingles: np.ndarray) -> dict[int, int]:
    return dict(zip(*(x.tolist() for x in np.unique(shingles, return_counts=True))))


class Index:
    """Items by their number of words."""

    def __init__(self, ids: list, texts: pa.Array):
        grouped: dict[int, list] = {}
        known: dict[int, list] = {}
        for i, j, w in W.batches(texts, lower=True):
            for k in range(j - i):
                h = w.hash[w.docs[k]:w.docs[k + 1]]
                if len(h):
                    q = min(SHINGLE, len(h))
                    g = W.grams(h, q)
                    grouped.setdefault(len(h), []).append((ids[i + k], g))
                    known.setdefault(q, []).append(g)
        self.known = {q: np.unique(np.concatenate(g)) for q, g in known.items()}
        self.filters = {q: self._filter(k) for q, k in self.known.items()}
        self.lengths = {}
        for n, items in sorted(grouped.items()):
            prints = np.concatenate([simhash(g) for _, g in items])
            blocks = []
            for shift, mask in BLOCKS:
                table = np.zeros((mask + 1, len(items)), dtype=bool)
                table[((prints >> W.U(shift)) & W.U(mask)).astype(np.int64), np.arange(len(items))] = True
                blocks.append(table)
            self.lengths[n] = ([x for x, _ in items], [counted(g) for _, g in items], prints, blocks)

    @staticmethod
    def _filter(known: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << 22, dtype=bool)
        table[(known >> W.U(42)).astype(np.int64)] = True
        return table

    def places(self, grams: np.ndarray, q: int) -> np.ndarray:
        """Mask of the shingles that some item has."""
        maybe = self.filters[q][(grams >> W.U(42)).view(np.int64)]
        at = np.flatnonzero(maybe)
        maybe[at] = np.isin(grams[at], self.known[q])
        return maybe

    def matches(self, grams: dict[int, np.ndarray], hits: dict[int, np.ndarray]) -> list[dict]:
        """Matching items of one document, from its shingles and their mask."""
        found: dict = {}
        for n, (ids, items, prints, blocks) in self.lengths.items():
            q = min(SHINGLE, n)
            m = n - q + 1
            g = grams[q]
            size = min(m, len(g))  # a shorter document is one window
            need = math.ceil(NUMERATOR * (size + m) / (NUMERATOR + DENOMINATOR))
            if size < need or hits[q].sum() < need:
                continue
            count = np.concatenate([[0], np.cumsum(hits[q])])
            starts = np.flatnonzero(count[size:] - count[:-size] >= need)
            for a in range(0, len(starts), 4096):
                self._near(starts[a:a + 4096], g, size, ids, items, prints, blocks, found)
        return [{"item_id": k, "start": v[0], "similarity": v[1]} for k, v in found.items()]

    def _near(self, starts, g, m, ids, items, prints, blocks, found) -> None:
        if not len(starts):
            return
        own = _windows(g, starts, m)
        near = np.zeros((len(starts), len(ids)), dtype=bool)
        for (shift, mask), table in zip(BLOCKS, blocks):
            near |= table[((own >> W.U(shift)) & W.U(mask)).astype(np.int64)]
        row, item = np.nonzero(near)
        distance = np.bitwise_count(own[row] ^ prints[item])
        order = np.lexsort((row, distance))
        for k in order[distance[order] <= RADIUS]:
            if ids[item[k]] in found:
                continue
            s = int(starts[row[k]])
            top, bottom = similarity(counted(g[s:s + m]), items[item[k]])
            if top * DENOMINATOR >= bottom * NUMERATOR:
                found[ids[item[k]]] = (s, top / bottom)


def _windows(g: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """SimHash of m shingles from each start; starts that lie close share
    their running sums."""
    out = np.zeros(len(starts), dtype=np.uint64)
    cut = np.flatnonzero(np.diff(starts) > m) + 1
    for a, b in zip(np.r_[0, cut], np.r_[cut, len(starts)]):
        low, high = starts[a], starts[b - 1] + m
        total = np.zeros((high - low + 1, 64), dtype=np.int32)
        np.cumsum(_bits(g[low:high]), axis=0, out=total[1:])
        at = starts[a:b] - low
        out[a:b] = _packed(total[at + m] - total[at])
    return out


def _matched(index: Index, texts: pa.Array) -> list[list[dict]]:
    out = []
    for i, j, w in W.batches(texts, lower=True):
        grams = {q: W.grams(w.hash, q) for q in index.known}
        hits = {q: index.places(g, q) for q, g in grams.items()}
        totals = {q: np.concatenate([[0], np.cumsum(h)]) for q, h in hits.items()}
        for k in range(j - i):
            a, b = w.docs[k], w.docs[k + 1]
            # Shingles that start in the document: of the last, short ones of a group there are none.
            part = {q: (min(a, len(g)), min(max(a, b - q + 1), len(g))) for q, g in grams.items()}
            if any(totals[q][y] > totals[q][x] for q, (x, y) in part.items()):
                out.append(index.matches({q: grams[q][x:y] for q, (x, y) in part.items()}, {q: hits[q][x:y] for q, (x, y) in part.items()}))
            else:
                out.append([])
    return out


def _shards(spark: SparkSession, benchmark: DataFrame) -> Iterator:
    """Broadcast items, a bounded number at a time: an item whose text alone
    is longer than the byte bound is a shard of its own at worst."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    n, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, math.ceil(n / SHARD_ITEMS), math.ceil((size or 0) / SHARD_BYTES))
    for s in range(shards):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == s).collect()
        ids = {}
        for r in rows:  # repeated items once
            ids.setdefault((r.item_id, r.text))
        yield spark.sparkContext.broadcast(([i for i, _ in ids], [t for _, t in ids]))


def _indexed(shared) -> Index:
    """The shard's index, built once per Python worker; the cache holds one."""
    value = shared.value
    if _CACHE.get("value") is not value:
        _CACHE.clear()
        _CACHE.update(value=value, index=Index(value[0], pa.array(value[1], pa.large_string())))
    return _CACHE["index"]


_CACHE: dict = {}


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, contaminated, matches (item, first word
    of the matching window, similarity)."""
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    kind = MATCH.format(item_type)
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.expr(f"cast(array() as {kind})").alias("matches"))
    arrow = pa.list_(pa.struct([("item_id", _arrow(benchmark)), ("start", pa.int32()), ("similarity", pa.float64())]))
    for shared in _shards(spark, benchmark):
        def scan(batches, shared=shared):
            for batch in batches:
                own = _matched(_indexed(shared), batch["text"])
                own = [a.as_py() + b for a, b in zip(batch["matches"], own)]
                yield pa.record_batch([batch["doc_id"], batch["text"], pa.array(own, arrow)], names=["doc_id", "text", "matches"])
        out = out.mapInArrow(scan, f"doc_id {id_type}, text string, matches {kind}")
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"), "matches")


def _arrow(benchmark: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(benchmark.schema["item_id"].dataType)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item, with all their columns."""
    out = docs
    for shared in _shards(spark, benchmark):
        def keep(batches, shared=shared):
            for batch in batches:
                text = batch["text"].cast(pa.large_string()).fill_null("")
                yield batch.filter(pa.array([not x for x in _matched(_indexed(shared), text)], pa.bool_()))
        out = out.mapInArrow(keep, docs.schema)
    return out
