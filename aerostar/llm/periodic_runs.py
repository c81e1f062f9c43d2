"""Runs (maximal periodic stretches) of the words of whole texts.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends keeping period q, of at least
``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods.

Method, Kruskal over suffixes by descending common prefix. The suffixes of a
document are sorted (prefix doubling over word numbers); neighbours in that
order carry the length of their longest common prefix. Going through these
lengths downwards, the classes of two neighbours are united: at length l a
class holds the positions, in order, whose next l words are the same. Where a
union makes positions x < y neighbours in their class and y - x <= l, the words
from x to y + l have period y - x: a seed. A run that starts at s with period q
and length L has its s and s + q united exactly at L - q, and nothing of their
class lies between them, else q were not the smallest period; so each run is
seeded at its own start, where the word before s differs from the one before
s + q, and other seeds of it are passed over. A class that is united in several
steps of one length can show two positions as neighbours for a moment; such a
seed has the start and length of a true run and a longer period, so of equal
starts and lengths the shortest period stands.

Only prefixes of ``MIN_LENGTH - 1`` words or more can seed a run; all others are
never united. Words are compared as they are (bytes, numbered by a table of the
document), not by hashes. A position enters classes of growing size only, so
each document costs n log(n) steps; classes are chunked lists, so also one
word repeated a million times is no square.

Every text is whole in one task, together with others of about ``GROUP`` words;
a longer one is alone. Nothing is shuffled.

Cases: null and empty texts have no words, hence no runs; repeated rows come
back repeated; an empty table gives no rows; other columns are not read, so
their names do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_EXPONENT = 6, 4
GROUP, CHUNK = 100_000, 1024
RUNS = "array<struct<start:long,length:long,period:long>>"


class Positions:
    """Ordered numbers in chunks, so that an insertion moves few of them."""

    def __init__(self, x: int):
        self.chunks, self.heads, self.size = [[x]], [x], 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk

    def add(self, x: int) -> tuple[int, int]:
        """Insert x; its neighbours before and after (-1: none)."""
        k = max(bisect_left(self.heads, x) - 1, 0)
        chunk = self.chunks[k]
        at = bisect_left(chunk, x)
        before = chunk[at - 1] if at else -1  # x below the first chunk's head: nothing before
        after = chunk[at] if at < len(chunk) else self.heads[k + 1] if k + 1 < len(self.heads) else -1
        insort(chunk, x)
        self.heads[k] = chunk[0]
        self.size += 1
        if len(chunk) > 2 * CHUNK:
            self.chunks[k:k + 1] = [chunk[:CHUNK], chunk[CHUNK:]]
            self.heads[k:k + 1] = [chunk[0], chunk[CHUNK]]
        return before, after


def neighbours(ids: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with a common prefix of at least ``least``
    words: (p, q, its length). ids: dense word numbers, no number in two
    documents; ends: for each place, one past the last word of its document."""
    n = len(ids)
    count = np.bincount(ids)
    rank = (np.cumsum(count) - count)[ids].astype(np.int32)  # of the first suffix of the same class
    levels, open_, step = [rank], np.flatnonzero(count[ids] > 1), 1
    while len(open_):
        then = open_ + step
        second = np.where(then < ends[open_], rank[np.minimum(then, n - 1)], -1)
        order = np.lexsort((second, rank[open_]))
        open_, second = open_[order], second[order]
        first = rank[open_]
        place = np.arange(len(open_))
        group = np.r_[True, first[1:] != first[:-1]]
        part = group | np.r_[True, second[1:] != second[:-1]]
        group_at, part_at = (np.maximum.accumulate(np.where(x, place, 0)) for x in (group, part))
        rank = rank.copy()
        rank[open_] = first + part_at - group_at
        levels.append(rank)
        sizes = np.diff(np.r_[np.flatnonzero(part), len(open_)])
        open_ = open_[np.repeat(sizes > 1, sizes)]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    p, q = order[:-1], order[1:]
    whole = min(least.bit_length() - 1, len(levels) - 1)  # the longest level that such neighbours must share
    same = levels[whole][p] == levels[whole][q]
    p, q = p[same], q[same]
    shared = np.zeros(len(p), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = p + shared, q + shared
        inside = (x < ends[p]) & (y < ends[q])
        equal = levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]
        shared += (inside & equal) << k
    enough = shared >= least
    return p[enough], q[enough], shared[enough]


def runs_of(ids: np.ndarray, ends: np.ndarray, starts: np.ndarray, min_length: int = MIN_LENGTH,
            min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. starts: for
    each place the first word of its document."""
    if len(ids) < min_length:
        return []
    least = min(max(min_length - period, (min_exponent - 1) * period) for period in range(1, min_length + 1))
    p, q, shared = neighbours(ids, ends, least)
    down = np.argsort(-shared, kind="stable")
    parent: dict[int, int] = {}
    held: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        if x not in parent:
            parent[x], held[x] = x, Positions(x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(x: int, y: int, common: int) -> None:
        period = y - x
        if period + common >= max(min_length, min_exponent * period) and (x == starts[x] or ids[x - 1] != ids[y - 1]):
            key = (x, period + common)
            found[key] = min(period, found.get(key, period))

    for a, b, common in zip(p[down].tolist(), q[down].tolist(), shared[down].tolist()):
        a, b = root(a), root(b)
        if held[a].size < held[b].size:
            a, b = b, a
        parent[b], large, small = a, held[a], list(held.pop(b))
        for k, x in enumerate(small):
            before, after = large.add(x)
            if before >= 0 and not (k and before == small[k - 1]):
                seed(before, x, common)
            if after >= 0 and not (k + 1 < len(small) and small[k + 1] < after):
                seed(x, after, common)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    gone = np.cumsum(depth[:-1]) > 0
    return [w for w, g in zip(words, gone) if not g]


def _grouped(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of some consecutive rows). bytes.split cuts at the
    bytes 9 to 13 and 32, as ``[^\\x20\\x09-\\x0D]+`` does."""
    first, group, size = 0, [], 0
    for k in range(len(texts)):
        words = (texts[k].as_py() or b"").split()
        if group and size + len(words) > GROUP:
            yield first, group
            first, group, size = k, [], 0
        group.append(words)
        size += len(words)
    if group:
        yield first, group


def _found(group: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some documents."""
    numbers, base = [], 0
    for words in group:
        seen: dict[bytes, int] = {}
        numbers.append(np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64) + base)
        base += len(seen)
    lengths = np.array([len(w) for w in group])
    cuts = np.r_[0, np.cumsum(lengths)]
    starts, ends = np.repeat(cuts[:-1], lengths), np.repeat(cuts[1:], lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in group]
    if cuts[-1]:
        for start, length, period in runs_of(np.concatenate(numbers), ends, starts, min_length, min_exponent):
            k = int(np.searchsorted(cuts, start, side="right")) - 1
            out[k].append((start - int(cuts[k]), length, period))
    return out


def _mapped(key: str, min_length: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in _grouped(batch["text"].cast(pa.large_binary())):
                runs = _found(group, min_length, min_exponent)
                flat = [r for x in runs for r in x]
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in runs])].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
                kept = pa.array([b" ".join(collapse(w, x)).decode() for w, x in zip(group, runs)], pa.large_string())
                sizes = pa.array([len(w) for w in group], pa.int64())
                yield pa.record_batch([batch[key].slice(first, len(group)), sizes, lists, kept.cast(pa.string())],
                                      names=[key, "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of docs: key, n_words, runs (by start, then period) and
    collapsed, the text whose runs keep their first period only, words joined
    by one space."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")
    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key), F.col("text"))
            .mapInArrow(_mapped(key, min_length, min_exponent), f"`{key}` {kind}, n_words long, runs {RUNS}, collapsed string"))


def longest(runs: str = "runs") -> list:
    """Columns of the longest run (ties: least start, then least period; no
    run: nulls): start, length, period, exponent_milli."""
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r.length).alias("l"), r.start.alias("s"), r.period.alias("p"))))
    return [best.s.alias("start"), (-best.l).alias("length"), best.p.alias("period"),
            F.floor(F.expr("1000L") * -best.l / best.p).cast("long").alias("exponent_milli")]
