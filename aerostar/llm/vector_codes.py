"""Codes of vectors: a product quantiser in integers.

A vector is cut into ``parts`` equal consecutive parts; each part becomes the
number of the nearest entry of the codebook of its position. Components are
``floor(SCALE * x)``, and everything after that is integer arithmetic, so codes
and codebooks are the same whatever the partitions and their order.

Method, slice and intersect. For each dimension of a codebook the entries'
coordinates are sorted, and every prefix of that order carries a mask with a bit
for each of its entries (64-bit words). A radius r around a part selects, in
each dimension, the entries of a range of coordinates: the mask of the prefix
up to x + r without that up to x - r, two binary searches and no look at an
entry. The masks of all dimensions ANDed leave the entries in the cube around
the part, a superset of those in the ball; only these get a distance. The
radius begins at the root mean square error of the last round (first round: at
half the mean distance between entries). A part whose cube is empty doubles
its radius; one whose best candidate lies beyond r takes that distance as its
radius; a best distance within r proves that nothing outside the cube is nearer
or as near, so the result is exact, ties to the lower index included.

Each round is one pass over the staged integer vectors; what leaves a task is a
sum and a count for each component of each entry, so the shuffle and the driver
hold parts x entries x width numbers whatever the table's size. The codebooks
travel to the tasks (bounded by the same product).

Cases: vectors that are null, empty, or hold null or non-finite components are
dropped. Integers saturate at a bound that keeps every sum of squares in 64
bits (2**27 for 64 components). A length that ``parts`` does not divide is
padded with zeros; rows whose length differs from that of the kept vector of
least id are dropped. Null ids come last among the first codebook's rows, equal
ids go by their components. Fewer kept rows than entries: fewer entries. Repeated
rows come back repeated. An empty table gives no rows. Only the id and the vector
are read; other columns are passed on by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
ROWS = 8192

#: Codebooks: (parts, entries, width) integers.
Books = np.ndarray


class Slices:
    """One codebook, prepared for searches."""

    def __init__(self, entries: np.ndarray):
        n, width = entries.shape
        self.entries, self.words = entries, -(-n // 64)
        self.sorted, self.prefix = [], []
        for d in range(width):
            order = np.argsort(entries[:, d], kind="stable")
            masks = np.zeros((n + 1, self.words), dtype=np.uint64)
            for k, e in enumerate(order):
                masks[k + 1] = masks[k]
                masks[k + 1, e // 64] |= np.uint64(1) << np.uint64(e % 64)
            self.sorted.append(entries[order, d])
            self.prefix.append(masks)

    def cube(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within radius in every dimension."""
        out = np.full((len(x), self.words), ~np.uint64(0))
        for d, (coordinates, prefix) in enumerate(zip(self.sorted, self.prefix)):
            low = np.searchsorted(coordinates, x[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, x[:, d] + radius, side="right")
            out &= prefix[high] & ~prefix[low]
        return out

    def nearest(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row of x."""
        n = len(self.entries)
        best, error = np.zeros(len(x), dtype=np.int64), np.full(len(x), -1, dtype=np.int64)
        reach = np.full(len(x), max(1, radius), dtype=np.int64)
        left = np.arange(len(x))
        while len(left):
            masks = self.cube(x[left], reach[left])
            bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :n]
            row, entry = np.nonzero(bits)  # rows ascending, entries ascending within a row
            apart = ((x[left[row]] - self.entries[entry]) ** 2).sum(axis=1)
            order = np.lexsort((entry, apart, row))
            some, at = np.unique(row[order], return_index=True)
            held = left[some]
            best[held], error[held] = entry[order][at], apart[order][at]
            done = np.zeros(len(left), dtype=bool)
            done[some] = error[held] <= reach[held] ** 2
            wider = reach[left] * 2
            wider[some] = np.ceil(np.sqrt(error[held].astype(np.float64))).astype(np.int64) + 1
            reach[left] = wider
            left = left[~done]
        return best, error


def limit(width: int) -> int:
    """Bound of the integers: the squared distance of two vectors stays below 2**62."""
    return isqrt((1 << 62) // width) // 2


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the kept columns and the integer vector (``ints``) of the usable rows."""
    n = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(_usable(F.col("v"))).orderBy(
        F.col("id").asc_nulls_last(), F.size("v"), "v").select(F.size("v").alias("n")).head()
    size = n["n"] if n else parts
    width = -(-size // parts) * parts
    bound = float(limit(width))
    whole = F.transform(F.col(vector), lambda x: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), x.cast("double") * SCALE))).cast("long"))
    padded = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), width - size))
    return (vectors.where(_usable(F.col(vector)) & (F.size(vector) == size))
            .select(F.col(key), *keep, padded.alias("ints")))


def _usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite)


def first_books(ints: DataFrame, key: str, parts: int = PARTS, entries: int = ENTRIES) -> Books:
    """The parts of the ``entries`` rows of least key (that many reach the driver)."""
    rows = ints.select(F.col(key).alias("k"), "ints").orderBy(F.col("k").asc_nulls_last(), "ints").limit(entries).collect()
    if not rows:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    x = np.array([r["ints"] for r in rows], dtype=np.int64)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2).copy()


def spread(books: Books) -> list[int]:
    """Half the mean distance between entries of each codebook: the first radius."""
    apart = np.sqrt(((books[:, :, None, :] - books[:, None, :, :]).astype(np.float64) ** 2).sum(axis=3))
    return [int(a.mean() / 2) for a in apart]


def _parts(column: pa.Array, books: Books) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, books.shape[0], books.shape[2])
    for at in range(0, len(flat), ROWS):
        yield flat[at:at + ROWS]


def _sums(books: Books, radius: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        parts, entries, width = books.shape
        total = np.zeros((parts, entries, width), dtype=np.int64)
        count, error = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries))
        for batch in batches:
            for x in _parts(batch["ints"], books):
                for p, s in enumerate(slices):
                    best, apart = s.nearest(x[:, p], radius[p])
                    np.add.at(total[p], best, x[:, p])
                    count[p] += np.bincount(best, minlength=entries)
                    error[p] += np.bincount(best, weights=apart.astype(np.float64), minlength=entries)
        p, e = np.nonzero(count)
        yield pa.record_batch([pa.array(np.repeat(p, width)), pa.array(np.repeat(e, width)), pa.array(np.tile(np.arange(width), len(p))),
                               pa.array(total[p, e].ravel()), pa.array(np.repeat(count[p, e], width)), pa.array(np.repeat(error[p, e], width))],
                              names=["part", "entry", "place", "total", "n", "error"])
    return run


def train(ints: DataFrame, books: Books, rounds: int = ROUNDS) -> tuple[Books, list[int]]:
    """Codebooks after the rounds, and the radius at which the next search begins."""
    radius = spread(books)
    for _ in range(rounds):
        sums = (ints.select("ints").mapInArrow(_sums(books, radius), "part long, entry long, place long, total long, n long, error double")
                .groupBy("part", "entry", "place")
                .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"), F.sum("error").alias("error")))
        books, spent, seen = books.copy(), np.zeros(len(books)), np.zeros(len(books))
        for r in sums.collect():  # a row for each component of a used entry; one job (an iterator runs one a partition)
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
            spent[r["part"]] += r["error"]
            seen[r["part"]] += r["n"]
        radius = [int(np.sqrt(s / n)) if n else 1 for s, n in zip(spent, seen)]
    return books, radius


def _coded(books: Books, radius: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            codes, errors = [], []
            for x in _parts(batch["ints"], books):
                found = [s.nearest(x[:, p], radius[p]) for p, s in enumerate(slices)]
                hexes = np.stack([b for b, _ in found], axis=1).astype(np.uint8)
                codes += [c.tobytes().hex() for c in hexes]
                errors.append(np.sum([e for _, e in found], axis=0))
            yield pa.record_batch([*(batch[c] for c in names), pa.array(codes, pa.string()),
                                   pa.array(np.concatenate(errors) if errors else np.zeros(0, np.int64))], names=[*names, "code", "error"])
    return run


def encode(ints: DataFrame, books: Books, radius: list[int]) -> DataFrame:
    """The columns of ints without the vector, code (two hex digits a part) and error."""
    names = [c for c in ints.columns if c != "ints"]
    kinds = "".join(f"`{c}` {ints.schema[c].dataType.simpleString()}, " for c in names)
    return ints.mapInArrow(_coded(books, radius, names), f"{kinds}code string, error long")


def compress(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, keep: tuple[str, ...] = ()) -> tuple[DataFrame, Books]:
    """(key, kept columns, code, error) of the usable vectors, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    ints = staged(spark, integers(vectors, key, vector, parts, keep), "vector-ints")
    books = first_books(ints, key, parts, entries)
    if not books.size:
        kinds = "".join(f"`{c}` {ints.schema[c].dataType.simpleString()}, " for c in ints.columns if c != "ints")
        return spark.createDataFrame([], f"{kinds}code string, error long"), books
    books, radius = train(ints, books, rounds)
    return encode(ints, books, radius), books


def decode(codes: DataFrame, books: Books) -> DataFrame:
    """codes with ``approx``: the components the code stands for."""
    entry = F.create_map(*[x for p, book in enumerate(books) for e, values in enumerate(book)
                           for x in (F.lit(f"{p}:{e:02x}"), F.array(*[F.lit(float(v) / SCALE) for v in values]))])
    each = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)),
                       lambda p: F.element_at(entry, F.concat(p.cast("string"), F.lit(":"), F.substring("code", p * 2 + 1, F.lit(2)))))
    return codes.withColumn("approx", F.flatten(each))
