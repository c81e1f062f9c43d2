"""Embedding near-dedup: all pairs of vectors with cosine 0.9 or more, as link
counts and components.

Method, pigeonhole over subspaces. Unit vectors with cosine c lie at squared
distance 2 - 2c, so a link is a pair within a budget of ``2 - 2 * COSINE``. The
vectors are rotated (principal axes of a sample, dealt to the blocks in turn, so
blocks have about equal shares and begin with their widest axes) and split into
blocks of ``WIDTH`` dimensions. The budget is shared out to the blocks in
proportion to their variance; a pair within the whole budget is within the
share of one block at least. So each block is joined by range: a grid over its
first ``GRID`` axes with cells as wide as the block's radius sends a vector to its
own cell and to the later neighbours that its ball reaches; pairs of a cell are
held against the block's share, and the first block a pair fits decides it,
exactly: by the cosine of the given vectors in double precision. (The sample
only turns the axes and picks pivots. Any rotation and any pivots give the same
result; they decide how much work it takes.)

Dense groups. Equal vectors are one node. Of the rest, whatever lies within half
the link angle of one of ``PIVOTS`` sampled nodes belongs to the core of the
nearest one: by the triangle inequality the members of a core are all linked with
each other, so they are counted by the size of the core and never paired. A
vector outside a core that could reach a member (its angle to the pivot is at
most one and a half link angles) is compared with the members. So a group of near
copies that holds a third of all rows is pivoted with near certainty and costs
its size, not the square; only vectors outside cores go through the grid. Groups
too small to be sampled, and wide ones, are compared pair by pair in blocks of
``CHUNK``.

What is shuffled: nodes in blocks of at most about ``CHUNK`` rows a side, so no
task holds more however full a cell is. Pairs never leave a task: it returns a
count and a spanning star per node. To the driver come the sample and its
rotation (``SAMPLE`` x dimensions), and sums.

Where vectors fill all directions evenly, cells as wide as a radius are wide:
with 64 even dimensions at cosine 0.9 a cell and its neighbours hold more than
half of the vectors outside cores. The join is then a blocked comparison of most
pairs over the dimensions of a block; it gets selective as the axes get uneven.

Cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing (component: the own id). Vectors of different lengths never
link. Repeated rows and ids are vectors of their own, so copies link with each
other. A null id names a component only if it has no other id. Empty table: no
rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from .components import components
from .staging import staged

COSINE, WIDTH, GRID = 0.9, 16, 2
SAMPLE, PIVOTS, CHUNK = 2048, 512, 16384
#: Slack of tests that must not lose a pair to rounding; decisions have none.
SLACK = 1e-7
SIDE = 1024


class Plan:
    """The rotation, the blocks' shares of the budget, and the pivots."""

    def __init__(self, sample: np.ndarray, lengths: np.ndarray, cosine: float):
        size = sample.shape[1]
        self.size, self.cosine = size, cosine
        centred = sample - sample.mean(axis=0)
        spread, axes = np.linalg.eigh(centred.T @ centred / len(sample))
        order = np.argsort(-spread, kind="stable")
        m = max(1, -(-size // WIDTH))
        dealt = [order[b::m] for b in range(m)]
        self.rotation = axes[:, np.concatenate(dealt)]
        self.cuts = np.cumsum([0] + [len(d) for d in dealt])
        share = np.array([max(spread[d].sum(), 0.0) for d in dealt]) + 1e-6
        self.budget = (2 - 2 * cosine) * share / share.sum() + 1e-12
        self.pivots, self.pivot_lengths = sample[:PIVOTS], lengths[:PIVOTS]
        link = np.arccos(cosine)
        self.core = np.cos(link / 2 - 1e-6)
        self.reach = np.cos(min(1.5 * link + 1e-6, np.pi))

    def block(self, b: int) -> slice:
        return slice(self.cuts[b], self.cuts[b + 1])

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """Term by term, so that a vector's result is the same in every task
        (products of matrices may add in an order that depends on the batch)."""
        out = np.zeros_like(x)
        for d in range(self.size):
            out += x[:, d:d + 1] * self.rotation[d]
        return out


def units(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in doubles, filled up with zeros, and their lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = np.zeros((len(lengths), size))
    x[np.arange(size)[None, :] < lengths[:, None]] = flat
    if len(x):
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, lengths


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


PLACES = "array<struct<kind:int,a:long,b:long,home:boolean>>"


def _placed(plan: Plan):
    """(node, vec, copies, least) -> with core (its pivot) and places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x, lengths = units(batch["vec"], plan.size)
                near = np.where(lengths[:, None] == plan.pivot_lengths, x @ plan.pivots.T, -2.0)
                best = near.argmax(axis=1)
                inside = near[np.arange(len(x)), best] >= plan.core
                core = np.where(inside, best, -1)
                near[np.arange(len(x)), best] = np.where(inside, -2.0, near[np.arange(len(x)), best])  # the own core is settled
                row, pivot = np.nonzero(near >= plan.reach)
                members = np.flatnonzero(inside)
                found = [(row, np.full(len(row), -1), pivot, np.zeros(len(row), np.int64), np.zeros(len(row), bool)),
                         (members, np.full(len(members), -1), best[members], np.zeros(len(members), np.int64), np.ones(len(members), bool))]
                free = np.flatnonzero(~inside)
                y = plan.rotate(x[free])
                for b in range(len(plan.budget)):
                    found += _cells(free, y[:, plan.block(b)], float(np.sqrt(plan.budget[b])) + SLACK, b)
                row, kind, a, c, home = (np.concatenate([f[k] for f in found]) for k in range(5))
                order = np.argsort(row, kind="stable")
                places = pa.StructArray.from_arrays(
                    [pa.array(kind[order], pa.int32()), pa.array(a[order], pa.int64()), pa.array(c[order], pa.int64()), pa.array(home[order])],
                    ["kind", "a", "b", "home"])
                offsets = np.searchsorted(row[order], np.arange(len(x) + 1)).astype(np.int32)
                yield pa.record_batch([*(batch[k] for k in ("node", "vec", "copies", "least")), pa.array(core, pa.int32(), mask=core < 0),
                                       pa.ListArray.from_arrays(pa.array(offsets), places)],
                                      names=["node", "vec", "copies", "least", "core", "places"])
    return run


def _cells(row: np.ndarray, y: np.ndarray, radius: float, block: int) -> list[tuple]:
    """The home cell of each vector, and the later neighbour cells within radius."""
    y = y[:, :GRID]
    cell = np.floor(y / radius).astype(np.int64)
    if y.shape[1] < 2:
        cell = np.c_[cell, np.zeros(len(cell), np.int64)]
        y = np.c_[y, np.zeros(len(y))]
    below = y - cell * radius
    out = [(row, np.full(len(row), block), cell[:, 0], cell[:, 1], np.ones(len(row), bool))]
    for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1)):
        gap = sum({0: 0, 1: radius - below[:, k], -1: below[:, k]}[d] ** 2 for k, d in enumerate((dx, dy)))
        some = gap <= (radius + SLACK) ** 2
        out.append((row[some], np.full(int(some.sum()), block), cell[some, 0] + dx, cell[some, 1] + dy, np.zeros(int(some.sum()), bool)))
    return out


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a and b; label holds the least member of each class."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def _tile(plan: Plan):
    """Vectors of two sides (left; right, or none: the left with itself) ->
    node, links found here, least node of its class here."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("left", "descending"), ("node", "ascending")])
        x, lengths = units(group["vec"], plan.size)
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        free = group["free"].to_numpy().astype(bool)
        kind, n, m = group["kind"][0].as_py(), len(x), int(np.sum(group["left"].to_numpy()))
        y = plan.rotate(x) if kind >= 0 else x
        links, label = np.zeros(n, dtype=np.int64), np.arange(n)
        itself = m == n
        for i in range(0, m, SIDE):
            for j in range(i if itself else m, n, 4 * SIDE):
                left, right = slice(i, min(i + SIDE, m)), slice(j, min(j + 4 * SIDE, n))
                p, q = np.nonzero(_candidates(plan, kind, x, y, left, right))
                p, q = p + left.start, q + right.start
                if itself:
                    p, q = p[p < q], q[p < q]
                for at in range(0, len(p), 65536):
                    a, b = _linked(plan, kind, x, y, lengths, p[at:at + 65536], q[at:at + 65536])
                    np.add.at(links, b, copies[a])
                    # a member of a core counts its probes from other cores where these are members
                    np.add.at(links, a, copies[b] if kind >= 0 else np.where(free[b], copies[b], 0))
                    unite(label, a, b)
        some = (links > 0) | (label != np.arange(n))
        return pa.table({"node": pa.array(node[some], pa.int64()), "links": pa.array(links[some], pa.int64()),
                         "root": pa.array(node[label[some]], pa.int64())})
    return run


def _candidates(plan: Plan, kind: int, x: np.ndarray, y: np.ndarray, left: slice, right: slice) -> np.ndarray:
    if kind < 0:
        return x[left] @ x[right].T >= plan.cosine - SLACK
    b = plan.block(kind)
    u, v = y[left, b], y[right, b]
    return (u * u).sum(axis=1)[:, None] + (v * v).sum(axis=1) - 2 * (u @ v.T) <= plan.budget[kind] + SLACK


def _linked(plan: Plan, kind: int, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, p: np.ndarray,
            q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are links and, in a block's cell, whose first fitting
    block it is."""
    good = lengths[p] == lengths[q]
    if kind >= 0:
        for b in range(kind + 1):
            apart = ((y[p, plan.block(b)] - y[q, plan.block(b)]) ** 2).sum(axis=1)
            good &= (apart <= plan.budget[b]) == (b == kind)
    p, q = p[good], q[good]
    near = (x[p] * x[q]).sum(axis=1) >= plan.cosine
    return p[near], q[near]


def _plan(nodes: DataFrame, cosine: float) -> Plan | None:
    """Fitted on the SAMPLE nodes of least hash (of a part that holds about
    four times as many, so that no task sorts them all)."""
    n, size = nodes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return None
    mark = F.xxhash64("vec")
    part = nodes.where(F.pmod(mark, F.lit(max(1, n // (4 * SAMPLE)))) == 0) if n > 8 * SAMPLE else nodes
    rows = part.select("vec", mark.alias("mark")).orderBy("mark", "vec").limit(SAMPLE).collect()
    x, lengths = units(pa.array([r["vec"] for r in rows], pa.list_(pa.float64())), size)
    return Plan(x, lengths, cosine)


def links(spark: SparkSession, nodes: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """nodes (node, vec, copies, least) -> (per node: node, copies, least,
    vec, n_links to other nodes' rows; edges (a, b) that connect each
    component)."""
    placed = staged(spark, nodes.mapInArrow(_placed(plan), f"{_kinds(nodes)}, core int, places {PLACES}"), "subspace-places")
    each = placed.select("node", F.explode("places").alias("at")).select("node", "at.*")
    filled = each.groupBy("kind", "a", "b").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("probes"))
    filled = filled.where("homes > 0 and (probes > 0 or (kind >= 0 and homes > 1))").select(
        "kind", "a", "b", F.ceil(F.col("homes") / CHUNK).cast("int").alias("hc"), F.ceil(F.col("probes") / CHUNK).cast("int").alias("pc"))
    filled = staged(spark, filled, "subspace-cells")
    if fits_broadcast(filled):  # a row per cell in use
        filled = F.broadcast(filled)

    mine = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    upto = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    hc, pc, zero = F.col("hc"), F.col("pc"), F.lit(0)
    own = mine(hc)
    home_left = F.transform(upto(F.when(F.col("kind") < 0, hc).otherwise(own), hc + pc), lambda j: tile(own, j, True))
    home_right = F.transform(upto(zero, F.when(F.col("kind") < 0, zero).otherwise(own)), lambda i: tile(i, own, False))
    probe = F.transform(upto(zero, hc), lambda i: tile(i, hc + mine(F.greatest(pc, F.lit(1))), False))
    to = F.when(F.col("home"), F.concat(home_left, home_right)).otherwise(probe)
    dealt = (placed.select("node", "vec", "copies", F.col("core").isNull().alias("free"), F.explode("places").alias("at"))
             .select("node", "vec", "copies", "free", "at.*").join(filled, ["kind", "a", "b"])
             .select("kind", "a", "b", "node", "vec", "copies", "free", F.explode(to).alias("to"))
             .select("kind", "a", "b", "to.i", "to.j", "to.left", "node", "vec", "copies", "free"))
    found = staged(spark, dealt.groupBy("kind", "a", "b", "i", "j").applyInArrow(_tile(plan), "node long, links long, root long"),
                   "subspace-links")

    cores = staged(spark, placed.where("core is not null").groupBy("core")
                   .agg(F.sum("copies").alias("all"), F.min("node").alias("first")), "subspace-cores")  # a row per pivot
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    counted = (placed.select("node", "copies", "least", "vec", "core").join(F.broadcast(cores), "core", "left").join(sums, "node", "left")
               .select("node", "copies", "least", "vec", "first",
                       (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("all") - F.col("copies"), F.lit(0))).alias("links")))
    counted = staged(spark, counted, "subspace-counted")
    edges = (found.where("root != node").select(F.col("node").alias("a"), F.col("root").alias("b"))
             .unionByName(counted.where("first != node").select(F.col("node").alias("a"), F.col("first").alias("b"))))
    return counted.drop("first"), edges


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def near_vectors(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """One row per row of vectors: key, n_links, component_id, kept."""
    if not 0 < cosine < 1:
        raise ValueError("the cosine of a link lies between 0 and 1")
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    nodes = (rows.where(usable(F.col("vec"))).groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
             .select(F.monotonically_increasing_id().alias("node"), "vec", "copies", "least"))
    nodes = staged(spark, nodes, "subspace-nodes")  # fixes the numbers
    alone = rows.where(~F.coalesce(usable(F.col("vec")), F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    plan = _plan(nodes, cosine)
    if plan is None:
        out = alone
    else:
        counted, edges = links(spark, nodes, plan)
        root = components(spark, edges).withColumnRenamed("vertex", "node")
        placed = staged(spark, counted.join(root, "node", "left")
                        .select("vec", "copies", "least", "links", F.coalesce("root", "node").alias("root")), "subspace-rooted")
        named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        done = staged(spark, placed.join(named, "root").select(
            "vec", "copies", "least", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "subspace-done")
        out = alone.unionByName(done.where("copies = 1").select(F.col("least").alias("id"), "n_links", "component_id"))
        several = done.where("copies > 1").select("vec", "n_links", "component_id")
        if not several.isEmpty():
            out = out.unionByName(rows.join(several, "vec").select("id", "n_links", "component_id"))
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
