"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target number of words. Over training time t in [0, 1] its
weight is ``target * (1 + tilt * (2 t - 1))``; the integral up to t is its
cumulative demand, ``target * ((1 - tilt) t + tilt t^2)``. A document that
starts after c words of its source's stream is due when that demand reaches c,
so its position is the inverse of the integral. A source whose target exceeds
its size is read again: pass p of a document starts after ``p * source_size``
more words and has a position of its own, so all of the demand is inverted. The
mix is one row per document and pass, range-sorted by position (``schedule``).
DataFrame functions only.

Sizes are words ``[^\\x20\\x09-\\x0D]+``; weights (3, 1, 2, repeating) go to
the sources by code point, null last. The targets share ``budget`` times all
words by weight; none exceeds ``cap`` times its source, and the excess is
shared again by weight. A source's stream is its documents in the order of a
hash of the id, again from the start on each further pass; the document at
which the target is reached is taken in part, so a source's taken words equal
its target, rounded to whole words.

Skew: a source may hold a third of all rows. Its running sums are built from
4,096 hash buckets: totals per bucket by partial aggregates, a window over at
most 4,096 rows per source, and a window inside each (source, bucket).

Cases: null text has size 0; null source is a source of its own; an empty
table gives no rows; with no words at all, targets and taken are 0. Repeated
rows are separate documents. Input columns with the name of an output column
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import staged
from .words import WORD_PATTERN

WEIGHTS = (3, 1, 2)
TILTS = (0.5, 0.0, -0.5)  # late, even, early; repeating like the weights
BUDGET, CAP = 1.5, 2
OUTPUT = ("size", "source_size", "target", "taken", "position", "passes", "pass")


def size_of(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _cycle(rank, values) -> F.Column:
    """The value of a 1-based rank, repeating."""
    return F.element_at(F.array(*map(F.lit, values)), ((rank - 1) % len(values) + 1).cast("int"))


def targets(totals: DataFrame, weights=WEIGHTS, tilts=TILTS, budget=BUDGET, cap=CAP) -> DataFrame:
    """(source, source_size) -> with target and tilt. One row per source, so a
    window over all of them is over the list of sources only.

    Sources ordered by cap / weight fill up in that order. With the first k
    full, the rest share what is left at one level; k is the smallest number
    for which the level leaves the next source below its cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    return (totals.withColumn("rank", F.row_number().over(by_name))
            .withColumn("weight", _cycle(F.col("rank"), weights).cast("double"))
            .withColumn("tilt", _cycle(F.col("rank"), tilts).cast("double"))
            .withColumn("full", (F.lit(cap) * F.col("source_size")).cast("double"))
            .withColumn("all", F.lit(budget) * F.sum("source_size").over(everything))
            .withColumn("left", F.col("all") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("level", F.col("left") / F.col("open"))
            .withColumn("fits", F.col("level") * F.col("weight") <= F.col("full"))
            .withColumn("water", F.max(F.when(F.col("fits"), F.struct((-F.col("full") / F.col("weight")).alias("k"), F.col("level").alias("level")))).over(everything))
            .withColumn("target", F.coalesce(F.least("full", F.col("water.level") * F.col("weight")), F.col("full")))
            .select("source", "source_size", "target", "tilt"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, tilts=TILTS, budget=BUDGET, cap=CAP) -> DataFrame:
    """All rows of docs with size, source_size, target, taken (words, repeats
    counted), position (of the first pass, null where nothing is taken) and
    passes (pass, position and taken words of each pass that takes some; at
    most cap of them, rounded up), in no order; ``schedule`` sorts them. Taken
    never exceeds cap * size."""
    others = [c for c in docs.columns if c.lower() not in OUTPUT]
    given = F.struct(*[F.col(f"`{c}`") for c in others]).alias("given")  # no name in docs can clash with those below
    rows = docs.select(given, "doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("__tie"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    buckets = (rows.select("source", "size", F.substring(key, 1, 3).alias("__bucket"))
               .groupBy("source", "__bucket").agg(F.sum("size").alias("__words")))
    buckets = staged(spark, buckets, "mix-buckets")  # at most 4,096 rows per source

    plan = targets(buckets.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, tilts, budget, cap)
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("__start", F.coalesce(F.sum("__words").over(earlier), F.lit(0))).drop("__words")
    plan = (offsets.join(plan.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
            .select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), "__start", "source_size", "target", "tilt"))

    inside = (Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "__tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, 3))
              .withColumn("__before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(plan, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b"))))
    start = F.col("__start") + F.col("__before")
    whole = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    rest = whole - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    taken = (passes * F.col("size") + part).cast("long")
    slope = 1 - F.col("tilt")

    def position(n):
        due = F.when(F.col("target") > 0, F.least(F.lit(1.0), (start + n * F.col("source_size")) / F.col("target"))).otherwise(0.0)
        return F.round(F.when(F.col("tilt") == 0, due).otherwise(
            (F.sqrt(slope * slope + 4 * F.col("tilt") * due) - slope) / (2 * F.col("tilt"))), 9)

    def one_pass(n):
        return F.struct(n.cast("int").alias("pass"), position(n).alias("position"), F.when(n < passes, F.col("size")).otherwise(part).alias("taken"))

    every = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), passes), one_pass), lambda x: x.taken > 0)
    return (placed.withColumn("taken", taken)
            .withColumn("position", F.when(F.col("taken") > 0, position(F.lit(0))))
            .withColumn("passes", every)
            .select("given.*", *OUTPUT[:-1]))


def curriculum(mixed: DataFrame) -> DataFrame:
    """The documents of which the mix takes something, once each, range-sorted
    by the position of their first pass; ``schedule`` has all passes."""
    return mixed.where(F.col("taken") > 0).orderBy("position", "doc_id")


def schedule(mixed: DataFrame) -> DataFrame:
    """The mix: one row per document and pass that takes words, with the pass,
    its position and the words it takes, and the number of the document's such
    passes (``passes``), range-sorted by position."""
    others = [F.col(f"`{c}`") for c in mixed.columns if c not in ("pass", "position", "taken", "passes")]
    return mixed.select(*others, F.size("passes").alias("passes"), F.inline("passes")).orderBy("position", "doc_id", "pass")
