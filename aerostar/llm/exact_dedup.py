"""Exact dedup by a stateful stream.

A structured stream of fingerprints keeps, per digest, a state that never
expires: how many rows were seen, and of the row that stays its stable
identifier and content locator (file and row in the source). The state is a
streaming aggregation without a watermark in the RocksDB state store, so it
lives on disk, survives restarts through the checkpoint, and every batch is
combined before it reaches a key's state: a digest held by a third of all rows
sends one row per task.

Equal digests are only hits. Every hit is checked on full bytes: the locator
fetches the text of the row that stays, and each other row of the digest is
compared with it. Rows whose bytes differ (a collision) are grouped among
themselves by their full text.

Of equal texts the row with the largest id stays; among rows with that id, the
one with the largest locator. So exactly one row stays, also of rows that are
equal in every column.

Cases: null text counts as empty; a null id is the smallest, and stays only if
its text has no other id; an empty table gives no rows. Frames that do not
read files are staged first, so that their rows have locators. Input columns
whose names clash with the results' are not affected: ``distinct_rows`` returns
the input's own columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_dir
from .staging import staged

FILES_PER_BATCH = 1024
#: State on disk; without files that reserve megabytes for every state partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows of docs as one column (``given``, a struct) with __file and __row,
    which name a row of the source's files. No name in docs can clash with them.
    Where docs has no files, or a column hides their metadata, it is staged."""
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    if "_metadata" not in (c.lower() for c in docs.columns):
        try:
            return docs.select(given, *place)
        except AnalysisException:  # no files below
            pass
    return staged(spark, docs.select(given), "dedup-input").select("given", *place)


def fold(spark: SparkSession, prints: DataFrame, state: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Run a folder of fingerprints (__digest, __id, __file, __row) through the
    state and return its last word on every digest: __digest, n, stay.

    Batch b appends the digests that it changed under ``batch=b``; a batch that
    is run again after a failure overwrites its own folder."""
    log, kind = f"{state}/log", f"__digest string, n long, stay {_stay_type(prints)}"
    spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{log}/batch=-1")  # a stream without rows runs no batch
    source = (spark.readStream.schema(prints.schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(prints.inputFiles()[0].rsplit("/", 1)[0]))
    stay = F.struct(F.col("__id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row"))
    held = source.groupBy("__digest").agg(F.count(F.lit(1)).alias("n"), F.max(stay).alias("stay"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        query = (held.writeStream.outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", f"{state}/checkpoint").foreachBatch(write).start())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    words = spark.read.schema(f"{kind}, batch long").parquet(log)
    return (words.groupBy("__digest").agg(F.max(F.struct("batch", "n", "stay")).alias("w"))
            .select("__digest", "w.n", "w.stay"))


def _stay_type(prints: DataFrame) -> str:
    return f"struct<id:{prints.schema['__id'].dataType.simpleString()},file:string,row:bigint>"


def groups(spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256,
           files_per_batch: int = FILES_PER_BATCH) -> tuple[DataFrame, DataFrame]:
    """(rows, verdicts). rows: docs with locators (``located``). verdicts, one per row:
    __file, __row, __id, __digest, n (rows of equal text), stay."""
    rows = located(spark, docs)
    text = F.coalesce("given.text", F.lit(""))
    prints = staged(spark, rows.select(digest(text).alias("__digest"), F.col("given.doc_id").alias("__id"), "__file", "__row"), "fingerprints")
    state = staged(spark, fold(spark, prints, stage_dir(spark, "llm-dedup-state"), files_per_batch), "dedup-groups")
    several = staged(spark, state.where("n > 1"), "dedup-hits")

    # The text of every hit, the rows that stay among them, moves once. (The
    # merge hint keeps one plan at every size.)
    hits = prints.join(several, "__digest")  # every row whose digest was seen more than once
    hits = staged(spark, rows.select("__file", "__row", text.alias("__text")).join(hits.hint("merge"), ["__file", "__row"]), "dedup-hits-texts")
    kept = hits.where(_stays()).select("__digest", F.col("__text").alias("__kept"))
    checked = hits.join(kept.hint("merge"), "__digest").withColumn("__equal", F.col("__text") == F.col("__kept"))
    checked = staged(spark, checked.select("__file", "__row", "__id", "__digest", "n", "stay", "__equal",
                                           F.when(~F.col("__equal"), F.col("__text")).alias("__text")), "dedup-checked")
    single = prints.join(several.select("__digest"), "__digest", "left_anti")
    columns = ["__file", "__row", "__id", "__digest"]
    alone = single.select(*columns, F.lit(1).cast("long").alias("n"), _own(prints))
    clash = staged(spark, checked.where("not __equal").select("__digest").distinct(), "dedup-collisions")
    if clash.isEmpty():
        return rows, alone.unionByName(checked.select(*columns, "n", "stay"))
    apart = _apart(spark, checked, clash, columns)
    clean = checked.join(clash, "__digest", "left_anti").select(*columns, "n", "stay")
    return rows, alone.unionByName(clean).unionByName(apart)


def _own(prints: DataFrame) -> Column:
    return F.struct(F.col("__id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row")).cast(_stay_type(prints)).alias("stay")


def _apart(spark: SparkSession, checked: DataFrame, clash: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of colliding digests, grouped by digest and full text (null: the
    text of the row that stays)."""
    mixed = checked.join(clash, "__digest").select(*columns, "__text")
    by_text = mixed.groupBy("__digest", "__text").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(
        F.col("__id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row"))).alias("stay"))
    by_text = staged(spark, by_text, "dedup-apart").withColumnsRenamed({"__digest": "__d", "__text": "__t"})
    return (mixed.join(by_text, (F.col("__digest") == F.col("__d")) & F.col("__text").eqNullSafe(F.col("__t")))
            .select(*columns, "n", "stay"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256,
                     files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, digest."""
    _, verdicts = groups(spark, docs, digest, files_per_batch)
    return verdicts.select(F.col("__id").alias("doc_id"), F.col("stay.id").alias("keep_id"), F.col("n").alias("group_size"),
                           _stays().alias("kept"), F.col("__digest").alias("digest"))


def _stays() -> Column:
    return (F.col("stay.file") == F.col("__file")) & (F.col("stay.row") == F.col("__row"))


def distinct_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with the columns of docs."""
    rows, verdicts = groups(spark, docs)
    gone = verdicts.where(~_stays()).select("__file", "__row")
    return rows.join(gone, ["__file", "__row"], "left_anti").select("given.*")
