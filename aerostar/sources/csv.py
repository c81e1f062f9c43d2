"""Typed CSV scans.

Files are read with every column as text (the header gives the names; no
inference pass over the data) and each declared column is then converted by
name with ``try_cast``. That keeps extra columns and any column order
working, and a malformed value becomes null instead of failing the job under
ANSI; ``read_rejects`` lists what became null that way, and ``quarantine_csv``
divides the rows, in one pass, into those to load and those to set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from aerostar.operators.joins import fits_broadcast
from aerostar.schemas import HOTELS, LEGS
from aerostar.session import stage_dir


def read_typed_csv(spark: SparkSession, path: str | list[str], schema: StructType,
                   infer: bool = False, **options) -> DataFrame:
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    if infer:  # the original's behaviour: an extra pass over the data
        return reader.option("inferSchema", True).csv(path)
    return _typed(reader.csv(path), schema, path)


def _typed(raw: DataFrame, schema: StructType, path: str | list[str]) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"CSV at {path} lacks columns {missing}")
    return raw.select(*[_value(f).alias(f.name) for f in schema.fields])


def _value(f) -> Column:
    c = F.col(f"`{f.name}`")
    return c if isinstance(f.dataType, StringType) else c.try_cast(f.dataType)


def _problems(schema: StructType) -> Column:
    """column_name and value of each text that is no value of its column."""
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & _value(f).isNull(),
                  F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("value")))
           for f in schema.fields if not isinstance(f.dataType, StringType)]
    return F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<column_name:string,value:string>>")


def read_rejects(spark: SparkSession, path: str | list[str], schema: StructType, **options) -> DataFrame:
    """Values of a typed CSV that ``read_typed_csv`` reads as null although the
    file holds text there: ``column_name``, ``value`` and how often."""
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return (reader.csv(path).select(F.explode(_problems(schema)).alias("r"))
            .groupBy("r.column_name", "r.value").agg(F.count(F.lit(1)).alias("rows")))


#: Values of the status column of a quarantine.
LOADED, REJECTED = "loaded", "rejected"


def quarantine_csv(spark: SparkSession, path: str | list[str], schema: StructType, out: str,
                   critical: Sequence[str], **options) -> dict[str, int]:
    """Read once and write every row once below ``out``, by status: rejected
    where a critical column has no value (missing or malformed), else loaded.
    All rows carry ``problems``, their malformed values; rejected ones also the
    row as it is in the file (``row``, JSON). Returns how many rows landed, were
    loaded and were rejected, counted on the way; the run fails unless what is
    written adds up to them."""
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.csv(path)
    typed = _typed(raw, schema, path)  # checks the columns
    status = F.when(sum((_value(schema[c]).isNull().cast("int") for c in critical), F.lit(0)) > 0, REJECTED).otherwise(LOADED)
    tagged = raw.select(*[_value(f).alias(f.name) for f in schema.fields], _problems(schema).alias("problems"), status.alias("__status"),
                        F.when(status == REJECTED, F.to_json(F.struct(*raw.columns))).alias("row"))
    seen = Observation()
    counted = tagged.observe(seen, F.count(F.lit(1)).alias("landed"), F.count_if(F.col("__status") == LOADED).alias(LOADED),
                             F.count_if(F.col("__status") == REJECTED).alias(REJECTED))
    counted.write.mode("overwrite").partitionBy("__status").parquet(out)
    counts = {k: int(v) for k, v in seen.get.items()}
    written = dict(read_quarantine(spark, out, typed.schema).groupBy("__status").count().collect())
    if counts["landed"] != sum(written.values()) or any(counts[k] != written.get(k, 0) for k in (LOADED, REJECTED)):
        raise RuntimeError(f"{path}: {counts} rows were read, {written} are in {out}")
    return counts


def read_quarantine(spark: SparkSession, out: str, schema: StructType, status: str | None = None) -> DataFrame:
    """Rows of a quarantine, of one status or of both."""
    kind = "problems array<struct<column_name:string,value:string>>, row string, __status string"
    rows = spark.read.schema(StructType(schema.fields + StructType.fromDDL(kind).fields)).parquet(out)
    return rows if status is None else rows.where(F.col("__status") == status)


def read_legs(spark: SparkSession, path: str | list[str], schema: StructType = LEGS,
              infer: bool = False) -> DataFrame:
    """Flight legs CSV; ``path`` may be a glob (``file_part_*.csv``) to read many
    files as one table."""
    return read_typed_csv(spark, path, schema, infer=infer)


def read_hotels(spark: SparkSession, path: str | list[str], schema: StructType = HOTELS, split: bool = True) -> DataFrame:
    """Hotel rows CSV as a ``csv`` module writer leaves it: quotes doubled inside
    quoted fields and possible line breaks in labels. ``split=False`` reads each
    file in one task (``multiLine``)."""
    if split:
        return _typed(split_records(spark, path, escape='"'), schema, path)
    return read_typed_csv(spark, path, schema, escape='"', multiLine=True)


def split_records(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV with line breaks inside quoted fields as text columns, one file read
    by many tasks. (``multiLine`` gives a file of any size to one task.)

    Lines are read in splits, as plain text. A line belongs to the record before
    it where the quotes before it are odd in number; so all it takes are sums of
    quotes: within a split, and over the splits of a file (a row per split, and
    all that is broadcast). Splits without an odd line need nothing further; the
    lines of the others meet by split, and records that cross the end of a split
    are put together from its last and the next ones' first lines. The lines are
    staged once, which fixes the splits. Records end with a line feed, with or
    without a carriage return; the first of each file is its header."""
    reader = spark.read.option("header", True).option("multiLine", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    names = reader.csv(path).columns  # of the first file's header
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"), (quotes % 2).alias("odd")))
    staged = stage_dir(spark, "csv-lines")
    lines.write.parquet(staged)
    lines = spark.read.schema(lines.schema).parquet(staged)

    in_file = Window.partitionBy("file").orderBy("block")
    splits = (lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"), F.min("at").alias("first"))
              .withColumn("before", F.coalesce(F.sum("odds").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
              .withColumn("header", F.first("first").over(in_file)))
    path_of_splits = stage_dir(spark, "csv-splits")
    splits.write.parquet(path_of_splits)
    splits = spark.read.schema(splits.schema).parquet(path_of_splits)
    known = F.broadcast(splits) if fits_broadcast(splits) else splits
    lines = lines.join(known, ["file", "block"])
    plain = lines.where("odds = 0 and before = 0 and at != header").select(F.col("line").alias("record"))

    in_split = Window.partitionBy("file", "block").orderBy("at")
    open_ = (F.col("before") + F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2
    parts = (lines.where("odds > 0 or before = 1").withColumn("starts", (open_ == 0).cast("int"))
             .withColumn("n", F.sum("starts").over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("file", "block", "n")
             .agg(F.min("at").alias("at"), F.first("header").alias("header"), F.first("before").alias("before"), F.sum("odd").alias("odd"),
                  F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x.line), "\n").alias("record")))
    parts = parts.withColumn("head", F.col("n") == 0).withColumn("cut", F.col("head") | (F.col("odd") % 2 == 1))
    path_of_parts = stage_dir(spark, "csv-parts")
    parts.write.parquet(path_of_parts)  # the records of the splits that hold line breaks
    parts = spark.read.schema(parts.schema).parquet(path_of_parts)
    whole = parts.where("not cut and at != header").select("record")
    ordered = Window.partitionBy("file").orderBy("block", "n")  # at most two rows per split
    crossing = (parts.where("cut").withColumn("record_no", F.sum((~F.col("head")).cast("int")).over(ordered))
                .groupBy("file", "record_no").agg(F.min("at").alias("at"), F.first("header").alias("header"),
                                                  F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "record"))),
                                                                           lambda x: x.record), "\n").alias("record"))
                .where("at != header").select("record"))
    records = plain.unionByName(whole).unionByName(crossing).select(F.regexp_replace("record", "\r$", "").alias("record")).where("trim(record) != ''")
    kind = ", ".join(f"`{n}` string" for n in names)
    given = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in {**options, "multiLine": True}.items()}
    return records.select(F.from_csv("record", kind, given).alias("r")).select("r.*")
