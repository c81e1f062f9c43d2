"""Resumable hotel-page ingest.

The original crawler keeps its position (``last_page``) in the orchestrator
and appends rows to a CSV. Here landed lookup responses (JSON lines, one
document per page) are the stream source and the checkpoint is Structured
Streaming's own: each run processes exactly the files not seen before
(``trigger(availableNow=True)``), appends the flattened rows to Parquet and
stops. Re-running adds nothing; a new file adds its rows once; an empty page
adds none. One stream with one checkpoint serves both outputs: each document is
parsed once, and what does not parse goes to a rejects table. A batch writes
below folders of its number, so a batch that is run again after a failure
replaces what it wrote, and it fails unless landed = parsed + rejected. The
checkpoint and output folders must be on shared, reliable storage (below
``spark.checkpoint.dir`` in the ETL runs)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerostar.sources import flatten_hotel_pages, tag_hotel_pages

#: Partition column of the outputs: the number of the batch.
BATCH = "__batch"


def land_pages(pages: DataFrame, landing: str, batch: str) -> str:
    """Write ``(page, json)`` documents as JSON-lines files of one landing batch."""
    path = f"{landing.rstrip('/')}/{batch}"
    pages.select("json").write.mode("errorifexists").text(path)
    return path


def ingest_pages(spark: SparkSession, landing: str, out: str, checkpoint: str,
                 max_files_per_trigger: int | None = None, keep_page: bool = True,
                 source_options: dict | None = None, rejects: str | None = None) -> None:
    """Run one incremental ingest of all landed documents not seen before.

    ``rejects`` (``<out>-rejects`` by default) takes the documents that do not
    parse, ``<out>-counts`` the numbers of documents of each batch.
    ``max_files_per_trigger`` bounds each micro-batch; ``source_options`` go to
    the file source as they are."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (source_options or {}).items():
        reader = reader.option(k, v)
    documents = reader.load(f"{landing.rstrip('/')}/*").withColumnRenamed("value", "json")
    keep, bad_ones = ("page",) if keep_page else (), rejects or rejects_of(out)

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        tagged = (tag_hotel_pages(batch).observe(seen, F.count(F.lit(1)).alias("landed"), F.count_if("parsed").alias("parsed"))
                  .persist(StorageLevel.MEMORY_AND_DISK))  # parsed once for both outputs
        try:
            rows = flatten_hotel_pages(tagged.where("parsed").select("doc.page", "doc.results"), keep=keep)
            rows.write.mode("overwrite").parquet(_folder(out, number))
            tagged.where("not parsed").select("json").write.mode("overwrite").parquet(_folder(bad_ones, number))
        finally:
            tagged.unpersist()
        rejected = batch.sparkSession.read.schema("json string").parquet(_folder(bad_ones, number)).count()
        landed, parsed = seen.get["landed"], seen.get["parsed"]
        if landed != parsed + rejected:
            raise RuntimeError(f"batch {number} of {landing}: {landed} documents landed, {parsed} parsed, {rejected} rejected")
        counts = batch.sparkSession.createDataFrame([(landed, parsed, rejected)], "landed long, parsed long, rejected long")
        counts.coalesce(1).write.mode("overwrite").parquet(_folder(counts_of(out), number))

    query = documents.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def rejects_of(out: str) -> str:
    return f"{out.rstrip('/')}-rejects"


def counts_of(out: str) -> str:
    """Documents landed, parsed and rejected, a row per batch."""
    return f"{out.rstrip('/')}-counts"


def _folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={number}"
