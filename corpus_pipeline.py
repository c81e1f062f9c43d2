"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on, with
the columns of documents; the last returns the mix in training order, one row
per document and pass, with size, pass, words taken and position. ``run`` writes each
stage's result to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostar.llm import decontaminate, exact_dedup, minhash_dedup, mixing, quality
from aerostar.llm.staging import importable, staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer rejects (junk, toxic) go."""
    importable(spark)
    return quality.accept(spark, docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of largest id stays."""
    importable(spark)
    return exact_dedup.distinct_rows(spark, docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of least id stays."""
    importable(spark)
    return minhash_dedup.distinct_rows(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    importable(spark)
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every pass of a document of which the mix takes words, in training order."""
    return mixing.schedule(mixing.mix(spark, docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup_stage),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: SQL cannot express the trained scorer; tests hold the run against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
