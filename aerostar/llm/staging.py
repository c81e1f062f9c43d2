"""Tables staged in the shared folder of the session (``spark.checkpoint.dir``).

A staged table cuts the lineage: what reads it survives lost executors without
recomputing what came before, and no plan is evaluated twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import importable, stage_dir


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared folder and return the table read back."""
    path = stage_dir(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
