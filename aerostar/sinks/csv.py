"""CSV writers. Quotes inside fields are doubled (``escape='"'``), as the
``csv`` module writes them, so ``read_hotels`` reads our own output back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

CSV_OPTIONS = {"header": True, "escape": '"'}


def _writer(df: DataFrame, mode: str):
    w = df.write.mode(mode)
    for k, v in CSV_OPTIONS.items():
        w = w.option(k, v)
    return w


def write_csv(df: DataFrame, path: str, single_part: bool = False) -> None:
    """CSV folder, header, overwrite. Parts are written in parallel;
    ``single_part=True`` writes one part through one task, which the caller
    asks for (only the write runs there, not the plan before it)."""
    _writer(df.repartition(1) if single_part else df, "overwrite").csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows to a CSV folder (each appended part carries its header)."""
    _writer(df, "append").csv(path)


def write_single_csv(df: DataFrame, path: str) -> str:
    """One named CSV file (e.g. ``.../dim_date.csv``), always a file.

    The caller asks for one file, and so for one writing task: choose it for
    dimension-sized tables and ``write_csv`` (a folder of parallel parts) for
    anything that grows with the facts. The part file is written to a sibling
    folder and renamed with the Hadoop ``FileSystem`` of the target (works on
    HDFS and object stores, unlike local ``os``/``shutil`` calls)."""
    spark = df.sparkSession
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    write_csv(df, tmp, single_part=True)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = src_dir.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().endswith(".csv")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one CSV part in {tmp}, found {len(parts)}")
    dst = jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(parts[0], dst):
        raise RuntimeError(f"could not move {parts[0]} to {path}")
    fs.delete(src_dir, True)
    return path
