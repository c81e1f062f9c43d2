"""Session settings and the shared staging folder.

Everything that must outlive one action (materialised keys, landed pages,
published tables in tests) goes below ``spark.checkpoint.dir``: on a cluster
that is a shared, reliable folder (HDFS / object store) named by the
deployment, so staged data survives the loss of an executor. We only pick a
folder ourselves when the session has none, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays on (the Spark 4 default), so raw
# text is always parsed with try_* functions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # No broadcast from plan-time size estimates: joins broadcast either behind
    # an explicit check (fits_broadcast, fixed-size reference tables, tables of
    # per-partition counts) or when AQE has measured a side's actual shuffle
    # output under the adaptive threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def get_spark(master: str | None = None, app: str = "aerostar",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SESSION_CONF.items():  # also where an existing session is reused
        spark.conf.set(k, v)
    return spark


#: Settings on which results depend.
RESULT_CONF = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def apply_settings(spark: SparkSession) -> None:
    """Set what results depend on in an existing session (e.g. the driver's);
    a session that refuses it is an error. How a plan runs is left to it."""
    for k in RESULT_CONF:
        if spark.conf.get(k, None) != SESSION_CONF[k]:
            spark.conf.set(k, SESSION_CONF[k])


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # no classic context (e.g. a remote session)
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder; set one only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # no classic context: only the configuration is visible
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared, reliable folder: staged "
                               "tables must outlive executors and be visible to all of them")
        # Unset in a local run (tests): a folder of this machine is the shared folder.
        configured = tempfile.mkdtemp(prefix="aerostar-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage_dir(spark: SparkSession, name: str = "stage") -> str:
    """A fresh, unique folder under the checkpoint folder for staged tables."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/aerostar/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Python workers import this package by name: where only the driver's own
    path has it (a local session started elsewhere), tell the workers."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few helpers that list local folders."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def run_concurrently(jobs):
    """Run independent driver-side callables (each submits its own Spark jobs)
    from threads, so small jobs overlap instead of queueing; returns their
    results in order and re-raises the first failure."""
    if len(jobs) <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]
