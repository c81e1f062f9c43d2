"""Several tables published as one version.

``publish`` (one table, dynamic partition overwrite) replaces segments in place:
a reader can see half of it, a failure leaves half of it, and a segment whose
rows are gone is never written, so it stays. A ``Release`` writes every change
into folders of its own, by segment, and then commits them all with one small
file, the manifest of the next version: for each table the folders that hold its
segments. What is not in a manifest does not exist: a failed publish is
invisible, readers of an older version keep reading it, and an interval that is
replaced loses the segments that its new rows do not have.

The commit is a rename that fails where the version exists already, so of two
publishers that began from the same version the second fails and must begin
again (its keys and anti-joins were taken from an older version).

The driver holds folder names only: one for each live segment and append.
``compact`` merges segments that many appends have split."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerostar.sinks.publish import DAY, SEGMENT

#: The folder of rows without a segment, as partitioned writes name it (fixed value).
NO_SEGMENT = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another publish committed first."""


@dataclass
class Change:
    """New rows of a table, with the segment column of ``publish_frame``.

    They are added to what is there, or replace it: ``interval`` = (first, last)
    replaces the segments from first to last, whether or not the rows have
    them; ``segments`` replaces those named; ``everything`` replaces the table."""

    rows: DataFrame
    interval: tuple[str, str] | None = None
    segments: Sequence[str] | None = None
    everything: bool = False

    def replaces(self, segment: str) -> bool:
        if self.everything or (self.segments is not None and segment in self.segments):
            return True
        return self.interval is not None and segment != NO_SEGMENT and self.interval[0] <= segment <= self.interval[1]


class Release:
    """Versioned tables below ``root``: ``data/<table>/<change>/__segment=<day>``
    and ``versions/<number>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- versions

    def version(self) -> int:
        """The last committed version; 0 before the first."""
        names = [n for n in self._names(f"{self.root}/versions") if n.isdigit()]
        return max(map(int, names), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``tables``: per table its schema, live ``[segment, folder]`` and what
        the version replaced; ``state``: what the publisher keeps with it."""
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}, "state": {}}
        return json.loads(self._read(self._version_path(version)))

    def state(self, version: int | None = None) -> dict:
        return self.manifest(version)["state"]

    def read(self, table: str, version: int | None = None, first: str | None = None, last: str | None = None,
             segments: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, without the segment column; with ``first`` and
        ``last`` only the segments in between are read, with ``segments`` only
        those."""
        held = self.manifest(version)["tables"].get(table)
        if held is None:
            raise KeyError(f"no table {table!r} in version {self.version() if version is None else version} of {self.root}")
        schema = StructType.fromJson(held["schema"])
        folders = [f for s, f in held["live"]
                   if (first is None or s >= first) and (last is None or s <= last) and (s != NO_SEGMENT or first is last is None)
                   and (segments is None or s in segments)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def has(self, table: str, version: int | None = None) -> bool:
        return table in self.manifest(version)["tables"]

    # ---- publishing

    def publish(self, changes: dict[str, Change], state: dict | None = None, base: int | None = None) -> int:
        """Write all changes, then commit them as the next version; returns it.
        ``base`` is the version the changes were made from (default: the last
        one now); a later one in the meantime is a ``Conflict``. ``state`` is
        merged into the last version's."""
        base = self.version() if base is None else base
        before = self.manifest(base)
        tables = dict(before["tables"])
        for name, change in changes.items():
            folder = f"data/{name}/{uuid.uuid4().hex}"
            schema = StructType([f for f in change.rows.schema.fields if f.name != SEGMENT])
            held = tables.get(name)
            if held and StructType.fromJson(held["schema"]).simpleString() != schema.simpleString() and not change.everything:
                raise ValueError(f"{name}: the rows have {schema.simpleString()}, the table has other columns")
            change.rows.write.partitionBy(SEGMENT).parquet(f"{self.root}/{folder}")
            new = sorted(n.split("=", 1)[1] for n in self._names(f"{self.root}/{folder}") if n.startswith(f"{SEGMENT}="))
            gone = [[s, f] for s, f in (held["live"] if held else []) if change.replaces(s)]
            live = [x for x in (held["live"] if held else []) if x not in gone] + [[s, f"{folder}/{SEGMENT}={s}"] for s in new]
            tables[name] = {"schema": schema.jsonValue(), "live": sorted(live), "replaced": sorted({s for s, _ in gone}), "written": new}
        for name in set(tables) - set(changes):
            tables[name] = {**tables[name], "replaced": [], "written": []}
        version = base + 1
        self._commit(version, {"version": version, "tables": tables, "state": {**before["state"], **(state or {})}})
        return version

    def compact(self, table: str, most: int = 1) -> int:
        """Rewrite the segments that lie in more than ``most`` folders as one
        folder each, in a version of their own; the rows stay the same."""
        base = self.version()
        folders: dict[str, int] = {}
        for segment, _ in self.manifest(base)["tables"][table]["live"]:
            folders[segment] = folders.get(segment, 0) + 1
        split = [s for s, n in folders.items() if n > most]
        if not split:
            return base
        held = self.manifest(base)["tables"][table]
        parts = [f"{self.root}/{f}" for s, f in held["live"] if s in split]
        rows = self.spark.read.schema(StructType.fromJson(held["schema"])).parquet(*parts)
        name = F.regexp_extract(F.input_file_name(), f"/{SEGMENT}=([^/]*)/", 1)
        rows = rows.withColumn(SEGMENT, F.when(name != NO_SEGMENT, name))
        return self.publish({table: Change(rows.hint("rebalance", SEGMENT), segments=split)}, base=base)

    # ---- files, through the Hadoop file system of the root

    def _version_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:010d}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _read(self, path: str) -> str:
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        """A whole file under another name first, then the rename."""
        jvm = self.spark._jvm
        target, _ = self._fs(self._version_path(version))
        temporary, fs = self._fs(f"{self.root}/versions/.{uuid.uuid4().hex}")
        stream = fs.create(temporary)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, target, none)  # fails where the target exists
        except Exception as e:
            fs.delete(temporary, False)
            if fs.exists(target):
                raise Conflict(f"version {version} of {self.root} was committed by another publish") from e
            raise


__all__ = ["Change", "Conflict", "Release", "DAY", "SEGMENT", "NO_SEGMENT"]
