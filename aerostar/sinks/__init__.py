"""Sinks: CSV folders, single named CSV files, appends, the day-partitioned
publish step and releases of several tables."""

from aerostar.sinks.csv import append_rows, write_csv, write_single_csv
from aerostar.sinks.publish import publish, publish_frame, published_between, read_published
from aerostar.sinks.release import Change, Conflict, Release

__all__ = ["write_csv", "write_single_csv", "append_rows", "publish", "publish_frame",
           "published_between", "read_published", "Release", "Change", "Conflict"]
