"""aerostar: travel-listing ETL (flight and hotel star schemas) as Spark plans.

Sub-packages:

* ``functions`` - ``Column -> Column`` helpers (durations, segments, times, text).
* ``sources``   - scans: legs / hotel CSV, nested hotel JSON, saved web pages.
* ``operators`` - projections, filters, dedupe, surrogate keys, dimension lookups.
* ``plans``     - star-schema builders, the page scrape, end-to-end ETL runs and
                  the fixtures that shape the test tables into travel inputs.
* ``sinks``     - CSV writers and the day-partitioned publish step.
* ``streaming`` - resumable page ingest on Structured Streaming.
"""

from aerostar.session import get_spark, stage_dir

__all__ = ["get_spark", "stage_dir"]
