"""
the same inputs.

* four sinks (date, airport, fact, airline dimensions) from a cleaned-legs
  lineage that is recomputed per sink and keyed with single-task windows (the
  original's shape), against one materialised cleaned table, staged two-pass
  keys and checked broadcasts (``run_flight``'s shape);
* a key over every column of the deduped legs as one global window against
  ``dense_key``.

Each sink runs through the ``noop`` format, so only the plans differ."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aerostar.operators import dedupe, dense_key  # noqa: E402
from aerostar.plans import fixtures, flight  # noqa: E402
from aerostar.session import get_spark, stage_dir  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def original_shape(spark, sf):
    clean = flight.clean_legs(fixtures.legs(spark, sf), key="monotonic")  # lazy, never materialised
    airlines = (clean.select(F.col("segmentsAirlineName").alias("airlineName")).distinct()
                .withColumn("airlineKey", F.row_number().over(Window.orderBy("airlineName"))))
    airports = (clean.select(F.col("startingAirport").alias("airportCode"))
                .union(clean.select(F.col("destinationAirport").alias("airportCode"))).distinct()
                .withColumn("airportKey", F.row_number().over(Window.orderBy("airportCode"))))
    dates = flight.dim_date(clean)
    fact = clean.select("flightKey", F.col("segmentsAirlineName").alias("airlineName"),
                        "startingAirport", "destinationAirport")
    fact = (fact.join(airlines, "airlineName", "left")
                .join(airports.withColumnRenamed("airportKey", "startingAirportKey")
                      .withColumnRenamed("airportCode", "startingAirport"), "startingAirport", "left")
                .join(airports.withColumnRenamed("airportKey", "destinationAirportKey")
                      .withColumnRenamed("airportCode", "destinationAirport"), "destinationAirport", "left"))
    for df in (dates, airports, fact, airlines):
        noop(df)


def our_shape(spark, sf):
    path = stage_dir(spark, "baseline-clean")
    flight.clean_legs(fixtures.legs(spark, sf)).write.parquet(path)
    clean = spark.read.parquet(path)
    airlines, airports = flight.dim_airline(clean), flight.dim_airport(clean)
    fact = flight.fact_flight(clean, airlines, airports)
    for df in (flight.dim_date(clean), airports, fact, airlines):
        noop(df)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="aerostar-baseline", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    warm = "/root/testdata/sf0.001"  # untimed warm-up of JIT and code generation
    original_shape(spark, warm)
    our_shape(spark, warm)
    rows = dedupe(fixtures.legs(spark, sf).select("legId", "flightDate", "totalFare"))
    noop(dense_key(dedupe(fixtures.legs(spark, warm).select("legId", "flightDate", "totalFare")), None, "k"))
    out = {
        "clean_legs_monotonic_key": timed(lambda: noop(flight.clean_legs(fixtures.legs(spark, sf), key="monotonic"))),
        "clean_legs_dense_key": timed(lambda: noop(flight.clean_legs(fixtures.legs(spark, sf)))),
        "four_sinks_original_shape": timed(lambda: original_shape(spark, sf)),
        "four_sinks_our_shape": timed(lambda: our_shape(spark, sf)),
        "key_all_columns_global_window": timed(lambda: noop(rows.withColumn(
            "rowKey", F.row_number().over(Window.orderBy(*rows.columns))))),
        "key_all_columns_two_pass": timed(lambda: noop(dense_key(rows, None, "rowKey"))),
    }
    print(json.dumps({"sf": os.path.basename(sf.rstrip("/")), "cpus": cpus, "sec": out}))


if __name__ == "__main__":
    main()
