"""End-to-end runs in the original's dependency order.

``run_flight``: clean legs -> (airport, airline, date dimensions) -> fact ->
warehouse CSVs -> publish (dimensions before the fact). The cleaned legs are
written once as Parquet and every output reads that table, instead of
re-running scan + dedupe for each of the four sinks; the keyed dimensions are
staged by ``dense_key`` and reused by the fact lookups.

``run_hotel``: incremental page ingest (Structured Streaming checkpoint) ->
clean -> country / location / hotel dimensions and the stay fact -> CSVs.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostar.operators import blank_to_null
from aerostar.plans.flight import clean_legs, dim_airline, dim_airport, dim_date, fact_flight
from aerostar.plans.hotel import (
    clean_hotels, dim_country, dim_hotel, dim_location, fact_hotel_stay,
)
from aerostar.schemas import HOTEL_COLUMNS, TEXT_COLUMNS
from aerostar.session import run_concurrently
from aerostar.sinks import publish, write_csv, write_single_csv
from aerostar.streaming import ingest_pages, rejects_of

# Columns of the published fact and date dimension.
FACT_DIMS = ["flightKey", "isBasicEconomy", "isRefundable", "isNonStop", "totalFare",
             "travelDuration", "departureTime", "arrivalTime", "dateKey", "airlineKey",
             "startingAirportKey", "destinationAirportKey"]
log = logging.getLogger("aerostar")

DATE_DIMS = ["dateKey", "date", "year", "month", "dayOfMonth", "dayOfWeek", "quarter"]


def run_flight(spark: SparkSession, legs: DataFrame, out: str, publish_tables: bool = True,
               key: str = "dense", single_files: bool = False) -> dict[str, str]:
    """``single_files`` writes each dimension as one named CSV file, as the
    original does, instead of a folder of parts."""
    out = out.rstrip("/")
    paths = {"clean": f"{out}/stage/clean_legs"}
    clean_legs(legs, key=key).write.mode("overwrite").parquet(paths["clean"])
    clean = spark.read.parquet(paths["clean"])
    log.info("flight: cleaned legs written to %s", paths["clean"])

    airports, airlines = run_concurrently([lambda: dim_airport(clean), lambda: dim_airline(clean)])
    paths["dates"] = f"{out}/stage/dim_date"  # read by the CSV and the publish
    dim_date(clean).write.mode("overwrite").parquet(paths["dates"])
    dates = spark.read.parquet(paths["dates"])
    fact = fact_flight(clean, airlines, airports)
    log.info("flight: airline, airport and date dimensions keyed; fact planned")

    wh = f"{out}/warehouse"
    # Independent sinks run as concurrent Spark jobs (the original graph runs
    # the dimension branches in parallel too); the fact's publish waits for
    # the dimensions, as in the original dependency order.
    paths["fact_flight"] = f"{wh}/fact_flight"
    write_dim = write_single_csv if single_files else write_csv
    _concurrently([
        lambda: write_dim(airports, f"{wh}/dim_airport.csv"),
        lambda: write_dim(airlines, f"{wh}/dim_airline.csv"),
        lambda: write_dim(dates, f"{wh}/dim_date.csv"),
        # The fact is written in parallel parts (a single file would funnel
        # the largest table through one task).
        lambda: write_csv(fact, paths["fact_flight"]),
    ])
    paths.update({"dim_airport": f"{wh}/dim_airport.csv", "dim_airline": f"{wh}/dim_airline.csv",
                  "dim_date": f"{wh}/dim_date.csv"})
    log.info("flight: warehouse CSVs written to %s", wh)

    if publish_tables:
        pub = f"{out}/published"
        paths.update({"pub_dim_date": f"{pub}/dim_date", "pub_dim_airport": f"{pub}/dim_airport",
                      "pub_dim_airline": f"{pub}/dim_airline", "pub_fact_flight": f"{pub}/fact_flight"})
        _concurrently([
            lambda: publish(dates, paths["pub_dim_date"], DATE_DIMS, "dateKey", "yyyyMMdd",
                            unique_key="dateKey", granularity="year"),
            lambda: publish(airports, paths["pub_dim_airport"], ["airportKey", "airportCode"],
                            unique_key="airportKey"),
            lambda: publish(airlines, paths["pub_dim_airline"], ["airlineKey", "airlineName"],
                            unique_key="airlineKey"),
        ])
        # flightKey is unique per fact row, so the rollup cannot collapse rows
        # and its shuffle of the whole fact is skipped.
        log.info("flight: dimensions published")
        publish(fact, paths["pub_fact_flight"], FACT_DIMS, "dateKey", "yyyyMMdd",
                unique_key="flightKey")
        log.info("flight: fact published to %s", paths["pub_fact_flight"])
    return paths


def run_hotel(spark: SparkSession, landing: str, out: str) -> dict[str, str]:
    out = out.rstrip("/")
    paths = {"ingested": f"{out}/stage/hotel_rows"}
    ingest_pages(spark, landing, paths["ingested"], f"{out}/stage/_ingest_checkpoint")
    paths["rejected"] = rejects_of(paths["ingested"])
    log.info("hotel: landed documents ingested into %s, bad ones into %s", paths["ingested"], paths["rejected"])
    rows = spark.read.parquet(paths["ingested"]).select(*HOTEL_COLUMNS)
    # The original crawler hands rows to the ETL through a CSV file, where an
    # empty text field reads back as null; keep that, so rows without a
    # country are dropped by the null filter as they were.
    rows = blank_to_null(rows, TEXT_COLUMNS)
    hotels = clean_hotels(rows)
    paths["clean"] = f"{out}/stage/clean_hotels"
    hotels.write.mode("overwrite").parquet(paths["clean"])
    hotels = spark.read.parquet(paths["clean"])

    countries = dim_country(hotels)
    wh = f"{out}/warehouse"
    outputs = {
        "dim_country": countries,
        "dim_location": dim_location(hotels),
        "dim_hotel": dim_hotel(hotels, countries),
        "fact_hotel_stay": fact_hotel_stay(hotels, countries),
    }
    for name in outputs:
        paths[name] = f"{wh}/{name}"
    _concurrently([(lambda df=df, name=name: write_csv(df, paths[name])) for name, df in outputs.items()])
    log.info("hotel: country, location, hotel and stay tables written to %s", wh)
    return paths


def _concurrently(jobs) -> None:
    run_concurrently(jobs)


def run_explore(spark: SparkSession, legs: DataFrame, out: str) -> dict[str, str]:
    """The exploratory job's tables (airline pairs, flight type, date with an
    integer key, flight dimension), written as CSV folders."""
    from aerostar.plans.flight import (
        dim_airline_pairs, dim_date_rownum, dim_flight, dim_flight_type, explore_legs,
    )
    out = out.rstrip("/")
    paths = {"explore": f"{out}/stage/explore_legs"}
    explore_legs(legs).write.mode("overwrite").parquet(paths["explore"])
    base = spark.read.parquet(paths["explore"])
    tables = run_concurrently([lambda: dim_airline_pairs(base), lambda: dim_flight_type(base),
                               lambda: dim_date_rownum(base), lambda: dim_flight(base)])
    names = ["dim_airline", "dim_flight_type", "dim_date", "dim_flight"]
    for name in names:
        paths[name] = f"{out}/warehouse/{name}"
    _concurrently([(lambda df=df, name=name: write_csv(df, paths[name])) for name, df in zip(names, tables)])
    return paths


def run_scrape(spark: SparkSession, pages: DataFrame, out: str, year: int = 2025,
               rules: dict | None = None) -> str:
    """Saved search pages ``(page_id, html)`` -> the scraped flight table as CSV
    (the scraper's 13 columns, keyed over the whole table), and the pages whose
    lists do not match as Parquet beside it."""
    from aerostar.plans.scrape import page_rejects, scraped_flights
    from aerostar.schemas import SCRAPED_COLUMNS
    path = f"{out.rstrip('/')}/flights_crawl"
    rows = scraped_flights(pages, year=year, rules=rules, divert=True, table_key=True)
    write_csv(rows.select(*SCRAPED_COLUMNS), path)
    page_rejects(pages, rules=rules).write.mode("overwrite").parquet(f"{path}-rejects")
    return path


def output_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per output table, as one small DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
