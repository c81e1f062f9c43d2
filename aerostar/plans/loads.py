"""Loads of the flight star that add to what earlier loads published.

``run_flight`` builds the star from all legs at hand. On a schedule every run
brings a further file, and parts of earlier ones again. ``load_flight`` takes
such a file and commits, as one version of a release:

- the legs not loaded before: a row's digest is looked up among the digests of
  the months that the file touches, so a file that comes twice adds nothing;
- new airlines and airports, numbered on from the last key (``extend_keys``), so
  every fact row published before still names its members;
- new dates, and the new fact rows, whose flight keys go on from the last one.

A load that fails commits nothing and is run again.

``load_hotels`` does the same for hotels: the documents that landed since the last
load are ingested, and of their countries, locations, hotels and stays those are
added that are not there yet. The tables lie in buckets by location, so only the
buckets of the new rows are read."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostar.operators import blank_to_null, dedupe, dense_key, drop_null, extend_keys, new_members, project, union_distinct
from aerostar.plans.flight import CLEAN_COLUMNS, CRITICAL, cleaned, date_parts, fact_flight
from aerostar.plans.hotel import clean_hotels, dim_hotel, dim_location, fact_hotel_stay
from aerostar.functions import date_key
from aerostar.schemas import HOTEL_COLUMNS, LEG_COLUMNS, TEXT_COLUMNS
from aerostar.session import run_concurrently, stage_dir
from aerostar.sinks import Change, Release, publish_frame
from aerostar.sinks.publish import SEGMENT
from aerostar.streaming import BATCH, ingest_pages

log = logging.getLogger("aerostar")

FACT = ["flightKey", "isBasicEconomy", "isRefundable", "isNonStop", "totalFare", "travelDuration", "departureTime",
        "arrivalTime", "dateKey", "airlineKey", "startingAirportKey", "destinationAirportKey"]
DATES = ["dateKey", "date", "year", "month", "dayOfMonth", "dayOfWeek", "quarter"]


def row_digest(columns: list[str]) -> F.Column:
    """32 bytes that name a row: SHA-256 over its JSON, which names each column
    and leaves out nulls."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256))


def new_legs(spark: SparkSession, legs: DataFrame, release: Release, base: int) -> DataFrame:
    """The legs of this file that no earlier load had, deduped and cleaned, with
    ``__digest`` and the month (``__segment``) under which the digest is kept.

    Rows are deduped by their digest, which leaves them partitioned for the
    anti-join by digest; of the digests kept, only the months of the file are
    read. New rows are cleaned once, before they are staged: numbering reads them
    twice, for a sample and to deal them out."""
    rows = drop_null(project(legs, LEG_COLUMNS), CRITICAL)
    rows = rows.withColumn("__digest", row_digest(LEG_COLUMNS)).withColumn(SEGMENT, F.trunc("flightDate", "month"))
    fresh = dedupe(rows, ["__digest"])
    if release.has("leg_digest", base):
        first, last = drop_null(legs.select(*CRITICAL), CRITICAL).agg(
            F.min(F.trunc("flightDate", "month").cast("string")), F.max(F.trunc("flightDate", "month").cast("string"))).first()
        if first is not None:
            seen = release.read("leg_digest", base, first, last).select(F.col("digest").alias("__digest"))
            fresh = fresh.join(seen, "__digest", "left_anti")
    fresh = cleaned(fresh, keep=("__digest", SEGMENT))
    path = stage_dir(spark, "new-legs")
    fresh.write.parquet(path)
    return spark.read.schema(fresh.schema).parquet(path)


def load_flight(spark: SparkSession, legs: DataFrame, root: str) -> int:
    """Load one file's legs; returns the version that holds them (the last one
    where nothing is new)."""
    release = Release(spark, root)
    base = release.version()
    state = release.state(base)
    fresh = new_legs(spark, legs, release, base)
    n = fresh.count()
    if not n and base:
        log.info("load: nothing new")
        return base
    clean = dense_key(fresh.drop("__digest", SEGMENT), ["legId"] + CLEAN_COLUMNS, "flightKey", start=state.get("flightKey", 0) + 1)

    known = lambda name: release.read(name, base) if release.has(name, base) else None
    airlines, airports = known("dim_airline"), known("dim_airport")
    names = clean.select(F.col("segmentsAirlineName").alias("airlineName"))
    codes = union_distinct(clean.select(F.col("startingAirport").alias("airportCode")), clean.select("destinationAirport"))
    new_airlines, new_airports = run_concurrently([
        lambda: extend_keys(names, airlines, ["airlineName"], "airlineKey", state.get("airlineKey", 0)),
        lambda: extend_keys(codes, airports, ["airportCode"], "airportKey", state.get("airportKey", 0))])
    dates = new_members(clean.select(F.col("flightDate").alias("date")), known("dim_date"), ["date"])
    dates = date_parts(dates, "date").withColumn("dateKey", date_key("date")).select(*DATES)

    members = lambda old, new: new if old is None else old.select(new.columns).unionByName(new)
    fact = fact_flight(clean, members(airlines, new_airlines), members(airports, new_airports))
    last = lambda new, key, held: max(held, new.agg(F.coalesce(F.max(key), F.lit(0))).first()[0])
    state = {"flightKey": state.get("flightKey", 0) + n,
             "airlineKey": last(new_airlines, "airlineKey", state.get("airlineKey", 0)),
             "airportKey": last(new_airports, "airportKey", state.get("airportKey", 0))}
    version = release.publish({
        "dim_airline": Change(publish_frame(new_airlines, ["airlineName", "airlineKey"], typed=True, unique_key="airlineKey")),
        "dim_airport": Change(publish_frame(new_airports, ["airportCode", "airportKey"], typed=True, unique_key="airportKey")),
        "dim_date": Change(publish_frame(dates, DATES, "dateKey", "yyyyMMdd", typed=True, unique_key="dateKey", granularity="year")),
        "fact_flight": Change(publish_frame(fact, FACT, "dateKey", "yyyyMMdd", typed=True, unique_key="flightKey", granularity="month")),
        # Rebalanced as the others are: else every task writes a file to every month.
        "leg_digest": Change(fresh.select(F.col("__digest").alias("digest"), SEGMENT).hint("rebalance", SEGMENT)),
    }, state, base)
    log.info("load: %d new legs in version %d of %s", n, version, root)
    return version


#: Buckets of the hotel tables, by location.
BUCKETS = 32


def load_hotels(spark: SparkSession, landing: str, root: str) -> int:
    """Ingest what landed since the last load and add it to the hotel tables of
    the release below ``root``; returns its version. What a failed load ingested
    the next one still finds."""
    root = root.rstrip("/")
    ingested = f"{root}/stage/hotel_rows"
    ingest_pages(spark, landing, ingested, f"{root}/stage/_ingest_checkpoint")
    release = Release(spark, f"{root}/release")
    base = release.version()
    state = release.state(base)
    landed = spark.read.parquet(ingested).where(F.col(BATCH) > state.get("batch", -1))  # only the new batches' folders
    newest = landed.agg(F.max(BATCH)).first()[0]
    if newest is None:
        return base
    path = stage_dir(spark, "new-hotels")
    # As in run_hotel, empty text becomes null before the null filter.
    clean_hotels(blank_to_null(landed.select(*HOTEL_COLUMNS), TEXT_COLUMNS)).write.parquet(path)
    hotels = spark.read.parquet(path)

    known = release.read("dim_country", base) if release.has("dim_country", base) else None
    names = hotels.select("Country Name")
    new_countries = extend_keys(names, known, ["Country Name"], "Country ID", state.get("country", -1))
    countries = new_countries if known is None else known.select(new_countries.columns).unionByName(new_countries)
    changes = {"dim_country": Change(new_countries.withColumn(SEGMENT, F.lit("all")))}
    for name, rows in (("dim_location", dim_location(hotels)), ("dim_hotel", dim_hotel(hotels, countries)),
                       ("fact_hotel_stay", fact_hotel_stay(hotels, countries))):
        bucket = F.format_string("b%02d", F.pmod(F.xxhash64("Location ID"), F.lit(BUCKETS)))
        if release.has(name, base):
            touched = [r[0] for r in rows.select(bucket).distinct().collect()]  # at most BUCKETS
            rows = new_members(rows, release.read(name, base, segments=touched), rows.columns)
        changes[name] = Change(rows.withColumn(SEGMENT, bucket).hint("rebalance", SEGMENT))
    last = new_countries.agg(F.coalesce(F.max("Country ID"), F.lit(-1))).first()[0]
    return release.publish(changes, {"batch": newest, "country": max(last, state.get("country", -1))}, base)
