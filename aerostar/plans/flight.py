"""Flight star schema: cleaned legs, airline / airport / date dimensions, the
flight fact, and the exploratory variants (airline pairs, flight type, date
with integer key, flight dimension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions import (
    clock, date_key, first_segment, flag, iso_hours, iso_hours_strict, last_item,
    segments, to_bool, to_float,
)
from aerostar.operators import (
    dedupe, dense_key, distinct_of, drop_null, fill, fits_broadcast, hashed_key, lookup_key, project,
    union_distinct, unique_key,
)
from aerostar.session import run_concurrently, stage_dir
from aerostar.schemas import LEG_COLUMNS, LEG_COLUMNS_WIDE

# Columns and flags of the original's cleaned legs.
CRITICAL = ["legId", "flightDate", "startingAirport", "destinationAirport"]
FLAGS = ["isBasicEconomy", "isRefundable", "isNonStop"]
CLEAN_COLUMNS = [
    "flightDate", "startingAirport", "destinationAirport", "isBasicEconomy",
    "isRefundable", "isNonStop", "totalFare", "segmentsAirlineName",
    "travelDuration", "departureTime", "arrivalTime",
]


def clean_legs(legs: DataFrame, key: str = "dense", local_clock: bool = False,
               duration_days: bool = False) -> DataFrame:
    """Project, dedupe, fill, drop nulls, cast, duration, flags, segment picks, id.

    Order of steps, as in the original job, except that the null filter runs
    before the dedupe: the critical columns are part of the deduped row, so
    the rows are the same, the shuffle is smaller and the filter reaches the
    scan. The fare fill stays after the dedupe (a null fare and a 0 fare are
    different rows until then).

    ``key='dense'`` numbers legs 1..n by (legId, cleaned columns) - repeatable;
    ``key='monotonic'`` is the original's gapped, run-dependent id (no shuffle);
    ``key='hashed'`` numbers them 1..n by hash bucket, then legId and columns, on
    the dedupe's own exchange (one exchange in all, no sampling job).
    """
    df = project(legs, LEG_COLUMNS)
    df = drop_null(df, CRITICAL)
    df = dedupe(df)
    df = cleaned(df, local_clock, duration_days)
    if key == "dense":
        # Staged: the sample for the ranges would finish the dedupe and clean the legs again.
        path = stage_dir(legs.sparkSession, "cleaned")
        df.write.parquet(path)
        df = dense_key(legs.sparkSession.read.schema(df.schema).parquet(path), ["legId"] + CLEAN_COLUMNS, "flightKey")
    elif key == "monotonic":
        df = unique_key(df, "flightKey", start=1)
    elif key == "hashed":
        df = hashed_legs(legs, local_clock, duration_days)
    else:
        raise ValueError(f"key must be 'dense', 'hashed' or 'monotonic', not {key!r}")
    return df.select(*CLEAN_COLUMNS, "flightKey")


def hashed_legs(legs: DataFrame, local_clock: bool = False, duration_days: bool = False) -> DataFrame:
    """Deduped legs, keyed where the dedupe's exchange has left them, cleaned."""
    rows = dedupe(drop_null(project(legs, LEG_COLUMNS), CRITICAL))
    keyed = hashed_key(rows, LEG_COLUMNS, "flightKey", LEG_COLUMNS)
    return cleaned(keyed, local_clock, duration_days, keep=("flightKey",))


def cleaned(rows: DataFrame, local_clock: bool = False, duration_days: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``legId`` and the cleaned columns of deduped legs, row by row."""
    df = fill(rows, {"totalFare": 0})
    return df.select(
        "legId", "flightDate", "startingAirport", "destinationAirport",
        *[flag(c).alias(c) for c in FLAGS],
        to_float("totalFare").alias("totalFare"),
        first_segment("segmentsAirlineName").alias("segmentsAirlineName"),
        iso_hours("travelDuration", days=duration_days).alias("travelDuration"),
        clock(first_segment("segmentsDepartureTimeRaw"), local=local_clock).alias("departureTime"),
        clock(last_item(segments("segmentsArrivalTimeRaw")), local=local_clock).alias("arrivalTime"), *keep,
    )


def dim_columns(legs: DataFrame) -> DataFrame:
    """The cleaned columns that the airline, airport and date dimensions read.
    They come from the same rows as the cleaned legs, and a distinct projection
    needs neither the full-row dedupe nor the key: only their few values are
    shuffled, after partial aggregates, and the scan reads only their columns."""
    return drop_null(legs, CRITICAL).select(
        "flightDate", "startingAirport", "destinationAirport",
        first_segment("segmentsAirlineName").alias("segmentsAirlineName"))


def dim_airline(clean: DataFrame) -> DataFrame:
    """Distinct first-segment airline names keyed 1..n by name (nulls first)."""
    names = distinct_of(clean, [F.col("segmentsAirlineName").alias("airlineName")])
    return dense_key(names, ["airlineName"], "airlineKey")


def dim_airport(clean: DataFrame) -> DataFrame:
    """Start and destination airports (SQL UNION) keyed 1..n by code."""
    codes = union_distinct(clean.select(F.col("startingAirport").alias("airportCode")),
                           clean.select(F.col("destinationAirport").alias("airportCode")))
    return dense_key(codes, ["airportCode"], "airportKey")


def date_parts(df: DataFrame, col: str, day_name: str = "dayOfMonth",
               week: bool = True, quarter: bool = True) -> DataFrame:
    c = F.col(col)
    parts = {"year": F.year(c), "month": F.month(c), day_name: F.dayofmonth(c)}
    if week:
        parts["dayOfWeek"] = F.dayofweek(c)  # Sunday = 1
    if quarter:
        parts["quarter"] = F.quarter(c)
    return df.withColumns(parts)


def dim_date(clean: DataFrame) -> DataFrame:
    """Distinct flight dates with calendar parts and the text key ``yyyyMMdd``."""
    dates = distinct_of(clean, [F.col("flightDate").alias("date")])
    return date_parts(dates, "date").withColumn("dateKey", date_key("date"))


def fact_flight(clean: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Fact with the date key and the airline / start / destination keys.

    Each dimension is broadcast behind its size check, so the fact is scanned
    once and never shuffled for the three lookups."""
    fact = clean.select(
        "flightKey",
        F.col("startingAirport").alias("startingAirportId"),
        F.col("destinationAirport").alias("destinationAirportId"),
        F.col("segmentsAirlineName").alias("airlineName"),
        *FLAGS, "totalFare", "travelDuration", "departureTime", "arrivalTime",
        date_key("flightDate").alias("dateKey"),
    )
    # One size check per dimension (the airport one serves both roles).
    small_airlines, small_airports = run_concurrently([
        lambda: fits_broadcast(airlines.select("airlineName", "airlineKey")),
        lambda: fits_broadcast(airports.select("airportCode", "airportKey")),
    ])
    fact = lookup_key(fact, airlines, "airlineName", "airlineName", "airlineKey",
                      broadcast=small_airlines)
    fact = lookup_key(fact, airports, "startingAirportId", "airportCode", "airportKey",
                      as_name="startingAirportKey", broadcast=small_airports)
    fact = lookup_key(fact, airports, "destinationAirportId", "airportCode", "airportKey",
                      as_name="destinationAirportKey", broadcast=small_airports)
    return fact.select("flightKey", *FLAGS, "totalFare", "travelDuration", "departureTime",
                       "arrivalTime", "dateKey", "airlineKey", "startingAirportKey",
                       "destinationAirportKey")


# ---- exploratory variants -------------------------------------------------

def explore_legs(legs: DataFrame) -> DataFrame:
    """The exploratory job's input: 18 columns, flags cast to boolean, the
    duration in hours when both parts are present (else null)."""
    df = project(legs, LEG_COLUMNS_WIDE)
    return df.withColumns({
        **{c: to_bool(c) for c in ("isRefundable", "isNonStop", "isBasicEconomy")},
        "travelDuration": iso_hours_strict("travelDuration"),
    })


def airline_items(legs: DataFrame, cross: bool = False, distinct: bool = False) -> DataFrame:
    """(airline_name, airline_code) per segment.

    ``cross=False`` pairs names and codes by position (``arrays_zip``).
    ``cross=True`` is what two generators in one select give: every name with
    every code of the same leg. Null lists give no rows (``explode``)."""
    names, codes = segments("segmentsAirlineName"), segments("segmentsAirlineCode")
    if cross:
        if distinct:  # pairs that a dedupe would remove anyway
            names, codes = F.array_distinct(names), F.array_distinct(codes)
        return (legs.select(F.explode(names).alias("airline_name"), codes.alias("__codes"))
                    .select("airline_name", F.explode("__codes").alias("airline_code")))
    return legs.select(F.inline(F.arrays_zip(names.alias("airline_name"),
                                             codes.alias("airline_code"))))


def dim_airline_pairs(legs: DataFrame, cross: bool = False) -> DataFrame:
    pairs = dedupe(airline_items(legs, cross=cross, distinct=True))
    keyed = dense_key(pairs, ["airline_name", "airline_code"], "airline_key")
    return keyed.select("airline_key", "airline_code", "airline_name")


def dim_flight_type(legs: DataFrame) -> DataFrame:
    """Distinct flag combinations. As in the original, rows are deduped on the
    raw booleans *before* null and false both become 0, so two output rows can
    be equal with different keys. Keys follow the raw values (nulls first)."""
    cols = ["isBasicEconomy", "isNonStop", "isRefundable"]
    combos = dedupe(legs.select(*cols))
    keyed = dense_key(combos, cols, "flight_type_key")
    return keyed.select("flight_type_key", *[flag(c).alias(c) for c in cols])


def dim_date_rownum(legs: DataFrame) -> DataFrame:
    dates = dedupe(legs.select("flightDate"))
    dates = date_parts(dates, "flightDate", day_name="day", week=False, quarter=False)
    keyed = dense_key(dates, ["flightDate"], "date_key")
    return keyed.select("date_key", "flightDate", "year", "month", "day")


def dim_flight(legs: DataFrame) -> DataFrame:
    """Fact-sized dimension: this is where the single-task global window of
    the original breaks at scale; ``dense_key`` numbers it in two passes."""
    cols = ["legId", "flightDate", "startingAirport", "destinationAirport",
            "totalFare", "seatsRemaining", "travelDuration"]
    flights = dedupe(legs.select(*cols))
    keyed = dense_key(flights, cols, "flight_key")
    return keyed.select("flight_key", *cols)
