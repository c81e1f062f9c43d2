"""Registered queries: one per operator of SURVEY section 2, each reading the
test tables (through the fixtures) at ``sf_dir``, with DuckDB SQL where the
result is expressible in SQL. ``__spark_entry__`` exposes this registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from aerostar.functions import (
    clock, date_key, first_item, first_of, flag, iso_hours, iso_hours_strict, label_date,
    label_time, last_item, lower, non_blank, pad, segment_count, segments,
    text_flag, text_hours, to_bool, to_float,
)
from aerostar.operators import (
    bucketed_lookup, dedupe, dense_key, distinct_of, drop_cols, drop_null, drop_sentinel, fill, lookup_key,
    preview, project, project_as, rename, row_count, schema_report, union_distinct,
    store_bucketed, unique_key, with_cols,
)
from aerostar.plans import fixtures, flight, hotel, oracle as O, scrape
from aerostar.plans.etl_runs import DATE_DIMS, FACT_DIMS, run_explore, run_flight, run_hotel, run_scrape
from aerostar.plans.loads import load_flight, load_hotels
from aerostar.schemas import HOTEL_COLUMNS, LEG_COLUMNS, LEG_COLUMNS_WIDE, LEGS, SCRAPED_COLUMNS
from aerostar.session import apply_settings, run_concurrently, stage_dir
from aerostar.sinks import (
    Change, Release, append_rows, publish, publish_frame, read_published, write_csv, write_single_csv,
)
from aerostar.sources import (
    attribute, attributes, element_text, elements_text, extract_page_fields, flatten_hotel_pages, parse_hotel_pages, read_hotels,
    quarantine_csv, read_legs, read_quarantine, read_rejects, read_typed_csv,
)
from aerostar.streaming import ingest_pages, land_pages, rejects_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return deco


# ---- shared inputs ----------------------------------------------------------------

def legs(spark, sf):
    return fixtures.legs(spark, sf)


def clean(spark, sf):
    return flight.clean_legs(legs(spark, sf))


def clean_for_dims(spark, sf):
    """The columns of the cleaned legs that the dimensions read."""
    return flight.dim_columns(legs(spark, sf))


def explore(spark, sf):
    return flight.explore_legs(legs(spark, sf))


def hotels_raw(spark, sf, keep=()):
    return flatten_hotel_pages(parse_hotel_pages(fixtures.hotel_pages(spark, sf)), keep=keep)


def hotels_clean(spark, sf):
    """Staged: the tables and the country key read it, the flattening runs once."""
    path = stage_dir(spark, "hotels")
    hotel.clean_hotels(hotels_raw(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


def flight_pages(spark, sf):
    return fixtures.flight_pages(spark, sf)


def driver_pages(spark, sf):
    return fixtures.read_table(spark, sf, "pages")


def star(spark, sf):
    c = clean(spark, sf)
    airlines, airports = run_concurrently([lambda: flight.dim_airline(c), lambda: flight.dim_airport(c)])
    return c, airlines, airports


LEGS_PER_PART = 50_000  # of the files of scan_legs_glob
FLAGS = ["isBasicEconomy", "isRefundable", "isNonStop"]
DROPPED = ["segmentsArrivalAirportCode", "segmentsDepartureAirportCode",
           "segmentsDurationInSeconds", "segmentDepartureTimes", "segmentArrivalTimes"]
FACT_SCHEMA = StructType([
    StructField("flightKey", LongType()), StructField("isBasicEconomy", IntegerType()),
    StructField("isRefundable", IntegerType()), StructField("isNonStop", IntegerType()),
    StructField("totalFare", FloatType()), StructField("travelDuration", DoubleType()),
    StructField("departureTime", StringType()), StructField("arrivalTime", StringType()),
    StructField("dateKey", StringType()), StructField("airlineKey", LongType()),
    StructField("startingAirportKey", LongType()), StructField("destinationAirportKey", LongType()),
])
FACT_COLS = ", ".join(f.name for f in FACT_SCHEMA.fields)
L = O.with_legs
S = O.with_star
H = O.with_hotels
FR = O.with_flight_rows


# ---- scans / sources ----------------------------------------------------------------

@query("scan_legs_csv", L("SELECT * FROM legs"))
def scan_legs_csv(spark, sf):
    """Legs written as CSV (derived from the tables), read back typed."""
    path = stage_dir(spark, "legs-csv")
    write_csv(legs(spark, sf), path)
    return read_legs(spark, path)


@query("scan_legs_glob", L("SELECT * FROM legs"))
def scan_legs_glob(spark, sf):
    """Several part files addressed by one glob, read as one table. Their
    number follows that of the legs, so no task writes or reads a growing part."""
    path = stage_dir(spark, "legs-glob")
    parts = max(4, -(-fixtures.read_table(spark, sf, "orders").count() // LEGS_PER_PART))
    write_csv(legs(spark, sf).repartition(parts), path)
    return read_legs(spark, f"{path}/part-*.csv")


@query("scan_hotels_csv", H(f"SELECT {O.HOTEL_COLS_CSV} FROM hotels"))
def scan_hotels_csv(spark, sf):
    """S3: hotel rows with quoted labels and line breaks survive a CSV round trip."""
    path = stage_dir(spark, "hotels-csv")
    write_csv(hotels_raw(spark, sf), path)
    return read_hotels(spark, path, split=False)


@query("scan_hotels_split", H(f"SELECT {O.HOTEL_COLS_CSV} FROM hotels"))
def scan_hotels_split(spark, sf):
    """S3: the same rows from one file, which is read in splits: a line break
    inside quotes ends no record."""
    path = stage_dir(spark, "hotels-one-csv")
    write_csv(hotels_raw(spark, sf), path, single_part=True)
    return read_hotels(spark, path)


@query("hotel_json_flatten", H(f"SELECT {O.HOTEL_COLS} FROM hotels"))
def hotel_json_flatten(spark, sf):
    """Nested lookup responses to flat rows, page fields repeated."""
    return hotels_raw(spark, sf)


@query("hotel_json_empty", H("SELECT page, count(*) AS hotels FROM hotels GROUP BY page"))
def hotel_json_empty(spark, sf):
    """Rows per page; the empty closing pages yield no rows at all."""
    rows = hotels_raw(spark, sf, keep=("page",))
    return rows.groupBy("page").agg(F.count(F.lit(1)).alias("hotels"))


@query("ingest_resumable", H(f"SELECT {O.HOTEL_COLS} FROM hotels"))
def ingest_resumable(spark, sf):
    """Land half the pages, ingest, land the rest, ingest, ingest again:
    every page's rows arrive exactly once."""
    root = stage_dir(spark, "ingest")
    pages = fixtures.hotel_pages(spark, sf)
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/_checkpoint"
    land_pages(pages.filter(F.col("page") % 2 == 0), landing, "batch-1")
    ingest_pages(spark, landing, out, ckpt)
    land_pages(pages.filter(F.col("page") % 2 != 0), landing, "batch-2")
    ingest_pages(spark, landing, out, ckpt)
    ingest_pages(spark, landing, out, ckpt)  # nothing new: adds no rows
    return spark.read.parquet(out).select(*HOTEL_COLUMNS)


@query("ingest_rejects", H("SELECT 'rejected' AS kind, '{broken ' || CAST(page AS VARCHAR) AS document "
                           "FROM (SELECT DISTINCT page FROM hotels WHERE page % 5 = 0) UNION ALL "
                           "SELECT 'parsed', CAST(page AS VARCHAR) FROM (SELECT DISTINCT page FROM hotels WHERE page % 5 <> 0)"))
def ingest_rejects(spark, sf):
    """Documents that do not parse land in the rejects table: landed =
    parsed + rejected."""
    root = stage_dir(spark, "ingest-bad")
    page = F.col("page")
    pages = fixtures.hotel_pages(spark, sf).where(page >= 0).withColumn(
        "json", F.when(page % 5 == 0, F.concat(F.lit("{broken "), page.cast("string"))).otherwise(F.col("json")))
    land_pages(pages, f"{root}/landing", "batch-1")
    ingest_pages(spark, f"{root}/landing", f"{root}/out", f"{root}/_checkpoint")
    parsed = spark.read.parquet(f"{root}/out").select(page.cast("string").alias("document")).distinct()
    rejected = spark.read.parquet(rejects_of(f"{root}/out")).select(F.col("json").alias("document"))
    return rejected.select(F.lit("rejected").alias("kind"), "document").unionByName(
        parsed.select(F.lit("parsed").alias("kind"), "document"))


@query("scan_legs_rejects", L("SELECT 'flightDate' AS column_name, 'soon' AS value, count(*) AS rows FROM legs "
                              "WHERE CAST(legId AS BIGINT) % 17 = 0 HAVING count(*) > 0 UNION ALL "
                              "SELECT 'totalFare', 'n/a', count(*) FROM legs WHERE CAST(legId AS BIGINT) % 19 = 0 HAVING count(*) > 0"))
def scan_legs_rejects(spark, sf):
    """Values that a typed scan reads as null although the file holds text."""
    return read_rejects(spark, bad_legs_csv(spark, sf), LEGS)


def bad_legs_csv(spark, sf):
    """Legs as CSV, with dates and fares that are none."""
    path, k = stage_dir(spark, "legs-bad"), F.col("legId").cast("long")
    bad = legs(spark, sf).withColumns({
        "flightDate": F.when(k % 17 == 0, "soon").otherwise(F.col("flightDate").cast("string")),
        "totalFare": F.when(k % 19 == 0, "n/a").otherwise(F.col("totalFare").cast("string"))})
    write_csv(bad, path)
    return path


@query("legs_quarantine", L("""
SELECT CASE WHEN CAST(legId AS BIGINT) % 17 = 0 OR destinationAirport IS NULL THEN 'rejected' ELSE 'loaded' END AS status, legId,
       concat_ws(';', CASE WHEN CAST(legId AS BIGINT) % 17 = 0 THEN 'flightDate=soon' END, CASE WHEN CAST(legId AS BIGINT) % 19 = 0 THEN 'totalFare=n/a' END) AS problems,
       CASE WHEN CAST(legId AS BIGINT) % 17 = 0 OR destinationAirport IS NULL THEN startingAirport END AS kept_airport
FROM legs"""))
def legs_quarantine(spark, sf):
    """One pass over the file sets aside the rows without a date or an
    airport and notes malformed values; landed = loaded + rejected, or it fails."""
    out = stage_dir(spark, "quarantine")
    quarantine_csv(spark, bad_legs_csv(spark, sf), LEGS, out, flight.CRITICAL)
    rows = read_quarantine(spark, out, LEGS)
    noted = F.array_join(F.transform("problems", lambda p: F.concat_ws("=", p.column_name, p.value)), ";")
    return rows.select(F.col("__status").alias("status"), "legId", noted.alias("problems"),
                       F.get_json_object("row", "$.startingAirport").alias("kept_airport"))


@query("page_fields", "SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang, "
                      "regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def page_fields(spark, sf):
    """Scalar fields of saved pages."""
    return scrape.page_fields(driver_pages(spark, sf))


@query("page_rows_zip", """
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, href, anchor FROM (
  SELECT page_id, unnest(h) AS href, unnest(a) AS anchor, generate_subscripts(h, 1) AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h,
           regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS a FROM pages))""")
def page_rows_zip(spark, sf):
    """List fields zipped by position into rows."""
    return scrape.page_links(driver_pages(spark, sf))


@query("filter_array_blank", """
SELECT page_id, CAST(len(ps) AS INTEGER) AS n_all,
       CAST(len(nb) AS INTEGER) AS n_nonblank
FROM (SELECT page_id, regexp_extract_all(html, '<p>([^<]*)', 1) AS ps,
             regexp_extract_all(html, '<p>([^<]+)', 1) AS nb FROM pages)""")
def filter_array_blank(spark, sf):
    """drop empty strings from an extracted list."""
    ps = F.regexp_extract_all("html", F.lit("<p>([^<]*)"), F.lit(1))
    return driver_pages(spark, sf).select(
        "page_id", F.size(ps).alias("n_all"), F.size(non_blank(ps)).alias("n_nonblank"))


# ---- projections / filters ------------------------------------------------------------

@query("project_legs", L(f"SELECT {O.LEG15} FROM legs"))
def project_legs(spark, sf):
    """Keep and order named columns."""
    return project(legs(spark, sf), LEG_COLUMNS)


@query("project_alias", L("SELECT legId, startingAirport AS startingAirportId, "
                          "destinationAirport AS destinationAirportId, segmentsAirlineName AS airlineName FROM legs"))
def project_alias(spark, sf):
    """Project and rename."""
    return project_as(legs(spark, sf), {"legId": "legId", "startingAirport": "startingAirportId",
                                        "destinationAirport": "destinationAirportId",
                                        "segmentsAirlineName": "airlineName"})


@query("bool_flags_to_int", L(f"SELECT legId, {O.flag('isBasicEconomy')} AS isBasicEconomy, "
                              f"{O.flag('isRefundable')} AS isRefundable, {O.flag('isNonStop')} AS isNonStop FROM legs"))
def bool_flags_to_int(spark, sf):
    """Boolean flags to 1/0, null to 0."""
    return with_cols(legs(spark, sf).select("legId", *FLAGS), {c: flag(c) for c in FLAGS})


@query("drop_columns", L("SELECT legId, flightDate, startingAirport, destinationAirport, travelDuration, "
                         "isBasicEconomy, isRefundable, isNonStop, totalFare, segmentsDepartureTimeRaw, "
                         "segmentsArrivalTimeRaw, segmentsAirlineName FROM legs"))
def drop_columns(spark, sf):
    """Drop columns; names that are absent are ignored."""
    return drop_cols(project(legs(spark, sf), LEG_COLUMNS), DROPPED)


@query("duration_hours", L(f"SELECT legId, {O.iso_hours('travelDuration')} AS travelDuration FROM legs"))
def duration_hours(spark, sf):
    """ISO duration to hours (missing parts 0), swapped in under the old name."""
    df = legs(spark, sf).select("legId", "travelDuration")
    df = df.withColumn("travelDurationHours", iso_hours("travelDuration")).drop("travelDuration")
    return rename(df, "travelDurationHours", "travelDuration")


@query("duration_hours_strict", L(f"SELECT legId, {O.iso_hours_strict('travelDuration')} AS travelDuration FROM legs"))
def duration_hours_strict(spark, sf):
    """Both parts required, else null (the Python UDF, made native)."""
    return legs(spark, sf).select("legId", iso_hours_strict("travelDuration").alias("travelDuration"))


@query("drop_null_critical", L(f"SELECT {O.LEG15} FROM legs WHERE "
                               + " AND ".join(c + " IS NOT NULL" for c in O.CRIT)))
def drop_null_critical(spark, sf):
    """drop rows with a null critical column."""
    return drop_null(project(legs(spark, sf), LEG_COLUMNS), flight.CRITICAL)


@query("fill_missing_fare", L("SELECT legId, coalesce(totalFare, 0) AS totalFare FROM legs"))
def fill_missing_fare(spark, sf):
    """fill a missing fare with 0."""
    return fill(legs(spark, sf).select("legId", "totalFare"), {"totalFare": 0})


@query("cast_flags", L("SELECT legId, TRY_CAST(CAST(isBasicEconomy AS VARCHAR) AS BOOLEAN) AS isBasicEconomy, "
                       "TRY_CAST(CAST(isRefundable AS VARCHAR) AS BOOLEAN) AS isRefundable, "
                       "TRY_CAST(CAST(isNonStop AS VARCHAR) AS BOOLEAN) AS isNonStop FROM legs"))
def cast_flags(spark, sf):
    """Flag text to boolean."""
    return legs(spark, sf).select("legId", *[to_bool(F.col(c).cast("string")).alias(c) for c in FLAGS])


@query("cast_fare", L("SELECT legId, CAST(totalFare AS FLOAT) AS totalFare FROM legs"))
def cast_fare(spark, sf):
    """Fare to 32-bit float."""
    return legs(spark, sf).select("legId", to_float("totalFare").alias("totalFare"))


# ---- segments / arrays ---------------------------------------------------------------

@query("segments_split", L("SELECT legId, CAST(len(string_split(segmentsAirlineName, '||')) AS INTEGER) AS n_segments, "
                           "array_to_string(string_split(segmentsAirlineName, '||'), ',') AS airlines FROM legs"))
def segments_split(spark, sf):
    """Split a '||' multi-value column (shown as count and re-joined text)."""
    arr = segments("segmentsAirlineName")
    return legs(spark, sf).select("legId", F.size(arr).alias("n_segments"),
                                  F.array_join(arr, ",").alias("airlines"))


@query("first_segment", L("SELECT legId, string_split(segmentsAirlineName, '||')[1] AS airlineName FROM legs"))
def first_segment(spark, sf):
    """First item of the segment list."""
    return legs(spark, sf).select("legId", first_item(segments("segmentsAirlineName")).alias("airlineName"))


@query("last_segment", L("SELECT legId, string_split(segmentsArrivalTimeRaw, '||')[-1] AS lastArrivalRaw FROM legs"))
def last_segment(spark, sf):
    """Last item of the segment list."""
    return legs(spark, sf).select("legId", last_item(segments("segmentsArrivalTimeRaw")).alias("lastArrivalRaw"))


@query("segment_count", L("SELECT legId, CAST(len(string_split(segmentsDepartureTimeRaw, '||')) AS INTEGER) "
                          "AS n_segments FROM legs"))
def segment_count_q(spark, sf):
    """Number of segments."""
    return legs(spark, sf).select("legId", segment_count(segments("segmentsDepartureTimeRaw")).alias("n_segments"))


@query("explode_airlines", L("SELECT legId, unnest(string_split(segmentsAirlineName, '||')) AS airline FROM legs"))
def explode_airlines(spark, sf):
    """One row per segment airline; null lists give no rows."""
    return legs(spark, sf).select("legId", F.explode(segments("segmentsAirlineName")).alias("airline"))


@query("airline_cross", L("""
SELECT t.airline_name, u.airline_code FROM
  (SELECT string_split(segmentsAirlineName, '||') AS n, string_split(segmentsAirlineCode, '||') AS c FROM legs) x,
  LATERAL (SELECT unnest(x.n) AS airline_name) t,
  LATERAL (SELECT unnest(x.c) AS airline_code) u"""))
def airline_cross(spark, sf):
    """Two generators over one leg = every name with every code."""
    return flight.airline_items(legs(spark, sf), cross=True)


@query("dim_airline_pairs", L("""
SELECT row_number() OVER (ORDER BY airline_name NULLS FIRST, airline_code NULLS FIRST) AS airline_key,
       airline_code, airline_name
FROM (SELECT DISTINCT airline_name, airline_code FROM (
  SELECT unnest(string_split(segmentsAirlineName, '||')) AS airline_name,
         unnest(string_split(segmentsAirlineCode, '||')) AS airline_code FROM legs))"""))
def dim_airline_pairs(spark, sf):
    """name/code pairs by position, deduped, keyed."""
    return flight.dim_airline_pairs(legs(spark, sf))


# ---- times and dates ------------------------------------------------------------------

@query("first_departure_time", L(f"SELECT legId, {O.clock(O.FIRST_DEPARTURE)} AS departureTime FROM legs"))
def first_departure_time(spark, sf):
    """First departure instant shown as hh:mm a (UTC)."""
    return legs(spark, sf).select("legId", clock(first_item(segments("segmentsDepartureTimeRaw"))).alias("departureTime"))


@query("last_arrival_time", L(f"SELECT legId, {O.clock(O.LAST_ARRIVAL)} AS arrivalTime FROM legs"))
def last_arrival_time(spark, sf):
    """Last arrival instant shown as hh:mm a (UTC)."""
    return legs(spark, sf).select("legId", clock(last_item(segments("segmentsArrivalTimeRaw"))).alias("arrivalTime"))


@query("date_key", L("SELECT legId, strftime(flightDate, '%Y%m%d') AS dateKey FROM legs"))
def date_key_q(spark, sf):
    """Date to text key yyyyMMdd."""
    return legs(spark, sf).select("legId", date_key("flightDate").alias("dateKey"))


# ---- flight star schema ---------------------------------------------------------------

@query("clean_legs", S("SELECT * FROM clean"))
def clean_legs(spark, sf):
    """The cleaned legs with a repeatable 1..n flight key."""
    return clean(spark, sf)


@query("dim_airline", S("SELECT * FROM dim_airline"))
def dim_airline(spark, sf):
    """Airline dimension."""
    return flight.dim_airline(clean_for_dims(spark, sf))


@query("dim_airport", S("SELECT * FROM dim_airport"))
def dim_airport(spark, sf):
    """Airport dimension."""
    return flight.dim_airport(clean_for_dims(spark, sf))


@query("dim_date", S("SELECT * FROM dim_date"))
def dim_date(spark, sf):
    """Date dimension with text key."""
    return flight.dim_date(clean_for_dims(spark, sf))


@query("fact_flight", S("SELECT * FROM fact_flight"))
def fact_flight(spark, sf):
    """C5 (flagship): the flight fact with its four keys."""
    return flight.fact_flight(*star(spark, sf))


@query("fact_join_airline", S("SELECT c.flightKey, al.airlineKey FROM clean c "
                              "LEFT JOIN dim_airline al ON c.segmentsAirlineName = al.airlineName"))
def fact_join_airline(spark, sf):
    """Left lookup of the airline key; a null name gets a null key."""
    c = clean(spark, sf)
    airlines = flight.dim_airline(c)
    fact = c.select("flightKey", F.col("segmentsAirlineName").alias("airlineName"))
    return lookup_key(fact, airlines, "airlineName", "airlineName", "airlineKey")


@query("fact_join_airports", S("SELECT c.flightKey, sa.airportKey AS startingAirportKey, "
                               "da.airportKey AS destinationAirportKey FROM clean c "
                               "LEFT JOIN dim_airport sa ON c.startingAirport = sa.airportCode "
                               "LEFT JOIN dim_airport da ON c.destinationAirport = da.airportCode"))
def fact_join_airports(spark, sf):
    """Role-playing lookups (same dimension as start and destination)."""
    c = clean(spark, sf)
    airports = flight.dim_airport(c)
    fact = c.select("flightKey", "startingAirport", "destinationAirport")
    fact = lookup_key(fact, airports, "startingAirport", "airportCode", "airportKey", as_name="startingAirportKey")
    return lookup_key(fact, airports, "destinationAirport", "airportCode", "airportKey",
                      as_name="destinationAirportKey")


@query("dedupe_rows", L(f"SELECT DISTINCT {O.LEG15} FROM legs"))
def dedupe_rows(spark, sf):
    """A1: full-row dedupe."""
    return dedupe(project(legs(spark, sf), LEG_COLUMNS))


@query("distinct_projection", L("SELECT DISTINCT startingAirport, destinationAirport FROM legs"))
def distinct_projection(spark, sf):
    """A2: distinct of a two-column projection."""
    return distinct_of(legs(spark, sf), ["startingAirport", "destinationAirport"])


@query("row_count", L("SELECT count(*) AS row_count FROM legs"))
def row_count_q(spark, sf):
    """A3: row count."""
    return row_count(legs(spark, sf))


@query("preview_limit", L("SELECT least(20, count(*)) AS shown, least(20, count(*)) AS found FROM legs"))
def preview_limit(spark, sf):
    """O2: the first 20 rows, as show() displays. Which rows they are is open,
    so the result says how many are shown and how many of those the legs hold."""
    rows = project(legs(spark, sf), LEG_COLUMNS)
    shown = preview(rows, 20).withColumn("__n", F.monotonically_increasing_id())
    known = rows.select(F.struct(*LEG_COLUMNS).alias("__row")).distinct()
    return (shown.join(known, F.struct(*LEG_COLUMNS).eqNullSafe(F.col("__row")), "left")
            .agg(F.count("__n").alias("shown"), F.count("__row").alias("found")))


@query("airports_union", L("SELECT startingAirport AS airportCode FROM legs UNION SELECT destinationAirport FROM legs"))
def airports_union(spark, sf):
    """SQL UNION of two projections."""
    lg = legs(spark, sf)
    return union_distinct(lg.select(F.col("startingAirport").alias("airportCode")),
                          lg.select(F.col("destinationAirport").alias("airportCode")))


@query("key_natural_order", L("SELECT destinationAirport, row_number() OVER (ORDER BY destinationAirport NULLS FIRST) "
                              "AS airportKey FROM (SELECT DISTINCT destinationAirport FROM legs)"))
def key_natural_order(spark, sf):
    """Dense key by natural order, the null member first (key 1)."""
    codes = distinct_of(legs(spark, sf), ["destinationAirport"])
    return dense_key(codes, ["destinationAirport"], "airportKey")


@query("key_all_columns", L("SELECT legId, flightDate, totalFare, row_number() OVER (ORDER BY legId NULLS FIRST, "
                            "flightDate NULLS FIRST, totalFare NULLS FIRST) AS rowKey "
                            "FROM (SELECT DISTINCT legId, flightDate, totalFare FROM legs)"))
def key_all_columns(spark, sf):
    """Dense key ordered by every column (repeatable where the original
    ordered by a monotonic id)."""
    rows = dedupe(legs(spark, sf).select("legId", "flightDate", "totalFare"))
    return dense_key(rows, None, "rowKey")


@query("key_monotonic", L("SELECT count(*) AS rows, count(*) AS distinct_keys, count(*) AS positive_keys FROM legs"))
def key_monotonic(spark, sf):
    """Unique, gapped, run-dependent id. The ids differ from run to run, so
    the result states what holds of them: one per row, all different, from 1."""
    keyed = unique_key(project(legs(spark, sf), ["legId"]), "flightKey", start=1)
    return keyed.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("flightKey").alias("distinct_keys"),
                     F.count_if(F.col("flightKey") >= 1).alias("positive_keys"))


@query("dim_flight_type", L(f"""
SELECT flight_type_key, {O.flag('isBasicEconomy')} AS isBasicEconomy, {O.flag('isNonStop')} AS isNonStop,
       {O.flag('isRefundable')} AS isRefundable
FROM (SELECT *, row_number() OVER (ORDER BY isBasicEconomy NULLS FIRST, isNonStop NULLS FIRST,
        isRefundable NULLS FIRST) AS flight_type_key
      FROM (SELECT DISTINCT isBasicEconomy, isNonStop, isRefundable FROM legs))""", O.EXPLORE))
def dim_flight_type(spark, sf):
    """Flag combinations keyed before null and false collapse to 0."""
    return flight.dim_flight_type(explore(spark, sf))


@query("dim_date_rownum", L("""
SELECT row_number() OVER (ORDER BY flightDate NULLS FIRST) AS date_key, flightDate,
       CAST(year(flightDate) AS INTEGER) AS year, CAST(month(flightDate) AS INTEGER) AS month,
       CAST(day(flightDate) AS INTEGER) AS day
FROM (SELECT DISTINCT flightDate FROM explore)""", O.EXPLORE))
def dim_date_rownum(spark, sf):
    """Date dimension with an integer key."""
    return flight.dim_date_rownum(explore(spark, sf))


@query("dim_flight", L("""
SELECT row_number() OVER (ORDER BY legId NULLS FIRST, flightDate NULLS FIRST, startingAirport NULLS FIRST,
         destinationAirport NULLS FIRST, totalFare NULLS FIRST, seatsRemaining NULLS FIRST,
         travelDuration NULLS FIRST) AS flight_key,
       legId, flightDate, startingAirport, destinationAirport, totalFare, seatsRemaining, travelDuration
FROM (SELECT DISTINCT legId, flightDate, startingAirport, destinationAirport, totalFare, seatsRemaining,
        travelDuration FROM explore)""", O.EXPLORE))
def dim_flight(spark, sf):
    """The fact-sized flight dimension (two-pass key, no single-task window)."""
    return flight.dim_flight(explore(spark, sf))


SCHEMA_TYPES = {"flightDate": "date", "travelDuration": "double", "isBasicEconomy": "boolean",
                "isRefundable": "boolean", "isNonStop": "boolean", "baseFare": "double",
                "totalFare": "double", "seatsRemaining": "int"}
_schema_rows = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, '{SCHEMA_TYPES.get(c, 'string')}' AS data_type, "
    f"count({c}) AS non_null FROM explore" for i, c in enumerate(LEG_COLUMNS_WIDE))


@query("schema_report", L(_schema_rows, O.EXPLORE))
def schema_report_q(spark, sf):
    """Column types (and non-null counts) of the exploratory input."""
    return schema_report(explore(spark, sf), counts=True)


# ---- hotels ----------------------------------------------------------------------------

@query("clean_hotels", H("SELECT * FROM clean_hotels"))
def clean_hotels(spark, sf):
    """Drop null critical fields, dedupe, lower-case the country."""
    return hotels_clean(spark, sf)


@query("country_lower", H('SELECT "Hotel ID", lower("Country Name") AS "Country Name" FROM hotels'))
def country_lower(spark, sf):
    """Lower-case text."""
    return hotels_raw(spark, sf).select("Hotel ID", lower("Country Name").alias("Country Name"))


@query("dim_country", H("SELECT * FROM dim_country"))
def dim_country(spark, sf):
    """Countries keyed 0..n-1."""
    return hotel.dim_country(hotels_clean(spark, sf))


@query("key_country", H('SELECT "Country Name", row_number() OVER (ORDER BY "Country Name" NULLS FIRST) - 1 '
                        'AS "Country ID" FROM (SELECT DISTINCT "Country Name" FROM hotels)'))
def key_country(spark, sf):
    """0-based dense key over the raw (not lower-cased) country names."""
    names = distinct_of(hotels_raw(spark, sf), ["Country Name"])
    return dense_key(names, ["Country Name"], "Country ID", start=0)


@query("dim_location", H('SELECT DISTINCT "Location ID", "Location Name", "Latitude", "Longitude" FROM clean_hotels'))
def dim_location(spark, sf):
    """Location dimension."""
    return hotel.dim_location(hotels_clean(spark, sf))


@query("dim_hotel", H('SELECT h."Hotel ID", h."Label", h."Location ID", c."Country ID" FROM '
                      '(SELECT DISTINCT "Hotel ID", "Label", "Location ID", "Country Name" FROM clean_hotels) h '
                      'LEFT JOIN dim_country c ON h."Country Name" = c."Country Name"'))
def dim_hotel(spark, sf):
    """Hotel dimension with the country key."""
    h = hotels_clean(spark, sf)
    return hotel.dim_hotel(h, hotel.dim_country(h))


@query("fact_hotel_stay", H('SELECT h."Hotel ID", h."Hotels Count", h."Location ID", c."Country ID" FROM '
                            '(SELECT DISTINCT "Hotel ID", "Hotels Count", "Location ID", "Country Name" FROM clean_hotels) h '
                            'LEFT JOIN dim_country c ON h."Country Name" = c."Country Name"'))
def fact_hotel_stay(spark, sf):
    """C14: hotel-stay fact with the country key."""
    h = hotels_clean(spark, sf)
    return hotel.fact_hotel_stay(h, hotel.dim_country(h))


@query("hotel_join_country", H('SELECT h."Hotel ID", h."Country Name", c."Country ID" FROM clean_hotels h '
                               'LEFT JOIN dim_country c ON h."Country Name" = c."Country Name"'))
def hotel_join_country(spark, sf):
    """Join by name keeping one copy of the name."""
    h = hotels_clean(spark, sf)
    rows = h.select("Hotel ID", "Country Name")
    return lookup_key(rows, hotel.dim_country(h), "Country Name", "Country Name", "Country ID",
                      keep_fact_col=True)


# ---- flight search pages ---------------------------------------------------------------

def page_rows(spark, sf):
    """Rows of the search pages before the sentinel filter."""
    return scrape.page_rows(flight_pages(spark, sf))


@query("scraped_flights", FR("SELECT page_id, flightDate, startingAirport, destinationAirport, isBasicEconomy, "
                             "isRefundable, isNonStop, totalFare, segmentsAirlineName, travelDuration, "
                             "departureTime, arrivalTime, flightKey FROM scrape_rows "
                             "WHERE totalFare <> 'Price Unavailable'"))
def scraped_flights(spark, sf):
    """Saved search pages to the scraper's 12-column flight table."""
    return scrape.scraped_flights(flight_pages(spark, sf), year=fixtures.SCRAPE_YEAR)


@query("page_rows_keyed", FR("SELECT page_id, flightKey, 'A' || CAST(k % 7 AS VARCHAR) AS airline "
                             "FROM scrape_rows"))
def page_rows_keyed(spark, sf):
    """1..n per page in list order, before any row is dropped."""
    return page_rows(spark, sf).select("page_id", "flightKey", first_of("airline").alias("airline"))


@query("page_rejects", FR("SELECT page_id, CAST(max(n) AS INTEGER) AS n_items, CAST(max(n) + 1 AS INTEGER) AS n_fares "
                          "FROM scrape_rows WHERE page_id % 4 = 0 AND n % 2 = 1 GROUP BY page_id"))
def page_rejects(spark, sf):
    """Pages with more fares than flights are diverted, not made into rows."""
    return scrape.page_rejects(surplus_fares(spark, sf))


def surplus_fares(spark, sf):
    """The search pages, every fourth with one more fare text at its end."""
    extra = '<span role="text" aria-label="9 US dollars">$9</span></ul>'
    return flight_pages(spark, sf).withColumn(
        "html", F.when(F.col("page_id") % 4 == 0, F.replace("html", F.lit("</ul>"), F.lit(extra))).otherwise(F.col("html")))


@query("scraped_flights_rules", FR("SELECT page_id, flightDate, startingAirport, destinationAirport, isBasicEconomy, "
                                   "isRefundable, isNonStop, totalFare, segmentsAirlineName, travelDuration, "
                                   "departureTime, arrivalTime, flightKey FROM scrape_rows "
                                   "WHERE totalFare <> 'Price Unavailable'"))
def scraped_flights_rules(spark, sf):
    """The same table from pages marked up otherwise (other attribute
    order, more classes, nested tags, entities), by rules given as argument."""
    html = F.col("html")
    for old, new in (('<div class="al">', '<div data-x="1" class="row al big"><b>'), (", B</div>", "&#44; B</b></div>"),
                     ('<span role="text" aria-label="', '<span data-k="v" aria-label="From '), ("$", "<i>&#36;</i>"),
                     ('<div class="st">1 stop', '<div class="x st"><span>1</span> st&#111;p'),
                     ('<input class="date" value="', '<input type="text" class="q date" value="'),
                     ('<span class="dep" aria-label="', '<span aria-label="'), ('<span class="arr" aria-label="', '<span aria-label="')):
        html = F.replace(html, F.lit(old), F.lit(new))
    rules = {"airline": elements_text("div", "al"), "fare": elements_text("span", aria_label="US dollars"),
             "stops": elements_text("div", "st"), "cabin": element_text("div", "cabin"),
             "date_label": attribute("input", "value", "date"),
             "dep": attributes("span", "aria-label", aria_label=scrape.DEPARTURE_MARKER.strip()),
             "arr": attributes("span", "aria-label", aria_label=scrape.ARRIVAL_MARKER.strip()),
             "duration": elements_text("div", "du")}
    return scrape.scraped_flights(flight_pages(spark, sf).withColumn("html", html), year=fixtures.SCRAPE_YEAR, rules=rules)


@query("scraped_flights_nested", SQL["scraped_flights_rules"])
def scraped_flights_nested(spark, sf):
    """The same table from pages whose fields hold elements of their own
    name, comments and scripts with tags in them, attributes quoted in either
    way or not at all, and references by name, number and code point."""
    html = F.col("html")
    for old, new in (('<div class="al">', "<DIV title='a > b' class='row al'><div class=al2><div>"), (", B</div>", "&comma; B</div></div></DIV>"),
                     ('<div class="st">1 stop', "<div class=st><!-- </div> --><div>1</div><script>var x='</div>';</script> st&#x6f;p"),
                     ('<div class="st">Nonstop', '<div\nclass = "st"><div>Non</div>stop'),
                     ('<div class="cabin">', "<div class=cabin><div class='cabin-mark'></div>"),
                     ('<div class="du">', "<div id=du class='du x'><div hidden></div>"),
                     ("$", "&dollar;")):
        html = F.replace(html, F.lit(old), F.lit(new))
    rules = {"airline": elements_text("div", "al"), "fare": elements_text("span", role="text", aria_label="US dollars"),
             "stops": elements_text("div", "st"), "cabin": element_text("div", "cabin"), "date_label": attribute("input", "value", "date"),
             "dep": attributes("span", "aria-label", "dep"), "arr": attributes("span", "aria-label", "arr"),
             "duration": elements_text("div", "du"), "from_ap": elements_text("div", "from"), "to_ap": elements_text("div", "to")}
    return scrape.scraped_flights(flight_pages(spark, sf).withColumn("html", html), year=fixtures.SCRAPE_YEAR, rules=rules)


@query("page_elements", r"""
SELECT page_id, regexp_replace(regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's'), '&amp;', '&', 'g') AS ad,
       list_transform(regexp_extract_all(html, '<a href="([^"]*)">', 1), lambda x: regexp_replace(x, '&amp;', '&', 'g')) AS hrefs,
       CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS n_items,
       regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '&amp;', '&', 'g') AS title FROM pages""")
def page_elements(spark, sf):
    """Elements of saved pages by tag, class and attribute."""
    found = extract_page_fields(driver_pages(spark, sf), {
        "ad": element_text("div", "ad"), "hrefs": attributes("a", "href"), "items": elements_text("li"), "title": element_text("title")})
    return found.select("page_id", "ad", "hrefs", F.size("items").alias("n_items"), "title")


@query("label_to_date", FR("SELECT DISTINCT page_id, flightDate FROM scrape_rows"))
def label_to_date(spark, sf):
    """X16: 'Wed, Jan 1' plus a year to a date."""
    f = scrape.page_lists(flight_pages(spark, sf))
    return f.select("page_id", label_date("date_label", fixtures.SCRAPE_YEAR).alias("flightDate"))


@query("label_to_time", FR("SELECT page_id, flightKey, departureTime, arrivalTime FROM scrape_rows"))
def label_to_time(spark, sf):
    """Aria labels to '9:05 AM'."""
    return page_rows(spark, sf).select(
        "page_id", "flightKey", label_time("dep", scrape.DEPARTURE_MARKER).alias("departureTime"),
        label_time("arr", scrape.ARRIVAL_MARKER).alias("arrivalTime"))


@query("duration_text_hours", FR("""
SELECT page_id, flightKey, travelDuration,
  CASE WHEN k % 10 = 7 THEN printf('%.2f', (k % 59 + 1) / 60.0)
       WHEN k % 3 = 0 THEN printf('%.2f', CAST(k % 9 + 1 AS DOUBLE))
       ELSE printf('%.2f', (k % 9 + 1) + (k % 59 + 1) / 60.0) END AS travelDurationStrict
FROM scrape_rows"""))
def duration_text_hours(spark, sf):
    """X3/N18: '2 hr 29 min' to '2.48'; the positional rule and the unit-aware one."""
    return page_rows(spark, sf).select(
        "page_id", "flightKey", text_hours("duration").alias("travelDuration"),
        text_hours("duration", strict=True).alias("travelDurationStrict"))


@query("text_to_flag", FR("SELECT page_id, flightKey, isBasicEconomy, isNonStop FROM scrape_rows"))
def text_to_flag(spark, sf):
    """text equality to a 1/0 flag."""
    return page_rows(spark, sf).select("page_id", "flightKey",
                                       text_flag("cabin", "Economy").alias("isBasicEconomy"),
                                       text_flag("stops", "Nonstop").alias("isNonStop"))


@query("fare_strip", FR("SELECT page_id, flightKey, totalFare FROM scrape_rows"))
def fare_strip(spark, sf):
    """Fares without the currency sign, the short list padded."""
    return page_rows(spark, sf).select("page_id", "flightKey", F.col("fare").alias("totalFare"))


@query("first_of_list", FR("SELECT page_id, flightKey, segmentsAirlineName FROM scrape_rows"))
def first_of_list(spark, sf):
    """First of a comma list, trimmed."""
    return page_rows(spark, sf).select("page_id", "flightKey", first_of("airline").alias("segmentsAirlineName"))


@query("pad_fares", FR("SELECT page_id, CAST(max(n) AS INTEGER) AS n_items, "
                       "CAST(max(n) - CASE WHEN max(n) % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_fares, "
                       "CAST(max(n) AS INTEGER) AS n_padded FROM scrape_rows GROUP BY page_id"))
def pad_fares(spark, sf):
    """Pad a short list with a sentinel to the item count."""
    f = scrape.page_lists(flight_pages(spark, sf))
    return f.select("page_id", F.size("dep").alias("n_items"), F.size("fare").alias("n_fares"),
                    F.size(pad("fare", F.size("dep"), scrape.NO_FARE)).alias("n_padded"))


@query("filter_sentinel", FR("SELECT page_id, flightKey FROM scrape_rows WHERE totalFare <> 'Price Unavailable'"))
def filter_sentinel(spark, sf):
    """drop the rows whose fare is the sentinel."""
    rows = page_rows(spark, sf).select("page_id", "flightKey", F.col("fare").alias("totalFare"))
    return drop_sentinel(rows, "totalFare", scrape.NO_FARE).drop("totalFare")


# ---- sinks -----------------------------------------------------------------------------

@query("sink_csv_roundtrip", S(f"SELECT {FACT_COLS} FROM fact_flight"))
def sink_csv_roundtrip(spark, sf):
    """K1/K3: the fact written as a CSV folder and read back typed."""
    path = stage_dir(spark, "fact-csv")
    write_csv(flight.fact_flight(*star(spark, sf)), path)
    return read_typed_csv(spark, path, FACT_SCHEMA)


@query("sink_single_csv", S("SELECT airlineName, airlineKey FROM dim_airline"))
def sink_single_csv(spark, sf):
    """K2: one named CSV file, renamed through the Hadoop file system."""
    path = stage_dir(spark, "single") + "/dim_airline.csv"
    write_single_csv(flight.dim_airline(clean_for_dims(spark, sf)), path)
    schema = StructType([StructField("airlineName", StringType()), StructField("airlineKey", LongType())])
    return read_typed_csv(spark, path, schema)


@query("sink_append", H(f"SELECT {O.HOTEL_COLS_CSV} FROM hotels"))
def sink_append(spark, sf):
    """K4: two appends to one CSV folder read back as one table."""
    path = stage_dir(spark, "append")
    rows = hotels_raw(spark, sf, keep=("page",))
    append_rows(rows.filter(F.col("page") % 2 == 0).drop("page"), path)
    append_rows(rows.filter(F.col("page") % 2 != 0).drop("page"), path)
    return read_hotels(spark, path)


def _published_sql(table: str, dims: list[str], time_sql: str, floats: tuple[str, ...] = ()) -> str:
    cols = ", ".join(f"{O.float_text(d)} AS {d}" if d in floats else f"CAST({d} AS VARCHAR) AS {d}"
                     for d in dims)
    return S(f"SELECT DISTINCT {time_sql} AS __time, {cols}, CAST({time_sql} AS DATE) AS __day FROM {table}")


@query("publish_fact_by_day", _published_sql("fact_flight", FACT_DIMS,
                                             "CAST(strptime(dateKey, '%Y%m%d') AS TIMESTAMP)",
                                             floats=("totalFare",)))
def publish_fact_by_day(spark, sf):
    """K5/A4: publish the fact by day with text dimensions, as the store types
    bare dimension names. "Publish twice equals once" and "replace only the
    days present" are checked by tests."""
    path = stage_dir(spark, "pub-fact")
    fact = flight.fact_flight(*star(spark, sf))
    publish(fact, path, FACT_DIMS, "dateKey", "yyyyMMdd", unique_key="flightKey")
    return read_published(spark, path)


@query("publish_dim_date", _published_sql("dim_date", DATE_DIMS, "CAST(strptime(dateKey, '%Y%m%d') AS TIMESTAMP)"))
def publish_dim_date(spark, sf):
    """K5: the date dimension published with its own key as time."""
    path = stage_dir(spark, "pub-date")
    publish(flight.dim_date(clean_for_dims(spark, sf)), path, DATE_DIMS, "dateKey", "yyyyMMdd")
    return read_published(spark, path)


@query("publish_dim_constant_time", _published_sql("dim_airport", ["airportKey", "airportCode"],
                                                   "TIMESTAMP '1970-01-01 00:00:00'"))
def publish_dim_constant_time(spark, sf):
    """K6: a dimension without time column, published at 1970-01-01."""
    path = stage_dir(spark, "pub-airport")
    publish(flight.dim_airport(clean_for_dims(spark, sf)), path, ["airportKey", "airportCode"])
    return read_published(spark, path)


@query("publish_missing_time", S("""
SELECT DISTINCT CASE WHEN dayOfMonth % 2 = 0 THEN CAST(strptime(dateKey, '%Y%m%d') AS TIMESTAMP) ELSE TIMESTAMP '1990-01-01 00:00:00' END AS __time,
       CAST(dateKey AS VARCHAR) AS dateKey,
       CAST(CASE WHEN dayOfMonth % 2 = 0 THEN CAST(strptime(dateKey, '%Y%m%d') AS TIMESTAMP) ELSE TIMESTAMP '1990-01-01 00:00:00' END AS DATE) AS __day
FROM dim_date"""))
def publish_missing_time(spark, sf):
    """K5: a time that is null or does not parse takes the given value; every
    row is published, in segments of a month."""
    path, day = stage_dir(spark, "pub-missing"), F.col("dayOfMonth")
    dates = flight.dim_date(clean_for_dims(spark, sf)).withColumn(
        "at", F.when(day % 2 == 0, F.col("dateKey")).when(day % 3 == 0, "bad"))
    publish(dates, path, ["dateKey"], "at", "yyyyMMdd", missing="1990-01-01 00:00:00", granularity="month")
    return read_published(spark, path)


# ---- end-to-end runs ---------------------------------------------------------------------------

def _content(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the rows of a table and a sum over the hashes of their text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")).alias("content"))


def _contents(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    parts = [_content(df, cols).select(F.lit(name).alias("table_name"), "rows", "content") for name, (df, cols) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _content_sql(name: str, source: str, texts: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({t} AS VARCHAR), '')" for t in texts)
    return (f"SELECT '{name}' AS table_name, count(*) AS rows, "
            f"CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS BIGINT) AS content FROM {source}")


def _quoted(columns: list[str]) -> list[str]:
    return [f'"{c}"' for c in columns]


CLEAN_TABLE = flight.CLEAN_COLUMNS + ["flightKey"]
_float = lambda cols: [O.float_text(c) if c == "totalFare" else c for c in cols]
FLIGHT_TABLES = {"dim_airport": ["airportCode", "airportKey"], "dim_airline": ["airlineName", "airlineKey"],
                 "dim_date": DATE_DIMS, "fact_flight": FACT_DIMS}


@query("flight_etl_run", S(" UNION ALL ".join(
    [_content_sql("clean_legs", "clean", _float(CLEAN_TABLE))]
    + [_content_sql(n, n, _float(c)) for n, c in FLIGHT_TABLES.items()]
    + [_content_sql("published_fact_flight", "fact_flight", _float(FACT_DIMS)),
       _content_sql("published_dim_date", "dim_date", DATE_DIMS)])))
def flight_etl_run(spark, sf):
    """The whole flight run; rows and content of what it wrote."""
    p = run_flight(spark, legs(spark, sf), stage_dir(spark, "flight-run"))
    csv = lambda path: spark.read.option("header", True).csv(path)
    tables = {"clean_legs": (spark.read.parquet(p["clean"]), CLEAN_TABLE)}
    tables |= {n: (csv(p[n]), c) for n, c in FLIGHT_TABLES.items()}
    tables["published_fact_flight"] = (read_published(spark, p["pub_fact_flight"]), FACT_DIMS)
    tables["published_dim_date"] = (read_published(spark, p["pub_dim_date"]), DATE_DIMS)
    return _contents(tables)


_CH = "(SELECT * FROM clean_hotels WHERE \"Country Name\" <> '')"
_CC = f"(SELECT \"Country Name\", row_number() OVER (ORDER BY \"Country Name\") - 1 AS \"Country ID\" FROM (SELECT DISTINCT \"Country Name\" FROM {_CH}))"
HOTEL_TABLES = {"dim_country": ["Country Name", "Country ID"], "dim_hotel": ["Hotel ID", "Label", "Location ID", "Country ID"],
                "fact_hotel_stay": ["Hotel ID", "Hotels Count", "Location ID", "Country ID"]}


def _keyed_hotels(columns: list[str]) -> str:
    cols = ", ".join(_quoted(columns))
    return f"(SELECT h.*, c.\"Country ID\" FROM (SELECT DISTINCT {cols}, \"Country Name\" FROM {_CH}) h JOIN {_CC} c USING (\"Country Name\"))"


@query("hotel_etl_run", H(" UNION ALL ".join([
    _content_sql("dim_country", _CC, _quoted(HOTEL_TABLES["dim_country"])),
    _content_sql("dim_hotel", _keyed_hotels(HOTEL_TABLES["dim_hotel"][:-1]), _quoted(HOTEL_TABLES["dim_hotel"])),
    _content_sql("fact_hotel_stay", _keyed_hotels(HOTEL_TABLES["fact_hotel_stay"][:-1]), _quoted(HOTEL_TABLES["fact_hotel_stay"])),
    _content_sql("dim_location", f'(SELECT DISTINCT "Location ID", "Location Name", "Latitude", "Longitude" FROM {_CH})',
                 _quoted(["Location ID", "Location Name"]))])))
def hotel_etl_run(spark, sf):
    """Land pages, ingest incrementally, build the hotel tables; rows and
    content of what was written."""
    root = stage_dir(spark, "hotel-run")
    land_pages(fixtures.hotel_pages(spark, sf), f"{root}/landing", "batch-1")
    p = run_hotel(spark, f"{root}/landing", f"{root}/out")
    csv = lambda path: spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    tables = {n: (csv(p[n]), c) for n, c in HOTEL_TABLES.items()}
    return _contents(tables | {"dim_location": (csv(p["dim_location"]), ["Location ID", "Location Name"])})


EXPLORE_TABLES = {"dim_airline": ("dim_airline_pairs", ["airline_key", "airline_code", "airline_name"]),
                  "dim_flight_type": ("dim_flight_type", ["flight_type_key", "isBasicEconomy", "isNonStop", "isRefundable"]),
                  "dim_date": ("dim_date_rownum", ["date_key", "flightDate", "year", "month", "day"]),
                  "dim_flight": ("dim_flight", ["flight_key", "legId", "flightDate", "startingAirport", "destinationAirport", "seatsRemaining"])}


@query("explore_etl_run", " UNION ALL ".join(_content_sql(n, f"({SQL[q]})", c) for n, (q, c) in EXPLORE_TABLES.items()))
def explore_etl_run(spark, sf):
    """The exploratory job's tables; rows and content of what it wrote."""
    p = run_explore(spark, legs(spark, sf), stage_dir(spark, "explore-run"))
    csv = lambda path: spark.read.option("header", True).csv(path)
    return _contents({n: (csv(p[n]), c) for n, (_, c) in EXPLORE_TABLES.items()})


@query("scrape_run", FR("SELECT * EXCLUDE (page_id, pos) FROM (SELECT page_id, flightKey AS pos, flightDate, startingAirport, "
                        "destinationAirport, isBasicEconomy, isRefundable, isNonStop, totalFare, segmentsAirlineName, travelDuration, "
                        "departureTime, arrivalTime, row_number() OVER (ORDER BY page_id, flightKey) AS flightKey FROM scrape_rows) "
                        "WHERE totalFare <> 'Price Unavailable'"))
def scrape_run(spark, sf):
    """Saved pages to the scraper's CSV, read back; keys over the table."""
    path = run_scrape(spark, flight_pages(spark, sf), stage_dir(spark, "scrape-run"), year=fixtures.SCRAPE_YEAR)
    return spark.read.schema("flightDate date, startingAirport string, destinationAirport string, isBasicEconomy int, isRefundable int, "
                             "isNonStop int, totalFare string, segmentsAirlineName string, travelDuration string, departureTime string, "
                             "arrivalTime string, flightKey long").option("header", True).csv(path).select(*SCRAPED_COLUMNS)


@query("fact_join_bucketed", """
SELECT o_orderkey, o_custkey, c_nationkey AS nationKey, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey FROM orders)
LEFT JOIN (SELECT c_custkey, c_nationkey, c_name FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey""")
def fact_join_bucketed(spark, sf):
    """J1/J2 beyond the broadcast budget: orders and customers stored by buckets
    of the customer; a third of the orders have one customer."""
    k = F.col("o_orderkey")
    orders = fixtures.read_table(spark, sf, "orders").select("o_orderkey", F.when(k % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")).cast("long").alias("o_custkey"))
    customers = fixtures.read_table(spark, sf, "customer").where("c_custkey % 5 <> 0").select(
        F.col("c_custkey").cast("long").alias("c_custkey"), F.struct("c_nationkey", "c_name").alias("member"))
    fact, dim = store_bucketed(orders, "o_custkey", 16), store_bucketed(customers, "c_custkey", 16, find_hot=False)
    found = bucketed_lookup(spark, fact, dim, "member")
    return found.select("o_orderkey", "o_custkey", F.col("member.c_nationkey").alias("nationKey"), F.col("member.c_name").alias("c_name"))


@query("clean_legs_hashed", L(f"""
SELECT {', '.join(c for c in flight.CLEAN_COLUMNS)}, count(*) AS copies, (SELECT count(*) FROM clean) AS keys, true AS keys_dense FROM clean GROUP BY ALL""",
    O.CLEAN))
def clean_legs_hashed(spark, sf):
    """The cleaned legs, numbered on the dedupe's own exchange. Which number
    a leg has depends on the hash; that they are 1..n, each once, is the result."""
    path = stage_dir(spark, "hashed-legs")
    flight.clean_legs(legs(spark, sf), key="hashed").write.parquet(path)
    rows = spark.read.parquet(path)
    k = F.col("flightKey")
    n, low, high, distinct = rows.agg(F.count(F.lit(1)), F.min(k), F.max(k), F.count_distinct(k)).first()
    return rows.groupBy(*flight.CLEAN_COLUMNS).agg(F.count(F.lit(1)).alias("copies")).withColumns(
        {"keys": F.lit(n).cast("long"), "keys_dense": F.lit((low, high, distinct) in ((1, n, n), (None, None, 0)))})


# ---- second loads and releases ------------------------------------------------------------------

#: The first file's legs; the second file holds all legs, so these again.
FIRST_FILE = ("destinationAirport < 'M' AND startingAirport < 'M' AND flightDate < DATE '1996-01-01' "
              "AND segmentsAirlineName LIKE 'Carrier 1%'")
_CLEAN_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ["legId"] + flight.CLEAN_COLUMNS)


@query("flight_two_loads", L(f"""
SELECT f.flightKey, f.load, strftime(f.flightDate, '%Y%m%d') AS dateKey, f.totalFare, a.airlineKey, f.segmentsAirlineName AS airlineName,
       s.airportKey AS startingAirportKey, f.startingAirport, d.airportKey AS destinationAirportKey, f.destinationAirport
FROM loaded f LEFT JOIN airlines a ON f.segmentsAirlineName = a.airlineName
LEFT JOIN airports s ON f.startingAirport = s.airportCode LEFT JOIN airports d ON f.destinationAirport = d.airportCode""",
    O.CLEAN.split("clean AS (")[0].replace(f"DISTINCT {O.LEG15}", f"DISTINCT {O.LEG15}, CAST(CASE WHEN {FIRST_FILE} THEN 1 ELSE 2 END AS INTEGER) AS load")
    .replace("SELECT legId,", "SELECT legId, load,").rstrip().rstrip(","),
    f"loaded AS (SELECT *, row_number() OVER (ORDER BY load, {_CLEAN_ORDER}) AS flightKey FROM clean_cols)",
    """airlines AS (SELECT airlineName, row_number() OVER (ORDER BY load, airlineName NULLS FIRST) AS airlineKey
  FROM (SELECT segmentsAirlineName AS airlineName, min(load) AS load FROM loaded GROUP BY ALL))""",
    """airports AS (SELECT airportCode, row_number() OVER (ORDER BY load, airportCode NULLS FIRST) AS airportKey
  FROM (SELECT airportCode, min(load) AS load FROM (SELECT startingAirport AS airportCode, load FROM loaded
        UNION ALL SELECT destinationAirport, load FROM loaded) GROUP BY ALL))"""))
def flight_two_loads(spark, sf):
    """C16, W1, W4, A1 on a schedule: a file of some legs, a file of all, and that
    file again. Keys given by the first load stay, each leg is there once."""
    root, given = stage_dir(spark, "two-loads"), stage_dir(spark, "two-loads-legs")
    legs(spark, sf).write.parquet(given)  # the files of the two loads
    every = spark.read.parquet(given)
    for file in (every.where(FIRST_FILE), every, every):
        load_flight(spark, file, root)
    release = Release(spark, root)
    airlines, airports = release.read("dim_airline"), release.read("dim_airport")
    facts = release.read("fact_flight").withColumn("load", F.when(F.col("flightKey") <= release.state(1)["flightKey"], 1).otherwise(2))
    named = (facts.join(airlines.select("airlineKey", "airlineName"), "airlineKey", "left")
             .join(airports.select(F.col("airportKey").alias("startingAirportKey"), F.col("airportCode").alias("startingAirport")), "startingAirportKey", "left")
             .join(airports.select(F.col("airportKey").alias("destinationAirportKey"), F.col("airportCode").alias("destinationAirport")),
                   "destinationAirportKey", "left"))
    return named.select("flightKey", "load", "dateKey", "totalFare", "airlineKey", "airlineName", "startingAirportKey", "startingAirport",
                        "destinationAirportKey", "destinationAirport")


_KEPT = """(SELECT * REPLACE (lower("Country Name") AS "Country Name"), CASE WHEN page % 4 = 0 THEN 1 ELSE 2 END AS load FROM hotels
  WHERE "Hotel ID" IS NOT NULL AND "Label" IS NOT NULL AND "Location Name" IS NOT NULL AND "Country Name" <> ''
    AND "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL)"""


@query("hotel_two_loads", H(f"""
SELECT DISTINCT h."Hotel ID", h."Hotels Count", h."Location ID", c."Country ID", c."Country Name" FROM {_KEPT} h JOIN
  (SELECT "Country Name", row_number() OVER (ORDER BY min(load), "Country Name") - 1 AS "Country ID" FROM {_KEPT} GROUP BY "Country Name") c
  USING ("Country Name")"""))
def hotel_two_loads(spark, sf):
    """C18 on a schedule: some pages land and are loaded, then all of them; country
    keys given by the first load stay, and each stay is there once."""
    root, pages = stage_dir(spark, "hotel-loads"), fixtures.hotel_pages(spark, sf)
    for name, some in (("batch-1", pages.where("page % 4 = 0")), ("batch-2", pages)):
        land_pages(some, f"{root}/landing", name)
        load_hotels(spark, f"{root}/landing", root)
    release = Release(spark, f"{root}/release")
    stays, countries = release.read("fact_hotel_stay"), release.read("dim_country")
    return stays.join(countries, "Country ID").select("Hotel ID", "Hotels Count", "Location ID", "Country ID", "Country Name")


@query("publish_versions", S("""
SELECT CAST(v AS INTEGER) AS version, 'flights' AS table_name, strftime(flightDate, '%Y%m%d') AS dateKey, count(*) AS rows
FROM clean, range(1, 3) t(v) WHERE v = 1 OR NOT (year(flightDate) = 1995 AND day(flightDate) % 2 = 1) GROUP BY ALL
UNION ALL
SELECT CAST(v AS INTEGER), 'dim_date', dateKey, 1 FROM dim_date, range(1, 3) t(v) WHERE v = 1 OR NOT (year = 1995 AND dayOfMonth % 2 = 1)"""))
def publish_versions(spark, sf):
    """K5: two tables in one release; the second version replaces the year 1995
    by its even days, so the odd ones go from both. Rows of both versions."""
    release = Release(spark, stage_dir(spark, "release"))
    flights = stage_dir(spark, "release-flights")
    clean(spark, sf).select("flightKey", date_key("flightDate").alias("dateKey")).write.parquet(flights)
    flights = spark.read.parquet(flights)
    path = stage_dir(spark, "release-dates")  # both versions read them
    flight.dim_date(clean_for_dims(spark, sf)).select("dateKey", "dayOfMonth").write.parquet(path)
    dates = spark.read.parquet(path)
    frames = lambda keep: {
        "flights": publish_frame(flights.where(keep), ["flightKey", "dateKey"], "dateKey", "yyyyMMdd", typed=True, unique_key="flightKey"),
        "dim_date": publish_frame(dates.where(keep), ["dateKey", "dayOfMonth"], "dateKey", "yyyyMMdd", typed=True, unique_key="dateKey")}
    release.publish({n: Change(df) for n, df in frames("true").items()})
    even = "dateKey LIKE '1995%' AND pmod(cast(substr(dateKey, 7) AS int), 2) = 0"
    release.publish({n: Change(df, interval=("1995-01-01", "1995-12-31")) for n, df in frames(even).items()})
    counts = [release.read(name, v).groupBy("dateKey").agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(v).alias("version"), F.lit(name).alias("table_name"), "dateKey", "rows")
              for v in (1, 2) for name in ("flights", "dim_date")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
