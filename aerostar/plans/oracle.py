"""DuckDB SQL for the correctness gate: the fixtures of ``fixtures.py`` and the
operators over them, written independently in SQL. Tables (region nation
customer supplier part orders lineitem pages ...) are views in DuckDB."""

from __future__ import annotations

CRIT = ("legId", "flightDate", "startingAirport", "destinationAirport")
LEG15 = ("legId, flightDate, startingAirport, destinationAirport, travelDuration, isBasicEconomy, "
         "isRefundable, isNonStop, totalFare, segmentsDepartureTimeRaw, segmentsArrivalTimeRaw, "
         "segmentsArrivalAirportCode, segmentsDepartureAirportCode, segmentsAirlineName, "
         "segmentsDurationInSeconds")


def vs(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


def lpad2(e: str) -> str:
    return f"lpad(CAST({e} AS VARCHAR), 2, '0')"


def clock(e: str) -> str:
    """Offset timestamp text -> 'hh:mm AM' of the UTC instant."""
    local = f"try_strptime(substr({e}, 1, 23), '%Y-%m-%dT%H:%M:%S.%g')"
    sign = f"(CASE WHEN substr({e}, 24, 1) = '-' THEN -1 ELSE 1 END)"
    mins = f"(TRY_CAST(substr({e}, 25, 2) AS INTEGER) * 60 + TRY_CAST(substr({e}, 28, 2) AS INTEGER))"
    return f"strftime({local} - to_minutes(CAST({sign} * {mins} AS BIGINT)), '%I:%M %p')"


def float_text(e: str) -> str:
    """A 32-bit float as Spark casts it to text: the shortest decimal that reads
    back as the same float (ties to even), e.g. 490695.12 rather than the exact
    490695.125 that a plain cast prints here."""
    x = f"CAST({e} AS DOUBLE)"
    cases = " ".join(f"WHEN CAST(round_even({x}, {d}) AS FLOAT) = {e} THEN CAST(round_even({x}, {d}) AS VARCHAR)"
                     for d in range(10))
    return f"CASE WHEN {e} IS NULL THEN NULL {cases} ELSE CAST({x} AS VARCHAR) END"


def iso_hours(e: str) -> str:
    h = f"CAST(coalesce(TRY_CAST(regexp_extract({e}, 'PT(\\d+)H', 1) AS FLOAT), 0.0) AS DOUBLE)"
    m = f"CAST(coalesce(TRY_CAST(regexp_extract({e}, '(\\d+)M', 1) AS FLOAT), 0.0) AS DOUBLE)"
    return f"round({h} + {m} / 60, 2)"


def iso_hours_strict(e: str) -> str:
    p = "'^PT(\\d+)H(\\d+)M'"
    return (f"CASE WHEN regexp_matches({e}, {p}) THEN round(CAST(regexp_extract({e}, {p}, 1) AS INTEGER)"
            f" + CAST(regexp_extract({e}, {p}, 2) AS INTEGER) / 60.0, 2) END")


def flag(e: str) -> str:
    return f"CASE WHEN {e} = true THEN 1 ELSE 0 END"


FIRST_DEPARTURE = "string_split(segmentsDepartureTimeRaw, '||')[1]"
LAST_ARRIVAL = "string_split(segmentsArrivalTimeRaw, '||')[-1]"

_SEG_ORDER = "ORDER BY ln, pk, sk, px, dep, arr"

LEGS = f"""
legs_seg AS (
  SELECT l_orderkey, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS px,
    CASE WHEN l_orderkey % 37 = 0 THEN 'n/a'
         ELSE strftime(l_shipdate, '%Y-%m-%d') || 'T' || {lpad2('(l_linenumber * 3) % 24')} || ':30:00.000-04:00' END AS dep,
    strftime(l_shipdate, '%Y-%m-%d') || 'T' || {lpad2('(l_linenumber * 5 + 1) % 24')} || ':'
      || {lpad2('(l_linenumber * 7) % 60')} || ':00.000+01:00' AS arr,
    'P' || {vs('l_partkey % 25')} AS arr_ap,
    'S' || {vs('l_suppkey % 25')} AS dep_ap,
    'Carrier ' || {vs('l_suppkey % 31')} AS name,
    'C' || {vs('l_suppkey % 31')} AS code,
    {vs('l_linenumber * 900')} AS secs
  FROM lineitem),
legs_ord AS (
  SELECT l_orderkey, min(sk) AS min_supp, sum(ln) AS q, count(*) AS n_lines,
    string_agg(dep, '||' {_SEG_ORDER}) AS dep_raw,
    string_agg(arr, '||' {_SEG_ORDER}) AS arr_raw,
    string_agg(arr_ap, '||' {_SEG_ORDER}) AS arr_ap_raw,
    string_agg(dep_ap, '||' {_SEG_ORDER}) AS dep_ap_raw,
    string_agg(name, '||' {_SEG_ORDER}) AS name_raw,
    string_agg(code, '||' {_SEG_ORDER}) AS code_raw,
    string_agg(secs, '||' {_SEG_ORDER}) AS secs_raw
  FROM legs_seg GROUP BY l_orderkey),
legs_base AS (
  SELECT {vs('o.o_orderkey')} AS legId,
    CAST(o.o_orderdate AS DATE) AS flightDate,
    sn.n_name AS startingAirport,
    CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE dn.n_name END AS destinationAirport,
    CASE WHEN a.q % 10 = 0 THEN 'PT' || {vs('(a.q * 7) % 60')} || 'M'
         WHEN a.q % 10 = 1 THEN 'PT' || {vs('a.q % 24')} || 'H'
         WHEN a.q % 10 = 2 THEN 'P1DT' || {vs('a.q % 24')} || 'H' || {vs('(a.q * 7) % 60')} || 'M'
         WHEN a.q % 10 = 3 THEN NULL
         ELSE 'PT' || {vs('a.q % 24')} || 'H' || {vs('(a.q * 7) % 60')} || 'M' END AS travelDuration,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderkey % 2 = 0 END AS isBasicEconomy,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderkey % 3 = 0 END AS isRefundable,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE a.n_lines = 1 END AS isNonStop,
    o.o_totalprice * 0.5 AS baseFare,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice END AS totalFare,
    CAST(o.o_orderkey % 10 AS INTEGER) AS seatsRemaining,
    a.dep_raw AS segmentsDepartureTimeRaw,
    a.arr_raw AS segmentsArrivalTimeRaw,
    a.arr_ap_raw AS segmentsArrivalAirportCode,
    a.dep_ap_raw AS segmentsDepartureAirportCode,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE a.name_raw END AS segmentsAirlineName,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE a.code_raw END AS segmentsAirlineCode,
    a.secs_raw AS segmentsDurationInSeconds,
    o.o_orderkey AS k
  FROM orders o
  JOIN legs_ord a ON a.l_orderkey = o.o_orderkey
  JOIN nation sn ON sn.n_nationkey = a.min_supp % 25
  JOIN nation dn ON dn.n_nationkey = o.o_custkey % 25),
legs AS (
  SELECT b.* EXCLUDE (k) FROM legs_base b
  JOIN (SELECT 1 AS c UNION ALL SELECT 2 AS c) rep ON rep.c = 1 OR b.k % 20 = 0)"""

CLEAN = f"""
clean_src AS (
  SELECT DISTINCT {LEG15} FROM legs
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in CRIT)}),
clean_cols AS (
  SELECT legId, flightDate, startingAirport, destinationAirport,
    {flag('isBasicEconomy')} AS isBasicEconomy,
    {flag('isRefundable')} AS isRefundable,
    {flag('isNonStop')} AS isNonStop,
    CAST(coalesce(totalFare, 0) AS FLOAT) AS totalFare,
    string_split(segmentsAirlineName, '||')[1] AS segmentsAirlineName,
    {iso_hours('travelDuration')} AS travelDuration,
    {clock(FIRST_DEPARTURE)} AS departureTime,
    {clock(LAST_ARRIVAL)} AS arrivalTime
  FROM clean_src),
clean AS (
  SELECT * EXCLUDE (legId), row_number() OVER (ORDER BY legId NULLS FIRST, flightDate NULLS FIRST,
    startingAirport NULLS FIRST, destinationAirport NULLS FIRST, isBasicEconomy NULLS FIRST,
    isRefundable NULLS FIRST, isNonStop NULLS FIRST, totalFare NULLS FIRST,
    segmentsAirlineName NULLS FIRST, travelDuration NULLS FIRST, departureTime NULLS FIRST,
    arrivalTime NULLS FIRST) AS flightKey
  FROM clean_cols)"""

DIMS = """
dim_airline AS (
  SELECT airlineName, row_number() OVER (ORDER BY airlineName NULLS FIRST) AS airlineKey
  FROM (SELECT DISTINCT segmentsAirlineName AS airlineName FROM clean)),
dim_airport AS (
  SELECT airportCode, row_number() OVER (ORDER BY airportCode NULLS FIRST) AS airportKey
  FROM (SELECT startingAirport AS airportCode FROM clean
        UNION SELECT destinationAirport FROM clean)),
dim_date AS (
  SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
    CAST(day(date) AS INTEGER) AS dayOfMonth, CAST(dayofweek(date) + 1 AS INTEGER) AS dayOfWeek,
    CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y%m%d') AS dateKey
  FROM (SELECT DISTINCT flightDate AS date FROM clean))"""

FACT = """
fact_flight AS (
  SELECT c.flightKey, c.isBasicEconomy, c.isRefundable, c.isNonStop, c.totalFare,
    c.travelDuration, c.departureTime, c.arrivalTime, strftime(c.flightDate, '%Y%m%d') AS dateKey,
    al.airlineKey, sa.airportKey AS startingAirportKey, da.airportKey AS destinationAirportKey
  FROM clean c
  LEFT JOIN dim_airline al ON c.segmentsAirlineName = al.airlineName
  LEFT JOIN dim_airport sa ON c.startingAirport = sa.airportCode
  LEFT JOIN dim_airport da ON c.destinationAirport = da.airportCode)"""

EXPLORE = f"""
explore AS (
  SELECT legId, flightDate, startingAirport, destinationAirport,
    {iso_hours_strict('travelDuration')} AS travelDuration,
    isBasicEconomy, isRefundable, isNonStop, baseFare, totalFare, seatsRemaining,
    segmentsDepartureTimeRaw, segmentsArrivalTimeRaw, segmentsArrivalAirportCode,
    segmentsDepartureAirportCode, segmentsAirlineName, segmentsAirlineCode, segmentsDurationInSeconds
  FROM legs)"""


def with_legs(select: str, *extra: str) -> str:
    ctes = ",".join((LEGS,) + extra)
    return f"WITH {ctes}\n{select}"


def with_star(select: str) -> str:
    return with_legs(select, CLEAN, DIMS, FACT)


# ---- hotels -----------------------------------------------------------------

HOTELS = """
hotel_counts AS (
  SELECT c_nationkey AS cn, CAST(count(*) AS INTEGER) AS hotels_count FROM customer GROUP BY c_nationkey),
hotels AS (
  SELECT (c_custkey // 250) * 25 + c_nationkey AS page,
    CAST(c_custkey AS VARCHAR) AS "Hotel ID",
    CASE WHEN c_custkey % 7 = 0 THEN c_name || ' "Grand", Hotel'
         WHEN c_custkey % 9 = 0 THEN c_name || chr(10) || 'Annex' ELSE c_name END AS "Label",
    c_mktsegment AS "Location Name",
    c_name || ', ' || n_name AS "Full Name",
    CAST(c_nationkey AS VARCHAR) AS "Location ID",
    n_name AS "City Name",
    CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE '' END AS "Country Name",
    'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "Country Code",
    'I' || CAST(n_nationkey AS VARCHAR) AS "IATA",
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal / 100 END AS "Latitude",
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE -c_acctbal / 50 END AS "Longitude",
    hotels_count AS "Hotels Count"
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN hotel_counts ON cn = c_nationkey),
clean_hotels AS (
  SELECT * REPLACE (lower("Country Name") AS "Country Name") FROM (
    SELECT DISTINCT "Hotel ID", "Label", "Location Name", "Full Name", "Location ID", "City Name",
      "Country Name", "Country Code", "IATA", "Latitude", "Longitude", "Hotels Count"
    FROM hotels
    WHERE "Hotel ID" IS NOT NULL AND "Label" IS NOT NULL AND "Location Name" IS NOT NULL
      AND "Country Name" IS NOT NULL AND "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL)),
dim_country AS (
  SELECT "Country Name", row_number() OVER (ORDER BY "Country Name" NULLS FIRST) - 1 AS "Country ID"
  FROM (SELECT DISTINCT "Country Name" FROM clean_hotels))"""

HOTEL_COLS_CSV = ('"Hotel ID", "Label", "Location Name", "Full Name", "Location ID", '
                  'NULLIF("City Name", \'\') AS "City Name", NULLIF("Country Name", \'\') AS "Country Name", '
                  'NULLIF("Country Code", \'\') AS "Country Code", NULLIF("IATA", \'\') AS "IATA", '
                  '"Latitude", "Longitude", "Hotels Count"')

HOTEL_COLS = ('"Hotel ID", "Label", "Location Name", "Full Name", "Location ID", "City Name", '
              '"Country Name", "Country Code", "IATA", "Latitude", "Longitude", "Hotels Count"')


def with_hotels(select: str) -> str:
    return f"WITH {HOTELS}\n{select}"


# ---- flight search pages ------------------------------------------------------

FLIGHT_ROWS = """
fo AS (
  SELECT o_orderkey AS k, o_custkey, o_orderkey // 16 AS page_id,
    row_number() OVER (PARTITION BY o_orderkey // 16 ORDER BY o_orderkey) AS pos,
    count(*) OVER (PARTITION BY o_orderkey // 16) AS n,
    first_value(o_orderdate) OVER (PARTITION BY o_orderkey // 16 ORDER BY o_orderkey) AS first_date
  FROM orders),
scrape_rows AS (
  SELECT page_id, pos AS flightKey, n, k,
    CAST(try_strptime('2025 ' || strftime(first_date, '%b %-d'), '%Y %b %d') AS DATE) AS flightDate,
    'AP' || CAST(o_custkey % 40 AS VARCHAR) AS startingAirport,
    'AP' || CAST(k % 40 AS VARCHAR) AS destinationAirport,
    CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS isBasicEconomy,
    0 AS isRefundable,
    CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS isNonStop,
    CASE WHEN pos = n AND n % 2 = 0 THEN 'Price Unavailable'
         WHEN k % 25 = 0 THEN '1,' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0')
         ELSE CAST(k % 900 + 50 AS VARCHAR) END AS totalFare,
    'A' || CAST(k % 7 AS VARCHAR) AS segmentsAirlineName,
    CASE WHEN k % 10 = 7 THEN printf('%.2f', CAST(k % 59 + 1 AS DOUBLE))
         WHEN k % 3 = 0 THEN printf('%.2f', CAST(k % 9 + 1 AS DOUBLE))
         ELSE printf('%.2f', (k % 9 + 1) + (k % 59 + 1) / 60.0) END AS travelDuration,
    CAST(k % 12 + 1 AS VARCHAR) || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ' '
      || CASE WHEN k % 2 = 0 THEN 'AM' ELSE 'PM' END AS departureTime,
    CAST((k * 5) % 12 + 1 AS VARCHAR) || ':' || lpad(CAST((k * 7) % 60 AS VARCHAR), 2, '0') || ' '
      || CASE WHEN k % 3 = 0 THEN 'PM' ELSE 'AM' END AS arrivalTime
  FROM fo)"""


def with_flight_rows(select: str) -> str:
    return f"WITH {FLIGHT_ROWS}\n{select}"
