"""Adapters that shape the driver's test tables into the travel inputs.

The original jobs read files nobody ships (a flight-prices CSV, hotel lookup
responses, saved search pages). These adapters derive equivalent inputs from
the TPC-H-like test tables so every operator runs on data that grows with the
scale factor and has a DuckDB oracle (``aerostar.plans.oracle`` holds the same
definitions in SQL). Formulas are fixture choices, chosen to hit the edge
cases of SURVEY section 1.4 (missing duration parts, null flags, null fares,
null airports, bad timestamps, exact duplicate rows, absent JSON keys, labels
with quotes and line breaks, short fare lists).

Scale notes: every group that is collected is bounded by construction - the
lines of one order (a TPC-H order has a handful of lines), at most
``HOTELS_PER_PAGE`` customer keys per hotel page and ``FLIGHTS_PER_PAGE``
orders per search page - so no task ever holds an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostar.session import table_path

# Fixed values of the fixtures (shared with the SQL oracle).
AIRLINES = 31            # carriers: 'Carrier <l_suppkey % 31>'
HOTELS_PER_PAGE = 250    # customer keys per hotel page block
FLIGHTS_PER_PAGE = 16    # orders per search page
SCRAPE_YEAR = 2025


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _lpad2(c):
    return F.lpad(c.cast("string"), 2, "0")


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight leg per order with lines (plus exact copies of every 20th).

    Segments are the order's lines in (l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, ...) order, joined with ``||``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    # Only the small numeric line fields cross the shuffle; segment strings are
    # built after grouping. Sorting by (line, part, supplier, price, ship day)
    # is the segment order (the strings are functions of these fields).
    line = F.struct(
        F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"), F.col("l_extendedprice").alias("px"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    per_order = li.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("min_supp"),
        F.sum("l_linenumber").alias("q"),
        F.count(F.lit(1)).alias("n_lines"),
        F.array_sort(F.collect_list(line)).alias("segs"),
    )
    na = F.col("l_orderkey") % 37 == 0

    def seg_text(s, field):
        day, ln = s["day"].cast("string"), s["ln"]
        carrier = (s["sk"] % AIRLINES).cast("string")
        return {
            "dep": F.when(na, F.lit("n/a")).otherwise(
                F.concat(day, F.lit("T"), _lpad2((ln * 3) % 24), F.lit(":30:00.000-04:00"))),
            "arr": F.concat(day, F.lit("T"), _lpad2((ln * 5 + 1) % 24), F.lit(":"), _lpad2((ln * 7) % 60),
                            F.lit(":00.000+01:00")),
            "arr_ap": F.concat(F.lit("P"), (s["pk"] % 25).cast("string")),
            "dep_ap": F.concat(F.lit("S"), (s["sk"] % 25).cast("string")),
            "name": F.concat(F.lit("Carrier "), carrier),
            "code": F.concat(F.lit("C"), carrier),
            "secs": (ln * 900).cast("string"),
        }[field]

    # One pass over each order's sorted lines builds every segment text (a
    # single lambda); the texts are then pulled out per field without lambdas.
    fields = ["dep", "arr", "arr_ap", "dep_ap", "name", "code", "secs"]
    texts = F.transform("segs", lambda x: F.struct(*[seg_text(x, f).alias(f) for f in fields]))
    per_order = per_order.withColumn("segs", texts)

    def joined(field):
        return F.array_join(F.col(f"segs.{field}"), "||")

    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    start_nation = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    dest_nation = nation.select(F.col("n_nationkey").alias("dn_key"), F.col("n_name").alias("dn_name"))
    k = F.col("o_orderkey")
    q = F.col("q")
    h = (q % 24).cast("string")
    m = ((q * 7) % 60).cast("string")
    duration = (F.when(q % 10 == 0, F.concat(F.lit("PT"), m, F.lit("M")))
                 .when(q % 10 == 1, F.concat(F.lit("PT"), h, F.lit("H")))
                 .when(q % 10 == 2, F.concat(F.lit("P1DT"), h, F.lit("H"), m, F.lit("M")))
                 .when(q % 10 == 3, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("PT"), h, F.lit("H"), m, F.lit("M"))))
    nullable_flag = lambda cond: F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(cond)
    airline_null = k % 13 == 0
    base = (orders.join(per_order, k == F.col("l_orderkey"))
            .join(start_nation, F.col("min_supp") % 25 == F.col("sn_key"))
            .join(dest_nation, F.col("o_custkey") % 25 == F.col("dn_key"))
            .select(
                k.cast("string").alias("legId"),
                F.col("o_orderdate").cast("date").alias("flightDate"),
                F.col("sn_name").alias("startingAirport"),
                F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("dn_name"))
                 .alias("destinationAirport"),
                duration.alias("travelDuration"),
                nullable_flag(k % 2 == 0).alias("isBasicEconomy"),
                nullable_flag(k % 3 == 0).alias("isRefundable"),
                nullable_flag(F.col("n_lines") == 1).alias("isNonStop"),
                (F.col("o_totalprice") * 0.5).alias("baseFare"),
                F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
                 .alias("totalFare"),
                (k % 10).cast("int").alias("seatsRemaining"),
                joined("dep").alias("segmentsDepartureTimeRaw"),
                joined("arr").alias("segmentsArrivalTimeRaw"),
                joined("arr_ap").alias("segmentsArrivalAirportCode"),
                joined("dep_ap").alias("segmentsDepartureAirportCode"),
                F.when(airline_null, F.lit(None).cast("string")).otherwise(joined("name"))
                 .alias("segmentsAirlineName"),
                F.when(airline_null, F.lit(None).cast("string")).otherwise(joined("code"))
                 .alias("segmentsAirlineCode"),
                joined("secs").alias("segmentsDurationInSeconds"),
                k.alias("__k"),
            ))
    # Exact copies of every 20th leg, made by a generator rather than a union
    # (a union would scan and aggregate the inputs twice).
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("__k") % 20 == 0, 2).otherwise(1)))
    return base.select("*", copies.alias("__copy")).drop("__k", "__copy")


def hotel_rows_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer hotel facts with their page number (no JSON yet)."""
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "n_name", "r_name"))
    # Hotels per city (nation): one small aggregate, 25 rows.
    counts = (cust.groupBy(F.col("c_nationkey").alias("cn"))
              .agg(F.count(F.lit(1)).cast("int").alias("hotels_count")))
    ck = F.col("c_custkey")
    label = (F.when(ck % 7 == 0, F.concat("c_name", F.lit(' "Grand", Hotel')))
              .when(ck % 9 == 0, F.concat("c_name", F.lit("\nAnnex")))
              .otherwise(F.col("c_name")))
    return (cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(counts, F.col("c_nationkey") == F.col("cn"))
            .select(
                ((ck / HOTELS_PER_PAGE).cast("long") * 25 + F.col("c_nationkey")).alias("page"),
                F.col("n_nationkey"), F.col("n_name"), F.col("r_name"), F.col("hotels_count"),
                ck.cast("string").alias("id"), label.alias("label"),
                F.col("c_mktsegment").alias("locationName"),
                F.concat("c_name", F.lit(", "), "n_name").alias("fullName"),
                F.col("c_nationkey").cast("string").alias("locationId"),
                F.when(ck % 10 == 0, F.lit(None))
                 .otherwise(F.struct((F.col("c_acctbal") / 100).alias("lat"),
                                     (-F.col("c_acctbal") / 50).alias("lon"))).alias("location"),
            ))


def _location_struct():
    nk = F.col("n_nationkey")
    return F.struct(
        F.col("n_name").alias("cityName"),
        # countryName is absent (not null) for odd nations: to_json drops nulls.
        F.when(nk % 2 == 0, F.col("r_name")).alias("countryName"),
        F.concat(F.lit("N"), F.lpad(nk.cast("string"), 2, "0")).alias("countryCode"),
        F.concat(F.lit("I"), nk.cast("string")).alias("iata"),
        F.col("hotels_count").alias("hotelsCount"),
    )


def hotel_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lookup responses: ``(page bigint, json string)``, one JSON document
    per (customer-key block, nation) page, plus one empty closing page per nation."""
    rows = hotel_rows_source(spark, sf_dir)
    hotel = F.struct("id", "label", "locationName", "fullName", "locationId", "location")
    pages = (rows.groupBy("page", "n_nationkey", "n_name", "r_name", "hotels_count")
             .agg(F.array_sort(F.collect_list(hotel)).alias("hotels")))
    full = pages.select("page", F.struct(_location_struct().alias("location"),
                                         F.col("hotels")).alias("results"))
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    empty = (nation.join(region, nation.n_regionkey == region.r_regionkey)
             .select((-1 - F.col("n_nationkey")).cast("long").alias("page"),
                     F.struct(F.struct(F.col("n_name").alias("cityName")).alias("location"),
                              F.array().cast("array<string>").alias("hotels")).alias("results")))
    docs = full.select("page", F.to_json(F.struct("page", "results")).alias("json"))
    closing = empty.select("page", F.to_json(F.struct("page", "results")).alias("json"))
    return docs.unionByName(closing)


def flight_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved search pages: ``(page_id bigint, html string)``, one page per block
    of ``FLIGHTS_PER_PAGE`` order keys, items in order-key order. The last item
    of a page with an even item count shows no fare (a short fare list)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    am = F.when(k % 2 == 0, "AM").otherwise("PM")
    dep = F.concat(F.lit('<span class="dep" aria-label="Departure time: '),
                   (k % 12 + 1).cast("string"), F.lit(":"), _lpad2(k % 60),
                   F.lit("\u202f"), am, F.lit('."></span>'))
    arr = F.concat(F.lit('<span class="arr" aria-label="Arrival time: '),
                   ((k * 5) % 12 + 1).cast("string"), F.lit(":"), _lpad2((k * 7) % 60),
                   F.lit("\u202f"), F.when(k % 3 == 0, "PM").otherwise("AM"), F.lit('."></span>'))
    hours = (k % 9 + 1).cast("string")
    mins = (k % 59 + 1).cast("string")
    # Saved pages separate with no-break spaces and line breaks too.
    gap = F.when(k % 7 == 1, "\u00a0").when(k % 7 == 2, "\u202f").when(k % 7 == 3, "\n").otherwise(" ")
    dur = (F.when(k % 10 == 7, F.concat(mins, gap, F.lit("min")))
            .when(k % 3 == 0, F.concat(hours, gap, F.lit("hr")))
            .otherwise(F.concat(hours, gap, F.lit("hr"), gap, mins, gap, F.lit("min"))))
    fare = F.when(k % 25 == 0, F.concat(F.lit("1,"), F.lpad((k % 1000).cast("string"), 3, "0"))) \
            .otherwise((k % 900 + 50).cast("string"))
    item = F.struct(
        k.alias("k"),
        F.concat(F.lit('<li class="fl">'), dep, arr,
                 F.lit('<div class="al">'), F.when(k % 5 == 1, "\n\u00a0").otherwise(""), F.lit("A"), (k % 7).cast("string"),
                 F.when(k % 5 == 2, "\n").otherwise(""), F.lit(", B</div>"),
                 F.lit('<div class="st">'), F.when(k % 4 == 0, "Nonstop").otherwise("1 stop"),
                 F.lit("</div>")).alias("head"),
        F.concat(F.lit('<span role="text" aria-label="'), fare, F.lit(' US dollars">$'), fare,
                 F.lit("</span>")).alias("fare"),
        F.concat(F.lit('<div class="du">'), dur, F.lit('</div><div class="from">AP'),
                 (F.col("o_custkey") % 40).cast("string"), F.lit('</div><div class="to">AP'),
                 (k % 40).cast("string"), F.lit("</div></li>")).alias("tail"),
    )
    page_id = (k / FLIGHTS_PER_PAGE).cast("long")
    pages = (o.groupBy(page_id.alias("page_id"))
             .agg(F.array_sort(F.collect_list(item)).alias("items"),
                  F.min_by("o_orderdate", "o_orderkey").alias("first_date")))
    n = F.size("items")
    body = F.array_join(F.transform(
        "items",
        lambda x, i: F.concat(x["head"],
                              F.when((i == n - 1) & (n % 2 == 0), F.lit("")).otherwise(x["fare"]),
                              x["tail"])), "")
    cabin = F.when(F.col("page_id") % 3 == 0, "Premium economy").otherwise("Economy")
    html = F.concat(F.lit('<html><body><div class="cabin">'), cabin,
                    F.lit('</div><input class="date" value="'),
                    F.date_format("first_date", "EEE, MMM d"), F.lit('"><ul>'), body,
                    F.lit("</ul></body></html>"))
    return pages.select("page_id", html.alias("html"))
