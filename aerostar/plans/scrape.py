"""Saved flight search pages -> the scraper's 12-column flight table, and the
field / link extraction over generic pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions import (
    first_of, label_date, label_time, non_blank, strip_currency, text_flag, text_hours,
)
from aerostar.operators import dense_key, drop_sentinel, position_key
from aerostar.sources import extract_page_fields, unequal_lists, zip_fields

# Where the search page keeps each field, and the scraper's
# sentinel for a missing fare.
FLIGHT_PAGE_RULES = {
    "cabin": (r'<div class="cabin">([^<]*)</div>', 1, "one"),
    "date_label": (r'<input class="date" value="([^"]*)"', 1, "one"),
    "dep": (r'<span class="dep" aria-label="([^"]*)"', 1, "all"),
    "arr": (r'<span class="arr" aria-label="([^"]*)"', 1, "all"),
    "airline": (r'<div class="al">([^<]*)</div>', 1, "all"),
    "stops": (r'<div class="st">([^<]*)</div>', 1, "all"),
    "fare": (r'<span role="text" aria-label="[^"]*US dollars">([^<]*)</span>', 1, "all"),
    "duration": (r'<div class="du">([^<]*)</div>', 1, "all"),
    "from_ap": (r'<div class="from">([^<]*)</div>', 1, "all"),
    "to_ap": (r'<div class="to">([^<]*)</div>', 1, "all"),
}
NO_FARE = "Price Unavailable"
DEPARTURE_MARKER = "Departure time: "
ARRIVAL_MARKER = "Arrival time: "

# Generic page fields of the driver's ``pages`` table.
PAGE_RULES = {
    "lang": (r'<html lang="([^"]*)"', 1, "one"),
    "title": (r"<title>([^<]*)</title>", 1, "one"),
    "href": (r'<a href="([^"]*)">([^<]*)</a>', 1, "all"),
    "anchor": (r'<a href="([^"]*)">([^<]*)</a>', 2, "all"),
}


ITEM_LISTS = ["dep", "arr", "airline", "stops", "fare", "duration", "from_ap", "to_ap"]


def page_lists(pages: DataFrame, rules: dict | None = None) -> DataFrame:
    """Per page: scalars and lists; fares keep only non-blank texts and lose
    the currency sign, as the scraper does. ``rules`` says where a page keeps
    each field (see ``sources.web_pages``), by default as the fixture's do."""
    f = extract_page_fields(pages, {**FLIGHT_PAGE_RULES, **(rules or {})})
    return f.withColumn("fare", F.transform(non_blank("fare"), lambda x: strip_currency(x)))


def page_rejects(pages: DataFrame, rules: dict | None = None) -> DataFrame:
    """Pages whose lists do not make rows: a list is longer than the first one
    or, fares aside, shorter."""
    return page_lists(pages, rules).where(unequal_lists(ITEM_LISTS, {"fare": NO_FARE})).select(
        "page_id", F.size("dep").alias("n_items"), F.size("fare").alias("n_fares"))


def page_rows(pages: DataFrame, rules: dict | None = None, divert: bool = False) -> DataFrame:
    """Rows of the pages by position, keyed 1..n per page in list order.
    ``divert`` leaves out the pages of ``page_rejects``, which otherwise fail
    the job."""
    lists = page_lists(pages, rules)
    if divert:
        lists = lists.where(~unequal_lists(ITEM_LISTS, {"fare": NO_FARE}))
    rows = zip_fields(lists, ITEM_LISTS, keep=("page_id", "cabin", "date_label"), pad={"fare": NO_FARE})
    return position_key(rows, "pos", "flightKey")


def scraped_flights(pages: DataFrame, year: int = 2025, strict_duration: bool = False,
                    rules: dict | None = None, divert: bool = False, table_key: bool = False) -> DataFrame:
    """Rows by position; fares padded with the sentinel; keys 1..n in list
    order *before* sentinel rows are dropped (so gaps remain), per page or, by
    ``table_key``, over the whole table by (page, position); the page date
    parsed with ``year`` (the scraper overwrote it with the raw label)."""
    rows = page_rows(pages, rules, divert)
    if table_key:
        rows = dense_key(rows.drop("flightKey"), ["page_id", "pos"], "flightKey")
    out = rows.select(
        "page_id",
        label_date("date_label", year).alias("flightDate"),
        F.col("from_ap").alias("startingAirport"),
        F.col("to_ap").alias("destinationAirport"),
        text_flag("cabin", "Economy").alias("isBasicEconomy"),
        F.lit(0).alias("isRefundable"),
        text_flag("stops", "Nonstop").alias("isNonStop"),
        F.col("fare").alias("totalFare"),
        first_of("airline").alias("segmentsAirlineName"),
        text_hours("duration", strict=strict_duration).alias("travelDuration"),
        label_time("dep", DEPARTURE_MARKER).alias("departureTime"),
        label_time("arr", ARRIVAL_MARKER).alias("arrivalTime"),
        "flightKey",
    )
    return drop_sentinel(out, "totalFare", NO_FARE)


def page_fields(pages: DataFrame) -> DataFrame:
    """Scalar fields of generic pages: language and title."""
    return extract_page_fields(pages, {k: PAGE_RULES[k] for k in ("lang", "title")})


def page_links(pages: DataFrame) -> DataFrame:
    """Links of generic pages as rows (href and anchor text zipped by position)."""
    lists = extract_page_fields(pages, {k: PAGE_RULES[k] for k in ("href", "anchor")})
    return zip_fields(lists, ["href", "anchor"], keep=("page_id",))
