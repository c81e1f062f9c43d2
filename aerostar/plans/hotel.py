"""Hotel star schema: cleaned rows, country / location / hotel dimensions and
the hotel-stay fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.operators import dedupe, dense_key, distinct_of, drop_null, lookup_key
from aerostar.schemas import HOTEL_TABLE, LOCATION_TABLE, STAY_TABLE

# Columns without which a hotel row does not count.
CRITICAL = ["Hotel ID", "Label", "Location Name", "Country Name", "Latitude", "Longitude"]


def clean_hotels(rows: DataFrame) -> DataFrame:
    """Drop rows with a null critical field, dedupe, lower-case the country.
    The dedupe runs before lower-casing, as in the original."""
    df = dedupe(drop_null(rows, CRITICAL))
    return df.withColumn("Country Name", F.lower(F.col("Country Name")))


def dim_country(hotels: DataFrame) -> DataFrame:
    """Countries keyed 0..n-1 by name. The original's monotonic id over a
    recomputed distinct could disagree between outputs; this key is the same
    in every output that uses it."""
    names = distinct_of(hotels, ["Country Name"])
    return dense_key(names, ["Country Name"], "Country ID", start=0)


def hotel_table(hotels: DataFrame, columns: list[str], countries: DataFrame | None = None) -> DataFrame:
    """Distinct rows of some hotel columns; a ``Country ID`` among them comes
    from ``countries`` by the row's country name."""
    given = ["Country Name" if c == "Country ID" else c for c in columns]
    rows = distinct_of(hotels, [F.col(f"`{c}`") for c in given])
    if "Country ID" in columns:
        rows = lookup_key(rows, countries, "Country Name", "Country Name", "Country ID")
    return rows.select(*columns)


def dim_location(hotels: DataFrame) -> DataFrame:
    return hotel_table(hotels, LOCATION_TABLE)


def dim_hotel(hotels: DataFrame, countries: DataFrame) -> DataFrame:
    return hotel_table(hotels, HOTEL_TABLE, countries)


def fact_hotel_stay(hotels: DataFrame, countries: DataFrame) -> DataFrame:
    return hotel_table(hotels, STAY_TABLE, countries)
