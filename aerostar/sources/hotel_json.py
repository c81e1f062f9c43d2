"""Nested hotel lookup responses to flat hotel rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions.text import field
from aerostar.schemas import HOTEL_COLUMNS, HOTEL_PAGE


CORRUPT = "__corrupt"
_PARSED = HOTEL_PAGE.simpleString()[:-1] + f",{CORRUPT}:string>"


def _parsed(json_col: str):
    return F.from_json(F.col(json_col), _PARSED, {"columnNameOfCorruptRecord": CORRUPT})


def parse_hotel_pages(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Text documents -> ``(page, results)`` structs of the documents that
    parse; the others are the rows of ``reject_hotel_pages``."""
    return (df.select(_parsed(json_col).alias("__doc")).where(f"__doc is not null and __doc.{CORRUPT} is null")
            .select("__doc.page", "__doc.results"))


def reject_hotel_pages(df: DataFrame, json_col: str = "json") -> DataFrame:
    """The documents that do not parse (null text included), as they are: every
    input row is either parsed or rejected."""
    doc = _parsed(json_col)
    return df.where(doc.isNull() | doc[CORRUPT].isNotNull())


def tag_hotel_pages(df: DataFrame, json_col: str = "json") -> DataFrame:
    """``json``, the parsed document (``doc``) and whether it parses: every input
    row is here, parsed once."""
    tagged = df.select(F.col(json_col).alias("json"), _parsed(json_col).alias("doc"))
    return tagged.withColumn("parsed", F.col("doc").isNotNull() & F.col(f"doc.{CORRUPT}").isNull())


def flatten_hotel_pages(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per hotel, the page-level location fields repeated on each row.

    Defaults follow the crawler: absent text is ``''``, an absent count is 0,
    absent hotel fields (and a hotel without ``location``) are null. JSON null
    and an absent key look the same after ``from_json``, so both take the
    default. An empty ``hotels`` list yields no rows."""
    loc = F.col("results.location")
    page_level = [
        field(loc["cityName"], "").alias("City Name"),
        field(loc["countryName"], "").alias("Country Name"),
        field(loc["countryCode"], "").alias("Country Code"),
        field(loc["iata"], "").alias("IATA"),
        field(loc["hotelsCount"], 0).cast("int").alias("Hotels Count"),
    ]
    items = pages.select(*keep, *page_level, F.explode("results.hotels").alias("h"))
    h = F.col("h")
    out = items.select(
        *keep,
        h["id"].alias("Hotel ID"), h["label"].alias("Label"),
        h["locationName"].alias("Location Name"), h["fullName"].alias("Full Name"),
        h["locationId"].alias("Location ID"),
        "City Name", "Country Name", "Country Code", "IATA",
        h["location"]["lat"].alias("Latitude"), h["location"]["lon"].alias("Longitude"),
        "Hotels Count",
    )
    return out.select(*keep, *HOTEL_COLUMNS)
