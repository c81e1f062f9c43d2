"""Declared input schemas (no inference pass at read time). All names, orders
and types here are fixed values: they are the files' own."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType,
)

# Flight legs CSV: the 15 columns of the main job plus the three the
# exploratory job adds (baseFare, seatsRemaining, segmentsAirlineCode).
LEGS = StructType([
    StructField("legId", StringType()),
    StructField("flightDate", DateType()),
    StructField("startingAirport", StringType()),
    StructField("destinationAirport", StringType()),
    StructField("travelDuration", StringType()),
    StructField("isBasicEconomy", BooleanType()),
    StructField("isRefundable", BooleanType()),
    StructField("isNonStop", BooleanType()),
    StructField("baseFare", DoubleType()),
    StructField("totalFare", DoubleType()),
    StructField("seatsRemaining", IntegerType()),
    StructField("segmentsDepartureTimeRaw", StringType()),
    StructField("segmentsArrivalTimeRaw", StringType()),
    StructField("segmentsArrivalAirportCode", StringType()),
    StructField("segmentsDepartureAirportCode", StringType()),
    StructField("segmentsAirlineName", StringType()),
    StructField("segmentsAirlineCode", StringType()),
    StructField("segmentsDurationInSeconds", StringType()),
])

# Columns the main flight job selects (in its order).
LEG_COLUMNS = [
    "legId", "flightDate", "startingAirport", "destinationAirport",
    "travelDuration", "isBasicEconomy", "isRefundable", "isNonStop",
    "totalFare", "segmentsDepartureTimeRaw", "segmentsArrivalTimeRaw",
    "segmentsArrivalAirportCode", "segmentsDepartureAirportCode",
    "segmentsAirlineName", "segmentsDurationInSeconds",
]

# Columns the exploratory job keeps (in its order).
LEG_COLUMNS_WIDE = LEGS.names

# Hotel rows as the crawler writes them (CSV header names).
HOTELS = StructType([
    StructField("Hotel ID", StringType()),
    StructField("Label", StringType()),
    StructField("Location Name", StringType()),
    StructField("Full Name", StringType()),
    StructField("Location ID", StringType()),
    StructField("City Name", StringType()),
    StructField("Country Name", StringType()),
    StructField("Country Code", StringType()),
    StructField("IATA", StringType()),
    StructField("Latitude", DoubleType()),
    StructField("Longitude", DoubleType()),
    StructField("Hotels Count", IntegerType()),
])
HOTEL_COLUMNS = [f.name for f in HOTELS.fields]
TEXT_COLUMNS = [f.name for f in HOTELS.fields if isinstance(f.dataType, StringType)]

# One hotel lookup response (plus the page number the landing step adds).
HOTEL_PAGE = StructType([
    StructField("page", LongType()),
    StructField("results", StructType([
        StructField("location", StructType([
            StructField("cityName", StringType()),
            StructField("countryName", StringType()),
            StructField("countryCode", StringType()),
            StructField("iata", StringType()),
            StructField("hotelsCount", IntegerType()),
        ])),
        StructField("hotels", ArrayType(StructType([
            StructField("id", StringType()),
            StructField("label", StringType()),
            StructField("locationName", StringType()),
            StructField("fullName", StringType()),
            StructField("locationId", StringType()),
            StructField("location", StructType([
                StructField("lat", DoubleType()),
                StructField("lon", DoubleType()),
            ])),
        ]))),
    ])),
])

# The scraper's table, in its order (12 fields and the key).
SCRAPED_COLUMNS = [
    "flightDate", "startingAirport", "destinationAirport", "isBasicEconomy",
    "isRefundable", "isNonStop", "totalFare", "segmentsAirlineName",
    "travelDuration", "departureTime", "arrivalTime", "flightKey",
]

# Columns of the hotel star schema's tables, in their order.
LOCATION_TABLE = ["Location ID", "Location Name", "Latitude", "Longitude"]
HOTEL_TABLE = ["Hotel ID", "Label", "Location ID", "Country ID"]
STAY_TABLE = ["Hotel ID", "Hotels Count", "Location ID", "Country ID"]
