"""Invariants of the star schemas and the edge behaviours of the original."""

from pyspark.sql import functions as F

from aerostar.plans import fixtures, flight
from small_tables import SF_SMALL


def test_fact_invariants(spark):
    legs = fixtures.legs(spark, SF_SMALL)
    clean = flight.clean_legs(legs)
    airlines, airports = flight.dim_airline(clean), flight.dim_airport(clean)
    fact = flight.fact_flight(clean, airlines, airports)
    n = clean.count()
    assert fact.count() == n
    keys = [r.flightKey for r in clean.select("flightKey").collect()]
    assert sorted(keys) == list(range(1, n + 1))
    # every non-null foreign key exists in its dimension
    assert fact.join(airlines, "airlineKey", "left_anti").filter(F.col("airlineKey").isNotNull()).count() == 0
    for role in ("startingAirportKey", "destinationAirportKey"):
        missing = fact.join(airports.withColumnRenamed("airportKey", role), role, "left_anti")
        assert missing.filter(F.col(role).isNotNull()).count() == 0


def test_null_airline_gets_null_key_although_dimension_has_null_member(spark):
    clean = spark.createDataFrame(
        [(1, None, "AAA", "BBB"), (2, "X", "AAA", "BBB")],
        "flightKey long, segmentsAirlineName string, startingAirport string, destinationAirport string")
    airlines = flight.dim_airline(clean)
    assert {r.airlineName: r.airlineKey for r in airlines.collect()} == {None: 1, "X": 2}
    fact = clean.select("flightKey", F.col("segmentsAirlineName").alias("airlineName"))
    from aerostar.operators import lookup_key
    got = {r.flightKey: r.airlineKey for r in lookup_key(fact, airlines, "airlineName", "airlineName", "airlineKey").collect()}
    assert got == {1: None, 2: 2}


def test_flight_type_null_and_false_stay_apart(spark):
    df = spark.createDataFrame([(None, False, False), (False, False, False)],
                               "isBasicEconomy boolean, isNonStop boolean, isRefundable boolean")
    rows = flight.dim_flight_type(df).collect()
    assert len(rows) == 2
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0)}
    assert sorted(r.flight_type_key for r in rows) == [1, 2]


def test_airline_pairs_and_cross(spark):
    df = spark.createDataFrame([("A||B", "x||y")], "segmentsAirlineName string, segmentsAirlineCode string")
    pairs = sorted(tuple(r) for r in flight.airline_items(df).collect())
    assert pairs == [("A", "x"), ("B", "y")]
    assert flight.airline_items(df, cross=True).count() == 4


def test_transform_only_run_writes_no_publish(spark, scratch):
    import os
    from aerostar.plans.etl_runs import run_flight
    paths = run_flight(spark, fixtures.legs(spark, SF_SMALL), scratch, publish_tables=False)
    assert not any(k.startswith("pub_") for k in paths)
    assert os.path.isdir(paths["dim_airline"]) and os.path.isdir(paths["fact_flight"])
    fact_rows = spark.read.option("header", True).csv(paths["fact_flight"]).count()
    assert fact_rows == spark.read.parquet(paths["clean"]).count()
