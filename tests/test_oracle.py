"""Every registered query against its DuckDB SQL at sf0.001 (the driver's
gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from small_tables import SF_SMALL

import sys, os
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from compare import compare, duck  # noqa: E402

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL, verbose=False,
                   strict=True, check_types=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "flightKey" in df.columns


def test_entry_schema_is_stable(spark):
    first, second = entry.entry(spark).schema, entry.entry(spark).schema
    assert first == second
    assert [f.name for f in first] == [
        "flightKey", "isBasicEconomy", "isRefundable", "isNonStop", "totalFare", "travelDuration",
        "departureTime", "arrivalTime", "dateKey", "airlineKey", "startingAirportKey",
        "destinationAirportKey"]
