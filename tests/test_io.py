"""Sources, sinks and the incremental ingest."""

import json
import os

from pyspark.sql import functions as F

from aerostar.schemas import HOTEL_COLUMNS
from aerostar.sinks import publish, read_published, write_csv, write_single_csv
from aerostar.sources import flatten_hotel_pages, parse_hotel_pages, read_hotels
from aerostar.streaming import ingest_pages


def hotel_doc(page, hotels, country="X"):
    return json.dumps({"page": page, "results": {
        "location": {"cityName": "C", "countryName": country, "hotelsCount": len(hotels)},
        "hotels": hotels}})


def test_hotel_csv_quotes_and_line_breaks(spark, scratch):
    rows = [("1", 'The "Grand", Hotel'), ("2", "Two\nLines")]
    df = spark.createDataFrame(rows, "`Hotel ID` string, Label string")
    for c in HOTEL_COLUMNS[2:]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    write_csv(df.select(*HOTEL_COLUMNS), f"{scratch}/h")
    got = {r["Hotel ID"]: r["Label"] for r in read_hotels(spark, f"{scratch}/h").collect()}
    assert got == {"1": 'The "Grand", Hotel', "2": "Two\nLines"}


def test_hotel_json_defaults_empty_and_bad(spark):
    docs = [hotel_doc(1, [{"id": "h1", "label": "L"}]),           # no location
            hotel_doc(2, []),                                     # empty list: no rows
            json.dumps({"page": 3, "results": {"hotels": [{"id": "h3"}]}}),  # absent location
            "{not json"]
    df = spark.createDataFrame([(d,) for d in docs], "json string")
    rows = {r["Hotel ID"]: r for r in flatten_hotel_pages(parse_hotel_pages(df)).collect()}
    assert set(rows) == {"h1", "h3"}
    assert rows["h1"]["Latitude"] is None and rows["h1"]["Country Name"] == "X"
    assert rows["h3"]["City Name"] == "" and rows["h3"]["Hotels Count"] == 0


def test_ingest_exactly_once(spark, scratch):
    landing, out, ckpt = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt"

    def land(batch, docs):
        os.makedirs(f"{landing}/{batch}")
        with open(f"{landing}/{batch}/pages.json", "w") as f:
            f.write("\n".join(docs) + "\n")

    def count():
        return spark.read.parquet(out).count()

    land("b1", [hotel_doc(1, [{"id": "a"}, {"id": "b"}])])
    ingest_pages(spark, landing, out, ckpt)
    assert count() == 2
    ingest_pages(spark, landing, out, ckpt)
    assert count() == 2
    land("b2", [hotel_doc(2, [{"id": "c"}])])
    ingest_pages(spark, landing, out, ckpt)
    assert count() == 3
    land("b3", [hotel_doc(3, [])])
    ingest_pages(spark, landing, out, ckpt)
    assert count() == 3


def test_publish_replaces_only_days_present(spark, scratch):
    path = f"{scratch}/pub"
    two_days = spark.createDataFrame([("20240101", "a"), ("20240102", "b")], "dateKey string, v string")
    publish(two_days, path, ["dateKey", "v"], "dateKey", "yyyyMMdd")
    publish(two_days, path, ["dateKey", "v"], "dateKey", "yyyyMMdd")  # twice == once
    assert read_published(spark, path).count() == 2
    one_day = spark.createDataFrame([("20240102", "c")], "dateKey string, v string")
    publish(one_day, path, ["dateKey", "v"], "dateKey", "yyyyMMdd")
    got = sorted((r.dateKey, r.v) for r in read_published(spark, path).collect())
    assert got == [("20240101", "a"), ("20240102", "c")]


def test_publish_constant_time_and_rollup(spark, scratch):
    path = f"{scratch}/dim"
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, code string")
    publish(df, path, ["k", "code"])
    got = read_published(spark, path)
    assert got.count() == 2
    assert {str(r["__day"]) for r in got.collect()} == {"1970-01-01"}


def test_single_csv_file(spark, scratch):
    df = spark.range(0, 10, numPartitions=3)
    path = write_single_csv(df, f"{scratch}/one.csv")
    assert os.path.isfile(path)
    assert len(open(path).read().strip().splitlines()) == 11


def test_zip_fields_pads_and_checks_lengths(spark):
    import pytest
    from aerostar.sources import zip_fields
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["1", "2"], ["x", "y", "z"])],
                               "page_id int, dep array<string>, fare array<string>, al array<string>")
    rows = zip_fields(df, ["dep", "fare", "al"], keep=("page_id",), pad={"fare": "NA"}).collect()
    assert [(r.pos, r.dep, r.fare, r.al) for r in rows] == [(0, "a", "1", "x"), (1, "b", "2", "y"), (2, "c", "NA", "z")]
    bad = spark.createDataFrame([(1, ["a", "b"], ["x"])], "page_id int, dep array<string>, al array<string>")
    with pytest.raises(Exception):
        zip_fields(bad, ["dep", "al"], keep=("page_id",)).collect()


def test_single_csv_is_a_file_at_any_size(spark, scratch):
    for n in (0, 1, 50_000):
        path = write_single_csv(spark.range(0, n, numPartitions=4), f"{scratch}/{n}.csv")
        assert os.path.isfile(path)
        assert spark.read.option("header", True).csv(path).count() == n


def test_publish_keeps_rows_without_a_time(spark, scratch):
    import pytest
    from aerostar.sinks import published_between
    df = spark.createDataFrame([("20240105", 1), ("bad", 2), (None, 3), ("20240229", 4)], "at string, k int")
    path = publish(df, f"{scratch}/m", ["k"], "at", "yyyyMMdd", missing="1999-12-31 00:00:00", granularity="year")
    got = {(r.k, str(r["__day"])) for r in read_published(spark, path).collect()}
    assert got == {("1", "2024-01-05"), ("2", "1999-12-31"), ("3", "1999-12-31"), ("4", "2024-02-29")}
    assert [r.k for r in published_between(spark, path, "2024-02-01", "2024-03-01", "year").collect()] == ["4"]
    with pytest.raises(Exception, match="no time in at"):
        publish(df, f"{scratch}/n", ["k"], "at", "yyyyMMdd")


def test_values_that_do_not_parse_are_listed(spark, scratch):
    from aerostar.schemas import LEGS
    from aerostar.sources import read_rejects
    spark.createDataFrame([("1", "2024-01-01", "x"), ("2", "soon", "2.5"), ("3", None, "x")], "legId string, flightDate string, totalFare string") \
        .write.option("header", True).csv(f"{scratch}/bad")
    schema = type(LEGS)([f for f in LEGS.fields if f.name in ("legId", "flightDate", "totalFare")])
    got = {tuple(r) for r in read_rejects(spark, f"{scratch}/bad", schema).collect()}
    assert got == {("flightDate", "soon", 1), ("totalFare", "x", 2)}


def test_legs_csv_with_inferred_schema(spark, scratch):
    from aerostar.plans import fixtures
    from aerostar.sources import read_legs
    from small_tables import SF_SMALL
    write_csv(fixtures.legs(spark, SF_SMALL), f"{scratch}/legs")
    types = dict(read_legs(spark, f"{scratch}/legs", infer=True).dtypes)
    assert types["flightDate"] == "date" and types["isNonStop"] == "boolean"
    assert types["totalFare"] == "double" and types["seatsRemaining"] == "int"


def test_publish_with_unique_key_skips_rollup_shuffle(spark, scratch):
    df = spark.createDataFrame([("20240101", 1), ("20240101", 2)], "dateKey string, k int")
    publish(df, f"{scratch}/u", ["dateKey", "k"], "dateKey", "yyyyMMdd", unique_key="k")
    assert read_published(spark, f"{scratch}/u").count() == 2
