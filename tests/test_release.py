import pytest
from pyspark.sql import functions as F

from aerostar.operators import extend_keys, new_members
from aerostar.plans import fixtures
from aerostar.plans import hotel
from aerostar.plans.loads import load_flight, load_hotels
from aerostar.operators import blank_to_null
from aerostar.schemas import HOTEL_COLUMNS, TEXT_COLUMNS
from aerostar.sinks import Change, Conflict, Release, publish_frame
from aerostar.sources import flatten_hotel_pages, parse_hotel_pages
from aerostar.streaming import land_pages
from small_tables import SF_SMALL


def days(spark, *rows):
    return publish_frame(spark.createDataFrame(list(rows), "day string, v long"), ["day", "v"], "day", "yyyy-MM-dd", typed=True)


def held(release, table="t", **at):
    return sorted((r.day, r.v) for r in release.read(table, **at).collect())


def test_versions_intervals_and_pinned_readers(spark, scratch):
    r = Release(spark, scratch)
    assert r.version() == 0 and not r.has("t")
    with pytest.raises(KeyError):
        r.read("t")
    assert r.publish({"t": Change(days(spark, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-02-01", 3))),
                      "u": Change(days(spark, ("2024-01-01", 9)))}, {"last": 3}) == 1
    old = r.read("t")
    assert r.publish({"t": Change(days(spark, ("2024-01-02", 20)), interval=("2024-01-01", "2024-01-31"))}, {"more": 1}) == 2
    assert held(r) == [("2024-01-02", 20), ("2024-02-01", 3)]  # the first of January vanished with its interval
    assert held(r, version=1) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-02-01", 3)] and old.count() == 3
    assert r.manifest()["tables"]["t"]["replaced"] == ["2024-01-01", "2024-01-02"]
    assert held(r, "u") == [("2024-01-01", 9)] and r.state() == {"last": 3, "more": 1}
    assert held(r, first="2024-02-01", last="2024-02-29") == [("2024-02-01", 3)]
    assert len(r.read("t", first="2024-02-01", last="2024-02-29").inputFiles()) == 1  # other segments are not read


def test_an_empty_change_keeps_the_schema_and_replaces(spark, scratch):
    r = Release(spark, scratch)
    r.publish({"t": Change(days(spark).limit(0))})
    assert r.read("t").columns == ["__time", "day", "v", "__day"] and r.read("t").count() == 0
    r.publish({"t": Change(days(spark, ("2024-01-01", 1)))})
    r.publish({"t": Change(days(spark), everything=True)})
    assert held(r) == [] and held(r, version=2) == [("2024-01-01", 1)]
    with pytest.raises(ValueError):
        r.publish({"t": Change(days(spark, ("2024-01-01", 1)).withColumn("x", F.lit(1)))})


def test_a_failed_publish_is_invisible(spark, scratch):
    r = Release(spark, scratch)
    r.publish({"t": Change(days(spark, ("2024-01-01", 1)))})
    bad = days(spark, ("2024-01-05", 5)).withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        r.publish({"u": Change(days(spark, ("2024-01-01", 7)), everything=True), "t": Change(bad)})
    assert r.version() == 1 and held(r) == [("2024-01-01", 1)] and not r.has("u")


def test_of_two_publishers_the_second_fails(spark, scratch):
    a, b = Release(spark, scratch), Release(spark, scratch)
    a.publish({"t": Change(days(spark, ("2024-01-01", 1)))})
    base = b.version()
    a.publish({"t": Change(days(spark, ("2024-01-02", 2)))})
    with pytest.raises(Conflict):
        b.publish({"t": Change(days(spark, ("2024-01-03", 3)))}, base=base)
    assert held(b) == [("2024-01-01", 1), ("2024-01-02", 2)] and b.version() == 2


def test_compact_merges_appends(spark, scratch):
    r = Release(spark, scratch)
    for v in range(3):
        r.publish({"t": Change(days(spark, ("2024-01-01", v), ("2024-02-01", 10 + v) if v else ("2024-03-01", 7)))})
    rows, live = held(r), len(r.manifest()["tables"]["t"]["live"])
    assert live == 6 and r.compact("t") == 4
    assert held(r) == rows and len(r.manifest()["tables"]["t"]["live"]) == 3
    assert r.compact("t") == 4  # nothing left to merge


def test_keys_given_stay(spark):
    first = spark.createDataFrame([("b",), ("d",), (None,), ("b",)], "name string")
    given = extend_keys(first, None, ["name"], "key")
    assert {r.name: r.key for r in given.collect()} == {None: 1, "b": 2, "d": 3}
    second = spark.createDataFrame([("a",), ("c",), ("d",), (None,)], "name string")
    more = extend_keys(second, given, ["name"], "key")
    assert {r.name: r.key for r in more.collect()} == {"a": 4, "c": 5}
    assert new_members(second, given.unionByName(more), ["name"]).count() == 0


def test_loads_add_only_what_is_new(spark, scratch):
    legs = fixtures.legs(spark, SF_SMALL)
    early = legs.where("flightDate < DATE '1994-01-01' AND destinationAirport < 'M'")
    root = f"{scratch}/star"
    assert load_flight(spark, early, root) == 1
    r = Release(spark, root)
    before = {x.flightKey: x for x in r.read("fact_flight").collect()}
    names = {x.airportKey: x.airportCode for x in r.read("dim_airport").collect()}
    assert load_flight(spark, early, root) == 1  # the same file adds nothing
    assert load_flight(spark, legs, root) == 2
    assert load_flight(spark, legs, root) == 2
    facts = r.read("fact_flight").collect()
    want = legs.where("legId IS NOT NULL AND flightDate IS NOT NULL AND startingAirport IS NOT NULL AND destinationAirport IS NOT NULL")
    assert sorted(x.flightKey for x in facts) == list(range(1, want.drop("baseFare", "seatsRemaining", "segmentsAirlineCode").distinct().count() + 1))
    after = {x.flightKey: x for x in facts}
    assert all(after[k] == x for k, x in before.items())
    later = {x.airportKey: x.airportCode for x in r.read("dim_airport").collect()}
    assert len(later) > len(names) and all(later[k] == v for k, v in names.items())
    assert r.read("dim_date").select("date").distinct().count() == r.read("dim_date").count()


def test_digests_are_rebalanced_by_month(spark, scratch, monkeypatch):
    """However many tasks read the new legs, not each of them writes to every month."""
    published = {}
    monkeypatch.setattr(Release, "publish", lambda self, changes, *rest: published.update(changes) or 1)
    load_flight(spark, fixtures.legs(spark, SF_SMALL), f"{scratch}/star")
    assert "RebalancePartitions" in published["leg_digest"].rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_load_without_usable_rows(spark, scratch):
    legs = fixtures.legs(spark, SF_SMALL)
    none = legs.where("destinationAirport IS NULL")
    assert load_flight(spark, none, f"{scratch}/star") == 1
    r = Release(spark, f"{scratch}/star")
    assert r.read("fact_flight").count() == 0
    assert load_flight(spark, none, f"{scratch}/star") == 1


def test_hotel_loads_equal_the_rebuild_after_every_batch(spark, scratch):
    pages = fixtures.hotel_pages(spark, SF_SMALL)
    r, landed, keys = Release(spark, f"{scratch}/out/release"), None, {}
    for number, some in enumerate((pages.where("page % 3 = 0"), pages.where("page % 3 < 2"), pages, pages.limit(0))):
        land_pages(some, f"{scratch}/landing", f"b{number}")
        landed = some if landed is None else landed.unionByName(some)
        load_hotels(spark, f"{scratch}/landing", f"{scratch}/out")
        rows = hotel.clean_hotels(blank_to_null(flatten_hotel_pages(parse_hotel_pages(landed)).select(*HOTEL_COLUMNS), TEXT_COLUMNS))
        countries = r.read("dim_country")
        given = {x["Country Name"]: x["Country ID"] for x in countries.collect()}
        assert all(given[k] == v for k, v in keys.items()) and sorted(given.values()) == list(range(len(given)))
        keys = given
        for name, want in (("dim_location", hotel.dim_location(rows)), ("dim_hotel", hotel.dim_hotel(rows, countries)),
                           ("fact_hotel_stay", hotel.fact_hotel_stay(rows, countries))):
            assert sorted(map(tuple, r.read(name).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), (number, name)
    assert keys
