"""The command line runs the jobs on files, as a user of the original would."""

import os

from aerostar.__main__ import main
from aerostar.plans import fixtures
from aerostar.schemas import LEGS
from aerostar.sinks import write_csv
from aerostar.sources import read_quarantine
from aerostar.sources.csv import LOADED
from aerostar.streaming import land_pages
from small_tables import SF_SMALL


def test_cli_jobs_on_files(spark, scratch):
    legs_dir = f"{scratch}/legs"
    write_csv(fixtures.legs(spark, SF_SMALL).repartition(2), legs_dir)
    glob = f"{legs_dir}/part-*.csv"

    flight = main(["flight", "--legs", glob, "--out", f"{scratch}/flight", "--single-files"])
    assert os.path.isfile(flight["dim_date"]) and os.path.isdir(flight["pub_fact_flight"])

    assert read_quarantine(spark, flight["landed"], LEGS, LOADED).count() > 0
    for _ in range(2):  # the second time adds nothing
        load = main(["load", "--legs", glob, "--out", f"{scratch}/release"])
        assert load["version"] == 1 and load["landed_rows"] == load["loaded"] + load["rejected"]

    explore = main(["explore", "--legs", glob, "--out", f"{scratch}/explore"])
    assert spark.read.option("header", True).csv(explore["dim_flight"]).count() > 0

    land_pages(fixtures.hotel_pages(spark, SF_SMALL), f"{scratch}/landing", "day-1")
    hotel = main(["hotel", "--landing", f"{scratch}/landing", "--out", f"{scratch}/hotel"])
    assert os.path.isdir(hotel["dim_country"])

    added = main(["hotel", "--landing", f"{scratch}/landing", "--out", f"{scratch}/hotel-release", "--add"])
    assert added == {"version": 1}

    fixtures.flight_pages(spark, SF_SMALL).write.parquet(f"{scratch}/pages")
    scrape = main(["scrape", "--pages", f"{scratch}/pages", "--out", f"{scratch}/crawl"])
    assert spark.read.option("header", True).csv(scrape["flights"]).count() > 0
