"""Write PLANS.md: the final (post-AQE) physical plans of the main jobs at
sf0.1, so the shuffles, broadcasts, pushed filters and pruned scans can be read
without running anything."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from aerostar.operators import dedupe, drop_null, project  # noqa: E402
from aerostar.operators.keys import ranged_rows  # noqa: E402
from aerostar.plans import fixtures, flight, scrape  # noqa: E402
from aerostar.schemas import LEG_COLUMNS  # noqa: E402
from aerostar.session import get_spark  # noqa: E402
from aerostar.sinks import publish_frame  # noqa: E402
from aerostar.plans.etl_runs import FACT_DIMS  # noqa: E402
from aerostar.sources import flatten_hotel_pages, parse_hotel_pages  # noqa: E402


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    text = qe.executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    text = re.sub(r"file:[^\],]*/", "file:.../", text)       # local paths
    return "\n".join(line for line in text.splitlines())


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark("local[8]", app="aerostar-plans", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    legs = fixtures.legs(spark, sf)
    clean = flight.clean_legs(legs)
    airlines, airports = flight.dim_airline(clean), flight.dim_airport(clean)
    sections = [
        ("Legs fixture + null filter + dedupe (input of the flight key)",
         dedupe(drop_null(project(legs, LEG_COLUMNS), flight.CRITICAL))),
        ("Flight key, pass 1 (the rows dense_key stages): range partition, sort within partitions, "
         "row ids - no single-partition exchange over data rows",
         ranged_rows(flight.clean_legs(legs, key="monotonic").drop("flightKey"),
                     ["legId"] + flight.CLEAN_COLUMNS)),
        ("Airline dimension over the staged cleaned legs", airlines),
        ("Flight fact: three lookups, dimensions broadcast behind the size check",
         flight.fact_flight(clean, airlines, airports)),
        ("Rows of the fact's publish: day column, no rollup shuffle (unique flightKey), rebalance on the day",
         publish_frame(flight.fact_flight(clean, airlines, airports), FACT_DIMS, "dateKey", "yyyyMMdd",
                       unique_key="flightKey")),
        ("Hotel pages flattened (fixture grouping + from_json + explode)",
         flatten_hotel_pages(parse_hotel_pages(fixtures.hotel_pages(spark, sf)))),
        ("Scraped flights (fixture grouping; the scrape is map-only)",
         scrape.scraped_flights(fixtures.flight_pages(spark, sf))),
    ]
    out = ["# PLANS", "",
           f"Final physical plans (after AQE) at `{os.path.basename(sf)}`, local[8], "
           "16 shuffle partitions; generated by `tools/plans.py`. Expression ids and "
           "local paths are elided.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", final_plan(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
