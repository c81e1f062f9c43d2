"""Command line: run the original jobs on real inputs.

    python -m aerostar flight  --legs 'data/file_part_*.csv' --out warehouse [--no-publish] [--key monotonic]
    python -m aerostar load    --legs 'data/2024-05.csv' --out release
    python -m aerostar explore --legs 'data/file_part_*.csv' --out explore
    python -m aerostar hotel   --landing landing/ --out hotels
    python -m aerostar scrape  --pages saved_pages.parquet --out crawl [--year 2025]

``--master`` is only for local runs; on a cluster, ``spark-submit`` sets it.
Outputs and staged tables follow ``spark.checkpoint.dir`` and the paths given.
"""

from __future__ import annotations

import argparse
import json
import logging

from aerostar.plans.etl_runs import run_explore, run_flight, run_hotel, run_scrape
from aerostar.plans.flight import CRITICAL
from aerostar.plans.loads import load_flight, load_hotels
from aerostar.schemas import LEGS
from aerostar.session import get_spark, stage_dir
from aerostar.sources import quarantine_csv, read_legs, read_quarantine
from aerostar.sources.csv import LOADED


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="aerostar")
    ap.add_argument("--master", default=None, help="e.g. local[8]; leave unset under spark-submit")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("flight", help="clean legs, dimensions, fact, CSV, publish")
    f.add_argument("--legs", required=True, help="legs CSV path or glob (header row)")
    f.add_argument("--out", required=True, help="output folder (stage/, warehouse/, published/)")
    f.add_argument("--no-publish", action="store_true", help="transform only, skip the day-partitioned publish")
    f.add_argument("--key", choices=["dense", "hashed", "monotonic"], default="dense",
                   help="flight key: repeatable 1..n (dense), 1..n without a range pass (hashed) or gapped and free (monotonic)")
    f.add_argument("--single-files", action="store_true", help="write each dimension as one named CSV file")
    d = sub.add_parser("load", help="add a file's new legs to a release of the star; keys given before stay")
    d.add_argument("--legs", required=True, help="legs CSV path or glob (header row)")
    d.add_argument("--out", required=True, help="root of the release")
    e = sub.add_parser("explore", help="airline pairs, flight type, date and flight dimensions")
    e.add_argument("--legs", required=True, help="legs CSV path or glob (header row)")
    e.add_argument("--out", required=True, help="output folder")
    h = sub.add_parser("hotel", help="ingest landed lookup pages, build the hotel tables")
    h.add_argument("--landing", required=True, help="folder of landed JSON-lines lookup responses")
    h.add_argument("--out", required=True, help="output folder; keeps the ingest checkpoint between runs")
    h.add_argument("--add", action="store_true", help="add what is new to a release of the tables instead of rebuilding them")
    s = sub.add_parser("scrape", help="saved search pages to flight rows")
    s.add_argument("--pages", required=True, help="Parquet with page_id and html columns")
    s.add_argument("--out", required=True, help="output folder")
    s.add_argument("--year", type=int, default=2025, help="year of the page date labels")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    spark = get_spark(args.master, app=f"aerostar-{args.job}")
    if args.job == "flight":
        landed = f"{args.out.rstrip('/')}/stage/landed"
        counts = quarantine_csv(spark, args.legs, LEGS, landed, CRITICAL)
        logging.getLogger("aerostar").info("flight: %s; malformed values and rejected rows in %s", counts, landed)
        result = run_flight(spark, read_quarantine(spark, landed, LEGS, LOADED).select(*LEGS.fieldNames()), args.out,
                            publish_tables=not args.no_publish, key=args.key, single_files=args.single_files)
        result["landed"] = landed
    elif args.job == "load":
        landed = stage_dir(spark, "landed")
        counts = quarantine_csv(spark, args.legs, LEGS, landed, CRITICAL)
        legs = read_quarantine(spark, landed, LEGS, LOADED).select(*LEGS.fieldNames())
        result = {"version": load_flight(spark, legs, args.out), "landed": landed, "landed_rows": counts["landed"],
                  "loaded": counts["loaded"], "rejected": counts["rejected"]}
    elif args.job == "explore":
        result = run_explore(spark, read_legs(spark, args.legs), args.out)
    elif args.job == "hotel":
        result = {"version": load_hotels(spark, args.landing, args.out)} if args.add else run_hotel(spark, args.landing, args.out)
    else:
        result = {"flights": run_scrape(spark, spark.read.parquet(args.pages), args.out, args.year)}
    print(json.dumps(result, indent=1))
    return result


if __name__ == "__main__":
    main()
