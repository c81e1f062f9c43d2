import csv
import os
import random

import pytest

from aerostar.schemas import HOTELS, LEGS
from aerostar.sources import quarantine_csv, read_hotels, read_quarantine, split_records
from aerostar.sources.csv import LOADED, REJECTED
from aerostar.streaming import counts_of, ingest_pages, rejects_of


def write(path, rows, names, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([names, *rows])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def labels(rng, n, width=6):
    pieces = ["a", 'say ""x""'.replace('""', '"'), "line\nbreak", "\n", ",", '"', "", "é", "two\n\nbreaks", '"\n"', "plain text " * 3]
    return [[rng.choice(["", "".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))]) for _ in range(width)] for _ in range(n)]


@pytest.fixture()
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "300")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_records_equal_multi_line(spark, scratch, small_splits, end):
    """Small splits, so that records cross one or many of them."""
    rng, names = random.Random(3), list("abcdef")
    os.makedirs(f"{scratch}/in")
    for k in range(3):
        rows = labels(rng, 150)
        if k == 1:
            rows[70][2] = "long\n" * 400  # over several splits
        if k == 2:
            rows = [["x", "y", "z", "1", "2", "3"]] * 80  # no quote at all
        write(f"{scratch}/in/{k}.csv", rows, names, end)
    got = split_records(spark, f"{scratch}/in", escape='"')
    want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{scratch}/in")
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want) and want.count() > 300


def test_one_file_feeds_many_tasks(spark, scratch, small_splits):
    write(f"{scratch}/one.csv", labels(random.Random(1), 200), list("abcdef"))
    assert spark.read.option("multiLine", True).csv(f"{scratch}/one.csv").rdd.getNumPartitions() == 1
    assert spark.read.option("lineSep", "\n").text(f"{scratch}/one.csv").rdd.getNumPartitions() > 4


def test_split_records_of_files_without_rows(spark, scratch):
    write(f"{scratch}/none.csv", [], ["a", "b"])
    assert split_records(spark, f"{scratch}/none.csv").columns == ["a", "b"] and split_records(spark, f"{scratch}/none.csv").count() == 0


def test_hotels_read_either_way(spark, scratch, small_splits):
    names = HOTELS.fieldNames()
    rows = [[str(k), f'Hotel "{k}"\nAnnex', *["x"] * (len(names) - 5), "1.5", "bad", str(k)] for k in range(40)]
    write(f"{scratch}/h.csv", rows, names)
    assert rows_of(read_hotels(spark, f"{scratch}/h.csv")) == rows_of(read_hotels(spark, f"{scratch}/h.csv", split=False))


def test_quarantine_divides_all_rows(spark, scratch):
    names = ["extra", *LEGS.fieldNames()]
    at = {n: k for k, n in enumerate(names)}
    rows = []
    for k in range(20):
        row = ["e"] + [""] * len(LEGS)
        for n, v in (("legId", f"l{k}"), ("flightDate", "2024-01-05"), ("startingAirport", "A"), ("destinationAirport", "B"), ("totalFare", "5.5")):
            row[at[n]] = v
        rows.append(row)
    rows[3][at["flightDate"]] = "soon"
    rows[4][at["totalFare"]] = "n/a"
    rows[5][at["destinationAirport"]] = ""
    write(f"{scratch}/legs.csv", rows, names)
    out = f"{scratch}/landed"
    critical = ["legId", "flightDate", "startingAirport", "destinationAirport"]
    for _ in range(2):  # again replaces
        assert quarantine_csv(spark, f"{scratch}/legs.csv", LEGS, out, critical) == {"landed": 20, "loaded": 18, "rejected": 2}
    bad = {r.legId: r for r in read_quarantine(spark, out, LEGS, REJECTED).collect()}
    assert set(bad) == {"l3", "l5"} and [tuple(p) for p in bad["l3"].problems] == [("flightDate", "soon")]
    assert '"extra":"e"' in bad["l5"].row and '"flightDate":"soon"' in bad["l3"].row
    good = {r.legId: r for r in read_quarantine(spark, out, LEGS, LOADED).collect()}
    assert good["l4"].totalFare is None and [tuple(p) for p in good["l4"].problems] == [("totalFare", "n/a")] and good["l1"].problems == []
    with pytest.raises(ValueError):
        quarantine_csv(spark, f"{scratch}/legs.csv", HOTELS, out, ["Label"])


def test_one_stream_counts_and_divides_documents(spark, scratch):
    doc = '{"page": %d, "results": {"location": {}, "hotels": [{"id": "a"}, {"id": "b"}]}}'
    for batch, lines in (("b1", [doc % 1, "{broken", doc % 2]), ("b2", ["[]x", doc % 3])):
        os.makedirs(f"{scratch}/landing/{batch}")
        with open(f"{scratch}/landing/{batch}/p.json", "w") as f:
            f.write("\n".join(lines) + "\n")
        for _ in range(2):
            ingest_pages(spark, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt")
    assert sorted(r.page for r in spark.read.parquet(f"{scratch}/out").collect()) == [1, 1, 2, 2, 3, 3]
    assert sorted(r.json for r in spark.read.parquet(rejects_of(f"{scratch}/out")).collect()) == ["[]x", "{broken"]
    assert sorted((r.landed, r.parsed, r.rejected) for r in spark.read.parquet(counts_of(f"{scratch}/out")).collect()) == [(2, 1, 1), (3, 2, 1)]
