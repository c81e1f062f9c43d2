"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from aerostar.operators import drop_null
from aerostar.plans import fixtures, flight
from small_tables import SF_SMALL


def plan_of(df):
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # run this very plan, so AQE's final plan is visible
    return qe.executedPlan().toString()


def test_fact_lookups_are_broadcast_and_fact_not_shuffled(spark):
    clean = flight.clean_legs(fixtures.legs(spark, SF_SMALL))
    fact = flight.fact_flight(clean, flight.dim_airline(clean), flight.dim_airport(clean))
    plan = plan_of(fact)
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_null_filter_reaches_the_scan(spark):
    orders = fixtures.read_table(spark, SF_SMALL, "orders")
    plan = drop_null(orders, ["o_custkey", "o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey), IsNotNull(o_orderdate)]" in plan


def test_scan_reads_only_used_columns(spark):
    orders = fixtures.read_table(spark, SF_SMALL, "orders")
    plan = orders.select("o_orderkey").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_dimension_key_has_no_global_row_window(spark):
    clean = flight.clean_legs(fixtures.legs(spark, SF_SMALL))
    plan = plan_of(flight.dim_airline(clean))
    # The only single-partition step is over per-partition counts, not rows.
    assert "row_number" not in plan.lower()


def test_large_dimension_lookup_splits_hot_key(spark):
    """A dimension over the broadcast budget goes to a shuffle join; a fact key
    holding a third of the rows is split by AQE's skew join, not sent to one task."""
    from aerostar.operators import lookup_key
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300_000
        fact = spark.range(0, n, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50_000).alias("nk"),
            F.col("id").alias("fid"))
        dim = spark.range(0, 50_000).select(F.col("id").alias("nk"), (F.col("id") + 1).alias("sk"))
        out = lookup_key(fact, dim, "nk", "nk", "sk", broadcast=False)
        assert out.filter(F.col("sk").isNull()).count() == 0
        plan = plan_of(out)
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_publish_rebalances_on_day_and_skips_rollup_for_unique_keys(spark):
    from aerostar.sinks import publish_frame
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2)], "dateKey string, k int")
    keyed = publish_frame(df, ["dateKey", "k"], "dateKey", "yyyyMMdd", unique_key="k")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "HashAggregate" not in plan
    rolled = publish_frame(df, ["dateKey", "k"], "dateKey", "yyyyMMdd")
    assert "HashAggregate" in rolled._jdf.queryExecution().executedPlan().toString()


def test_hashed_keys_need_the_dedupes_exchange_only(spark):
    from aerostar.operators import dedupe, hashed_key
    from aerostar.operators.keys import placed_rows
    from aerostar.schemas import LEG_COLUMNS
    rows = dedupe(drop_null(fixtures.legs(spark, SF_SMALL).select(*LEG_COLUMNS), flight.CRITICAL))
    before = rows._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    tagged = placed_rows(rows, LEG_COLUMNS, LEG_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert tagged.count("Exchange ") == before and "rangepartitioning" not in tagged
    first, second = ({r.legId: r.k for r in hashed_key(rows, LEG_COLUMNS, "k", LEG_COLUMNS).collect()} for _ in range(2))
    assert first == second and sorted(first.values()) == list(range(1, len(first) + 1))


def test_bucketed_lookup_moves_neither_side(spark):
    from aerostar.operators import bucketed_lookup, store_bucketed
    dim = store_bucketed(spark.range(5000).selectExpr("id AS nk", "id + 1 AS sk").where("nk % 7 != 0"), "nk", 8, find_hot=False)
    even = store_bucketed(spark.range(20_000).selectExpr("id", "id % 6000 AS nk"), "nk", 8)
    assert even.hot == ()
    found = bucketed_lookup(spark, even, dim, "sk")
    plan = plan_of(found)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(map(tuple, found.collect())) == sorted((k, k % 6000, k % 6000 + 1 if k % 6000 < 5000 and k % 6000 % 7 else None) for k in range(20_000))
    hot = store_bucketed(spark.range(20_000).selectExpr("id", "IF(id % 3 = 0, 11, IF(id % 3 = 1, null, id % 6000)) AS nk"), "nk", 8)
    assert hot.hot == (11,)
    found = bucketed_lookup(spark, hot, dim, "sk")
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "hashpartitioning" not in plan
    want = {k: 12 if k % 3 == 0 else None if k % 3 == 1 or k % 6000 >= 5000 or k % 6000 % 7 == 0 else k % 6000 + 1 for k in range(20_000)}
    assert {r.id: r.sk for r in found.collect()} == want


def test_files_of_the_glob_follow_the_legs(spark, monkeypatch):
    from aerostar.plans import catalog
    small = catalog.QUERIES["scan_legs_glob"](spark, SF_SMALL)
    monkeypatch.setattr(catalog, "LEGS_PER_PART", 100)
    many = catalog.QUERIES["scan_legs_glob"](spark, SF_SMALL)
    assert len(small.inputFiles()) == 4 and len(many.inputFiles()) >= 15
    assert small.count() == many.count()


def test_legs_are_cleaned_before_they_are_numbered(spark, monkeypatch):
    """The sample for the numbering's ranges reads cleaned, staged rows: it must not
    dedupe and clean the legs a second time."""
    numbered = []
    monkeypatch.setattr(flight, "dense_key", lambda df, order, name: numbered.append(df) or df.withColumn(name, F.lit(1)))
    flight.clean_legs(fixtures.legs(spark, SF_SMALL))
    plan = numbered[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "Project" not in plan
