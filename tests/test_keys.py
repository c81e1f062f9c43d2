"""Two-pass dense key equals the single-task global window, at any partitioning."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerostar.operators import dense_key, unique_key


def test_dense_key_matches_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5003).cast("string").alias("k"), (F.col("id") % 13).alias("g"))
    df = df.dropDuplicates(["k"])
    got = dense_key(df, ["k"], "key").select("k", "key")
    want = df.select("k", F.row_number().over(Window.orderBy("k")).cast("long").alias("key"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_dense_key_nulls_first_and_start(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "name string")
    rows = {r.name: r.key for r in dense_key(df, ["name"], "key").collect()}
    assert rows == {None: 1, "a": 2, "b": 3}
    rows0 = {r.name: r.key for r in dense_key(df, ["name"], "key", start=0).collect()}
    assert rows0 == {None: 0, "a": 1, "b": 2}


def test_dense_key_hot_value_is_contiguous(spark):
    # A third of the rows share one order value: still 1..n, no gaps.
    hot = spark.range(0, 3000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    cold = spark.range(0, 6000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    keys = [r.key for r in dense_key(hot.union(cold), ["k"], "key").collect()]
    assert sorted(keys) == list(range(1, 9001))


def test_unique_key_unique(spark):
    df = unique_key(spark.range(0, 1000, numPartitions=4), "fk")
    assert df.select("fk").distinct().count() == 1000
    assert df.agg(F.min("fk")).first()[0] == 1


def test_fits_broadcast_bounds(spark):
    from aerostar.operators import fits_broadcast
    df = spark.range(0, 100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=50)
    assert not fits_broadcast(df, max_bytes=50_000)  # ~100 kB of strings
    nested = df.select(F.array(F.col("s"), F.col("s")).alias("a"))
    assert fits_broadcast(nested) and not fits_broadcast(nested, max_bytes=150_000)


def test_size_check_sends_no_rows_to_one_task(spark):
    from aerostar.operators import lookup_key
    fact, dim = spark.range(1000).withColumnRenamed("id", "n"), spark.range(100).select(F.col("id").alias("m"), F.col("id").alias("key"))
    plan = lookup_key(fact, dim, "n", "m", "key")._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan


def test_dense_key_empty_input(spark):
    df = spark.range(0).select(F.col("id").cast("string").alias("k"))
    out = dense_key(df, ["k"], "key")
    assert out.count() == 0
    assert out.columns == ["k", "key"]
