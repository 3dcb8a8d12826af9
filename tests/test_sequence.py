"""lag_by_key and number_by_key against plain windows, including one key holding most of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.sequence import lag_by_key, number_by_key


def _hot(spark, n=20000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 13 % 1000).alias("a"), F.col("id").alias("b"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 7 % 11).cast("string")).alias("v"))


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("width", [1, 37, 1_000_000])
def test_lag_matches_window_with_hot_key(spark, width):
    df = _hot(spark)
    got = lag_by_key(df, "k", ["a", "b"], "v", F.floor(F.col("a") / width), out="pv")
    want = df.withColumn("pv", F.lag("v").over(Window.partitionBy("k").orderBy("a", "b")))
    assert _rows(got, "k", "a", "b", "v", "pv") == _rows(want, "k", "a", "b", "v", "pv")


@pytest.mark.parametrize("width", [1, 37, 1_000_000])
def test_number_matches_row_number_with_hot_key(spark, width):
    df = _hot(spark)
    got = number_by_key(df, "k", ["a", "b"], F.floor(F.col("a") / width), out="rn", keep=["a", "b"])
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")))
    assert _rows(got, "k", "a", "b", "rn") == _rows(want, "k", "a", "b", "rn")


def test_null_keys_and_buckets(spark):
    df = spark.createDataFrame([(None, None, "a"), (None, 1, "b"), (None, 9000, "c"), (2, None, "d"), (2, 5000, "e")],
                               "k long, t long, v string")
    cut = F.floor(F.col("t") / 4096)
    assert _rows(number_by_key(df, "k", ["t"], cut, out="n"), "v", "n") == [
        ("a", 1), ("b", 2), ("c", 3), ("d", 1), ("e", 2)]
    assert _rows(lag_by_key(df, "k", ["t"], "v", cut), "v", "prev_value") == [
        ("a", None), ("b", "a"), ("c", "b"), ("d", None), ("e", "d")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, t long, v string")
    assert number_by_key(df, "k", ["t"], F.col("t")).count() == 0
    assert lag_by_key(df, "k", ["t"], "v", F.col("t")).count() == 0


def test_lag_shuffles_its_input_once(spark):
    df = spark.range(900).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    rows = lag_by_key(df, "k", ["t"], "v", F.floor(F.col("t") / 10))
    assert rows.filter("prev_value is null").count() == 2
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "InPandas" not in plan


def test_number_shuffles_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _hot(spark).withColumn("k", F.when(F.col("k") != 3, F.col("k"))).withColumn("wide", F.lit("x"))
        got = number_by_key(df, "k", ["a", "b"], F.when(F.col("a") > 30, F.floor(F.col("a") / 37)))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows once for window and join; the counts of the buckets by bucket, by key and for the join
    assert plan.count("Exchange hashpartitioning") == 4, plan
    want = df.withColumn("row_number", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")))
    assert _rows(got, "k", "a", "b", "row_number") == _rows(want, "k", "a", "b", "row_number")
