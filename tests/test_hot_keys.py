"""One key holding a third of the change log."""

from records import envelope, order, record, records_df
from tidemark import cli
from tidemark.operators import bronze as B
from tidemark.operators import silver as S


def _log(n_keys=200, hot_share=3):
    rows, i = [], 0
    for k in range(1, n_keys + 1):
        rows.append(record(envelope("c", after=order(k, "pending"), ts_ms=k, lsn=i), i)); i += 1
    # the hot key receives as many updates as all other rows together, and then some
    statuses = ["confirmed", "shipped", "delivered"]
    for j in range(n_keys * hot_share // 2):
        rows.append(record(envelope("u", after=order(1, statuses[j % 3]), ts_ms=10_000 + j,
                                    lsn=i), i)); i += 1
    return rows, statuses[(n_keys * hot_share // 2 - 1) % 3]


def test_hot_key_state_and_partial_limit(spark):
    rows, last_status = _log()
    recs = records_df(spark, rows).repartition(8)
    s = S.state(B.decode(recs), "orders")
    got = {r["order_id"]: r["status"] for r in s.collect()}
    assert len(got) == 200 and got[1] == last_status
    assert all(v == "pending" for k, v in got.items() if k != 1)
    plan = s._jdf.queryExecution().executedPlan().toString()
    # the hot key is cut to one row per map task before the shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_cli_bronze_arguments():
    args = cli._parser().parse_args(
        ["bronze", "--checkpoint", "/c", "--root", "/r", "--topics",
         "cdc.public.orders,payments", "--starting-offsets", "latest",
         "--max-per-trigger", "100000", "--partition-by", "cdc_table,event_month"])
    assert cli._tables(args.topics) == ["orders", "payments"]
    assert args.starting_offsets == "latest" and args.max_per_trigger == 100000
    assert args.partition_by.split(",") == ["cdc_table", "event_month"]
    assert cli._tables("all") == cli.TABLES
    s = cli._parser().parse_args(["silver", "--root", "/r", "--incremental", "--checkpoint", "/s"])
    assert s.incremental and s.checkpoint == "/s" and s.table == "all"


def test_gold_star_join_splits_a_hot_order(spark):
    """A third of all order lines on one order: AQE splits that key's partition on
    the fact side of the (non-broadcast) join instead of giving it to one task."""
    from pyspark.sql import functions as F

    from tidemark.plans import gold as G

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        live = [F.lit(False).alias("_is_deleted")]
        n = 60000
        items = spark.range(n).select(
            F.col("id").alias("line_no"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 2)
            .alias("order_id"),
            (F.col("id") % 100).alias("product_id"), F.lit(1).alias("quantity"),
            F.lit(2.5).cast("decimal(12,2)").alias("unit_price"), *live)
        orders = spark.range(1, 5002).select(
            F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"),
            F.current_timestamp().alias("order_date"), F.lit("web").alias("channel"),
            F.lit("confirmed").alias("status"), *live)
        products = spark.range(100).select(
            F.col("id").alias("product_id"), F.lit("p").alias("name"),
            F.lit("c").alias("category"), F.lit("b").alias("brand"), *live)
        customers = spark.range(50).select(
            F.col("id").alias("customer_id"), F.lit("n").alias("name"),
            F.lit("s").alias("segment"), F.lit("c").alias("city"), *live)
        df = G.gold_sales_facts(items, orders, products, customers)
        assert len(df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_insert_ignore_limits_a_hot_unique_key_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import quality as Q

    target = spark.createDataFrame([(0, "a@x")], "customer_id long, email string")
    incoming = spark.range(1, 30000).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot@x"))
        .otherwise(F.concat(F.col("id").cast("string"), F.lit("@x"))).alias("email"))
    out = Q.insert_ignore(target, incoming, ["email"], ["customer_id"])
    got = {r["email"]: r["customer_id"] for r in out.collect()}
    assert got["hot@x"] == 3 and got["a@x"] == 0 and len(got) == 1 + 1 + 20000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_replay_dedup_aggregates_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import bronze as B

    # one record delivered 20,000 times plus 10,000 distinct records
    hot = spark.range(20000).select(F.lit("t").alias("kafka_topic"),
                                    F.lit(0).alias("kafka_partition"),
                                    F.lit(7).cast("long").alias("kafka_offset"),
                                    F.lit("x").alias("v"))
    rest = spark.range(10000).select(F.lit("t").alias("kafka_topic"),
                                     F.lit(1).alias("kafka_partition"),
                                     F.col("id").alias("kafka_offset"), F.lit("y").alias("v"))
    out = B.dedup_replays(hot.unionByName(rest).repartition(8))
    assert out.count() == 10001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # map-side combine before the exchange


def test_fk_orphan_counts_pre_aggregate_a_hot_parent(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import quality as Q

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(60000).select(
            F.col("id").alias("line_no"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 2)
            .alias("order_id"))
        parent = spark.range(1, 4000).select(F.col("id").alias("order_id"))
        out = Q.fk_orphan_counts({"items": child, "orders": parent},
                                 [("items", "order_id", "orders", "order_id")])
        got = out.collect()
        want = child.join(parent, "order_id", "left_anti").count()
        assert got[0]["n_orphans"] == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        # references are counted per value before the join: the hot parent is one row
        join_at = plan.index("SortMergeJoin")
        assert "partial_count" in plan[join_at:]
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_bronze_write_clustering_spreads_a_hot_day(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.bronze import clustered_for_write

    n = 30000
    df = spark.range(n).select(
        F.lit("orders").alias("cdc_table"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .otherwise(F.date_format(F.date_add(F.lit("2023-01-01"), (F.col("id") % 300).cast("int")),
                                 "yyyy-MM-dd")).cast("date").alias("event_day"),
        F.lit("cdc.public.orders").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"))
    # AQE merges adjacent range partitions only up to the advisory size; at this tiny
    # size it would merge everything into one, so model large partitions by turning
    # coalescing off
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (clustered_for_write(df, ["cdc_table", "event_day"])
                 .filter(F.col("event_day") == F.lit("2024-01-01").cast("date"))
                 .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
