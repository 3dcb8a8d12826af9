"""Digest diff, daily bitmaps, VARIANT images, incremental facts, SQL table functions."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import variant as V
from tidemark.plans import incremental as I
from tidemark.plans import kpi as K
from tidemark.plans import rollup as R
from tidemark.plans.flow import Flow
from tidemark.sources import feed
from tidemark.sources.store import Store

from conftest import SF_SMALL
from records import envelope, record, records_df


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or df.columns)).collect()), key=str)


def test_digests_prune_buckets_that_agree(spark):
    p = Flow(spark, SF_SMALL)
    for table in ("customers", "order_items"):
        old = p.views[table]
        key = feed.PRIMARY_KEYS[table][0]
        new = old.where(F.col(key) != 7).withColumn(
            old.columns[-2], F.when(F.col(key) == 11, None).otherwise(F.col(old.columns[-2])))
        left, right = feed.differing_buckets(old, new, table)
        buckets = old.where(F.col(key).isin(7, 11)).select(
            F.pmod(F.xxhash64(*feed.PRIMARY_KEYS[table]), F.lit(feed.DIGEST_BUCKETS)).alias("b")).distinct().count()
        per_bucket = old.count() / feed.DIGEST_BUCKETS
        assert 0 < left.count() < 4 * buckets * per_bucket < old.count()
        at = F.lit("1999-01-01").cast(T.TimestampNTZType())
        assert _rows(feed.snapshot_diff_digests(old, new, table, at)) == _rows(feed.snapshot_diff(old, new, table, at))
        assert [x.count() for x in feed.differing_buckets(old, old, table)] == [0, 0]
        # a table against an empty one, either way
        none = old.limit(0)
        assert feed.snapshot_diff_digests(old, none, table, at).where("op = 'd'").count() == old.count()
        assert feed.snapshot_diff_digests(none, old, table, at).where("op = 'c'").count() == old.count()


def test_bitmaps_roll_up_exactly(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 70_000 * 37 % 90_001).alias("order_id"), (F.col("id") % 3).cast("string").alias("g"),
        F.date_add(F.lit("1997-11-20"), (F.col("id") % 60).cast("int")).alias("d"))
    rows = rows.unionByName(rows.limit(500)).unionByName(rows.limit(3).withColumn("order_id", F.lit(None).cast("long")))
    rows = rows.withColumn("g", F.when(F.col("g") != "2", F.col("g")))  # a null group
    days = R.daily_bitmaps(rows, ["g"], "d", "order_id")
    for level in R.LEVELS:
        got = R.distinct_counts(days, ["g"], level)
        period = F.col("d") if level == "day" else F.trunc("d", level)
        want = rows.groupBy("g", period.alias("period")).agg(F.count_distinct("order_id").alias("n"))
        assert _rows(got, "g", "period", "n_distinct") == _rows(want, "g", "period", "n")


def test_sets_of_spread_ids_take_no_whole_bitmap(spark):
    # 3,000 ids in as many buckets, and a bucket that a day fills while others hold few of it
    spread = spark.range(3000).selectExpr("id * 40000 + 1 AS x", "'a' AS g", "date_add('1997-11-20', cast(id % 50 AS int)) AS d")
    full = spark.range(2000).selectExpr("id + 1 AS x", "cast(NULL AS string) AS g", "date '1997-12-01' AS d")
    few = spark.range(40).selectExpr("id * 100 + 7 AS x", "cast(NULL AS string) AS g", "date '1997-12-03' AS d")
    rows = spread.unionByName(full).unionByName(few).unionByName(few)
    days = R.daily_bitmaps(rows, ["g"], "d", "x")
    assert days.where("ids IS NOT NULL").count() == 1
    assert sum(len(r["ids"] or b"") + 4 * len(r["few"] or ()) for r in days.collect()) < 4096 + 4 * 3100
    for level in R.LEVELS:
        period = F.col("d") if level == "day" else F.trunc("d", level)
        want = rows.groupBy("g", period.alias("period")).agg(F.count_distinct("x").alias("n"))
        assert _rows(R.distinct_counts(days, ["g"], level), "g", "period", "n_distinct") == _rows(want, "g", "period", "n")


def test_what_a_query_reads_often_is_built_once(spark):
    from tidemark.plans.queries import QUERIES
    for name in ("cdc_merge_upsert", "cdc_guarded_merge", "cdc_delete_unseen_key", "dq_pk_summary", "gold_facts_incremental",
                 "sql_table_functions"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan, name
    for name in ("cdc_malformed_filtered", "snapshot_diff_apply", "cdc_replay_dedup", "dq_fk_orphans"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "_none_0" not in plan, name  # the numbering of lines


def test_variant_images_keep_extra_fields_and_bear_missing_ones(spark):
    after = {"customer_id": 1, "name": "A", "registration_date": 19700, "loyalty": {"tier": 3}, "tags": ["x"]}
    rows = [record(envelope("c", after=after, ts_ms=1, lsn=1, table="customers"), 1, table="customers"),
            record(envelope("u", after={"customer_id": 2, "registration_date": "2023-12-09", "is_active": "maybe"},
                            ts_ms=2, lsn=2, table="customers"), 2, table="customers"),
            record(envelope("u", after={"name": "no key"}, ts_ms=3, lsn=3, table="customers"), 3, table="customers"),
            record(envelope("u", after="text", ts_ms=3, lsn=4, table="customers"), 4, table="customers"),
            record("{no json", 5, table="customers"), record(None, 6, table="customers"),
            record(envelope("t", after=after, table="customers"), 7, table="customers")]
    got = {r["customer_id"]: r for r in V.rows(V.decode(records_df(spark, rows)), "customers").collect()}
    assert set(got) == {1, 2}
    assert json.loads(got[1]["extra"]["loyalty"]) == {"tier": 3} and json.loads(got[1]["extra"]["tags"]) == ["x"]
    assert str(got[1]["registration_date"]) == str(got[2]["registration_date"]) == "2023-12-09"
    assert got[2]["name"] is None and got[2]["is_active"] is None and got[2]["extra"] == {}


def test_variant_is_parsed_once(spark):
    p = Flow(spark, SF_SMALL)
    plan = V.rows(V.decode(p.records_of("orders")), "orders")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json(") <= 1 or plan.count("Generate explode") >= 1


def test_facts_refresh_builds_only_affected_orders(spark, scratch):
    p = Flow(spark, SF_SMALL)
    st = Store(spark, scratch)
    old = {t: p.silver[t] for t in ("customers", "products", "orders", "order_items")}
    I.build_facts(st, "facts", old, buckets=8)
    before = {r["order_id"] for r in st.read("facts").select("order_id").distinct().collect()}
    customer = old["orders"].where("status = 'delivered'").first()["customer_id"]
    gone = sorted(before)[0]
    new = dict(old)
    new["customers"] = old["customers"].withColumn("segment", F.when(F.col("customer_id") == customer, "X").otherwise(F.col("segment")))
    new["orders"] = old["orders"].withColumn("_is_deleted", F.col("_is_deleted") | (F.col("order_id") == gone))
    changed = {"customers": spark.createDataFrame([(customer,)], "customer_id long"),
               "products": spark.createDataFrame([], "product_id long"),
               "orders": spark.createDataFrame([(gone,)], "order_id long"),
               "order_items": spark.createDataFrame([], "order_id long, line_no long")}
    affected = {r[0] for r in I.affected_orders(new, changed).collect()}
    assert affected == {gone} | {r[0] for r in old["orders"].where(F.col("customer_id") == customer).select("order_id").collect()}
    touched = I.refresh_facts(st, "facts", new, changed, buckets=8)
    assert 0 < len(touched) <= len(affected)
    assert _rows(st.read("facts").drop("bucket")) == _rows(I._facts(new))


def test_table_functions_take_parameters(spark):
    p = Flow(spark, SF_SMALL)
    K.publish_views(p.gold, p.kpis, ["sales_facts", "orders"])
    K.publish_functions(spark)
    for k in (10, 25):
        got = spark.sql(f"SELECT customer_id FROM gold_top_customers({k}) ORDER BY place").collect()
        assert [r[0] for r in got] == [r["customer_id"] for r in K.kpi_top_customers(p.gold["sales_facts"], k).collect()]
    none = spark.sql("SELECT * FROM gold_sales_between(DATE '2050-01-01', DATE '2050-12-31')")
    assert none.count() == 0
