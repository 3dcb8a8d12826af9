"""What queries read, shuffle and leave on disk."""

import os
import re

from tidemark.operators import bronze as B
from tidemark.plans import incremental as I
from tidemark.plans import queries as Q
from tidemark.plans.flow import Flow
from tidemark.plans.gold import gold_sales_facts
from tidemark.sources.store import Store
from tidemark.streaming import bronze_stream as BS
from tidemark.streaming import silver_stream as SS

from records import envelope, order, record, records_df

DAY = 86_400_000
EARLY, LATE = 9_000 * DAY, 10_000 * DAY  # before and after the cut of the merges


def _orders():
    """Order 1 is updated, 2 deleted and 3 new after the cut."""
    rows = [("c", 1, "pending", EARLY), ("c", 2, "pending", EARLY), ("u", 1, "confirmed", LATE), ("d", 2, "pending", LATE),
            ("c", 3, "pending", LATE)]
    return [record(envelope(op, ts_ms=ts, lsn=k, **{"before" if op == "d" else "after": order(i, status)}), k, ts_ms=ts)
            for k, (op, i, status, ts) in enumerate(rows, 1)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_merges_decode_the_log_once(spark, monkeypatch):
    p = Flow(spark, "nowhere")
    p.records_of = lambda t: records_df(spark, _orders())
    monkeypatch.setattr(Q, "TABLES", ["orders"])
    plans, merge = [], Store.merge
    monkeypatch.setattr(Store, "merge", lambda self, updates, *a, **kw: plans.append(_plan(updates)) or merge(self, updates, *a, **kw))
    out = {r["key"]: (r["label"], r["_is_deleted"]) for r in Q._merge_touched_partitions(p).collect()}
    assert out == {"1": ("confirmed", False), "2": ("pending", True), "3": ("pending", False)}
    assert len(plans) == 2 and not any("from_json" in x for x in plans)


def test_an_order_meets_its_customer_before_its_lines(spark):
    def of(table):
        return spark.createDataFrame([], Q.S.change_rows(B.decode(records_df(spark, [])), table).schema)
    lines = _plan(gold_sales_facts(of("order_items"), of("orders"), of("products"), of("customers"))).split("\n")
    depth = {k: next(re.search("Join", x).start() for x in lines if "Join" in x and re.search(rf"\({k}#", x))
             for k in ("customer_id", "order_id", "product_id")}
    assert depth["customer_id"] > depth["order_id"] > depth["product_id"]


def test_refreshed_facts_are_written_once_and_leave_nothing(spark, scratch):
    def of(table, rows, names):
        empty = spark.createDataFrame([], Q.S.change_rows(B.decode(records_df(spark, [])), table).schema)
        return empty.unionByName(spark.createDataFrame(rows, names), allowMissingColumns=True)
    lines = [(k, 1, 7, 2, False) for k in range(20)]
    silver = {"order_items": of("order_items", lines, "order_id long, line_no long, product_id long, quantity int, _is_deleted boolean"),
              "orders": of("orders", [(k, 1, "pending", False) for k in range(20)], "order_id long, customer_id long, status string, _is_deleted boolean"),
              "products": of("products", [(7, "p", False)], "product_id long, name string, _is_deleted boolean"),
              "customers": of("customers", [(1, "c", False)], "customer_id long, name string, _is_deleted boolean")}
    store = Store(spark, scratch)
    I.build_facts(store, "facts", silver, buckets=8)
    bucket = {r["order_id"]: r["bucket"] for r in store.read("facts").select("order_id", "bucket").collect()}
    gone = [k for k, b in bucket.items() if b == bucket[0]]  # a bucket that loses all its orders
    orders = silver["orders"].withColumn("_is_deleted", Q.F.col("order_id").isin(gone))
    none = spark.createDataFrame([], "customer_id long, product_id long, order_id long, line_no long")
    changed = {"customers": none, "products": none, "order_items": none, "orders": spark.createDataFrame([(k,) for k in [*gone, 1]], "order_id long")}
    touched = I.refresh_facts(store, "facts", silver | {"orders": orders}, changed, buckets=8)
    assert touched == sorted({bucket[0], bucket[1]})
    assert sorted(r["order_id"] for r in store.read("facts").collect()) == sorted(set(bucket) - set(gone))
    assert os.listdir(scratch) == ["facts"]


def test_the_state_holds_a_change_once_and_merged_changes_go(spark, scratch):
    bronze, store = B.decode(records_df(spark, _orders())), Store(spark, scratch)
    newest = SS.newest_changes(bronze)
    assert set(newest.columns) == {"cdc_table", "cdc_op", "cdc_ts", "cdc_lsn", "kafka_offset", "before_json", "after_json"}
    assert _plan(newest).count("kafka_topic") == _plan(bronze.select("cdc_table")).count("kafka_topic")
    write = SS.state_writer(store, "s", buckets=2)
    write(newest, 1)
    write(SS.newest_changes(B.decode(records_df(spark, _orders()[:2]))), 2)  # older changes move nothing
    out = {r["order_id"]: (r["status"], r["_is_deleted"], r["_cdc_offset"]) for r in store.read("silver/orders").collect()}
    assert out == {1: ("confirmed", False, 3), 2: ("pending", True, 4), 3: ("pending", False, 5)}
    assert not [x for x in os.listdir(f"{scratch}/silver_changes") if "=" in x]


def test_a_batch_is_stored_compressed_not_cached(spark, scratch, monkeypatch):
    def cached(self, *a):
        raise AssertionError("rows of a batch are cached")
    monkeypatch.setattr(type(spark.range(1)), "persist", cached)
    store = Store(spark, scratch)
    rows = [*_orders(), _orders()[0], record("{not json", 99)]
    assert BS.write_bronze_batch(store, records_df(spark, rows), "b", ["cdc_table"]) == (5, 1)
    assert BS.write_bronze_batch(store, records_df(spark, []), "none", ["cdc_table"], skip_empty=True) == (0, 0)
    assert store.read("bronze").count() == 5 and os.listdir(f"{scratch}/bronze") == ["batch=b"]
    assert not os.path.isdir(f"{scratch}/decoded") or not os.listdir(f"{scratch}/decoded")


def test_variants_are_walked_once_and_extras_made_where_there_are_any(spark):
    from tidemark.operators import variant as V
    rows = [record(envelope("c", after=order(1)), 1), record(envelope("c", after=order(2, more={"a": [1, "x"]}, n=1.5)), 2),
            record(envelope("c", after=[1]), 3), record('{"payload": {"op": "c", "source": 5, "after": {"order_id": 4}}}', 4),
            record('{"payload": {"op": "d", "ts_ms": "x", "source": {"table": "orders"}, "after": {}, "before": {"order_id": 5}}}', 5)]
    events = V.decode(records_df(spark, rows))
    out = {r["order_id"]: (r["_cdc_op"], r["_cdc_lsn"], r["extra"]) for r in V.rows(events, "orders").collect()}
    assert out == {1: ("INSERT", 0, {}), 2: ("INSERT", 0, {"more": '{"a":[1,"x"]}', "n": "1.5"}), 5: ("DELETE", None, {})}
    assert _plan(events).count("$.payload") == 1
