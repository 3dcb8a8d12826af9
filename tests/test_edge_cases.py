"""Hand-written change logs, one per edge case of FIXTURES section 5."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from records import envelope, order, record, records_df
from tidemark.model import PRIMARY_KEYS
from tidemark.operators import bronze as B
from tidemark.operators import silver as S
from tidemark.plans import gold as G
from tidemark.plans import kpi as K

KEYS = PRIMARY_KEYS["orders"]


def _state(spark, rows, **kw):
    return S.state(B.decode(records_df(spark, rows)), "orders", **kw)


def test_same_millisecond_resolved_by_lsn(spark):
    rows = [record(envelope("c", after=order(1, "pending"), ts_ms=1000, lsn=1), offset=10),
            record(envelope("u", after=order(1, "confirmed"), ts_ms=1000, lsn=2), offset=11)]
    got = _state(spark, rows).collect()
    assert len(got) == 1 and got[0]["status"] == "confirmed" and got[0]["_cdc_op"] == "UPDATE"


def test_replayed_record_counted_once(spark):
    v = envelope("c", after=order(1), ts_ms=1000, lsn=1)
    rows = [record(v, offset=5), record(v, offset=5), record(v, offset=6)]
    b = B.decode(records_df(spark, rows))
    assert b.count() == 3
    assert B.dedup_replays(b).count() == 2
    audit = G.gold_cdc_audit(B.dedup_replays(b)).collect()
    assert audit[0]["event_count"] == 2


def test_delete_of_unseen_key_is_inserted_deleted(spark):
    target = _state(spark, [record(envelope("c", after=order(1), ts_ms=1, lsn=1), offset=1)])
    deletes = _state(spark, [record(envelope("d", before=order(2), ts_ms=2, lsn=2), offset=2)])
    merged = {r["order_id"]: r for r in S.merge_upsert(target, deletes, KEYS).collect()}
    assert set(merged) == {1, 2}
    assert merged[2]["_is_deleted"] is True and merged[1]["_is_deleted"] is False


def test_key_only_delete_image(spark):
    rows = [record(envelope("c", after=order(1, "pending", total=12.5), ts_ms=1, lsn=1), offset=1),
            record(envelope("d", before={"order_id": 1}, ts_ms=2, lsn=2), offset=2)]
    before = _state(spark, rows).collect()[0]
    assert before["_is_deleted"] and before["status"] is None and before["total_amount"] is None
    known = _state(spark, rows, delete_image="last_known").collect()[0]
    assert known["_is_deleted"] and known["status"] == "pending"
    assert known["total_amount"] == decimal.Decimal("12.50")


def test_delete_then_insert_is_live_again(spark):
    rows = [record(envelope("c", after=order(1), ts_ms=1, lsn=1), offset=1),
            record(envelope("d", before=order(1), ts_ms=2, lsn=2), offset=2),
            record(envelope("c", after=order(1, "confirmed"), ts_ms=3, lsn=3), offset=3)]
    r = _state(spark, rows).collect()[0]
    assert r["_is_deleted"] is False and r["_deleted_at"] is None and r["status"] == "confirmed"


def test_envelope_faults_are_quarantined(spark):
    good = envelope("c", after=order(1), ts_ms=1, lsn=1)
    rows = [record(None, 1), record("{not json", 2), record('{"payload":null}', 3),
            record(envelope(None, after=order(1)), 4), record(envelope("t", after=order(1)), 5),
            record(envelope("c", after=order(1), table=None), 6), record(good, 7)]
    df = records_df(spark, rows)
    reasons = {r["kafka_offset"]: r["reject_reason"] for r in B.quarantine(df).collect()}
    assert reasons == {1: "value_null", 2: "not_json", 3: "payload_null", 4: "op_null",
                       5: "op_unknown", 6: "table_null"}
    assert [r["kafka_offset"] for r in B.decode(df).collect()] == [7]


def test_bad_images_never_reach_state(spark):
    rows = [record(envelope("c", after="oops", ts_ms=1, lsn=1), 1),
            record(envelope("c", after={}, ts_ms=1, lsn=2), 2),
            record(envelope("c", after={"status": "pending"}, ts_ms=1, lsn=3), 3),
            record(envelope("c", after=order(9), ts_ms=1, lsn=4), 4)]
    b = B.decode(records_df(spark, rows))
    assert [r["order_id"] for r in S.state(b, "orders").collect()] == [9]
    assert sorted(r["kafka_offset"] for r in S.image_rejects(b, "orders").collect()) == [1, 2, 3]


def test_dates_as_epoch_days_and_text(spark):
    rows = [record(envelope("c", after={"customer_id": 1, "registration_date": 19700},
                            table="customers", ts_ms=1, lsn=1), 1, table="customers"),
            record(envelope("c", after={"customer_id": 2, "registration_date": "2023-12-09"},
                            table="customers", ts_ms=1, lsn=2), 2, table="customers")]
    b = B.decode(records_df(spark, rows))
    got = {r["customer_id"]: r["registration_date"] for r in S.state(b, "customers").collect()}
    assert got == {1: dt.date(2023, 12, 9), 2: dt.date(2023, 12, 9)}


def test_money_sums_exactly(spark):
    rows = [record(envelope("c", after=order(i, total=19.99), ts_ms=1, lsn=i), i)
            for i in range(1, 1001)]
    s = _state(spark, rows)
    assert s.agg(F.sum("total_amount")).first()[0] == decimal.Decimal("19990.00")


def test_guarded_merge_ignores_late_event(spark):
    target = _state(spark, [record(envelope("u", after=order(1, "shipped"), ts_ms=50, lsn=5), 5)])
    late = _state(spark, [record(envelope("u", after=order(1, "confirmed"), ts_ms=10, lsn=3), 3)])
    guarded = S.merge_upsert(target, late, KEYS, guarded=True).collect()
    assert guarded[0]["status"] == "shipped"
    plain = S.merge_upsert(target, late, KEYS).collect()
    assert plain[0]["status"] == "confirmed"


def _customers(spark, rows):
    return S.state(B.decode(records_df(spark, rows)), "customers")


def test_deleted_customer_and_deleted_order(spark):
    cust = _customers(spark, [
        record(envelope("c", after={"customer_id": 1, "name": "A", "segment": "VIP"},
                        table="customers", ts_ms=1, lsn=1), 1, table="customers"),
        record(envelope("d", before={"customer_id": 1, "name": "A", "segment": "VIP"},
                        table="customers", ts_ms=2, lsn=2), 2, table="customers")])
    orders = _state(spark, [
        record(envelope("c", after=order(10, "confirmed", customer_id=1), ts_ms=1, lsn=1), 1),
        record(envelope("c", after=order(11, "pending", customer_id=1), ts_ms=1, lsn=2), 2),
        record(envelope("d", before=order(11, "pending", customer_id=1), ts_ms=2, lsn=3), 3)])
    go = G.gold_orders(orders, cust).collect()
    assert [(r["order_id"], r["customer_name"]) for r in go] == [(10, None)]
    pay = S.state(B.decode(records_df(spark, [record(envelope(
        "c", after={"payment_id": 5, "order_id": 10, "amount": 3.5, "method": "card",
                    "status": "completed", "payment_date": "2023-12-10T00:00:00Z"},
        table="payments", ts_ms=1, lsn=1), 1, table="payments")])), "payments")
    ps = G.gold_payments_summary(pay, orders, cust).collect()
    assert ps[0]["customer_segment"] == "VIP"  # D9: no delete filter in the chain
    items = S.state(B.decode(records_df(spark, [
        record(envelope("c", after={"order_id": 10, "line_no": 1, "product_id": 1, "quantity": 1,
                                    "unit_price": 2.0}, table="order_items", ts_ms=1, lsn=1),
               1, table="order_items"),
        record(envelope("c", after={"order_id": 11, "line_no": 1, "product_id": 1, "quantity": 1,
                                    "unit_price": 2.0}, table="order_items", ts_ms=1, lsn=2),
               2, table="order_items")])), "order_items")
    products = S.state(B.decode(records_df(spark, [])), "products")
    facts = G.gold_sales_facts(items, orders, products, cust).collect()
    assert [(r["order_id"], r["line_no"]) for r in facts] == [(10, 1)]


def test_cancellation_rate_of_empty_orders_is_null(spark):
    empty = _state(spark, [])
    cust = _customers(spark, [])
    r = K.kpi_cancellation_rate(G.gold_orders(empty, cust)).collect()
    assert len(r) == 1 and r[0][0] is None


def test_fk_orphan_counts_match_anti_joins(spark):
    from tidemark.operators import quality as Q
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    a = spark.createDataFrame([(1, 1), (2, 3), (3, None)], "aid long, pid long")
    b = spark.createDataFrame([(1, 2), (2, 2)], "bid long, pid long")
    fks = [("a", "pid", "p", "id"), ("b", "pid", "p", "id")]
    got = {(r["child_table"], r["n_orphans"]) for r in
           Q.fk_orphan_counts({"a": a, "b": b, "p": parent}, fks).collect()}
    assert got == {("a", 1), ("b", 0)}
    assert Q.fk_orphans(a, "pid", parent, "id").count() == 1


def test_all_null_amounts_average_to_null(spark):
    pay = S.state(B.decode(records_df(spark, [record(envelope(
        "c", after={"payment_id": 5, "order_id": 10, "method": "card", "status": "completed",
                    "payment_date": "2023-12-10T00:00:00Z"},
        table="payments", ts_ms=1, lsn=1), 1, table="payments")])), "payments")
    empty = _state(spark, [])
    r = G.gold_payments_summary(pay, empty, _customers(spark, [])).collect()
    assert r[0]["avg_amount"] is None and r[0]["nb_payments"] == 1
