"""The order lifecycle and the audit as event-driven streams."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import bronze as B
from tidemark.plans import gold as G
from tidemark.sources import offsets
from tidemark.streaming import audit_stream as AS
from tidemark.streaming import lifecycle_stream as LS

from records import envelope, order, record, records_df

MINUTE = 60_000
START = 1000  # minute 0 of the tests: Spark's first watermark is the epoch


def _stream(spark, scratch, landings, build, schema):
    for rows in landings:
        offsets.land(records_df(spark, rows), f"{scratch}/landing")
        src = offsets.stream(spark, f"{scratch}/landing", f"{scratch}/progress")
        q = build(B.decode(src)).writeStream.format("parquet").option("path", f"{scratch}/out").option(
            "checkpointLocation", f"{scratch}/ckpt").outputMode("append").trigger(processingTime="0 seconds").start()
        offsets.run_to_end(q, f"{scratch}/landing", f"{scratch}/progress")
    return spark.read.schema(schema).parquet(f"{scratch}/out")


def _change(op, order_id, status, minute, lsn):
    image = {"before": order(order_id, status)} if op == "d" else {"after": order(order_id, status)}
    at = (START + minute) * MINUTE
    return record(envelope(op, ts_ms=at, lsn=lsn, **image), lsn, ts_ms=at)


def test_drafts_expire_and_come_back(spark, scratch):
    first = [_change("c", 1, "pending", 0, 1),      # expires at minute 5
             _change("c", 2, "pending", 0, 2), _change("u", 2, "pending", 4, 3),  # its timer moves to minute 9
             _change("c", 3, "pending", 0, 4), _change("u", 3, "confirmed", 3, 5),
             _change("c", 4, "pending", 0, 6), _change("d", 4, "pending", 2, 7),
             _change("c", 5, "pending", 1, 8), _change("u", 5, "delivered", 1, 9),  # illegal, decided by the log position
             _change("c", 9, "confirmed", 8, 10)]   # moves the watermark to minute 7
    second = [_change("u", 1, "cancelled", 8, 11), _change("u", 3, "pending", 9, 12), _change("c", 8, "confirmed", 30, 13)]
    got = _stream(spark, scratch, [first, second], LS.order_events, LS.OUTPUT)
    events = sorted((r["order_id"], r["event"], r["from_status"], r["to_status"], r["at_ms"] // MINUTE - START) for r in got.collect())
    assert events == sorted([
        (1, "expired", "pending", None, 5), (1, "withdrawn", "pending", "cancelled", 8),
        (2, "expired", "pending", None, 9), (5, "illegal", "pending", "delivered", 1),
        (3, "illegal", "confirmed", "pending", 9), (3, "expired", "pending", None, 14)])


def test_legal_pairs_are_the_batch_rule(spark):
    from tidemark.operators import quality as Q
    states = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
    pairs = spark.createDataFrame([(a, b) for a in states for b in states], "a string, b string")
    legal = pairs.where(Q.legal_transition(F.col("a"), F.col("b"))).collect()
    assert {tuple(r) for r in legal} == LS.legal_pairs()


def test_audit_counts_every_event_once(spark, scratch):
    now = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    old = [_change("c", k, "pending", k, k) for k in range(40)]
    today = [record(envelope("u", after=order(k), ts_ms=now, lsn=900 + k), 900 + k, ts_ms=now) for k in range(3)]
    late = [_change("u", k, "confirmed", 50 + k, 100 + k) for k in range(5)] + [_change("c", 77, "pending", 3, 300)]
    out = _stream(spark, scratch, [old + today, late], AS.audit_events, AS.OUTPUT)
    whole = {(r["source_table"], r["operation"], str(r["event_day"])): (r["event_count"], r["n_late"], r["latency_ms_total"])
             for r in AS.audit(out).collect()}
    # today's window is still open: its events are kept, not published
    assert whole == {("orders", "INSERT", "1970-01-01"): (41, 1, 0), ("orders", "UPDATE", "1970-01-01"): (5, 5, 0)}
    batch = G.gold_cdc_audit(B.decode(records_df(spark, old + late))).collect()
    assert {(r["source_table"], r["operation"], str(r["event_day"])): r["event_count"] for r in batch} == {k: v[0] for k, v in whole.items()}


def test_a_task_sums_its_events_by_window(monkeypatch):
    import pyarrow as pa
    day, n = dt.date(1997, 1, 1), 6000

    def batch(k, latency=5):
        return pa.RecordBatch.from_pydict({
            "source_table": ["orders"] * n, "operation": ["INSERT"] * n, "event_day": [day] * n,
            "salt": pa.array([i % 16 for i in range(n)], pa.int32()), "closes_ms": [9] * n, "n": [1] * n,
            "whole_ms": [0] * n, "exact_ms": pa.array([latency] * n, pa.int64()), "last_ms": [k * n + i for i in range(n)]})

    for at_once in (1 << 18, 7000, 20):
        monkeypatch.setattr(AS, "_AT_ONCE", at_once)
        got = pa.Table.from_batches(list(AS.partial_sums(iter([batch(0), batch(1)]))))
        assert got.num_rows == (32 if at_once == 20 else 16)
        assert [sum(got[c].to_pylist()) for c in ("n", "whole_ms", "exact_ms")] == [2 * n, 0, 10 * n]
        assert max(got["last_ms"].to_pylist()) == 2 * n - 1
    assert set(pa.Table.from_batches(list(AS.partial_sums([batch(0, None)])))["exact_ms"].to_pylist()) == {None}


def test_neighbouring_orders_share_a_state(spark, scratch):
    pending = [_change("c", k, "pending", k % 4, k) for k in range(256, 512)]
    offsets.land(records_df(spark, [*pending, _change("c", 700, "confirmed", 60, 999)]), f"{scratch}/landing")
    src = offsets.stream(spark, f"{scratch}/landing", f"{scratch}/progress")
    q = LS.order_events(B.decode(src)).writeStream.format("parquet").option("path", f"{scratch}/out").option(
        "checkpointLocation", f"{scratch}/ckpt").outputMode("append").trigger(processingTime="0 seconds").start()
    offsets.run_to_end(q, f"{scratch}/landing", f"{scratch}/progress")
    updated = sum(s.numRowsUpdated for x in q.recentProgress for s in x.stateOperators)
    assert 0 < updated < 64  # a state an order: 256 at least
    got = spark.read.schema(LS.OUTPUT).parquet(f"{scratch}/out").collect()
    assert sorted((r["order_id"], r["event"], r["at_ms"] // MINUTE - START) for r in got) == [
        (k, "expired", k % 4 + 5) for k in range(256, 512)]


def test_partial_sums_go_on_from_earlier_sums(monkeypatch):
    """Columns that Spark marks as never null meet the sums of the batches before."""
    monkeypatch.setattr(AS, "_AT_ONCE", 4)
    types = {"source_table": pa.string(), "operation": pa.string(), "event_day": pa.date32(), "salt": pa.int32()}
    schema = pa.schema([pa.field(c, types.get(c, pa.int64()), nullable=c != "n") for c in [*AS._WINDOW, *AS._SUMS]])
    row = {"source_table": "orders", "operation": "READ", "event_day": dt.date(1997, 1, 1), "salt": 1, "closes_ms": 9,
           "n": 1, "whole_ms": 2, "exact_ms": 3}
    batches = [pa.RecordBatch.from_pylist([row | {"last_ms": 3 * k + i} for i in range(3)], schema) for k in range(4)]
    out = pa.Table.from_batches(AS.partial_sums(iter(batches)))
    assert sum(out["n"].to_pylist()) == 12 and sum(out["exact_ms"].to_pylist()) == 36 and max(out["last_ms"].to_pylist()) == 11
