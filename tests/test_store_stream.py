"""Plain writes, bucket merges, the streams and their sources."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.model import PRIMARY_KEYS
from tidemark.operators import bronze as B
from tidemark.operators import silver as S
from tidemark.plans import gold as G
from tidemark.plans import jobs
from tidemark.plans.flow import Flow
from tidemark.sources import offsets
from tidemark.sources.store import Store
from tidemark.streaming import bronze_stream as BS
from tidemark.streaming import silver_stream as SS

from conftest import SF_SMALL

COLS = ["order_id", "status", "_cdc_lsn", "_is_deleted"]


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or df.columns)).collect()), key=str)


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_snapshot_is_replaced_and_counted(spark, scratch):
    st = Store(spark, scratch)
    assert not st.exists("gold/x")
    with pytest.raises(FileNotFoundError):
        st.read("gold/x")
    assert st.write(spark.range(5), "gold/x") == 5
    assert st.write(spark.range(3), "gold/x") == 3
    assert st.exists("gold/x") and st.read("gold/x").count() == 3


def test_batches_of_a_log_are_replaced_by_name(spark, scratch):
    st = Store(spark, scratch)
    df = spark.range(4).withColumn("t", F.lit("a"))
    st.append(df, "log", "s-0", ["t"])
    st.append(df, "log", "s-1", ["t"])
    st.append(df.limit(2), "log", "s-1", ["t"])  # a retry of the second
    assert _rows(st.read("log").groupBy("batch").count()) == [("s-0", 4), ("s-1", 2)]


def test_merge_rewrites_only_touched_buckets(spark, scratch):
    p = Flow(spark, SF_SMALL)
    st = Store(spark, scratch)
    keys = ["order_id"]
    rows = S.change_rows(p.bronze_of("orders"), "orders")
    first = rows.where(F.col("_cdc_op") != "UPDATE")
    st.merge(S.latest_per_key(first, keys), "silver/orders", keys, buckets=16)
    before = _files(st.path("silver/orders"))
    some = rows.where((F.col("_cdc_op") == "UPDATE") & (F.pmod(F.xxhash64("order_id"), F.lit(16)) < 3))
    touched = st.merge(S.latest_per_key(some, keys), "silver/orders", keys, buckets=16)
    after = _files(st.path("silver/orders"))
    assert touched == [0, 1, 2]
    same = [f for f in before if int(f.split("bucket=")[1].split("/")[0]) > 2]
    assert len(same) == 13 and all(after[f] == before[f] for f in same)
    want = S.merge_upsert(S.latest_per_key(first, keys), S.latest_per_key(some, keys), keys, guarded=True)
    assert _rows(st.read("silver/orders"), *COLS) == _rows(want, *COLS)
    # merging older changes again, or nothing, changes nothing
    st.merge(S.latest_per_key(first, keys), "silver/orders", keys, buckets=16)
    assert st.merge(S.latest_per_key(first.limit(0), keys), "silver/orders", keys, buckets=16) == []
    assert _rows(st.read("silver/orders"), *COLS) == _rows(want, *COLS)


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    p = Flow(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    p.records.coalesce(4).write.parquet(landing)
    st = Store(spark, f"{scratch}/lake")
    for _ in range(2):
        q = BS.start_bronze_stream(BS.file_records(spark, landing, max_files_per_trigger=2), st,
                                   f"{scratch}/ckpt", trigger={"availableNow": True},
                                   partition_by=["cdc_table"])
        q.awaitTermination()
        assert q.exception() is None
        assert _rows(st.read("bronze"), *B.COORDINATES) == _rows(p.bronze, *B.COORDINATES)
    assert st.read("bronze").select("batch").distinct().count() > 1


def test_redelivery_across_batches_is_dropped(spark, scratch):
    p = Flow(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    recs = p.records_of("orders")
    # the same records land twice, in different files and so in different batches
    recs.repartition(3).write.parquet(landing)
    recs.repartition(2).write.mode("append").parquet(landing)
    st = Store(spark, f"{scratch}/lake")
    q = BS.start_bronze_stream(BS.file_records(spark, landing, max_files_per_trigger=1), st,
                               f"{scratch}/ckpt", trigger={"availableNow": True},
                               partition_by=["cdc_table"], dedup_within="1 hour")
    q.awaitTermination(600)
    assert q.exception() is None
    assert st.read("bronze").count() == recs.count()


def test_incremental_silver_job_and_error_isolation(spark, scratch):
    p = Flow(spark, SF_SMALL)
    st = Store(spark, f"{scratch}/lake")
    recs = p.records_of("orders").unionByName(p.records_of("customers"))
    part = F.pmod(F.hash("offset"), F.lit(2))
    for k in (1, 0):  # later changes of a key may come first
        jobs.run_bronze(st, recs.where(part == k), partition_by=["cdc_table"])
        jobs.run_silver_incremental(st, f"{scratch}/ckpt")
    jobs.run_silver_incremental(st, f"{scratch}/ckpt")  # nothing new
    assert _rows(st.read("silver/orders"), *COLS) == _rows(p.silver["orders"], *COLS)
    jobs.run_gold(st, ["orders"])
    assert st.read("gold/orders").count() == p.gold["orders"].count()
    # full rebuild: a table that cannot be built fails, the others are still written
    with pytest.raises(jobs.LayerErrors):
        jobs.run_silver(st, ["orders", "no_such_table"], by_month=True)
    assert "event_month" in st.read("silver/orders").columns
    assert _rows(st.read("silver/orders"), *COLS) == _rows(p.silver["orders"], *COLS)
    # union of audit branches skips a missing table's branch
    audit = G.union_audit_branches({"orders": p.bronze_of("orders"), "returns": None})
    assert {r["source_table"] for r in audit.select("source_table").distinct().collect()} == {"orders"}


def test_state_stream_ignores_what_is_no_row(spark, scratch):
    from records import envelope, order, record, records_df
    bad = [record(envelope("u", after=order(1, "shipped", total="lots"), ts_ms=9, lsn=9), 9),
           record(envelope("u", after={"status": "x"}, ts_ms=8, lsn=8), 8),
           record(envelope("c", after=order(1, "confirmed"), ts_ms=1, lsn=1), 1),
           record(envelope("c", after={"order_id": 1, "line_no": 2}, table="order_items", ts_ms=1, lsn=2), 2, table="order_items")]
    st = Store(spark, f"{scratch}/lake")
    jobs.run_bronze(st, records_df(spark, bad), partition_by=["cdc_table"])
    jobs.run_silver_incremental(st, f"{scratch}/ckpt")
    got = st.read("silver/orders").collect()
    assert [(r["order_id"], r["status"]) for r in got] == [(1, "confirmed")]
    assert _rows(st.read("silver/order_items"), *PRIMARY_KEYS["order_items"]) == [(1, 2)]


# ------------------------------------------------------------------------ offset source

def _run(spark, scratch, name, **kw):
    root = f"{scratch}/land"
    src = offsets.stream(spark, root, f"{scratch}/{name}-progress", **kw)
    q = src.writeStream.format("parquet").option("path", f"{scratch}/{name}-out").option(
        "checkpointLocation", f"{scratch}/{name}-ckpt").trigger(processingTime="0 seconds").start()
    offsets.run_to_end(q, root, f"{scratch}/{name}-progress", kw.get("topics"))
    if q.exception() is not None:
        raise q.exception()
    sizes = [x["numInputRows"] for x in q.recentProgress if x["numInputRows"]]
    return spark.read.schema(offsets.SCHEMA).parquet(f"{scratch}/{name}-out"), sizes


@pytest.fixture
def landed(spark, scratch):
    p = Flow(spark, SF_SMALL)
    recs = p.records_of("orders").unionByName(p.records_of("products"))
    offsets.land(recs, f"{scratch}/land")
    return recs


def test_offset_source_admits_offsets_and_restarts(spark, scratch, landed):
    n = landed.count()
    out, sizes = _run(spark, scratch, "a", max_offsets_per_trigger=700)
    assert max(sizes) <= 700 and out.count() == n
    offsets.land(landed.limit(50), f"{scratch}/land")
    out, sizes = _run(spark, scratch, "a", max_offsets_per_trigger=700)
    assert sum(sizes) == 50
    # offsets are positions: dense, each once, and values are what was landed
    per = out.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.count_distinct("offset").alias("d"),
                                                F.min("offset").alias("a"), F.max("offset").alias("b")).collect()
    assert all(r["n"] == r["d"] == r["b"] + 1 and r["a"] == 0 for r in per)
    assert _rows(out.select("value").distinct()) == _rows(landed.select("value").distinct())


def test_offset_source_starts_where_it_is_told(spark, scratch, landed):
    everything, _ = _run(spark, scratch, "all")
    topic = "cdc.public.products"
    out, _ = _run(spark, scratch, "some", topics=[topic],
                  starting_offsets=json.dumps({f"{topic}/0": 5, f"{topic}/1": 10_000}))
    want = everything.where((F.col("topic") == topic) & ((F.col("partition") == 2) | (F.col("partition") == 0) & (F.col("offset") >= 5)))
    assert _rows(out) == _rows(want)
    out, _ = _run(spark, scratch, "late", starting_offsets="latest")
    assert out.count() == 0
    offsets.land(landed.limit(7), f"{scratch}/land")
    out, _ = _run(spark, scratch, "late", starting_offsets="latest")
    assert out.count() == 7


def test_offset_source_fails_on_lost_records_unless_told_otherwise(spark, scratch, landed):
    offsets.land(landed.limit(30), f"{scratch}/land")
    index = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/land/index")
    lost = index.where((F.col("start") > 0) & (F.col("topic") == "cdc.public.orders")).first()
    folder = (f"{scratch}/land/records/{lost['run']}/topic={lost['topic']}/partition={lost['partition']}/chunk={lost['chunk']}")
    os.rename(folder, f"{scratch}/elsewhere")
    with pytest.raises(Exception, match="records lost"):
        _run(spark, scratch, "strict")
    out, _ = _run(spark, scratch, "lax", fail_on_data_loss=False)
    assert out.count() == landed.count() + 30 - lost["n"]


def test_offset_source_refuses_a_foreign_progress_folder(spark, scratch, landed):
    _run(spark, scratch, "a")
    os.rename(f"{scratch}/a-progress", f"{scratch}/gone")
    offsets.land(landed.limit(5), f"{scratch}/land")
    src = offsets.stream(spark, f"{scratch}/land", f"{scratch}/a-progress", max_offsets_per_trigger=10)
    q = src.writeStream.format("parquet").option("path", f"{scratch}/a-out").option(
        "checkpointLocation", f"{scratch}/a-ckpt").trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception, match="does not belong|lies before"):
        for _ in range(200):
            q.processAllAvailable()
            if q.exception() is not None:
                raise q.exception()
            time.sleep(0.05)
    q.stop()


def _changes(spark, n, lsn):
    return spark.range(n).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                 F.lit(None).cast("timestamp").alias("_cdc_ts"), F.lit(lsn).cast("long").alias("_cdc_lsn"),
                                 F.col("id").alias("_cdc_offset"))


def test_merge_writes_a_large_bucket_by_several_tasks(spark, scratch):
    st = Store(spark, scratch)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        assert st.merge(_changes(spark, 20_000, 1), "t", ["k"], buckets=1) == [0]
        assert len(_files(st.path("t"))) > 1
        some = _changes(spark, 20_001, 2).where("k % 2 = 0")
        assert st.merge(some, "t", ["k"], buckets=1, changes=some.union(some)) == [0]
        assert len(_files(st.path("t"))) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    got = st.read("t").groupBy("_cdc_lsn").agg(F.count("*"), F.count_distinct("k"), F.count("v"))
    assert _rows(got) == [(1, 10_000, 10_000, 10_000), (2, 10_001, 10_001, 10_001)]
    assert st.merge(_changes(spark, 0, 1), "none", ["k"]) == []


def test_a_trigger_costs_the_same_however_many_came_before(spark, scratch, monkeypatch):
    import pyarrow.parquet as pq
    offsets.land(spark.createDataFrame([("t", 0, k, None, str(k)) for k in range(50)], offsets.SCHEMA), f"{scratch}/landing")
    reader = offsets.OffsetReader({"path": f"{scratch}/landing", "progress": f"{scratch}/progress", "maxOffsetsPerTrigger": "1"})
    read, seen = pq.read_table, []
    monkeypatch.setattr(pq, "read_table", lambda *a, **k: seen.append(a) or read(*a, **k))
    ends = [reader.latestOffset()["t/0"] for _ in range(52)]
    assert ends == [*range(1, 51), 50, 50]
    assert len(seen) == 1 and len(os.listdir(f"{scratch}/progress")) <= offsets.KEPT_NOTES + 1
    offsets.land(spark.createDataFrame([("t", 0, 9, None, "x")], offsets.SCHEMA), f"{scratch}/landing")
    assert reader.latestOffset() == {"t/0": 51}
    again = offsets.OffsetReader({"path": f"{scratch}/landing", "progress": f"{scratch}/progress"})
    assert again.latestOffset() == {"t/0": 51}


def test_a_task_opens_only_the_row_groups_of_its_offsets(spark, scratch):
    import glob

    import pyarrow.parquet as pq
    rows = spark.range(0, 30_000, 1, 1).selectExpr(
        "'cdc.public.orders' topic", "0 partition", "id offset", "timestamp_seconds(id) timestamp", "repeat(sha2(string(id), 512), 5) value")
    offsets.land(rows.coalesce(1), f"{scratch}/landing")
    groups = [pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{scratch}/landing/records/**/*.parquet", recursive=True)]
    assert sum(groups) > len(groups)
    reader = offsets.OffsetReader({"path": f"{scratch}/landing", "progress": f"{scratch}/progress"})
    key = "cdc.public.orders/0"
    got = [n for c in reader.partitions({key: 14_990}, {key: 15_010}) for b in reader.read(c) for n in b.column(2).to_pylist()]
    assert sorted(got) == list(range(14_990, 15_010))
