"""Incremental silver: a stateful stream that keeps every key's newest change.

The state of all tables is one streaming aggregate: the ``max`` of a struct that begins with a
change's order (ts, lsn, offset) and ends with its row image, grouped by table and key, in update mode.  Each micro-batch hands on only keys
whose newest change may have moved, whatever the order in which changes arrive, and a change
seen again moves nothing.  State lives in the RocksDB state store under the checkpoint, so it
is bounded by the executors' disks, not their memory, and a restart goes on from it.

The newest rows are merged into Parquet state tables (``Store.merge``): the buckets that hold
them are rewritten by dynamic partition overwrite, all others stay as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import IMAGE_AFTER_OPS, PRIMARY_KEYS
from tidemark.operators.silver import change_rows, image_key, row_image
from tidemark.sources.store import BUCKETS, Store, free
from tidemark.streaming.state_store import use_rocksdb

BRONZE_LOG_SCHEMA = T.StructType([
    T.StructField("cdc_ts_ms", T.LongType()), T.StructField("cdc_ts", T.TimestampType()),
    T.StructField("cdc_db", T.StringType()), T.StructField("cdc_lsn", T.LongType()),
    T.StructField("before_json", T.StringType()), T.StructField("after_json", T.StringType()),
    T.StructField("kafka_topic", T.StringType()), T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()), T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()), T.StructField("cdc_op", T.StringType()),
    # partition columns of the bronze layout
    T.StructField("batch", T.StringType()), T.StructField("cdc_table", T.StringType()),
])


def bronze_log_stream(spark: SparkSession, store: Store, name: str = "bronze",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """The bronze log as a stream, batch folder by batch folder."""
    r = spark.readStream.schema(BRONZE_LOG_SCHEMA).option("basePath", store.path(name))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(store.path(name))


def _key() -> Column:
    """The key of a change as text, by its table; null for an image that is no row of it."""
    image = row_image()
    return F.coalesce(*[F.when(F.col("cdc_table") == t, image_key(image, t)) for t in PRIMARY_KEYS])


def newest_changes(bronze: DataFrame) -> DataFrame:
    """The newest change of each table's keys: its operation, place in the log and row image, in
    bronze columns.  The state holds no more than that, once: the change is its own order."""
    change = F.struct("cdc_ts", "cdc_lsn", "kafka_offset", "cdc_op", row_image().alias("image"))
    after = F.col("cdc_op").isin(IMAGE_AFTER_OPS)
    return (bronze.withColumn("_key", _key()).where(F.col("_key").isNotNull())
            .groupBy("cdc_table", "_key").agg(F.max(change).alias("_newest"))
            .select("cdc_table", "_newest.*")
            .select("cdc_table", "cdc_op", "cdc_ts", "cdc_lsn", "kafka_offset",
                    F.when(after, F.lit(None)).otherwise(F.col("image")).alias("before_json"),
                    F.when(after, F.col("image")).alias("after_json")))


def state_writer(store: Store, stream: str, prefix: str = "silver/", buckets: int = BUCKETS):
    """foreachBatch function: the batch's newest changes are written once, merged table by table,
    and go; a retry repeats all of it with the same outcome."""
    scratch = Store(store.spark, store.root, "zstd")

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"silver_changes/batch={stream}-{batch_id}"
        scratch.write(batch, name, ["cdc_table"])
        changes = store.spark.read.schema(batch.schema).parquet(store.path(name))
        for t in sorted(r[0] for r in changes.select("cdc_table").distinct().collect()):
            rows = change_rows(changes.where(F.col("cdc_table") == t), t)
            store.merge(rows, f"{prefix}{t}", PRIMARY_KEYS[t], buckets)
            free(store.spark)
        scratch.drop(name)

    return write


def start_state_stream(bronze: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None,
                       prefix: str = "silver/", buckets: int = BUCKETS):
    """Starts the stream over bronze rows (``decode`` of records, or the bronze log)."""
    use_rocksdb(store.spark)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]  # a restart goes on under its name
    return (newest_changes(bronze).writeStream.outputMode("update")
            .foreachBatch(state_writer(store, stream, prefix, buckets))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())
