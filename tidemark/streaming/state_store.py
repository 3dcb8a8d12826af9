"""Where streams keep their state: RocksDB on the executors' disks.

A micro-batch commits its changes (a changelog), and Spark's maintenance uploads whole
snapshots now and then; rows are not counted on each write, which would read the key first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # half the bytes of lz4, on the executors' disks and in the checkpoint
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # a restart goes on from the last batch: older versions of the state need not stay
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def use_rocksdb(spark: SparkSession) -> None:
    for key, value in _CONF.items():
        spark.conf.set(key, value)
