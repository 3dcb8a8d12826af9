"""Tables on plain Parquet paths (sinks S7-S15): Spark's own writes, no table format.

* a snapshot (gold, rebuilt silver) is one ``overwrite`` of its folder (S10, S11);
* a log (bronze, quarantine) gets one sub-folder ``batch=<name>`` per run or micro-batch; a
  retried batch overwrites its own, so at-least-once delivery leaves one copy (S7, D7);
* a state (incremental silver) is partitioned by a hash bucket of its key, and a merge
  rewrites the buckets that hold touched keys by dynamic partition overwrite (C3, C9).

An overwrite replaces files: readers of the same folder should run before or after it.  A
merge that dies while Spark moves its finished buckets into place is repeated by the stream
or job that ran it, from the same changes; merging them again changes nothing.  Paths may be
any Hadoop-compatible URI.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Buckets of a state table, fixed when it is first written: a merge rewrites at most the
# touched ones, so choose them for about a file of useful size each.
BUCKETS = 64


def free(spark: SparkSession) -> None:
    """Shuffle files of finished steps go when the driver collects its garbage; one with room to
    spare would leave those of many steps on disk."""
    spark._jvm.System.gc()


class Store:
    def __init__(self, spark: SparkSession, root: str, codec: str = "snappy"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.codec = codec

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        """Metadata-only availability probe (S5): no data is read."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # a finished write, or partitions (a dynamic overwrite leaves no marker)
        return fs.exists(at) and any(n == "_SUCCESS" or "=" in n for n in (s.getPath().getName() for s in fs.listStatus(at)))

    def read(self, name: str) -> DataFrame:
        """A snapshot, a state, or a log with all its batches."""
        if not self.exists(name):
            raise FileNotFoundError(f"no table {name} under {self.root}")
        return self.spark.read.option("basePath", self.path(name)).parquet(self.path(name))

    def drop(self, name: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def replace(self, name: str, by: str, partitions: list[str]) -> None:
        """Puts the ``partitions`` of the table ``by`` in the place of those of ``name``; one that
        ``by`` lacks is dropped.  What else ``by`` holds goes."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path(name)).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for p in partitions:
            old, new = path(f"{self.path(name)}/{p}"), path(f"{self.path(by)}/{p}")
            fs.delete(old, True)
            if fs.exists(new) and not fs.rename(new, old):
                raise OSError(f"could not move {new} to {old}")
        self.drop(by)

    @staticmethod
    def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        """Rows counted by the write itself, not by a second evaluation of the plan."""
        seen = Observation(f"rows_{uuid.uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def _write(self, df: DataFrame, path: str, partition_by: list[str] | None) -> int:
        df, seen = self._counted(df)
        w = df.write.mode("overwrite").option("compression", self.codec)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return int(seen.get.get("rows", 0))

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> int:
        """Create or replace; returns the rows written."""
        return self._write(df, self.path(name), partition_by)

    def append(self, df: DataFrame, name: str, batch: str, partition_by: list[str] | None = None) -> int:
        """One batch of a log, replacing what an earlier try of it wrote; returns the rows."""
        return self._write(df, f"{self.path(name)}/batch={batch}", partition_by)

    def merge(self, updates: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS,
              changes: DataFrame | None = None) -> list[int]:
        """Keyed merge of ``updates`` (one row a key) into a state table; an update older than
        the stored row is ignored (D16).  Only buckets with touched keys are read and
        rewritten; returns them (at most ``buckets`` numbers).

        ``changes``: rows with the keys of ``updates``, each as often as it likes (what they were
        reduced from), to find the touched buckets without that reduction.  A large bucket is
        written by several tasks, so work is spread whatever the number of buckets."""
        from tidemark.operators.silver import merge_upsert
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        updates = updates.withColumn("bucket", bucket)
        found = self.exists(name)
        if found:
            touched = self._buckets((updates if changes is None else changes).select(bucket.alias("bucket")))
            held = self.read(name).where(F.col("bucket").isin(touched))
            updates = merge_upsert(held, updates, keys, guarded=True)
        updates.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .option("compression", self.codec).partitionBy("bucket").parquet(self.path(name))
        if not found:  # all that is there has just been written
            touched = self._buckets(self.read(name)) if self.exists(name) else []
        return touched

    @staticmethod
    def _buckets(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select("bucket").distinct().collect())
