"""Landed change records as an offset-addressed stream source.

``land`` writes records as Parquet chunks, one directory per (topic, partition, chunk), and
an index of them: every record of a (topic, partition) gets the next offset, as a broker
would number it.  Offsets are positions, so a chunk is known by its first offset and its
count, and numbering moves no data: the index, one row a chunk, is all that is summed up.

``OffsetRecords`` is a Spark data source over that folder (format ``landed_records``) with a
stream reader whose offsets are ``{"topic/partition": next offset}``:

* ``maxOffsetsPerTrigger``: offsets admitted in a micro-batch, shared among the partitions in
  proportion to what each has left, as the Kafka source does;
* ``startingOffsets``: ``earliest``, ``latest`` or JSON of such a dictionary;
* ``failOnDataLoss`` (default true): a chunk that is gone, or holds other records than the
  index says, is an error; when false what is left is read;
* ``progress``: folder in which each admitted end is noted before it is given out.  Spark does
  not tell a Python source where a restarted query stands, and admission needs it.  If the
  query dies between that note and its own log, the next batch is larger, never wrong.

Planning reads the index only; records are read by the executors, chunk by chunk, each task
from the Parquet files of its own offset range.  Paths may be local, or any that pyarrow's
file systems open (hdfs, s3, gs).
"""

from __future__ import annotations

import json
import sys
import time
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.store import free

SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"
FORMAT = "landed_records"
# bytes of a row group in a chunk: rows lie in order, so a task opens those of its own offset range
ROW_GROUP = 1 << 20
KEPT_NOTES = 10  # of the progress folder, so that listing it costs the same at every trigger
_ROW = (1 << 33) - 1  # the part of monotonically_increasing_id() that counts rows of a task


def land(records: DataFrame, root: str) -> None:
    """Appends records to the landing folder, in order of time within each partition."""
    spark = records.sparkSession
    run = uuid.uuid4().hex
    order = ["topic", "partition", "timestamp", "offset"]
    rows = records.select("topic", "partition", "offset", "timestamp", "value") \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("topic", "partition", F.spark_partition_id().alias("chunk"),
                       F.monotonically_increasing_id().bitwiseAND(_ROW).alias("row"), "timestamp", "value")
    chunks = f"{root}/records/{run}"
    rows.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP) \
        .partitionBy("topic", "partition", "chunk").parquet(chunks)
    free(spark)
    # the rows of a (topic, partition) in a task follow one another
    stored = spark.read.schema("row long, topic string, partition int, chunk int").parquet(chunks) \
        .groupBy("topic", "partition", "chunk").agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
    before = Window.partitionBy("topic", "partition").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = _ends(spark, root)
    indexed = stored.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    if ends is not None:
        indexed = indexed.join(ends, ["topic", "partition"], "left")
    else:
        indexed = indexed.withColumn("_end", F.lit(0))
    indexed.select("topic", "partition", (F.col("_before") + F.coalesce("_end", F.lit(0))).alias("start"),
                   "n", "first_row", F.lit(run).alias("run"), "chunk") \
        .coalesce(1).write.parquet(f"{root}/index/{run}")


def _ends(spark: SparkSession, root: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/index")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/index") \
        .groupBy("topic", "partition").agg(F.max(F.col("start") + F.col("n")).alias("_end"))


def stream(spark: SparkSession, root: str, progress: str, topics: list[str] | None = None,
           max_offsets_per_trigger: int | None = None, starting_offsets: str = "earliest",
           fail_on_data_loss: bool = True) -> DataFrame:
    """The landed records as a stream with the columns of a Kafka source."""
    # the process on the driver that plans a Python source does not see the session's archives
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(OffsetRecords)
    r = spark.readStream.format(FORMAT).option("path", root).option("progress", progress) \
        .option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower())
    if topics:
        r = r.option("subscribe", ",".join(topics))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def run_to_end(query, root: str, progress: str, topics: list[str] | None = None) -> None:
    """Waits until a query over :func:`stream` has worked off all that is landed, and stops it."""
    low = {"path": root, "progress": progress} | ({"subscribe": ",".join(topics)} if topics else {})
    reader = OffsetReader(low)
    ends = {k: rows[-1]["start"] + rows[-1]["n"] for k, rows in reader._index().items()}
    try:
        while True:
            query.processAllAvailable()
            noted = reader._noted() or {}
            if all(noted.get(k, 0) >= v for k, v in ends.items()) or not query.isActive:
                break
        # the last batch and, after it, those without data that only move timers on
        quiet = 0
        while quiet < 8 and query.isActive:
            now = query.status["message"]
            quiet = 0 if now.startswith(("Processing new data", "No new data but")) else quiet + ("Waiting" in now)
            time.sleep(0.05)
    finally:
        query.stop()


class OffsetRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> OffsetReader:
        return OffsetReader(dict(self.options))


class Chunk(InputPartition):
    """Offsets [start, end) of one chunk; ``skip``: the same by its row numbers."""

    def __init__(self, topic, partition, start, end, first_row, path):
        self.topic, self.partition, self.start, self.end = topic, partition, start, end
        self.first_row, self.path = first_row, path


def _files(uri: str):
    """(file system, path) of a Spark path."""
    from pyarrow import fs
    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    path = uri.removeprefix("file:")
    return fs.LocalFileSystem(), "/" + path.lstrip("/")


class OffsetReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        # Spark hands option names over in lower case
        low = {k.lower(): v for k, v in options.items()}
        self.root = low["path"].rstrip("/")
        self.progress = low["progress"].rstrip("/")
        self.topics = set(low["subscribe"].split(",")) if "subscribe" in low else None
        self.starting = low.get("startingoffsets", "earliest")
        self.limit = int(low["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in low else None
        self.strict = low.get("failondataloss", "true") != "false"
        self._read: tuple[list[str], dict[str, list[dict]]] = ([], {})  # index files and what they hold

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_read": ([], {})}  # tasks need no index

    def _index(self) -> dict[str, list[dict]]:
        """Chunks of each topic/partition by offset."""
        import pyarrow.parquet as pq
        from pyarrow import fs
        files, path = _files(f"{self.root}/index")
        found = sorted(f.path for f in files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
                       if f.path.endswith(".parquet"))
        if found == self._read[0]:  # an index file never changes, a landing adds one
            return self._read[1]
        out: dict[str, list[dict]] = {}
        for f in found:
            for row in pq.read_table(f, filesystem=files).to_pylist():
                if self.topics is None or row["topic"] in self.topics:
                    out.setdefault(f"{row['topic']}/{row['partition']}", []).append(row)
        for rows in out.values():
            rows.sort(key=lambda r: r["start"])
        self._read = (found, out)
        return out

    def _there(self, row: dict) -> bool:
        from pyarrow import fs
        files, path = _files(self._folder(row))
        return files.get_file_info(path).type == fs.FileType.Directory

    def _folder(self, row: dict) -> str:
        return f"{self.root}/records/{row['run']}/topic={row['topic']}/partition={row['partition']}/chunk={row['chunk']}"

    def _noted(self) -> dict | None:
        """The end given out last."""
        from pyarrow import fs
        files, path = _files(self.progress)
        found = [f for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".json")]
        if not found:
            return None
        with files.open_input_stream(max(found, key=lambda f: f.base_name).path) as f:
            return json.loads(f.read())

    def _note(self, end: dict) -> None:
        from pyarrow import fs
        files, path = _files(self.progress)
        files.create_dir(path, recursive=True)
        held = [f.base_name for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True))]
        n = 1 + max((int(x.removesuffix(".json")) for x in held if x.endswith(".json")), default=-1)
        with files.open_output_stream(f"{path}/{n:012d}.json") as f:
            f.write(json.dumps(end).encode())
        for x in sorted(x for x in held if x.endswith(".json"))[:-KEPT_NOTES]:  # only the last is read
            files.delete_file(f"{path}/{x}")

    def initialOffset(self) -> dict:
        index = self._index()
        if self.starting == "latest":
            first = {k: rows[-1]["start"] + rows[-1]["n"] for k, rows in index.items()}
        else:
            first = {}
            for k, rows in index.items():
                # an explicit start, or the first record that is still there
                here = [r["start"] for r in rows if self._there(r)]
                first[k] = here[0] if here else rows[-1]["start"] + rows[-1]["n"]
            if self.starting != "earliest":
                first |= {k: int(v) for k, v in json.loads(self.starting).items()}
        self._note(first)
        return first

    def latestOffset(self) -> dict:
        index = self._index()
        begin = self._noted()
        if begin is None:
            begin = self.initialOffset()
        last = {k: max(rows[-1]["start"] + rows[-1]["n"], begin.get(k, 0)) for k, rows in index.items()}
        last = begin | last
        left = {k: v - begin.get(k, 0) for k, v in last.items()}
        total = sum(left.values())
        if self.limit is not None and total > self.limit:
            share = {k: v * self.limit // total for k, v in left.items()}
            if not any(share.values()):
                share[max(left, key=left.get)] = self.limit
            last = {k: begin.get(k, 0) + share[k] for k in last}
        if last != begin:
            self._note(last)
        return last

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        out = []
        index = self._index()
        for k, upto in end.items():
            since = start.get(k, 0)
            if upto < since:
                raise RuntimeError(f"{k}: admitted end {upto} lies before {since}; the folder {self.progress} "
                                   "does not belong to this query's checkpoint")
            at = since
            for row in index.get(k, []):
                a, b = max(since, row["start"]), min(upto, row["start"] + row["n"])
                if a >= b:
                    continue
                if a > at:
                    self._lost(f"{k}: no record of offsets {at} to {a - 1}")
                at = b
                if self._there(row):
                    shift = row["first_row"] - row["start"]
                    out.append(Chunk(row["topic"], row["partition"], a, b, shift, self._folder(row)))
                else:
                    self._lost(f"{k}: offsets {a} to {b - 1} are no longer in {self._folder(row)}")
            if at < upto:
                self._lost(f"{k}: no record of offsets {at} to {upto - 1}")
        return out or [Chunk("", 0, 0, 0, 0, "")]

    def _lost(self, what: str) -> None:
        if self.strict:
            raise RuntimeError(f"records lost: {what} (failOnDataLoss=false reads what is left)")

    def read(self, partition: Chunk):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        if partition.start == partition.end:
            return
        files, path = _files(partition.path)
        low, high = partition.start + partition.first_row, partition.end + partition.first_row
        rows = ds.dataset(path, filesystem=files, format="parquet")
        found = 0
        for batch in rows.to_batches(columns=["row", "timestamp", "value"],
                                     filter=(pc.field("row") >= low) & (pc.field("row") < high), batch_size=8192):
            n = batch.num_rows
            if not n:
                continue
            found += n
            yield pa.RecordBatch.from_arrays([
                pa.array([partition.topic] * n, pa.string()), pa.array([partition.partition] * n, pa.int32()),
                pc.subtract(batch.column("row"), pa.scalar(partition.first_row, pa.int64())),
                batch.column("timestamp").cast(pa.timestamp("us", "UTC")), batch.column("value").cast(pa.string())],
                ["topic", "partition", "offset", "timestamp", "value"])
        if found != partition.end - partition.start:
            self._lost(f"{partition.path} holds {found} of {partition.end - partition.start} records")

    def commit(self, end: dict) -> None:
        pass
