"""Bronze: decode Kafka-shaped change records into the append-only event log.

One pass computes the 13 bronze columns and a reject reason; valid rows and the
quarantine are two filters of the same projection.  Nothing here shuffles except
the optional replay dedup, which is keyed on the record's coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import evaluate_once, millis_to_ts, op_verb, topic_table
from tidemark.model import (BRONZE_COLUMNS, ENVELOPE_SCHEMA, OP_VERBS, REJECT_NOT_JSON,
                            REJECT_OP_NULL, REJECT_OP_UNKNOWN, REJECT_PAYLOAD_NULL,
                            REJECT_TABLE_NULL, REJECT_VALUE_NULL, topic_for)

COORDINATES = ["kafka_topic", "kafka_partition", "kafka_offset"]


def topic_filter(records: DataFrame, tables: list[str]) -> DataFrame:
    """Keep the records of the subscribed tables."""
    return records.filter(F.col("topic").isin([topic_for(t) for t in tables]))


def _parse(records: DataFrame) -> DataFrame:
    value = F.col("value").cast(T.StringType())
    env = F.from_json(F.col("_value"), ENVELOPE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt",
                                               "mode": "PERMISSIVE"})
    r = records.select("topic", "partition", "offset", "timestamp", value.alias("_value"))
    return evaluate_once(r, env, "_env", r.columns)


def _reject_reason() -> Column:
    p = F.col("_env.payload")
    op = p.getField("op")
    return (F.when(F.col("_value").isNull(), REJECT_VALUE_NULL)
            .when(F.col("_env._corrupt").isNotNull(), REJECT_NOT_JSON)
            .when(p.isNull(), REJECT_PAYLOAD_NULL)
            .when(op.isNull(), REJECT_OP_NULL)
            .when(~op.isin(list(OP_VERBS)), REJECT_OP_UNKNOWN)
            .when(p.getField("source").getField("table").isNull(), REJECT_TABLE_NULL))


def decode_all(records: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Bronze columns plus ``reject_reason`` (NULL for a valid change event)."""
    p = F.col("_env.payload")
    processed = run_ts if run_ts is not None else F.current_timestamp()
    return _parse(records).select(
        op_verb(p.getField("op")).alias("cdc_op"),
        p.getField("ts_ms").alias("cdc_ts_ms"),
        millis_to_ts(p.getField("ts_ms")).alias("cdc_ts"),
        p.getField("source").getField("db").alias("cdc_db"),
        p.getField("source").getField("table").alias("cdc_table"),
        p.getField("source").getField("lsn").alias("cdc_lsn"),
        p.getField("before").alias("before_json"),
        p.getField("after").alias("after_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast(T.IntegerType()).alias("kafka_partition"),
        F.col("offset").cast(T.LongType()).alias("kafka_offset"),
        F.col("timestamp").cast(T.TimestampType()).alias("kafka_ts"),
        processed.cast(T.TimestampType()).alias("processed_at"),
        _reject_reason().alias("reject_reason"),
        # the raw text is kept for rejects only; valid rows carry it in their images
        F.when(_reject_reason().isNotNull(), F.col("_value")).alias("raw_value"))


def decode(records: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Valid change events in the 13-column bronze layout."""
    return (decode_all(records, run_ts).filter(F.col("reject_reason").isNull())
            .select(*BRONZE_COLUMNS))


def quarantine(records: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Records that are not valid change events, with the reason."""
    return (decode_all(records, run_ts).filter(F.col("reject_reason").isNotNull())
            .select("reject_reason", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_ts", "raw_value", "processed_at"))


def dedup_replays(bronze: DataFrame) -> DataFrame:
    """At-least-once delivery repeats a record at the same coordinates (D7): keep one.

    A hash aggregate on (topic, partition, offset); partial aggregation runs before
    the shuffle, so a record repeated many times costs one row per map task.
    """
    return bronze.dropDuplicates(COORDINATES)


def table_of(bronze: DataFrame) -> Column:
    """Table of an event: the source block, else the topic name."""
    return F.coalesce(F.col("cdc_table"), topic_table(F.col("kafka_topic")))


def route(bronze: DataFrame, table: str) -> DataFrame:
    """Events of one table (P11); on a table partitioned by ``cdc_table`` this is a
    partition filter."""
    return bronze.filter(F.col("cdc_table") == table)


def with_storage_columns(bronze: DataFrame) -> DataFrame:
    """Partition columns for the bronze store: event day (days(cdc_ts) of S8) and
    event month, for logs too thin to fill a file per table and day."""
    return (bronze.withColumn("event_day", F.to_date("cdc_ts"))
            .withColumn("event_month", F.trunc("cdc_ts", "month")))


def clustered_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Range-partition on the layout columns, then the offset, before a partitioned
    write: each task covers a contiguous run of partition values, so files are few
    and large, and a partition value with a third of the rows spans several tasks
    instead of one (the offset splits it)."""
    return df.repartitionByRange(*partition_by, *COORDINATES)
