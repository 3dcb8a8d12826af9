"""Streaming audit: daily windows per table and operation, late events counted apart.

A day of events is published once, when the stream's watermark has passed its end by the
allowed ``lateness``; an event that comes after that is published at once, marked late, so
each event is counted exactly once and none is dropped.  The watermark runs on arrival (the
micro-batch's clock), which only grows: Spark drops no row as late, and a window closes by
the clock, whatever times the events carry.  Windows are kept by (table, operation, day, salt),
so that a day with a third of all events is spread over tasks; ``audit`` sums the parts.  Each
task sums its own events first, so the processor gets rows by windows and tasks, not by events.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.columns import ratio
from tidemark.streaming.state_store import use_rocksdb

SALTS = 16
OUTPUT = ("source_table string, operation string, event_day date, late boolean, event_count long, "
          "whole_ms long, exact_ms long, last_ms long")
_KEY = ["source_table", "operation", "event_day", "salt"]


class DayWindows(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n long, whole_ms long, exact_ms long, last_ms long")

    def _row(self, key, late, sums) -> Row:
        return Row(source_table=key[0], operation=key[1], event_day=key[2], late=late, event_count=sums[0],
                   whole_ms=sums[1], exact_ms=sums[2], last_ms=sums[3])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = whole = exact = 0
        last = closes = None
        for r in rows:  # one at a time, whatever their number
            n, whole, exact, closes = n + r.n, whole + r.whole_ms, exact + r.exact_ms, r.closes_ms
            last = r.last_ms if last is None or r.last_ms > last else last
        if closes <= timerValues.getCurrentWatermarkInMs():
            return iter((self._row(key, True, (n, whole, exact, last)),))
        held = self.sums.get()
        if held is None:
            self.handle.registerTimer(closes)
        else:
            n, whole, exact, last = n + held[0], whole + held[1], exact + held[2], max(last, held[3])
        self.sums.update((n, whole, exact, last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.sums.get()
        self.sums.clear()
        return iter((self._row(key, False, held),))

    def close(self) -> None:
        pass


_PARTS = "source_table string, operation string, event_day date, salt int, closes_ms long, n long, whole_ms long, exact_ms long, last_ms long"
_WINDOW, _SUMS = [*_KEY, "closes_ms"], ["n", "whole_ms", "exact_ms", "last_ms"]
_AT_ONCE = 1 << 18  # rows that a task holds between two sums


def _summed(held: list[pa.Table]) -> pa.Table:
    # a null is summed to null, not left out
    strict = pc.ScalarAggregateOptions(skip_nulls=False)
    out = pa.concat_tables(held).group_by(_WINDOW, use_threads=False).aggregate(
        [(c, "max" if c == "last_ms" else "sum", strict) for c in _SUMS])
    return out.select([*_WINDOW, *(f"{c}_{'max' if c == 'last_ms' else 'sum'}" for c in _SUMS)]).rename_columns([*_WINDOW, *_SUMS])


def partial_sums(batches):
    """A task's events summed by window; sums that have grown past ``_AT_ONCE`` windows are sent on."""
    held, rows = [], 0
    for batch in batches:
        # by names alone: a column that Spark marks as never null would not go with its sums
        held.append(pa.Table.from_arrays(batch.columns, names=batch.schema.names))
        rows += batch.num_rows
        if rows >= _AT_ONCE:
            held = [_summed(held)]
            rows = held[0].num_rows
            if rows >= _AT_ONCE // 2:
                yield from held[0].combine_chunks().to_batches(10_000)
                held, rows = [], 0
    if held:
        yield from _summed(held).combine_chunks().to_batches(10_000)


def audit_events(bronze: DataFrame, lateness: str = "1 day", delay: str = "0 seconds") -> DataFrame:
    """Published windows and late counts of a stream of bronze rows (append mode)."""
    use_rocksdb(bronze.sparkSession)
    # the process that plans a stateful processor does not see the session's archives
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    day = F.to_date("cdc_ts")
    closes = F.date_add(day, 1).cast("timestamp") + F.expr(f"INTERVAL {lateness}")
    rows = bronze.select(
        F.col("cdc_table").alias("source_table"), F.col("cdc_op").alias("operation"), day.alias("event_day"),
        F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(SALTS)).cast("int").alias("salt"),
        F.unix_millis(closes).alias("closes_ms"), F.lit(1).cast("long").alias("n"),
        (F.unix_seconds("kafka_ts") * 1000 - F.col("cdc_ts_ms")).alias("whole_ms"),
        (F.unix_millis("kafka_ts") - F.col("cdc_ts_ms")).alias("exact_ms"), F.col("cdc_ts_ms").alias("last_ms"))
    parts = rows.mapInArrow(partial_sums, _PARTS).withColumn("arrival", F.current_timestamp()).withWatermark("arrival", delay)
    return parts.groupBy(*_KEY).transformWithState(
        DayWindows(), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")


def audit(published: DataFrame) -> DataFrame:
    """The audit product from published windows and late counts, with how many were late."""
    return published.groupBy("source_table", "operation", "event_day").agg(
        F.sum("event_count").alias("event_count"),
        (ratio(F.sum("whole_ms"), F.sum("event_count")) / 1000.0).alias("avg_latency_seconds"),
        ratio(F.sum("exact_ms"), F.sum("event_count")).alias("avg_latency_ms"),
        F.sum("exact_ms").alias("latency_ms_total"), F.timestamp_millis(F.max("last_ms")).alias("last_event_ts"),
        F.coalesce(F.sum(F.when(F.col("late"), F.col("event_count"))), F.lit(0)).alias("n_late"))
