"""Batch jobs of the medallion flow over a store: bronze, silver, gold.

``run(layer, tables)`` walks a registry; every table is tried and the failures
are raised together at the end (D20), so one bad table neither hides the others
nor lets the job exit as if it succeeded.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import TABLES
from tidemark.operators.bronze import dedup_replays
from tidemark.operators.silver import state
from tidemark.plans import gold as G
from tidemark.sources.catalog import silver_rows
from tidemark.sources.store import Store
from tidemark.streaming.bronze_stream import QUARANTINE_SCHEMA, write_bronze_batch


log = logging.getLogger("tidemark.jobs")


class LayerErrors(RuntimeError):
    pass


def collect_errors(items, fn, parallel: int = 1) -> dict:
    """Run ``fn`` for every item; with ``parallel > 1`` the independent table jobs are
    submitted from that many driver threads, so small tables share the executors
    instead of running one after the other."""
    results, errors = {}, {}
    items = list(items)
    if parallel > 1 and len(items) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            futures = {name: pool.submit(fn, name) for name in items}
        for name, fut in futures.items():
            try:
                results[name] = fut.result()
            except Exception as e:  # noqa: BLE001 - reported below
                errors[name] = e
    else:
        for name in items:
            try:
                results[name] = fn(name)
            except Exception as e:  # noqa: BLE001 - reported below
                errors[name] = e
    if errors:
        raise LayerErrors("; ".join(f"{k}: {v}" for k, v in errors.items()))
    return results


def run_bronze(store: Store, records: DataFrame, batch: str | None = None,
               run_ts: Column | None = None,
               partition_by: list[str] | None = None) -> tuple[int, int]:
    """Batch ingest of one bounded chunk of records (a landed file set) as one batch of the
    log (valid events + quarantine); returns (events written, records quarantined).  Without
    ``batch`` it is appended under a new name; a given one is replaced.  Larger backlogs go
    through the stream, whose triggers bound each batch."""
    return write_bronze_batch(store, records, batch or f"run-{uuid.uuid4().hex}", partition_by, run_ts)


def read_bronze(store: Store, dedup: bool = False) -> DataFrame:
    b = store.read("bronze")
    return dedup_replays(b) if dedup else b


def run_silver(store: Store, tables: list[str] | None = None, run_ts: Column | None = None,
               delete_image: str = "before", parallel: int = 1, by_month: bool = False) -> dict:
    """Full rebuild of silver from the bronze log (C9); partition pruning on
    ``cdc_table`` makes each table read only its own events."""
    bronze = read_bronze(store)

    def one(t):
        s = state(bronze.filter(F.col("cdc_table") == t), t, run_ts, delete_image)
        layout = None
        if by_month:  # the layout of months(_cdc_ts) (S9)
            s, layout = silver_rows(s), ["event_month"]
        rows = store.write(s, f"silver/{t}", layout)
        log.info("silver %s: %s rows", t, rows)
        return rows

    return collect_errors(tables or TABLES, one, parallel)


def run_silver_incremental(store: Store, checkpoint: str) -> None:
    """Fold what is new in the bronze log into the silver state tables (C9, D15): the state
    stream over the log, run until it has seen everything that was there."""
    from tidemark.streaming.silver_stream import bronze_log_stream, start_state_stream
    q = start_state_stream(bronze_log_stream(store.spark, store), store, checkpoint, {"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_gold(store: Store, products: list[str] | None = None, parallel: int = 1) -> dict:
    silver = {t: store.read(f"silver/{t}") for t in TABLES if store.exists(f"silver/{t}")}
    bronze = read_bronze(store, dedup=True)

    def one(name):
        df = G.GOLD_BUILDERS[name](silver, lambda: bronze)
        part = G.GOLD_PARTITIONS.get(name)
        if part:
            # dealt by the partition column; AQE splits a hot year and joins thin ones
            df = df.hint("rebalance", F.col(part))
        rows = store.write(df, f"gold/{name}", [part] if part else None)
        log.info("gold %s: %s rows", name, rows)
        return rows

    return collect_errors(products or list(G.GOLD_BUILDERS), one, parallel)


def read_gold(store: Store) -> dict[str, DataFrame]:
    return {name: store.read(f"gold/{name}") for name in G.GOLD_BUILDERS}


def run(spark: SparkSession, store: Store, layer: str, tables: list[str] | None = None,
        records: DataFrame | None = None):
    if layer == "bronze":
        if records is None:
            raise ValueError("bronze needs records")
        return run_bronze(store, records)
    if layer == "silver":
        return run_silver(store, tables)
    if layer == "gold":
        return run_gold(store, tables)
    raise ValueError(f"unknown layer {layer!r}")


__all__ = ["LayerErrors", "QUARANTINE_SCHEMA", "read_bronze", "read_gold", "run",
           "run_bronze", "run_gold", "run_silver", "run_silver_incremental"]
