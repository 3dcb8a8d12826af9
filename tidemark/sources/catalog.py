"""Catalog path: namespaces and tables in the session catalog (S4, S5, S8, S9,
S13, S15).

Tables are Parquet data-source tables with explicit DDL; the silver DDL is
generated from the entity schema.  The built-in catalog has no hidden partition
transforms, so the layouts use derived columns (``event_day`` for days(cdc_ts),
``event_month`` for months(_cdc_ts)).  Appends go through ``insertInto`` (partition
columns last, by position), so a table is a stable, discoverable name instead of
a path.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ENTITY_SCHEMAS

BRONZE_DDL_COLUMNS = """
    cdc_op STRING, cdc_ts_ms BIGINT, cdc_ts TIMESTAMP, cdc_db STRING, cdc_lsn BIGINT,
    before_json STRING, after_json STRING, kafka_topic STRING, kafka_partition INT,
    kafka_offset BIGINT, kafka_ts TIMESTAMP, processed_at TIMESTAMP,
    cdc_table STRING, event_day DATE"""

SILVER_META_DDL = """
    _cdc_op STRING, _cdc_ts TIMESTAMP, _cdc_lsn BIGINT, _cdc_offset BIGINT, _is_deleted BOOLEAN,
    _deleted_at TIMESTAMP, _silver_updated_at TIMESTAMP, event_month DATE"""


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _location(location: str | None) -> str:
    return f"LOCATION '{location}'" if location else ""


def bronze_ddl(table: str, location: str | None = None,
               partition_by: tuple[str, ...] = ("cdc_table", "event_day")) -> str:
    """Bronze DDL; the default layout is table then day.  Partition columns go last in
    the column list so that positional appends line up."""
    cols = [c.strip() for c in BRONZE_DDL_COLUMNS.split(",")]
    names = [c.split()[0] for c in cols]
    ordered = ([c for c, n in zip(cols, names) if n not in partition_by]
               + [cols[names.index(p)] for p in partition_by])
    return (f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(ordered)}) USING parquet "
            f"PARTITIONED BY ({', '.join(partition_by)}) {_location(location)} "
            f"OPTIONS ('compression' = 'snappy')")


def silver_ddl(entity: str, table: str, location: str | None = None) -> str:
    """Parquet table of an entity's fields and the silver columns, by month of the change."""
    own = T.StructType([T.StructField(f.name, f.dataType) for f in ENTITY_SCHEMAS[entity]]).toDDL()
    return (f"CREATE TABLE IF NOT EXISTS {table} ({own}, {SILVER_META_DDL}) USING parquet {_location(location)} "
            f"PARTITIONED BY (event_month) OPTIONS ('compression' = 'snappy')")


def ensure_table(spark: SparkSession, ddl: str) -> None:
    spark.sql(ddl)


def table_exists(spark: SparkSession, table: str) -> bool:
    """Metadata-only availability probe."""
    return spark.catalog.tableExists(table)


def append(df: DataFrame, table: str) -> None:
    """Append by position in the table's column order."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table)


def bronze_rows(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_day", F.to_date("cdc_ts"))


def silver_rows(silver: DataFrame) -> DataFrame:
    return silver.withColumn("event_month", F.trunc("_cdc_ts", "month"))


def merge_into_table(updates: DataFrame, target: str, keys: list[str], guarded: bool = True,
                     order: tuple[str, ...] = ("_cdc_ts", "_cdc_lsn", "_cdc_offset")) -> None:
    """Keyed merge (C3, C4) into a table of a MERGE-capable V2 catalog: rows of known keys
    are updated, the others inserted.  ``guarded``: an update older than the stored row
    (by ``order``) leaves it alone (D16).  Stores without MERGE (plain Parquet) use
    ``Store.merge``; Spark rejects them here."""
    held = target.rsplit(".", 1)[-1]
    same_key = functools.reduce(lambda x, y: x & y, (F.col(f"{held}.{k}") == F.col(f"news.{k}") for k in keys))
    newer = F.struct(*(F.col(f"news.{c}") for c in order)) >= F.struct(*(F.col(f"{held}.{c}") for c in order))
    merge = updates.select(*updates.sparkSession.table(target).columns).alias("news").mergeInto(target, same_key)
    merge = (merge.whenMatched(newer) if guarded else merge.whenMatched()).updateAll()
    merge.whenNotMatched().insertAll().merge()
