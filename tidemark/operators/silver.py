"""Silver: current state per key from the change log.

``change_rows`` picks the row image (after for INSERT/UPDATE/READ, before for
DELETE), parses it with the entity schema and adds lineage columns.
``latest_per_key`` keeps the newest change per key by the total order
(ts, lsn, offset); Catalyst plans ``row_number() = 1`` with a partial
``WindowGroupLimit`` before the shuffle, so a key with millions of changes
ships one row per map task.  ``merge_upsert`` is the keyed MERGE written as a
full outer join, for stores without MERGE INTO.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import decode_date, evaluate_once
from tidemark.model import (ENTITY_SCHEMAS, IMAGE_AFTER_OPS, PRIMARY_KEYS, REJECT_IMAGE,
                            business_columns)

ORDER_COLUMNS = ["_cdc_ts", "_cdc_lsn", "_cdc_offset"]
LINEAGE = ["_cdc_op", "_cdc_ts", "_cdc_lsn", "_cdc_offset"]
FLAGS = ["_is_deleted", "_deleted_at", "_silver_updated_at"]


def _wire_schema(table: str) -> T.StructType:
    """Entity schema as it is read off the wire: dates as text (D2) plus a
    corrupt-record column."""
    fields = []
    for f in ENTITY_SCHEMAS[table].fields:
        dt = T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType
        fields.append(T.StructField(f.name, dt, True))
    fields.append(T.StructField("_corrupt", T.StringType(), True))
    return T.StructType(fields)


def row_image() -> Column:
    """INSERT/UPDATE/READ read ``after``; anything else ``before``."""
    return (F.when(F.col("cdc_op").isin(IMAGE_AFTER_OPS), F.col("after_json"))
            .otherwise(F.col("before_json")))


def _parsed(bronze: DataFrame, table: str) -> DataFrame:
    schema = _wire_schema(table)
    img = F.from_json(row_image(), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return evaluate_once(bronze, img, "_img", bronze.columns)


def _image_valid(table: str) -> Column:
    pk_ok = None
    for k in PRIMARY_KEYS[table]:
        c = F.col(f"_img.{k}").isNotNull()
        pk_ok = c if pk_ok is None else (pk_ok & c)
    return F.col("_img").isNotNull() & F.col("_img._corrupt").isNull() & pk_ok


def image_key(image: Column, table: str) -> Column:
    """The key of a row image as text; null unless the image is a valid row of ``table``."""
    parsed = F.from_json(image, _wire_schema(table), {"columnNameOfCorruptRecord": "_corrupt"})

    def key(row):
        parts = [row[k].cast("string") for k in PRIMARY_KEYS[table]]
        return F.when(row["_corrupt"].isNull(), F.concat(*[x for k in parts for x in (k, F.lit(":"))]))
    return F.element_at(F.transform(F.array(parsed), key), 1)  # parsed once


def change_rows(bronze: DataFrame, table: str, run_ts: Column | None = None) -> DataFrame:
    """Valid change rows of ``table``: entity columns, lineage and soft-delete flags.

    Images that are not JSON, are empty or lack the key never reach the state (D3).
    """
    now = run_ts if run_ts is not None else F.current_timestamp()
    deleted = F.col("cdc_op") == "DELETE"
    cols = []
    for f in ENTITY_SCHEMAS[table].fields:
        c = F.col(f"_img.{f.name}")
        if isinstance(f.dataType, T.DateType):
            c = decode_date(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return (_parsed(bronze, table).filter(_image_valid(table)).select(
        *cols,
        F.col("cdc_op").alias("_cdc_op"),
        F.col("cdc_ts").alias("_cdc_ts"),
        F.col("cdc_lsn").alias("_cdc_lsn"),
        F.col("kafka_offset").alias("_cdc_offset"),
        deleted.alias("_is_deleted"),
        F.when(deleted, now.cast(T.TimestampType())).alias("_deleted_at"),
        now.cast(T.TimestampType()).alias("_silver_updated_at")))


def triage(decoded: DataFrame, table: str) -> DataFrame:
    """One pass over ``decode_all`` output: the envelope reject reason, else the
    image verdict for ``table`` (valid rows get ``reject_reason`` NULL)."""
    parsed = _parsed(decoded, table)
    image_bad = F.col("reject_reason").isNull() & ~_image_valid(table)
    return parsed.withColumn(
        "reject_reason",
        F.when(image_bad, F.lit(REJECT_IMAGE)).otherwise(F.col("reject_reason")))


def image_rejects(bronze: DataFrame, table: str) -> DataFrame:
    """Events of ``table`` whose image cannot become a row (quarantine, D3)."""
    return (_parsed(bronze, table).filter(~_image_valid(table))
            .select(F.lit(REJECT_IMAGE).alias("reject_reason"), "kafka_topic",
                    "kafka_partition", "kafka_offset", "cdc_op", "before_json", "after_json"))


def newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS]


def latest_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Newest change per key by (ts, lsn, offset)."""
    w = Window.partitionBy(*keys).orderBy(*newest_first())
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def state(bronze: DataFrame, table: str, run_ts: Column | None = None,
          delete_image: str = "before") -> DataFrame:
    """Silver snapshot of ``table`` from its change events.

    ``delete_image="before"`` keeps the columns of the DELETE's before image, as the
    change stream delivers them; ``"last_known"`` fills what that image lacks (a
    key-only before image) from the newest non-delete image of the key (D6).
    """
    keys = PRIMARY_KEYS[table]
    rows = change_rows(bronze, table, run_ts)
    latest = latest_per_key(rows, keys)
    if delete_image == "before":
        return latest
    if delete_image != "last_known":
        raise ValueError(f"delete_image must be 'before' or 'last_known', not {delete_image!r}")
    biz = [c for c in business_columns(table) if c not in keys]
    known = latest_per_key(rows.filter(~F.col("_is_deleted")), keys).select(
        *keys, *[F.col(c).alias(f"_lk_{c}") for c in biz])
    j = latest.join(known, keys, "left")
    return j.select(
        *keys,
        *[F.when(F.col("_is_deleted"), F.coalesce(F.col(c), F.col(f"_lk_{c}")))
          .otherwise(F.col(c)).alias(c) for c in biz],
        *LINEAGE, *FLAGS)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: list[str],
                 guarded: bool = False) -> DataFrame:
    """Keyed MERGE: a matched key takes every column from ``updates``, an unmatched
    update is inserted, untouched target rows stay (C3, C6, C8).

    ``guarded=True`` applies an update only when it is not older than the target row
    by (ts, lsn, offset), so a late batch cannot roll a key back (D16).
    ``updates`` must hold at most one row per key (see :func:`latest_per_key`).
    """
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in cols])
    s = updates.select(*[F.col(c).alias(f"s__{c}") for c in cols],
                       F.lit(True).alias("s__present"))
    cond = None
    for k in keys:
        c = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = c if cond is None else (cond & c)
    j = t.join(s, cond, "full_outer")
    take = F.col("s__present").isNotNull()
    if guarded:
        s_ord = F.struct(*[F.col(f"s__{c}") for c in ORDER_COLUMNS])
        t_ord = F.struct(*[F.col(f"t__{c}") for c in ORDER_COLUMNS])
        take = take & (F.col(f"t__{keys[0]}").isNull() | (s_ord >= t_ord))
    return j.select(*[F.when(take, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c)
                      for c in cols])


def live(silver: DataFrame) -> DataFrame:
    """Rows not soft-deleted."""
    return silver.filter(F.col("_is_deleted") == F.lit(False))


def build_silver(bronze: DataFrame, tables: list[str], run_ts: Column | None = None,
                 delete_image: str = "before") -> dict[str, DataFrame]:
    return {t: state(bronze.filter(F.col("cdc_table") == t), t, run_ts, delete_image)
            for t in tables}
