"""Row images as VARIANT: one parse per record, typed extraction per entity, extra fields kept.

``decode`` parses each record once, into a VARIANT that holds the whole envelope; the bronze
columns and the row image are taken out of it together.  ``rows`` takes an entity's columns out of the
image by type; a field that is missing or of another type gives null, and fields that the
entity does not know stay readable in ``extra`` instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import decode_date, evaluate_once, millis_to_ts, op_verb
from tidemark.model import ENTITY_SCHEMAS, IMAGE_AFTER_OPS, OP_VERBS, PRIMARY_KEYS


# what decoding takes out of an envelope, in one walk through its payload
_PAYLOAD = "struct<op: string, ts_ms: bigint, source: struct<table: string, lsn: bigint>, before: variant, after: variant>"


def decode(records: DataFrame) -> DataFrame:
    """Valid change events: operation, table, log position, time, coordinates, and the row
    image as VARIANT."""
    payload = F.try_variant_get(F.try_parse_json("value"), "$.payload", _PAYLOAD)
    parsed = evaluate_once(records, payload, "_payload", ["topic", "partition", "offset", "timestamp"])
    at = F.col("_payload")
    op, source = at["op"], at["source"]
    verb = op_verb(op)
    image = F.when(verb.isin(IMAGE_AFTER_OPS), at["after"]).otherwise(at["before"])
    return parsed.where(op.isin(list(OP_VERBS)) & source["table"].isNotNull()).select(
        verb.alias("cdc_op"), source["table"].alias("cdc_table"), source["lsn"].alias("cdc_lsn"),
        millis_to_ts(at["ts_ms"]).alias("cdc_ts"), F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), image.alias("image"))


def _field(field: T.StructField) -> Column:
    path = f"$.{field.name}"
    if isinstance(field.dataType, T.DateType):  # epoch days or text (D2)
        return decode_date(F.try_variant_get("image", path, "string"))
    if isinstance(field.dataType, T.TimestampType):
        return F.try_variant_get("image", path, "string").try_cast(T.TimestampType())
    return F.try_variant_get("image", path, field.dataType.simpleString())


def rows(events: DataFrame, table: str) -> DataFrame:
    """An entity's change rows from the events' images, with what else the images hold."""
    schema = ENTITY_SCHEMAS[table]
    known = [f.name for f in schema]
    # object fields the schema does not name, as text; anything but an object has none.  Few
    # images have any, so the text is made for those alone
    fields = F.try_variant_get("image", "$", "map<string, variant>")
    text = F.from_json(F.to_json("image"), "map<string,string>")
    extra = F.when(F.forall(F.map_keys(fields), lambda k: k.isin(known)), F.create_map().cast("map<string,string>")) \
        .otherwise(F.map_filter(text, lambda k, v: ~k.isin(known)))
    out = events.where(F.col("cdc_table") == table).select(
        *[_field(f).alias(f.name) for f in schema], F.col("cdc_op").alias("_cdc_op"), F.col("cdc_ts").alias("_cdc_ts"),
        F.col("cdc_lsn").alias("_cdc_lsn"), F.col("kafka_offset").alias("_cdc_offset"),
        (F.col("cdc_op") == "DELETE").alias("_is_deleted"), extra.alias("extra"))
    for k in PRIMARY_KEYS[table]:
        out = out.where(F.col(k).isNotNull())
    return out
