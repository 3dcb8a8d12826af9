"""Data model: entity schemas, keys, envelope, bronze/silver layouts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Fixed values (wire contract): entity schemas of the six source tables.  Keys are int64
# because the driver's tables use int64 identifiers; a line's key is its order and its number
# in the order.
ENTITY_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("stock_qty", T.IntegerType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("total_amount", MONEY),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_id", T.LongType(), False),
        T.StructField("line_no", T.LongType(), False),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", MONEY),
        T.StructField("subtotal", MONEY),
        T.StructField("created_at", T.TimestampType()),
    ]),
    "payments": T.StructType([
        T.StructField("payment_id", T.LongType(), False),
        T.StructField("order_id", T.LongType()),
        T.StructField("payment_date", T.TimestampType()),
        T.StructField("method", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]),
    "returns": T.StructType([
        T.StructField("return_id", T.LongType(), False),
        T.StructField("order_id", T.LongType()),
        T.StructField("return_date", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("refund_amount", MONEY),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]),
}

TABLES = list(ENTITY_SCHEMAS)

# Fixed values (wire contract): primary keys.
PRIMARY_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "line_no"],
    "payments": ["payment_id"],
    "returns": ["return_id"],
}

# Foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("returns", "order_id", "orders", "order_id"),
]

# NOT NULL columns other than the keys (source DDL).
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "customers": ["name"],
    "products": ["name", "price"],
    "orders": ["customer_id"],
    "order_items": ["product_id", "quantity", "unit_price"],
    "payments": ["order_id", "amount"],
    "returns": ["order_id"],
}

# Change-capture naming and op codes.
TOPIC_PREFIX = "cdc"
SOURCE_SCHEMA = "public"
SOURCE_DB = "retail"
OP_VERBS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "READ"}
IMAGE_AFTER_OPS = ["INSERT", "UPDATE", "READ"]

# Order status lifecycle (pending -> confirmed -> shipped -> delivered,
# cancellation only from pending).
NEXT_STATUS = {"pending": "confirmed", "confirmed": "shipped", "shipped": "delivered"}
CANCELLABLE_FROM = ["pending"]


def topic_for(table: str) -> str:
    return f"{TOPIC_PREFIX}.{SOURCE_SCHEMA}.{table}"


# Kafka record contract (columns of a Kafka source DataFrame we rely on).
KAFKA_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

# Fixed values (wire contract): change envelope inside ``value``; row images stay raw JSON text so one schema
# serves every table.  ``_corrupt`` catches text that is not JSON at all.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([
            T.StructField("db", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("lsn", T.LongType()),
        ])),
    ])),
    T.StructField("_corrupt", T.StringType()),
])

# Fixed values (wire contract): bronze columns.
BRONZE_COLUMNS = [
    "cdc_op", "cdc_ts_ms", "cdc_ts", "cdc_db", "cdc_table", "cdc_lsn",
    "before_json", "after_json", "kafka_topic", "kafka_partition", "kafka_offset",
    "kafka_ts", "processed_at",
]

SILVER_META = ["_cdc_op", "_cdc_ts", "_cdc_lsn", "_cdc_offset", "_is_deleted",
               "_deleted_at", "_silver_updated_at"]

# Quarantine reasons.
REJECT_VALUE_NULL = "value_null"
REJECT_NOT_JSON = "not_json"
REJECT_PAYLOAD_NULL = "payload_null"
REJECT_OP_NULL = "op_null"
REJECT_OP_UNKNOWN = "op_unknown"
REJECT_TABLE_NULL = "table_null"
REJECT_IMAGE = "image_invalid"


def business_columns(table: str) -> list[str]:
    return [f.name for f in ENTITY_SCHEMAS[table].fields]
