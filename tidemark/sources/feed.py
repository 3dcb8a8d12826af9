"""Change feeds: relational change logs and their Kafka-shaped envelope records.

A *feed* is a relational change log: entity columns plus ``op`` (c/u/d/r),
``event_ts``, ``lsn``, ``kafka_partition``, ``kafka_offset`` and ``latency_s``.  ``to_records``
serialises a feed into the records a Kafka source yields (topic, partition,
offset, timestamp, value) with the JSON change envelope in ``value``; everything
is a row-local projection, so it scales with the partitions of the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import encode_date, encode_ts, ts_to_millis
from tidemark.model import (ENTITY_SCHEMAS, PRIMARY_KEYS, REJECT_IMAGE, REJECT_NOT_JSON, REJECT_OP_NULL,
                            REJECT_OP_UNKNOWN, REJECT_PAYLOAD_NULL, REJECT_TABLE_NULL, REJECT_VALUE_NULL,
                            SOURCE_DB, business_columns, topic_for)

FEED_META = ["op", "event_ts", "lsn", "kafka_partition", "kafka_offset", "latency_s"]

# Fixed value: time stamped on snapshot READ events that have no time of their own.
SNAPSHOT_TS = "1995-01-01 00:00:00"


class Changes:
    """Fixed rules that turn a table's rows into its change log: which rows are updated and
    deleted after their first event, when, and how the images differ.

    ``first`` / ``later``: columns that the first event's, or the update's and delete's, image
    shows otherwise than the row.  All of it is row-local.
    """

    def __init__(self, at, number, first_op="c", updated=None, deleted=None, update_at=None,
                 first=None, later=None):
        self.at, self.number, self.first_op = at, number, first_op
        self.updated, self.deleted, self.update_at = updated, deleted, update_at
        self.first, self.later = first or {}, later or {}


def _when(condition, value, otherwise: str):
    return F.when(condition, value).otherwise(F.col(otherwise))


def _changes(table: str) -> Changes:
    key = F.col(PRIMARY_KEYS[table][0])
    if table == "order_items":
        key = F.col("order_id") + F.col("line_no")
    every = lambda n: key % n == 0
    start = F.lit(SNAPSHOT_TS).cast(T.TimestampNTZType())
    if table == "customers":
        return Changes(F.col("registration_date").cast(T.TimestampNTZType()), key, F.lit("r"), every(4), every(9),
                       first={"segment": _when(every(4), "NEW", "segment")},
                       later={"name": F.when(~every(16), F.col("name"))})
    if table == "products":
        return Changes(start, key, F.lit("r"), every(5), every(11), first={"stock_qty": _when(every(5), 0, "stock_qty")})
    if table == "orders":
        early = F.col("order_date") < F.lit("1996-01-01 00:00:00").cast(T.TimestampNTZType())
        pending = F.col("status") == "pending"
        # an update in the insert's own millisecond: only the log position decides
        return Changes(F.col("order_date"), key, F.when(early, "r").otherwise("c"), ~pending, pending & every(7),
                       update_at=F.when(every(11), F.col("order_date")).otherwise(F.col("order_date") + F.expr("INTERVAL 1 DAY")),
                       first={"status": F.lit("pending")})
    if table == "order_items":
        return Changes(start, key, F.lit("c"), every(7), every(17),
                       first={"quantity": _when(every(7), 1, "quantity"), "subtotal": _when(every(7), F.col("unit_price"), "subtotal")},
                       later={"subtotal": _when(every(21), (F.col("subtotal") + 1).cast(T.DecimalType(12, 2)), "subtotal")})
    if table == "payments":
        return Changes(F.col("payment_date"), key, F.lit("c"), every(3), every(23),
                       first={"status": _when(every(3), "pending", "status"), "amount": F.when(~every(14), F.col("amount"))})
    return Changes(F.col("return_date"), key, F.lit("c"), every(4), every(19),
                   later={"status": _when(every(4), "approved", "status"),
                          "refund_amount": _when(every(8), (F.col("refund_amount") + 1).cast(T.DecimalType(12, 2)), "refund_amount")})


_LINES = 1 << 23  # line numbers in one partition of the order_items topic


def _coordinates(table: str, event: Column) -> tuple[Column, Column, Column]:
    """(lsn, partition, offset) of an event of a row; unique for every row, whatever its key:
    an order's lines beyond 2^23 go to further partitions."""
    if table == "order_items":
        lsn = F.col("order_id") * 10 + event
        offset = F.col("order_id") * _LINES + F.col("line_no") % _LINES
        return lsn, F.floor(F.col("line_no") / _LINES) * 3 + event, offset
    key = F.col(PRIMARY_KEYS[table][0])
    lsn = key * 10 + event
    return lsn, F.pmod(key, F.lit(3)), lsn


def change_log(rows: DataFrame, table: str) -> DataFrame:
    """Change log of a table's rows: a first event each, updates and deletes by rule."""
    rule = _changes(table)
    event = F.col("_event")
    if table == "order_items":  # numbered lines: one pass
        out = rows.select("*", F.explode(F.array_compact(F.array(
            F.lit(0), F.when(rule.updated, 1), F.when(rule.deleted, 2)))).alias("_event"))
    else:  # a branch an event, whose condition reaches the scan
        out = rows.withColumn("_event", F.lit(0)).unionByName(rows.where(rule.updated).withColumn("_event", F.lit(1))) \
            .unionByName(rows.where(rule.deleted).withColumn("_event", F.lit(2)))
    cols = []
    for c in rows.columns:
        if c in business_columns(table):
            col = F.when(event == 0, rule.first[c]).otherwise(F.col(c)) if c in rule.first else F.col(c)
            if c in rule.later:
                col = F.when(event > 0, rule.later[c]).otherwise(col)
            cols.append(col.cast(rows.schema[c].dataType).alias(c))
    updated = rule.update_at if rule.update_at is not None else rule.at + F.expr("INTERVAL 1 DAY")
    lsn, partition, offset = _coordinates(table, event)
    return out.select(
        *cols, F.when(event == 0, rule.first_op).when(event == 1, "u").otherwise("d").alias("op"),
        F.when(event == 0, rule.at).when(event == 1, updated).otherwise(rule.at + F.expr("INTERVAL 2 DAY")).alias("event_ts"),
        lsn.cast(T.LongType()).alias("lsn"), partition.cast(T.IntegerType()).alias("kafka_partition"),
        offset.cast(T.LongType()).alias("kafka_offset"), F.pmod(rule.number, F.lit(5)).cast(T.IntegerType()).alias("latency_s"))


def _stamped(rows: DataFrame, table: str, cols: list, op: Column, event_ts: Column) -> DataFrame:
    """Events of at most one a key, numbered by the key."""
    lsn, partition, offset = _coordinates(table, F.lit(0))
    number = _changes(table).number
    return rows.select(
        *cols, op.alias("op"), event_ts.cast(T.TimestampNTZType()).alias("event_ts"),
        lsn.cast(T.LongType()).alias("lsn"), partition.cast(T.IntegerType()).alias("kafka_partition"),
        offset.cast(T.LongType()).alias("kafka_offset"), F.pmod(number, F.lit(5)).cast(T.IntegerType()).alias("latency_s"))


def snapshot_to_feed(df: DataFrame, table: str, event_ts: Column | None = None) -> DataFrame:
    """Initial snapshot: one READ event per row (Q10)."""
    ts = event_ts if event_ts is not None else F.lit(SNAPSHOT_TS).cast(T.TimestampNTZType())
    return _stamped(df, table, [c for c in df.columns if c in business_columns(table)], F.lit("r"), ts)


def snapshot_diff(old: DataFrame, new: DataFrame, table: str, event_ts: Column) -> DataFrame:
    """Two snapshots -> change events (Q11): new key 'c', gone key 'd', changed 'u'.

    A full outer join on the key with a null-safe compare of every other column;
    unchanged rows produce nothing.
    """
    keys = PRIMARY_KEYS[table]
    cols = [c for c in new.columns if c in business_columns(table)]
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in cols], F.lit(True).alias("_o"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("_n"))
    cond = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys]
    j = o.join(n, cond, "full_outer")
    changed = F.lit(False)
    for c in cols:
        if c not in keys:
            changed = changed | ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    op = (F.when(F.col("_o").isNull(), "c").when(F.col("_n").isNull(), "d")
          .when(changed, "u"))
    j = j.withColumn("op", op).filter(F.col("op").isNotNull())
    image = j.select("op", *[F.when(F.col("op") == "d", F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c)
                             for c in cols])
    return _stamped(image, table, cols, F.col("op"), event_ts)


DIGEST_BUCKETS = 256


def snapshot_diff_digests(old: DataFrame, new: DataFrame, table: str, event_ts: Column,
                          buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """As :func:`snapshot_diff`, but only rows of key buckets that differ are joined.

    A bucket's digest is the count and the sums of two independent 64-bit hashes of its rows:
    free of order, so it is one small partial aggregate a side.  Buckets whose digests agree
    hold the same rows but for a chance of about 2^-128; the others are found by a join of at
    most ``buckets`` digests, and both snapshots are cut to them before the full outer join.
    """
    left, right = differing_buckets(old, new, table, buckets)
    return snapshot_diff(left, right, table, event_ts)


def differing_buckets(old: DataFrame, new: DataFrame, table: str,
                      buckets: int = DIGEST_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Both snapshots' rows in the key buckets whose digests differ."""
    cols = [c for c in new.columns if c in business_columns(table)]
    bucket = F.pmod(F.xxhash64(*PRIMARY_KEYS[table]), F.lit(buckets)).alias("_bucket")

    def digests(df):
        # a hash over the columns skips nulls, so which of them are null is hashed as well
        row = [*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols]]
        text = F.to_json(F.struct(*cols))
        halves = [F.xxhash64(*row), F.xxhash64(text, F.lit(1))]
        return df.select(bucket, *[h.cast(T.DecimalType(38, 0)).alias(f"h{i}") for i, h in enumerate(halves)]) \
            .groupBy("_bucket").agg(F.count("*").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))

    a, b = digests(old), digests(new)
    same = a.join(b, (a._bucket == b._bucket) & (a.n == b.n) & (a.h0 == b.h0) & (a.h1 == b.h1), "left_semi") \
        .select(F.col("_bucket").alias("_same"))
    return tuple(df.select("*", bucket).join(same, F.col("_bucket") == F.col("_same"), "left_anti").drop("_bucket")
                 for df in (old, new))


def _image(df: DataFrame, table: str) -> Column:
    """Row image as the connector encodes it: dates as epoch days, timestamps as
    zoned ISO text, decimals as doubles."""
    fields = []
    types = {f.name: f.dataType for f in ENTITY_SCHEMAS[table].fields}
    for c in df.columns:
        if c not in types:
            continue
        dt = types[c]
        col = F.col(c)
        if isinstance(dt, T.DateType):
            col = encode_date(col)
        elif isinstance(dt, T.TimestampType):
            col = encode_ts(col)
        elif isinstance(dt, T.DecimalType):
            col = col.cast(T.DoubleType())
        fields.append(col.alias(c))
    return F.struct(*fields)


def to_records(feed: DataFrame, table: str) -> DataFrame:
    """Relational feed -> Kafka-shaped records with a JSON change envelope."""
    img = _image(feed, table)
    is_del = F.col("op") == "d"
    ts = F.col("event_ts").cast(T.TimestampType())
    payload = F.struct(
        F.when(is_del, img).alias("before"),
        F.when(~is_del, img).alias("after"),
        F.col("op").alias("op"),
        ts_to_millis(ts).alias("ts_ms"),
        F.struct(F.lit(SOURCE_DB).alias("db"), F.lit(table).alias("table"),
                 F.col("lsn").alias("lsn")).alias("source"))
    return feed.select(
        F.lit(topic_for(table)).alias("topic"),
        F.col("kafka_partition").cast(T.IntegerType()).alias("partition"),
        F.col("kafka_offset").cast(T.LongType()).alias("offset"),
        (ts + F.make_dt_interval(secs=F.col("latency_s"))).alias("timestamp"),
        F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def retail_feeds(views) -> dict[str, DataFrame]:
    """Change logs of all six tables, each built on first use."""
    from tidemark.sources.tables import LazyFrames
    return LazyFrames({t: lambda t=t: change_log(views[t], t) for t in views.names()})


def retail_records(views, tables: list[str] | None = None) -> DataFrame:
    """One Kafka-shaped stream over the feeds of ``tables`` (default: all six)."""
    feeds = retail_feeds(views)
    out = None
    for t in (tables or feeds.names()):
        r = to_records(feeds[t], t)
        out = r if out is None else out.unionByName(r)
    return out


# Kinds of faulty deliveries, by the row's number modulo their count.
FAULTS = [REJECT_VALUE_NULL, REJECT_NOT_JSON, REJECT_PAYLOAD_NULL, REJECT_OP_NULL, REJECT_OP_UNKNOWN,
          REJECT_TABLE_NULL, REJECT_IMAGE]


def malformed_records(rows: DataFrame, table: str) -> DataFrame:
    """One faulty delivery for every row of a table, its kind by the row's number.  Their log
    positions and offsets are negative, apart from the table's own."""
    lsn, partition, offset = _coordinates(table, F.lit(0))
    key = F.struct(*PRIMARY_KEYS[table])

    def env(op, name, after):
        payload = F.struct(F.lit(None).cast(T.StringType()).alias("before"), after.alias("after"), op.alias("op"),
                           ts_to_millis(F.lit(SNAPSHOT_TS).cast(T.TimestampType())).alias("ts_ms"),
                           F.struct(F.lit(SOURCE_DB).alias("db"), name.alias("table"), (-1 - lsn).alias("lsn")).alias("source"))
        return F.to_json(F.struct(payload.alias("payload")))

    null, here = F.lit(None).cast(T.StringType()), F.lit(table)
    values = [null, F.concat(F.lit("{not json "), lsn.cast("string")), F.lit('{"payload":null}'), env(null, here, key),
              env(F.lit("t"), here, key), env(F.lit("c"), null, key), env(F.lit("u"), here, F.struct())]
    kind = F.pmod(_changes(table).number, F.lit(len(FAULTS)))
    value = F.coalesce(*[F.when(kind == i, v) for i, v in enumerate(values)])
    return rows.select(
        F.lit(topic_for(table)).alias("topic"), partition.cast(T.IntegerType()).alias("partition"),
        (-1 - offset).cast(T.LongType()).alias("offset"), F.lit(SNAPSHOT_TS).cast(T.TimestampType()).alias("timestamp"),
        value.alias("value"))
