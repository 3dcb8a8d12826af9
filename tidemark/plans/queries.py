"""Registered queries: one Spark plan per operator of the inventory.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables.  ``ORACLE`` holds the DuckDB statement of the same result.  Output columns
use engine-neutral types: money as double, timestamps without zone (the session is
UTC), and wall-clock columns (``processed_at``, ``_silver_updated_at``,
``_deleted_at``) are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import op_code, topic_table
from tidemark.model import FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED_COLUMNS, TABLES
from tidemark.operators import bronze as B
from tidemark.operators import quality as Q
from tidemark.operators import silver as S
from tidemark.operators import variant as V
from tidemark.plans import gold as G
from tidemark.plans import jobs
from tidemark.plans import incremental as I
from tidemark.plans import kpi as K
from tidemark.plans import rollup as R
from tidemark.plans.oracle_sql import CHANGES, KEYS, LABELS, VERB, rows_of, with_base
from tidemark.plans.oracle_sql import key_text as key_sql
from tidemark.plans.flow import Flow
from tidemark.session import checkpoint_dir
from tidemark.sources import offsets
from tidemark.sources.feed import (FAULTS, malformed_records, snapshot_diff, snapshot_diff_digests,
                                   snapshot_to_feed, to_records)
from tidemark.sources.store import Store, free
from tidemark.sources.tables import LazyFrames
from tidemark.streaming import audit_stream as AS
from tidemark.streaming import bronze_stream as BS
from tidemark.streaming import lifecycle_stream as LS
from tidemark.streaming import silver_stream as SS

WALL_CLOCK = {"processed_at", "_silver_updated_at", "_deleted_at"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ORACLE_BODIES: dict[str, str] = {}  # without the shared CTEs


def output(df: DataFrame) -> DataFrame:
    """Engine-neutral output types; wall-clock columns dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name in WALL_CLOCK:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast(T.TimestampNTZType())
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast(T.DoubleType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: output(fn(Flow(spark, sf_dir)))
        if oracle is not None:
            ORACLE[name] = with_base(oracle)
            ORACLE_BODIES[name] = oracle
        return fn
    return deco


# ----------------------------------------------------- rows of all six tables in one form

# a text and an amount that stand for a row in outputs over all tables
_LABELS = {"customers": ("segment", None), "products": ("brand", "price"), "orders": ("status", "total_amount"),
           "order_items": ("quantity", "subtotal"), "payments": ("status", "amount"),
           "returns": ("status", "refund_amount")}


def key_text(table: str):
    return F.concat_ws(":", *[F.col(k).cast("string") for k in PRIMARY_KEYS[table]])


def labelled(df: DataFrame, table: str, *more) -> DataFrame:
    """table_name, key, label, amount and ``more`` of a table's rows."""
    label, amount = _LABELS[table]
    return df.select(F.lit(table).alias("table_name"), key_text(table).alias("key"), F.col(label).cast("string").alias("label"),
                     (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"), *more)


def over_tables(build) -> DataFrame:
    """Union of ``build(table)`` over the six tables."""
    out = None
    for t in TABLES:
        df = build(t)
        out = df if out is None else out.unionByName(df)
    return out


_STATE = ["_cdc_op", "_cdc_ts", "_cdc_lsn", "_is_deleted"]
_STATE_ORACLE = f"""
    SELECT table_name, key, label, amount, {VERB} AS _cdc_op, event_ts AS _cdc_ts, lsn AS _cdc_lsn,
           op = 'd' AS _is_deleted
    FROM all_states"""


# --------------------------------------------------------------------------- bronze

@register("bronze_orders_decoded", f"""
    SELECT {VERB} AS cdc_op, epoch_ms(event_ts) AS cdc_ts_ms, event_ts AS cdc_ts,
           'retail' AS cdc_db, 'orders' AS cdc_table, lsn AS cdc_lsn,
           'cdc.public.orders' AS kafka_topic, CAST(kafka_partition AS INTEGER) AS kafka_partition,
           kafka_offset, event_ts + to_seconds(latency_s) AS kafka_ts,
           status AS image_status
    FROM feed_orders""")
def _bronze_orders_decoded(p: Flow) -> DataFrame:
    b = p.bronze_of("orders")
    return b.select(*[c for c in b.columns if c not in ("before_json", "after_json")],
                    F.get_json_object(S.row_image(), "$.status").alias("image_status"))


@register("cdc_op_decode", f"""
    SELECT op, {VERB} AS cdc_op, COUNT(*) AS n_events FROM all_changes GROUP BY 1, 2""")
def _cdc_op_decode(p: Flow) -> DataFrame:
    return (p.bronze.groupBy(op_code(F.col("cdc_op")).alias("op"), "cdc_op")
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("cdc_row_image", f"""
    SELECT table_name, key, label, amount, lsn AS _cdc_lsn, {VERB} AS cdc_op,
           CASE WHEN op = 'd' THEN 'before' ELSE 'after' END AS image_side
    FROM all_changes""")
def _cdc_row_image(p: Flow) -> DataFrame:
    side = F.when(F.col("_cdc_op").isin("INSERT", "UPDATE", "READ"), "after").otherwise("before")
    return over_tables(lambda t: labelled(S.change_rows(p.bronze_of(t), t), t, "_cdc_lsn",
                                          F.col("_cdc_op").alias("cdc_op"), side.alias("image_side")))


@register("variant_row_image", f"""
    SELECT table_name, key, label, amount, lsn AS _cdc_lsn, {VERB} AS cdc_op, 0 AS n_extra
    FROM all_changes""")
def _variant_row_image(p: Flow) -> DataFrame:
    """The same images through VARIANT: one parse a record, typed extraction per entity."""
    return over_tables(lambda t: labelled(V.rows(V.decode(p.records_of(t)), t), t, "_cdc_lsn", F.col("_cdc_op").alias("cdc_op"),
                                          F.size("extra").alias("n_extra")))


@register("cdc_soft_delete_flags", """
    SELECT table_name, key, lsn AS _cdc_lsn, op = 'd' AS _is_deleted, op = 'd' AS has_deleted_at
    FROM all_changes""")
def _cdc_soft_delete_flags(p: Flow) -> DataFrame:
    return over_tables(lambda t: S.change_rows(p.bronze_of(t), t).select(
        F.lit(t).alias("table_name"), key_text(t).alias("key"), "_cdc_lsn", "_is_deleted",
        F.col("_deleted_at").isNotNull().alias("has_deleted_at")))


@register("cdc_topic_filter", """
    SELECT 'cdc.public.' || table_name AS kafka_topic, COUNT(*) AS n_records
    FROM all_changes WHERE table_name IN ('orders', 'payments') GROUP BY 1""")
def _cdc_topic_filter(p: Flow) -> DataFrame:
    r = B.topic_filter(p.records, ["orders", "payments"])
    return r.groupBy(F.col("topic").alias("kafka_topic")).agg(
        F.count(F.lit(1)).alias("n_records"))


@register("topic_to_table", """
    SELECT 'cdc.public.' || table_name AS kafka_topic, table_name, COUNT(*) AS n_records
    FROM all_changes GROUP BY 1, 2""")
def _topic_to_table(p: Flow) -> DataFrame:
    return (p.records.groupBy(F.col("topic").alias("kafka_topic"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .select("kafka_topic", topic_table(F.col("kafka_topic")).alias("table_name"),
                    "n_records"))


@register("cdc_fanout_counts", f"""
    SELECT table_name AS cdc_table, {VERB} AS cdc_op, COUNT(*) AS n_events
    FROM all_changes GROUP BY 1, 2""")
def _cdc_fanout_counts(p: Flow) -> DataFrame:
    return p.bronze.groupBy("cdc_table", "cdc_op").agg(F.count(F.lit(1)).alias("n_events"))


@register("distinct_tables", "SELECT DISTINCT table_name AS cdc_table FROM all_changes")
def _distinct_tables(p: Flow) -> DataFrame:
    return p.bronze.select("cdc_table").distinct()


@register("cdc_replay_dedup", f"""
    SELECT table_name AS cdc_table, {VERB} AS cdc_op, lsn AS cdc_lsn, event_ts AS cdc_ts,
           CAST(kafka_partition AS INTEGER) AS kafka_partition, kafka_offset
    FROM all_changes""")
def _cdc_replay_dedup(p: Flow) -> DataFrame:
    """All six logs delivered twice, as after a restart that replays everything: the events
    that stay are those of one delivery (D7)."""
    p.keep(p.views, ["order_items"], _scratch(p))  # each delivery numbers the lines
    twice = B.decode(p.records.unionByName(p.records))
    return B.dedup_replays(twice).select("cdc_table", "cdc_op", "cdc_lsn", "cdc_ts", "kafka_partition", "kafka_offset")


# --------------------------------------------------------------------------- silver

@register("cdc_latest_per_key", _STATE_ORACLE)
def _cdc_latest_per_key(p: Flow) -> DataFrame:
    return over_tables(lambda t: labelled(p.silver[t], t, *_STATE))


@register("cdc_soft_delete_state", f"""
    SELECT table_name, {VERB} AS _cdc_op, op = 'd' AS _is_deleted, COUNT(*) AS n_keys
    FROM all_states GROUP BY 1, 2, 3""")
def _cdc_soft_delete_state(p: Flow) -> DataFrame:
    return over_tables(lambda t: p.silver[t].groupBy(F.lit(t).alias("table_name"), "_cdc_op", "_is_deleted")
                       .agg(F.count(F.lit(1)).alias("n_keys")))


_CUT = "1997-01-01 00:00:00"


def _change_rows(p: Flow, table: str) -> DataFrame:
    return S.change_rows(p.bronze_of(table), table)


def _before_cut(rows: DataFrame, before: bool) -> DataFrame:
    """Log before and after a time; where a table's log has but one day, that is by the key."""
    cut = F.lit(_CUT).cast(T.TimestampType())
    early = (F.col("_cdc_ts") < cut) & (F.col("_cdc_op") != "DELETE")
    return rows.filter(early if before else ~early)


@register("cdc_merge_upsert", _STATE_ORACLE)
def _cdc_merge_upsert(p: Flow) -> DataFrame:
    """Target = state of the log before a cut date without its deletes; updates = the rest."""
    p.keep(p.changes, TABLES, _scratch(p))  # target and updates are two reads of it

    def merged(t):
        rows, keys = p.changes[t], PRIMARY_KEYS[t]
        target = S.latest_per_key(_before_cut(rows, True), keys)
        updates = S.latest_per_key(_before_cut(rows, False), keys)
        return labelled(S.merge_upsert(target, updates, keys), t, *_STATE)
    return over_tables(merged)


@register("cdc_guarded_merge", _STATE_ORACLE)
def _cdc_guarded_merge(p: Flow) -> DataFrame:
    """The same two batches applied newest first; the guard ignores the late one."""
    p.keep(p.changes, TABLES, _scratch(p))

    def merged(t):
        rows, keys = p.changes[t], PRIMARY_KEYS[t]
        target = S.latest_per_key(_before_cut(rows, False), keys)
        late = S.latest_per_key(_before_cut(rows, True), keys)
        return labelled(S.merge_upsert(target, late, keys, guarded=True), t, *_STATE)
    return over_tables(merged)


@register("cdc_delete_unseen_key", """
    SELECT d.table_name, d.key, d.label, d.amount, TRUE AS _is_deleted,
           r.key IS NOT NULL AS was_known
    FROM all_changes d LEFT JOIN (SELECT * FROM all_changes WHERE op = 'r') r
      ON d.table_name = r.table_name AND d.key = r.key
    WHERE d.op = 'd'""")
def _cdc_delete_unseen_key(p: Flow) -> DataFrame:
    """Target = snapshot reads only; updates = the deletes.  A delete of a key the
    target never saw is inserted as a deleted row (C6)."""
    p.keep(p.changes, TABLES, _scratch(p))

    def merged(t):
        rows, keys = p.changes[t], PRIMARY_KEYS[t]
        target = S.latest_per_key(rows.filter(F.col("_cdc_op") == "READ"), keys)
        deletes = S.latest_per_key(rows.filter(F.col("_cdc_op") == "DELETE"), keys)
        known = target.select(*keys, F.lit(True).alias("was_known"))
        gone = S.merge_upsert(target, deletes, keys).filter(F.col("_is_deleted")).join(known, keys, "left")
        return labelled(gone, t, "_is_deleted", F.coalesce("was_known", F.lit(False)).alias("was_known"))
    return over_tables(merged)


# --------------------------------------------------------------------------- joins


@register("join_items_orders", """
    SELECT i.order_id, i.line_no, o.customer_id, o.status,
           CAST(i.quantity * i.unit_price AS DOUBLE) AS line_revenue
    FROM live_order_items i JOIN live_orders o ON i.order_id = o.order_id""")
def _join_items_orders(p: Flow) -> DataFrame:
    i = S.live(p.silver["order_items"]).select("order_id", "line_no", "quantity", "unit_price")
    o = S.live(p.silver["orders"]).select(F.col("order_id").alias("_o_id"), "customer_id",
                                          "status")
    return (i.join(o, i.order_id == o._o_id, "inner")
            .select("order_id", "line_no", "customer_id", "status",
                    (F.col("quantity") * F.col("unit_price")).alias("line_revenue")))


@register("join_orders_live_customers", """
    SELECT o.order_id, o.customer_id, c.name AS customer_name, c.segment AS customer_segment
    FROM live_orders o LEFT JOIN live_customers c ON o.customer_id = c.customer_id""")
def _join_orders_live_customers(p: Flow) -> DataFrame:
    o = S.live(p.silver["orders"]).select("order_id", "customer_id")
    c = G.live_customer_dim(p.silver["customers"], {"name": "customer_name",
                                                    "segment": "customer_segment"})
    return (o.join(c, o.customer_id == c._c_id, "left")
            .select("order_id", "customer_id", "customer_name", "customer_segment"))


@register("join_payments_chain", """
    SELECT py.payment_id, py.order_id, o.customer_id, c.segment AS customer_segment,
           CAST(py.amount AS DOUBLE) AS amount, o.op = 'd' AS order_deleted, c.op = 'd' AS customer_deleted
    FROM live_payments py LEFT JOIN silver_orders o ON py.order_id = o.order_id
    LEFT JOIN silver_customers c ON o.customer_id = c.customer_id""")
def _join_payments_chain(p: Flow) -> DataFrame:
    py = S.live(p.silver["payments"]).select("payment_id", "order_id", "amount")
    o = p.silver["orders"].select(F.col("order_id").alias("_o_id"), "customer_id",
                                  F.col("_is_deleted").alias("order_deleted"))
    c = p.silver["customers"].select(F.col("customer_id").alias("_c_id"),
                                     F.col("segment").alias("customer_segment"),
                                     F.col("_is_deleted").alias("customer_deleted"))
    return (py.join(o, py.order_id == o._o_id, "left")
            .join(c, F.col("customer_id") == c._c_id, "left")
            .select("payment_id", "order_id", "customer_id", "customer_segment", "amount",
                    "order_deleted", "customer_deleted"))


@register("unpaid_orders", """
    SELECT o.order_id, o.status, CAST(o.total_amount AS DOUBLE) AS total_amount
    FROM live_orders o
    WHERE o.status IN ('confirmed', 'shipped', 'delivered')
      AND NOT EXISTS (SELECT 1 FROM live_payments p WHERE p.order_id = o.order_id)""")
def _unpaid_orders(p: Flow) -> DataFrame:
    o = S.live(p.silver["orders"]).filter(F.col("status").isin("confirmed", "shipped",
                                                              "delivered"))
    # one row an order, so an order with very many payments is reduced map-side
    paid = S.live(p.silver["payments"]).select("order_id").distinct()
    return o.join(paid, "order_id", "left_anti").select("order_id", "status", "total_amount")


@register("returnable_orders", """
    SELECT o.order_id, CAST(o.total_amount AS DOUBLE) AS total_amount
    FROM live_orders o
    WHERE o.status = 'delivered'
      AND NOT EXISTS (SELECT 1 FROM live_returns r WHERE r.order_id = o.order_id)""")
def _returnable_orders(p: Flow) -> DataFrame:
    o = S.live(p.silver["orders"]).filter(F.col("status") == "delivered")
    returned = S.live(p.silver["returns"]).select("order_id").distinct()
    return o.join(returned, "order_id", "left_anti").select("order_id", "total_amount")


# --------------------------------------------------------------------------- gold


@register("gold_customers", """
    SELECT customer_id, name, email, city, country, segment, registration_date, is_active,
           event_ts AS _cdc_ts
    FROM live_customers""")
def _gold_customers(p: Flow) -> DataFrame:
    return p.gold["customers"]


@register("gold_orders",
          "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM gold_orders")
def _gold_orders(p: Flow) -> DataFrame:
    return p.gold["orders"]


@register("gold_sales_facts", """
    SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
                      CAST(line_revenue AS DOUBLE) AS line_revenue)
    FROM gold_sales_facts""")
def _gold_sales_facts(p: Flow) -> DataFrame:
    return p.gold["sales_facts"]


@register("gold_payments_summary", """
    SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM gold_payments_summary""")
def _gold_payments_summary(p: Flow) -> DataFrame:
    return p.gold["payments_summary"]


@register("gold_returns_summary", """
    SELECT * REPLACE (CAST(total_refund AS DOUBLE) AS total_refund) FROM gold_returns_summary""")
def _gold_returns_summary(p: Flow) -> DataFrame:
    return p.gold["returns_summary"]


@register("gold_cdc_audit", "SELECT * FROM gold_cdc_audit")
def _gold_cdc_audit(p: Flow) -> DataFrame:
    return p.gold["cdc_audit"]


@register("union_audit_branches", "SELECT * FROM gold_cdc_audit")
def _union_audit_branches(p: Flow) -> DataFrame:
    return G.union_audit_branches({t: p.bronze_of(t) for t in TABLES})


# --------------------------------------------------------------------------- KPIs

# The KPIs stated on the change logs and live rows, not on the gold products: an order's lines
# are summed per order first, so that distinct orders are a plain count.
_SOLD = """
    SELECT {what}, l.order_id, SUM(l.quantity * l.unit_price) AS money
    FROM live_order_items l JOIN live_orders o ON o.order_id = l.order_id AND o.status <> 'cancelled'
    LEFT JOIN live_{side} d ON d.{key} = {ref}.{key} GROUP BY ALL"""
_MONEY = "CAST(ROUND(SUM(money), 2) AS DOUBLE)"

_KPI_ORACLE = {
    "kpi_events_by_table_op": f"""
        SELECT table_name AS source_table, {VERB} AS operation, COUNT(*) AS nb_events
        FROM all_changes GROUP BY ALL""",
    "kpi_latency_by_table": """
        SELECT table_name AS source_table, ROUND(AVG(per_cell), 2) AS avg_latency_sec
        FROM (SELECT table_name, op, event_ts::DATE AS d, SUM(latency_s)::DOUBLE / COUNT(*) AS per_cell
              FROM all_changes GROUP BY ALL) GROUP BY ALL""",
    "kpi_latency_weighted": """
        SELECT table_name AS source_table, ROUND(SUM(latency_s)::DOUBLE / COUNT(*), 2) AS avg_latency_sec
        FROM all_changes GROUP BY ALL""",
    "kpi_orders_by_day": """
        SELECT order_date::DATE AS order_day, COUNT(*) AS nb_orders, CAST(ROUND(SUM(total_amount), 2) AS DOUBLE) AS revenue
        FROM live_orders GROUP BY 1 QUALIFY row_number() OVER (ORDER BY order_day DESC) <= 30""",
    "kpi_revenue_by_category": f"""
        SELECT product_category, {_MONEY} AS revenue, COUNT(*) AS nb_orders
        FROM ({_SOLD.format(what="d.category AS product_category", side="products", key="product_id", ref="l")}) GROUP BY ALL""",
    "kpi_payments_by_method": """
        SELECT month(payment_date)::INTEGER AS payment_month, year(payment_date)::INTEGER AS payment_year, method,
               COUNT(*) AS nb, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS amount
        FROM live_payments WHERE status = 'completed' GROUP BY ALL""",
    "kpi_cancellation_rate": """
        SELECT ROUND(CAST(COUNT(*) FILTER (WHERE status = 'cancelled') AS DOUBLE) * 100.0 / COUNT(*), 2)
                 AS cancellation_rate_pct
        FROM live_orders""",
    "kpi_sales_by_segment_channel": f"""
        SELECT customer_segment, channel, COUNT(*) AS nb_orders, {_MONEY} AS revenue
        FROM ({_SOLD.format(what="d.segment AS customer_segment, o.channel", side="customers", key="customer_id", ref="o")})
        GROUP BY ALL""",
    "kpi_top_customers": f"""
        SELECT customer_id, customer_name, customer_segment, COUNT(*) AS nb_orders, {_MONEY} AS total_revenue
        FROM ({_SOLD.format(what="o.customer_id, d.name AS customer_name, d.segment AS customer_segment",
                            side="customers", key="customer_id", ref="o")})
        GROUP BY 1, 2, 3 QUALIFY row_number() OVER (ORDER BY SUM(money) DESC, customer_id) <= 10""",
    "kpi_returns_by_reason": """
        SELECT reason, status, COUNT(*) AS nb, CAST(ROUND(SUM(refund_amount), 2) AS DOUBLE) AS refund
        FROM live_returns GROUP BY ALL""",
}


def _register_kpi(name: str):
    register(name, _KPI_ORACLE[name])(lambda p: p.kpis[name])


for _k in _KPI_ORACLE:
    _register_kpi(_k)


@register("sql_consumer", f"""
    SELECT p.method, p.payment_year, p.n, r.cancellation_rate_pct
    FROM (SELECT method, payment_year, CAST(SUM(nb) AS BIGINT) AS n
          FROM ({_KPI_ORACLE["kpi_payments_by_method"]}) GROUP BY ALL) p,
         ({_KPI_ORACLE["kpi_cancellation_rate"]}) r""")
def _sql_consumer(p: Flow) -> DataFrame:
    K.publish_views(p.gold, p.kpis, ["kpi_payments_by_method", "kpi_cancellation_rate"])
    return p.spark.sql("""
        SELECT method, payment_year, sum(nb) AS n,
               (SELECT first(cancellation_rate_pct) FROM kpi_cancellation_rate) AS cancellation_rate_pct
        FROM kpi_payments_by_method GROUP BY method, payment_year""")


@register("sql_table_functions", """
    WITH sold AS (
      SELECT o.*, c.name, l.quantity * l.unit_price AS money, p.category
      FROM live_order_items l JOIN live_orders o USING (order_id) LEFT JOIN live_customers c USING (customer_id)
      LEFT JOIN live_products p ON p.product_id = l.product_id WHERE o.status <> 'cancelled'),
    ranked AS (SELECT customer_id, SUM(money) AS total, COUNT(DISTINCT order_id) AS n,
                      row_number() OVER (ORDER BY SUM(money) DESC, customer_id) AS place
               FROM sold GROUP BY customer_id)
    SELECT 'top_' || k AS report, CAST(customer_id AS VARCHAR) AS item, CAST(total AS DOUBLE) AS revenue, n AS nb_orders
    FROM ranked, (VALUES (10), (25)) v(k) WHERE place <= k
    UNION ALL
    SELECT '1997', category, CAST(SUM(money) AS DOUBLE), COUNT(DISTINCT order_id) FROM sold
    WHERE year(order_date) = 1997 GROUP BY category
    UNION ALL
    SELECT 'BUILDING', year(o.order_date) || ' ' || channel, CAST(SUM(total_amount) AS DOUBLE), COUNT(*)
    FROM live_orders o JOIN live_customers c USING (customer_id)
    WHERE c.segment = 'BUILDING' AND o.status <> 'cancelled' GROUP BY year(o.order_date), channel""")
def _sql_table_functions(p: Flow) -> DataFrame:
    """Parameterised reports as SQL table functions over the gold views."""
    states = p.keep(p.silver, ["orders", "customers"], _scratch(p))  # in both products
    p.keep(p.gold, ["sales_facts", "orders"], _scratch(p))
    for t in ("orders", "customers"):
        states.drop(t)
    K.publish_views(p.gold, p.kpis, ["sales_facts", "orders"])
    K.publish_functions(p.spark)
    return p.spark.sql("""
        SELECT 'top_10' AS report, CAST(customer_id AS STRING) AS item, CAST(total_revenue AS DOUBLE) AS revenue, nb_orders
        FROM gold_top_customers(10)
        UNION ALL SELECT 'top_25', CAST(customer_id AS STRING), CAST(total_revenue AS DOUBLE), nb_orders FROM gold_top_customers(25)
        UNION ALL SELECT '1997', product_category, CAST(revenue AS DOUBLE), nb_orders
        FROM gold_sales_between(DATE '1997-01-01', DATE '1997-12-31')
        UNION ALL SELECT 'BUILDING', concat_ws(' ', order_year, channel), CAST(revenue AS DOUBLE), nb_orders
        FROM gold_segment_orders('BUILDING')""")


@register("distinct_rollup", """
    WITH sold AS (SELECT DISTINCT d.category AS product_category, o.order_date::DATE AS day, l.order_id
                  FROM live_order_items l JOIN live_orders o ON o.order_id = l.order_id AND o.status <> 'cancelled'
                  LEFT JOIN live_products d ON d.product_id = l.product_id)
    SELECT level, product_category, CASE level WHEN 'day' THEN day ELSE date_trunc(level, day)::DATE END AS period,
           COUNT(DISTINCT order_id) AS n_distinct
    FROM sold, (VALUES ('day'), ('month'), ('year')) v(level) GROUP BY ALL""")
def _distinct_rollup(p: Flow) -> DataFrame:
    """Distinct orders per category and day, month and year from stored daily bitmaps (A2, K4)."""
    store = Store(p.spark, _scratch(p))
    facts = p.gold["sales_facts"].where("is_cancelled = 0")
    store.write(R.daily_bitmaps(facts, ["product_category"], "order_day", "order_id"), "orders_by_day")
    days = store.read("orders_by_day")
    out = [R.distinct_counts(days, ["product_category"], level) for level in R.LEVELS]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --------------------------------------------------------------------------- quarantine



def _faults_oracle() -> str:
    kinds = "[" + ", ".join(f"'{x}'" for x in FAULTS) + "]"
    parts = ["SELECT table_name, 'valid' AS reject_reason, COUNT(*) AS n_records FROM all_changes GROUP BY 1, 2"]
    parts += [f"SELECT '{t}', ({kinds})[1 + {CHANGES[t]['number']} % {len(FAULTS)}], COUNT(*) FROM retail_{t} GROUP BY 1, 2"
              for t in TABLES]
    return "\nUNION ALL ".join(parts)


@register("cdc_malformed_filtered", _faults_oracle())
def _cdc_malformed_filtered(p: Flow) -> DataFrame:
    """Each table's log mixed with a faulty delivery for every row: envelope faults are
    quarantined at bronze, image faults at silver; only valid changes reach the state (P3,
    D3, D4, D8)."""
    p.keep(p.views, ["order_items"], _scratch(p))  # its numbering is read by log and faults

    def counted(t):
        records = p.records_of(t).unionByName(malformed_records(p.views[t], t))
        verdict = S.triage(B.decode_all(records), t)
        return verdict.groupBy(F.lit(t).alias("table_name"),
                               F.coalesce("reject_reason", F.lit("valid")).alias("reject_reason")) \
            .agg(F.count(F.lit(1)).alias("n_records"))
    return over_tables(counted)


# --------------------------------------------------------------------------- feeds

@register("snapshot_to_feed", f"""
    SELECT *, 'READ' AS _cdc_op, FALSE AS _is_deleted FROM ({rows_of("retail")})""")
def _snapshot_to_feed(p: Flow) -> DataFrame:
    """Table snapshots as READ events, through envelopes, back to state (Q10)."""
    return over_tables(lambda t: labelled(_snapshot_state(p, t), t, "_cdc_op", "_is_deleted"))


def _snapshot_state(p: Flow, table: str) -> DataFrame:
    return S.state(B.decode(to_records(snapshot_to_feed(p.views[table], table), table)), table)


# Fixed edit rules that turn a table's snapshot into the next one: of each ten rows one goes, one
# is changed in the named column, one comes again under a negative key.
_DIFF_TS = "1999-01-01 00:00:00"
_EDITS = {"customers": ("segment", "'MOVED'"), "products": ("price", "CAST(price + 1 AS DECIMAL(12,2))"),
          "orders": ("status", "'cancelled'"), "order_items": ("quantity", "quantity + 1"),
          "payments": ("status", "'refunded'"), "returns": ("status", "'closed'")}


def _next_snapshot(rows: DataFrame, table: str) -> DataFrame:
    column, value = _EDITS[table]
    key, number = PRIMARY_KEYS[table][0], F.expr(CHANGES[table]["number"])
    kept = rows.filter(number % 10 != 3).withColumn(
        column, F.when(number % 10 == 5, F.expr(value)).otherwise(F.col(column)).cast(rows.schema[column].dataType))
    return kept.unionByName(rows.filter(number % 10 == 7).withColumn(key, -F.col(key)))


def _next_sql(table: str) -> str:
    column, value = _EDITS[table]
    key, number = KEYS[table][0], CHANGES[table]["number"]
    return (f"SELECT * REPLACE (CASE WHEN {number} % 10 = 5 THEN {value} ELSE {column} END AS {column}) FROM retail_{table} "
            f"WHERE {number} % 10 <> 3 UNION ALL SELECT * REPLACE (-{key} AS {key}) FROM retail_{table} WHERE {number} % 10 = 7")


def _diff_oracle() -> str:
    ctes = ", ".join(f"next_{t} AS ({_next_sql(t)})" for t in TABLES)
    parts = []
    for t, (label, amount) in LABELS.items():
        same = " AND ".join(f"o.{k} = n.{k}" for k in KEYS[t])
        gone = f"n.{KEYS[t][0]} IS NULL"
        parts.append(f"""
            SELECT '{t}' AS table_name, {key_sql(t)} AS key, op, {label} AS label, CAST({amount} AS DOUBLE) AS amount FROM (
              SELECT CASE WHEN {gone} THEN 'd' WHEN o.{KEYS[t][0]} IS NULL THEN 'c' ELSE 'u' END AS op,
                     unnest(CASE WHEN {gone} THEN o ELSE n END)
              FROM retail_{t} o FULL OUTER JOIN next_{t} n ON {same} WHERE o IS DISTINCT FROM n)""")
    return f"WITH {ctes} " + "\nUNION ALL ".join(parts)


def _applied_oracle() -> str:
    return f"WITH {', '.join(f'next_{t} AS ({_next_sql(t)})' for t in TABLES)} {rows_of('next')}"


def _diff(p: Flow, table: str, find=snapshot_diff) -> DataFrame:
    return find(p.views[table], _next_snapshot(p.views[table], table), table, F.lit(_DIFF_TS).cast(T.TimestampNTZType()))


@register("snapshot_diff", _diff_oracle())
def _snapshot_diff(p: Flow) -> DataFrame:
    """Two snapshots -> c/u/d events (Q11)."""
    return over_tables(lambda t: labelled(_diff(p, t), t, "op"))


@register("snapshot_diff_digests", _diff_oracle())
def _snapshot_diff_digests(p: Flow) -> DataFrame:
    """The same events from the key buckets whose order-free digests differ."""
    return over_tables(lambda t: labelled(_diff(p, t, snapshot_diff_digests), t, "op"))


@register("snapshot_diff_apply", _applied_oracle())
def _snapshot_diff_apply(p: Flow) -> DataFrame:
    """Old state merged with the decoded diff events gives the new snapshot."""
    p.keep(p.views, ["order_items"], _scratch(p))  # read as old, as next and as old state

    def applied(t):
        keys = PRIMARY_KEYS[t]
        updates = S.latest_per_key(S.change_rows(B.decode(to_records(_diff(p, t), t)), t), keys)
        return labelled(S.live(S.merge_upsert(_snapshot_state(p, t), updates, keys, guarded=True)), t)
    return over_tables(applied)


# --------------------------------------------------------------------------- quality

@register("dq_pk_duplicates", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, COUNT(*) AS n_rows
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _dq_pk_duplicates(p: Flow) -> DataFrame:
    """Natural key (order, line number) of the order lines: duplicated in the data,
    which is why item ids are numbered instead (Q1)."""
    li = p.tables.lineitem.select(F.col("l_orderkey").alias("order_id"),
                                  F.col("l_linenumber").alias("line_number"))
    return Q.pk_duplicates(li, ["order_id", "line_number"])


def _pk_oracle() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, table_name, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, "
        f"COUNT(*) FILTER (WHERE n > 1) AS n_duplicate_keys "
        f"FROM (SELECT table_name, key, COUNT(*) AS n FROM {rows} GROUP BY ALL) GROUP BY ALL"
        for layer, rows in (("log", "all_changes"), ("state", "all_states")))


@register("dq_pk_summary", _pk_oracle())
def _dq_pk_summary(p: Flow) -> DataFrame:
    """Key uniqueness of every table's change log (keys with several events) and state (Q1)."""
    p.changes.update({t: p.changes[t].select(*PRIMARY_KEYS[t], *S.ORDER_COLUMNS) for t in TABLES})
    p.keep(p.changes, TABLES, _scratch(p))
    log = over_tables(lambda t: Q.pk_summary(p.changes[t], PRIMARY_KEYS[t], t))
    state = over_tables(lambda t: Q.pk_summary(S.latest_per_key(p.changes[t], PRIMARY_KEYS[t]), PRIMARY_KEYS[t], t))
    return log.withColumn("layer", F.lit("log")).unionByName(state.withColumn("layer", F.lit("state")))


def _fk_oracle() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{child}' AS child_table, '{col}' AS fk_column, '{parent}' AS parent_table, "
        f"COUNT(*) AS n_orphans FROM live_{child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM live_{parent} p WHERE p.{pcol} = c.{col})"
        for child, col, parent, pcol in FOREIGN_KEYS)


@register("dq_fk_orphans", _fk_oracle())
def _dq_fk_orphans(p: Flow) -> DataFrame:
    """Live rows whose reference has no live parent, per foreign key (Q2)."""
    columns = {t: {c: None for child, col, parent, pcol in FOREIGN_KEYS for u, c in ((child, col), (parent, pcol)) if u == t}
               for t in TABLES}
    live = LazyFrames({t: lambda t=t: S.live(p.silver[t]).select(*columns[t]) for t in TABLES})
    p.keep(live, [t for t in TABLES if sum((child == t) + (parent == t) for child, _, parent, _ in FOREIGN_KEYS) > 1],
           _scratch(p))
    return Q.fk_orphan_counts(live, FOREIGN_KEYS)


def _null_oracle() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_nulls FROM live_{t}"
        for t, cols in REQUIRED_COLUMNS.items() for c in cols)


@register("dq_null_counts", _null_oracle())
def _dq_null_counts(p: Flow) -> DataFrame:
    """NULLs in required columns of the live rows (Q3)."""
    return over_tables(lambda t: Q.null_counts(S.live(p.silver[t]), t, REQUIRED_COLUMNS[t]))


@register("dq_subtotal_mismatch", """
    SELECT COUNT(*) AS n_items,
           COUNT(*) FILTER (WHERE subtotal IS DISTINCT FROM quantity * unit_price) AS n_mismatch,
           CAST(SUM(subtotal) AS DOUBLE) AS subtotal_total,
           CAST(SUM(quantity * unit_price) AS DOUBLE) AS recomputed_total
    FROM live_order_items""")
def _dq_subtotal_mismatch(p: Flow) -> DataFrame:
    """Stored line subtotal against quantity x unit price after the trip through the
    change stream, where amounts travel as doubles (Q5, D13)."""
    i = S.live(p.silver["order_items"])
    recomputed = F.col("quantity") * F.col("unit_price")
    return i.agg(F.count(F.lit(1)).alias("n_items"),
                 F.count(F.when(~F.col("subtotal").eqNullSafe(recomputed), 1)).alias("n_mismatch"),
                 F.sum("subtotal").alias("subtotal_total"),
                 F.sum(recomputed).alias("recomputed_total"))


@register("insert_ignore_conflicts", """
    WITH target AS (SELECT customer_id, email FROM live_customers WHERE NOT is_active),
    incoming AS (
        SELECT 0 AS attempt, customer_id, email FROM live_customers
        UNION ALL SELECT 1, -customer_id, email FROM live_customers),
    firsts AS (SELECT customer_id, email FROM incoming i
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.email = i.email)
        QUALIFY row_number() OVER (PARTITION BY email ORDER BY attempt, customer_id) = 1)
    SELECT * FROM target UNION ALL SELECT * FROM firsts""")
def _insert_ignore_conflicts(p: Flow) -> DataFrame:
    """Target = inactive customers; incoming = every customer and then a re-registration
    of each under a new (negative) id with the same e-mail.  E-mail is unique: existing
    e-mails are skipped, and the first registration of a new one wins (Q4)."""
    c = S.live(p.silver["customers"]).withColumn("attempt", F.lit(0))
    cols = ["attempt", "customer_id", "email"]
    target = c.filter(~F.col("is_active")).select(*cols)
    again = c.select(F.lit(1).alias("attempt"), (-F.col("customer_id")).alias("customer_id"), "email")
    return Q.insert_ignore(target, c.select(*cols).unionByName(again), ["email"], ["attempt", "customer_id"]).drop("attempt")


_AS_OF = "1998-08-02 00:00:00"


@register("expired_drafts", f"""
    SELECT order_id, customer_id, order_date FROM live_orders
    WHERE status = 'pending' AND order_date < TIMESTAMP '{_AS_OF}' - INTERVAL '5' MINUTE""")
def _expired_drafts(p: Flow) -> DataFrame:
    """Pending orders older than five minutes as of a fixed time (Q6)."""
    cutoff = F.lit(_AS_OF).cast(T.TimestampType()) - F.expr("INTERVAL 5 MINUTES")
    return (S.live(p.silver["orders"])
            .filter((F.col("status") == "pending") & (F.col("order_date") < cutoff))
            .select("order_id", "customer_id", "order_date"))


@register("order_next_status", """
    SELECT order_id, status,
           CASE status WHEN 'pending' THEN 'confirmed' WHEN 'confirmed' THEN 'shipped'
                       WHEN 'shipped' THEN 'delivered' END AS next_status
    FROM live_orders WHERE status IN ('pending', 'confirmed', 'shipped')""")
def _order_next_status(p: Flow) -> DataFrame:
    """Next lifecycle status of every open order (Q7)."""
    o = S.live(p.silver["orders"]).filter(F.col("status").isin("pending", "confirmed", "shipped"))
    return o.select("order_id", "status", Q.next_status(F.col("status")).alias("next_status"))


@register("status_transition_audit", """
    WITH ev AS (SELECT order_id, status, event_ts, lsn FROM feed_orders WHERE op <> 'd'),
    pairs AS (
        SELECT lag(status) OVER (PARTITION BY order_id ORDER BY event_ts, lsn) AS from_status,
               status AS to_status FROM ev)
    SELECT from_status, to_status, COUNT(*) AS n_transitions,
           (from_status = to_status
            OR (from_status = 'pending' AND to_status IN ('confirmed', 'cancelled'))
            OR (from_status = 'confirmed' AND to_status = 'shipped')
            OR (from_status = 'shipped' AND to_status = 'delivered')) AS is_legal
    FROM pairs WHERE from_status IS NOT NULL GROUP BY 1, 2""")
def _status_transition_audit(p: Flow) -> DataFrame:
    """Status pairs of consecutive row images per order in log order, flagged
    against the lifecycle (Q8)."""
    rows = _change_rows(p, "orders").filter(F.col("_cdc_op") != "DELETE")
    pairs = Q.status_transitions(rows, "order_id", S.ORDER_COLUMNS)
    return (pairs.groupBy("from_status", "to_status")
            .agg(F.count(F.lit(1)).alias("n_transitions"))
            .withColumn("is_legal", Q.legal_transition(F.col("from_status"),
                                                       F.col("to_status"))))


@register("refund_expected", """
    SELECT r.return_id, r.order_id, CAST(r.refund_amount AS DOUBLE) AS refund_amount,
           CAST(round(COALESCE(NULLIF(o.total_amount, 0), 30) * 0.8, 2) AS DOUBLE) AS expected_refund,
           r.refund_amount = round(COALESCE(NULLIF(o.total_amount, 0), 30) * 0.8, 2) AS matches
    FROM live_returns r LEFT JOIN silver_orders o ON r.order_id = o.order_id""")
def _refund_expected(p: Flow) -> DataFrame:
    """Each return's refund against 80 % of its order total (Q9)."""
    r = S.live(p.silver["returns"]).select("return_id", "order_id", "refund_amount")
    o = p.silver["orders"].select(F.col("order_id").alias("_o_id"), "total_amount")
    exp = Q.expected_refund(F.col("total_amount"))
    return (r.join(o, r.order_id == o._o_id, "left")
            .select("return_id", "order_id", "refund_amount", exp.alias("expected_refund"),
                    (F.col("refund_amount") == exp).alias("matches")))



# --------------------------------------------------------------------------- merges and streams

def _scratch(p: Flow) -> str:
    """A fresh folder under the shared checkpoint directory of the session."""
    return f"{checkpoint_dir(p.spark).rstrip('/')}/tidemark-{uuid.uuid4().hex[:12]}"


def _stored_states(store: Store) -> DataFrame:
    return over_tables(lambda t: labelled(store.read(f"silver/{t}"), t, *_STATE))


@register("merge_touched_partitions", _STATE_ORACLE)
def _merge_touched_partitions(p: Flow) -> DataFrame:
    """Stored states of the log before the cut, merged with the rest of the log in place:
    only the key buckets that hold touched keys are read and rewritten (C3, J5)."""
    store = Store(p.spark, _scratch(p))
    for t in TABLES:
        kept, keys = p.keep(p.changes, [t], _scratch(p)), PRIMARY_KEYS[t]  # read for both merges and the touched keys
        for before in (True, False):
            changes = _before_cut(p.changes[t], before)
            store.merge(S.latest_per_key(changes, keys), f"silver/{t}", keys, buckets=8, changes=changes)
        kept.drop(t)
        free(p.spark)
    return _stored_states(store)


@register("gold_facts_incremental", """
    SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
                      CAST(line_revenue AS DOUBLE) AS line_revenue)
    FROM gold_sales_facts""")
def _gold_facts_incremental(p: Flow) -> DataFrame:
    """Facts stored from the states before the cut, then brought up to date from the keys of
    customers, products, orders and lines that changed (G2, G3, S10)."""
    store = Store(p.spark, _scratch(p))
    tables = ["customers", "products", "orders", "order_items"]
    log = p.keep(p.changes, tables, _scratch(p))  # read as old state, new state and changed keys
    old = {t: S.latest_per_key(_before_cut(p.changes[t], True), PRIMARY_KEYS[t]) for t in tables}
    I.build_facts(store, "facts", old, buckets=8)
    free(p.spark)
    # read for the orders reached and for their facts, which show no place in the log
    p.silver.update({t: S.latest_per_key(p.changes[t], PRIMARY_KEYS[t]).drop(*S.LINEAGE, "_deleted_at", "_silver_updated_at")
                     for t in tables})
    states = p.keep(p.silver, tables, _scratch(p))
    changed = LazyFrames({t: lambda t=t: _before_cut(p.changes[t], False).select(*PRIMARY_KEYS[t]).distinct() for t in tables})
    touched = p.keep(changed, tables, _scratch(p))
    for t in tables:
        log.drop(t)
    I.refresh_facts(store, "facts", p.silver, changed, buckets=8)
    for t in tables:
        states.drop(t)
        touched.drop(t)
    return store.read("facts").drop("bucket")


def _landed(p: Flow, root: str, parts: int):
    """The six logs landed in parts, by a hash of the coordinates: each part's changes come in
    any order relative to the other parts'."""
    part = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(parts))
    for k in range(parts):
        offsets.land(p.records.where(part == k), f"{root}/landing")
        yield k


@register("stream_offsets", """
    SELECT 'cdc.public.' || table_name AS topic, kafka_partition::INTEGER AS partition, COUNT(*) AS n_records,
           COUNT(*) AS n_offsets, CAST(0 AS BIGINT) AS first_offset, COUNT(*) - 1 AS last_offset
    FROM all_changes GROUP BY ALL""")
def _stream_offsets(p: Flow) -> DataFrame:
    """Records through the offset source, a bounded number of offsets a trigger, with a
    restart after each landing: each offset exactly once (S1, T5, T6)."""
    root = _scratch(p)
    for _ in _landed(p, root, 2):
        src = offsets.stream(p.spark, f"{root}/landing", f"{root}/progress", max_offsets_per_trigger=50_000)
        q = src.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/checkpoint").trigger(processingTime="0 seconds").start()
        offsets.run_to_end(q, f"{root}/landing", f"{root}/progress")
    return p.spark.read.parquet(f"{root}/out").groupBy("topic", "partition").agg(
        F.count("value").alias("n_records"), F.count_distinct("offset").alias("n_offsets"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


@register("stream_bronze_available_now", f"""
    SELECT table_name AS cdc_table, {VERB} AS cdc_op, COUNT(*) AS n_events,
           COUNT(DISTINCT (kafka_partition, kafka_offset)) AS n_offsets
    FROM all_changes GROUP BY 1, 2""")
def _stream_bronze_available_now(p: Flow) -> DataFrame:
    """Streaming bronze equals batch bronze; a restart adds nothing."""
    root = _scratch(p)
    p.records.write.option("compression", "zstd").parquet(f"{root}/landing")
    free(p.spark)
    store = Store(p.spark, f"{root}/lake")
    for _ in range(2):
        src = BS.file_records(p.spark, f"{root}/landing", max_files_per_trigger=8)
        q = BS.start_bronze_stream(src, store, f"{root}/_checkpoints/bronze",
                                   trigger={"availableNow": True}, partition_by=["cdc_table"],
                                   dedup_within="1 hour")
        q.awaitTermination()  # never read a half-written table
        if q.exception() is not None:
            raise q.exception()
    return (store.read("bronze").groupBy("cdc_table", "cdc_op")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.count_distinct("kafka_partition", "kafka_offset").alias("n_offsets")))


@register("stream_state_all_tables", _STATE_ORACLE)
def _stream_state_all_tables(p: Flow) -> DataFrame:
    """Silver of all six tables kept by the state stream over the offset source, restarted
    after each of three landings whose changes overlap in time (C2, C9)."""
    root = _scratch(p)
    store = Store(p.spark, f"{root}/lake")
    for _ in _landed(p, root, 3):
        src = offsets.stream(p.spark, f"{root}/landing", f"{root}/progress")
        q = SS.start_state_stream(B.decode(src), store, f"{root}/checkpoint", {"processingTime": "0 seconds"}, buckets=8)
        offsets.run_to_end(q, f"{root}/landing", f"{root}/progress")
    return _stored_states(store)


@register("stream_silver_incremental", _STATE_ORACLE)
def _stream_silver_incremental(p: Flow) -> DataFrame:
    """Batch runs append to the bronze log; the incremental job folds what is new after each
    into the stored states (C9, D15)."""
    root = _scratch(p)
    store = Store(p.spark, f"{root}/lake")
    late = F.pmod(F.col("offset"), F.lit(2))
    for k in (1, 0):
        jobs.run_bronze(store, p.records.where(late == k), partition_by=["cdc_table"])
        jobs.run_silver_incremental(store, f"{root}/checkpoint")
    return _stored_states(store)


def _order_events(p: Flow) -> DataFrame:
    """Lifecycle events of the orders log, landed before and after the cut, with a restart."""
    root = _scratch(p)
    cut = F.lit(_CUT).cast(T.TimestampType())
    at = F.col("timestamp") - F.make_dt_interval(secs=F.lit(4))  # records arrive within four seconds
    for part in (at < cut, at >= cut):
        offsets.land(p.records_of("orders").where(part), f"{root}/landing")
        src = offsets.stream(p.spark, f"{root}/landing", f"{root}/progress")
        q = LS.order_events(B.decode(src)).writeStream.format("parquet").option("path", f"{root}/events").option(
            "checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(processingTime="0 seconds").start()
        offsets.run_to_end(q, f"{root}/landing", f"{root}/progress")
    return p.spark.read.schema(LS.OUTPUT).parquet(f"{root}/events")


@register("stream_draft_expiry", ORACLE_BODIES["expired_drafts"])
def _stream_draft_expiry(p: Flow) -> DataFrame:
    """Drafts that expired as the stream's event time passed, before a fixed time, and were not
    withdrawn by a later change (Q6)."""
    events = _order_events(p)
    as_of = F.unix_millis(F.lit(_AS_OF).cast(T.TimestampType()))
    expired = events.where((F.col("event") == "expired") & (F.col("at_ms") < as_of))
    back = events.where("event = 'withdrawn'").select("order_id").distinct()
    return expired.join(back, "order_id", "left_anti").select("order_id", "customer_id", "order_date")


@register("stream_illegal_transitions", f"""
    SELECT from_status, to_status, n_transitions FROM ({ORACLE_BODIES["status_transition_audit"]}) WHERE NOT is_legal""")
def _stream_illegal_transitions(p: Flow) -> DataFrame:
    """Illegal status changes, each reported once as it occurred (Q8)."""
    return _order_events(p).where("event = 'illegal'").groupBy("from_status", "to_status").agg(
        F.count("*").alias("n_transitions"))


@register("stream_audit", """
    SELECT g.*, n_late FROM gold_cdc_audit g JOIN (
      SELECT table_name AS source_table, op, event_ts::DATE AS event_day, COUNT(*) FILTER (WHERE kafka_offset % 7 = 0) AS n_late
      FROM all_changes GROUP BY ALL) l
    ON g.source_table = l.source_table AND g.event_day = l.event_day
       AND g.operation = CASE l.op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END""")
def _stream_audit(p: Flow) -> DataFrame:
    """The audit from a stream that publishes each day once; the records of the second landing
    come after their days were closed and are counted as late (C10, G6)."""
    root = _scratch(p)
    p.keep(p.views, ["order_items"], _scratch(p))  # both landings number the lines
    late = F.col("offset") % 7 == 0
    for part in (~late, late):
        offsets.land(p.records.where(part), f"{root}/landing")
        src = offsets.stream(p.spark, f"{root}/landing", f"{root}/progress")
        q = AS.audit_events(B.decode(src)).writeStream.format("parquet").option("path", f"{root}/audit").option(
            "checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(processingTime="0 seconds").start()
        offsets.run_to_end(q, f"{root}/landing", f"{root}/progress")
    return AS.audit(p.spark.read.schema(AS.OUTPUT).parquet(f"{root}/audit"))
