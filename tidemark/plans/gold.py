"""Gold data products (G1-G6) over silver state and the bronze log.

Each builder takes DataFrames and returns a DataFrame; the store decides where it
lands.  Joins are written facts-first; the planner picks broadcast only when a
side's measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
re-checks at run time), otherwise both sides shuffle on the key and AQE splits
skewed key partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import is_live, ratio

# Partition column of each gold product in the store.
GOLD_PARTITIONS = {"orders": "order_year", "sales_facts": "order_year",
                   "payments_summary": "payment_year"}


def _calendar(ts_col: str, prefix: str) -> list:
    c = F.col(ts_col)
    return [F.to_date(c).alias(f"{prefix}_day"), F.month(c).alias(f"{prefix}_month"),
            F.year(c).alias(f"{prefix}_year")]


def _cancelled(status):
    return F.when(status == "cancelled", 1).otherwise(0)


def gold_customers(customers: DataFrame) -> DataFrame:
    """Live customers (G1); ``is_active`` is carried, not tested."""
    return customers.filter(is_live(F.col("_is_deleted"))).select(
        "customer_id", "name", "email", "city", "country", "segment",
        "registration_date", "is_active", "_cdc_ts", "_silver_updated_at")


def live_customer_dim(customers: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Live customers projected for a join: the delete filter sits on the nullable
    side, before the join, which is what the ON-clause predicate means (P10)."""
    return customers.filter(is_live(F.col("_is_deleted"))).select(
        F.col("customer_id").alias("_c_id"), *[F.col(k).alias(v) for k, v in cols.items()])


def gold_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Live orders with live-customer attributes, calendar parts and the cancelled
    flag (G2, J2): an order of a deleted customer stays, with NULL attributes."""
    o = orders.filter(is_live(F.col("_is_deleted")))
    c = live_customer_dim(customers, {"name": "customer_name", "segment": "customer_segment",
                                      "city": "customer_city"})
    j = o.join(c, o.customer_id == c._c_id, "left")
    return j.select(
        "order_id", "customer_id", "customer_name", "customer_segment", "customer_city",
        "order_date", *_calendar("order_date", "order"), "status", "channel", "total_amount",
        _cancelled(F.col("status")).alias("is_cancelled"), "_cdc_ts", "_silver_updated_at")


def gold_sales_facts(items: DataFrame, orders: DataFrame, products: DataFrame,
                     customers: DataFrame) -> DataFrame:
    """One row per live order line of a live order."""
    i = items.filter(is_live(F.col("_is_deleted"))).select(
        "order_id", "line_no", "product_id", "quantity", "unit_price")
    o = orders.filter(is_live(F.col("_is_deleted"))).select(
        F.col("order_id").alias("_o_id"), "customer_id", "order_date", "channel", "status")
    p = products.filter(is_live(F.col("_is_deleted"))).select(
        F.col("product_id").alias("_p_id"), F.col("name").alias("product_name"),
        F.col("category").alias("product_category"), F.col("brand").alias("product_brand"))
    c = live_customer_dim(customers, {"name": "customer_name", "segment": "customer_segment",
                                      "city": "customer_city"})
    # an order meets its customer once, not with each of its lines
    o = o.join(c, o.customer_id == c._c_id, "left")
    j = i.join(o, i.order_id == o._o_id, "inner").join(p, i.product_id == p._p_id, "left")
    return j.select(
        "order_id", "line_no", "product_id", "customer_id", "product_name",
        "product_category", "product_brand", "customer_name", "customer_segment",
        "customer_city", "order_date", *_calendar("order_date", "order"), "channel", "status",
        "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
        _cancelled(F.col("status")).alias("is_cancelled"))


def _segment_chain(facts: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """fact -> order -> customer segment, left joins with *no* delete filter on the
    order or the customer, as in the reference (J4, D9)."""
    o = orders.select(F.col("order_id").alias("_o_id"), F.col("customer_id").alias("_o_cust"))
    c = customers.select(F.col("customer_id").alias("_c_id"),
                         F.col("segment").alias("customer_segment"))
    return (facts.join(o, facts.order_id == o._o_id, "left")
            .join(c, F.col("_o_cust") == c._c_id, "left"))


def gold_payments_summary(payments: DataFrame, orders: DataFrame,
                          customers: DataFrame) -> DataFrame:
    """Per day/month/year, method, status, segment: distinct payments, sum, mean."""
    p = payments.filter(is_live(F.col("_is_deleted"))).select(
        "payment_id", "order_id", "payment_date", "method", "status", "amount")
    j = _segment_chain(p, orders, customers)
    return (j.groupBy(*_calendar("payment_date", "payment"), "method", "status",
                      "customer_segment")
            .agg(F.count_distinct("payment_id").alias("nb_payments"),
                 F.sum("amount").alias("total_amount"),
                 ratio(F.sum("amount"), F.count("amount")).alias("avg_amount")))


def gold_returns_summary(returns: DataFrame, orders: DataFrame,
                         customers: DataFrame) -> DataFrame:
    """Per day/month/year, reason, status, segment: distinct returns, refunds."""
    r = returns.filter(is_live(F.col("_is_deleted"))).select(
        "return_id", "order_id", "return_date", "reason", "status", "refund_amount")
    j = _segment_chain(r, orders, customers)
    return (j.groupBy(*_calendar("return_date", "return"), "reason", "status",
                      "customer_segment")
            .agg(F.count_distinct("return_id").alias("nb_returns"),
                 F.sum("refund_amount").alias("total_refund")))


def _audit_aggs():
    # Latency in exact integer milliseconds; the seconds figure keeps the reference's
    # definition unix_timestamp(kafka_ts) - ts_ms/1000 (whole seconds minus exact, D11),
    # summed as integers so the result does not depend on summation order.
    ref_ms = F.unix_seconds(F.col("kafka_ts")) * 1000 - F.col("cdc_ts_ms")
    exact_ms = F.unix_millis(F.col("kafka_ts")) - F.col("cdc_ts_ms")
    return [F.count(F.lit(1)).alias("event_count"),
            (ratio(F.sum(ref_ms), F.count(ref_ms)) / 1000.0).alias("avg_latency_seconds"),
            ratio(F.sum(exact_ms), F.count(exact_ms)).alias("avg_latency_ms"),
            F.sum(exact_ms).alias("latency_ms_total"),
            F.max("cdc_ts").alias("last_event_ts")]


def gold_cdc_audit(bronze: DataFrame) -> DataFrame:
    """Events, mean latency and last event per table, operation and day.

    One scan grouped by table instead of one scan per table; partial aggregation
    makes the shuffle carry one row per group per map task.
    """
    return (bronze.groupBy(F.col("cdc_table").alias("source_table"),
                           F.col("cdc_op").alias("operation"),
                           F.to_date("cdc_ts").alias("event_day"))
            .agg(*_audit_aggs()))


def union_audit_branches(branches: dict[str, DataFrame]) -> DataFrame:
    """The audit as a union of per-table aggregates (U1, S6): tables whose log is
    missing are skipped before the union, the rest are matched by name."""
    out = None
    for table, df in branches.items():
        if df is None:
            continue
        a = (df.groupBy(F.lit(table).alias("source_table"), F.col("cdc_op").alias("operation"),
                        F.to_date("cdc_ts").alias("event_day"))
             .agg(*_audit_aggs()))
        out = a if out is None else out.unionByName(a)
    return out


# Builders by product: of the silver tables (by name) and a function that gives the events.
GOLD_BUILDERS = {
    "customers": lambda s, events: gold_customers(s["customers"]),
    "orders": lambda s, events: gold_orders(s["orders"], s["customers"]),
    "sales_facts": lambda s, events: gold_sales_facts(
        s["order_items"], s["orders"], s["products"], s["customers"]),
    "payments_summary": lambda s, events: gold_payments_summary(
        s["payments"], s["orders"], s["customers"]),
    "returns_summary": lambda s, events: gold_returns_summary(
        s["returns"], s["orders"], s["customers"]),
    "cdc_audit": lambda s, events: gold_cdc_audit(events()),
}


def build_gold(silver: dict[str, DataFrame], bronze: DataFrame) -> dict[str, DataFrame]:
    return {n: build(silver, lambda: bronze) for n, build in GOLD_BUILDERS.items()}
