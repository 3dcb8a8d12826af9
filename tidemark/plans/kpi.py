"""Business KPIs over the gold products (K1-K9), as DataFrame plans.

Money stays decimal through the sums so totals do not depend on summation order;
``money_out`` turns the rounded decimal into a double at the edge (D13, D17).
``publish_views`` offers them and the gold products to SQL consumers (S16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import money_out, ratio


def _money(c):
    return money_out(F.round(F.sum(c), 2))


def kpi_events_by_table_op(audit: DataFrame) -> DataFrame:
    """K1: events per table and operation, most frequent first."""
    return (audit.groupBy("source_table", "operation")
            .agg(F.sum("event_count").cast(T.LongType()).alias("nb_events"))
            .orderBy(F.desc("nb_events"), "source_table", "operation"))


def kpi_latency_by_table(audit: DataFrame) -> DataFrame:
    """K2: mean of the per-(operation, day) mean latencies, as the reference."""
    return (audit.groupBy("source_table")
            .agg(F.round(F.avg("avg_latency_seconds"), 2).alias("avg_latency_sec")))


def kpi_latency_weighted(audit: DataFrame) -> DataFrame:
    """K2, weighted by events: the true mean latency per event."""
    return (audit.groupBy("source_table")
            .agg(F.round(ratio(F.sum("latency_ms_total"), F.sum("event_count")) / 1000.0, 2)
                 .alias("avg_latency_sec")))


def kpi_orders_by_day(orders: DataFrame, days: int = 30) -> DataFrame:
    """K3: orders and revenue per day, the latest ``days`` days (a top-k report)."""
    return (orders.groupBy("order_day")
            .agg(F.count(F.lit(1)).alias("nb_orders"), _money("total_amount").alias("revenue"))
            .orderBy(F.desc("order_day")).limit(days))


def kpi_revenue_by_category(facts: DataFrame) -> DataFrame:
    """K4: revenue and distinct orders per product category, uncancelled lines."""
    return (facts.filter(F.col("is_cancelled") == 0).groupBy("product_category")
            .agg(_money("line_revenue").alias("revenue"),
                 F.count_distinct("order_id").alias("nb_orders"))
            .orderBy(F.desc("revenue"), "product_category"))


def kpi_payments_by_method(payments_summary: DataFrame) -> DataFrame:
    """K5: completed payments per month, year and method."""
    return (payments_summary.filter(F.col("status") == "completed")
            .groupBy("payment_month", "payment_year", "method")
            .agg(F.sum("nb_payments").cast(T.LongType()).alias("nb"),
                 _money("total_amount").alias("amount"))
            .orderBy(F.desc("payment_year"), F.desc("payment_month"), "method"))


def kpi_cancellation_rate(orders: DataFrame) -> DataFrame:
    """K6: percent of live orders cancelled; NULL for no orders."""
    return orders.agg(F.round(F.sum("is_cancelled").cast(T.DoubleType()) * 100.0
                              / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)
                      .alias("cancellation_rate_pct"))


def kpi_sales_by_segment_channel(facts: DataFrame) -> DataFrame:
    """K7: distinct orders and revenue per customer segment and channel."""
    return (facts.filter(F.col("is_cancelled") == 0).groupBy("customer_segment", "channel")
            .agg(F.count_distinct("order_id").alias("nb_orders"),
                 _money("line_revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "customer_segment", "channel"))


def kpi_top_customers(facts: DataFrame, k: int = 10) -> DataFrame:
    """K8: the ``k`` customers with the highest uncancelled revenue (ties by id)."""
    return (facts.filter(F.col("is_cancelled") == 0)
            .groupBy("customer_id", "customer_name", "customer_segment")
            .agg(F.count_distinct("order_id").alias("nb_orders"),
                 F.round(F.sum("line_revenue"), 2).alias("_rev"))
            .orderBy(F.desc("_rev"), "customer_id").limit(k)
            .select("customer_id", "customer_name", "customer_segment", "nb_orders",
                    money_out(F.col("_rev")).alias("total_revenue")))


def kpi_returns_by_reason(returns_summary: DataFrame) -> DataFrame:
    """K9: returns and refunds per reason and status."""
    return (returns_summary.groupBy("reason", "status")
            .agg(F.sum("nb_returns").cast(T.LongType()).alias("nb"),
                 _money("total_refund").alias("refund"))
            .orderBy(F.desc("nb"), "reason", "status"))


# KPI -> (builder, the gold product that it reads)
KPI_BUILDERS = {
    "kpi_events_by_table_op": (kpi_events_by_table_op, "cdc_audit"),
    "kpi_latency_by_table": (kpi_latency_by_table, "cdc_audit"),
    "kpi_latency_weighted": (kpi_latency_weighted, "cdc_audit"),
    "kpi_orders_by_day": (kpi_orders_by_day, "orders"),
    "kpi_revenue_by_category": (kpi_revenue_by_category, "sales_facts"),
    "kpi_payments_by_method": (kpi_payments_by_method, "payments_summary"),
    "kpi_cancellation_rate": (kpi_cancellation_rate, "orders"),
    "kpi_sales_by_segment_channel": (kpi_sales_by_segment_channel, "sales_facts"),
    "kpi_top_customers": (kpi_top_customers, "sales_facts"),
    "kpi_returns_by_reason": (kpi_returns_by_reason, "returns_summary"),
}


def build_kpis(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: build(gold[product]) for n, (build, product) in KPI_BUILDERS.items()}


def publish_views(gold: dict[str, DataFrame], kpis: dict[str, DataFrame],
                  names: list[str]) -> None:
    """Temp views ``gold_<product>`` and ``kpi_<name>`` for SQL consumers."""
    for n in names:
        df = kpis[n] if n in KPI_BUILDERS else gold[n]
        df.createOrReplaceTempView(n if n in KPI_BUILDERS else f"gold_{n}")


# Table functions over the views that ``publish_views`` makes; reports with parameters.
FUNCTIONS = {
    "gold_top_customers": ("""
        CREATE OR REPLACE TEMPORARY FUNCTION gold_top_customers(k INT)
        RETURNS TABLE (place INT, customer_id BIGINT, customer_name STRING, total_revenue DECIMAL(38,2), nb_orders BIGINT)
        RETURN SELECT place, customer_id, customer_name, total_revenue, nb_orders FROM (
          SELECT row_number() OVER (ORDER BY sum(line_revenue) DESC, customer_id) AS place, customer_id,
                 max(customer_name) AS customer_name, sum(line_revenue) AS total_revenue,
                 count(DISTINCT order_id) AS nb_orders
          FROM gold_sales_facts WHERE is_cancelled = 0 GROUP BY customer_id) WHERE place <= k"""),
    "gold_sales_between": ("""
        CREATE OR REPLACE TEMPORARY FUNCTION gold_sales_between(first_day DATE, last_day DATE)
        RETURNS TABLE (product_category STRING, revenue DECIMAL(38,2), nb_orders BIGINT)
        RETURN SELECT product_category, sum(line_revenue), count(DISTINCT order_id) FROM gold_sales_facts
        WHERE is_cancelled = 0 AND order_day BETWEEN first_day AND last_day GROUP BY product_category"""),
    "gold_segment_orders": ("""
        CREATE OR REPLACE TEMPORARY FUNCTION gold_segment_orders(wanted STRING)
        RETURNS TABLE (order_year INT, channel STRING, nb_orders BIGINT, revenue DECIMAL(38,2))
        RETURN SELECT order_year, channel, count(*), sum(total_amount) FROM gold_orders
        WHERE customer_segment <=> wanted AND is_cancelled = 0 GROUP BY order_year, channel"""),
}


def publish_functions(spark, names: list[str] | None = None) -> None:
    """SQL table functions over the published gold views (S16): top k, period, segment."""
    for n in names or FUNCTIONS:
        spark.sql(FUNCTIONS[n])
