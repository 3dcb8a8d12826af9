"""Gold facts kept up to date by change propagation.

From the keys that changed in the four tables follow the orders whose facts may differ: the
orders themselves, orders of changed customers, orders of changed lines, orders with lines of
changed products.  Each is a semi-join that starts from the changed keys.  Only those orders'
facts are built again, and only the buckets of the stored facts that hold them are rewritten.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.gold import gold_sales_facts
from tidemark.sources.store import BUCKETS, Store, free


def affected_orders(silver: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """Order ids whose facts the changed keys can reach; ``silver`` holds the new states."""
    orders, items = silver["orders"], silver["order_items"]
    found = [
        changed["orders"].select("order_id"),
        changed["order_items"].select("order_id"),
        orders.join(changed["customers"].select("customer_id").distinct(), "customer_id", "left_semi").select("order_id"),
        items.join(changed["products"].select("product_id").distinct(), "product_id", "left_semi").select("order_id")]
    return functools.reduce(DataFrame.unionByName, found).distinct()


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")


def _facts(silver: dict[str, DataFrame], orders: DataFrame | None = None) -> DataFrame:
    kept = {t: silver[t] if orders is None else silver[t].join(orders, "order_id", "left_semi") for t in ("order_items", "orders")}
    return gold_sales_facts(kept["order_items"], kept["orders"], silver["products"], silver["customers"])


def build_facts(store: Store, name: str, silver: dict[str, DataFrame], buckets: int = BUCKETS) -> int:
    """The whole facts table, stored by buckets of the order."""
    return store.write(_facts(silver).withColumn("bucket", _bucket(buckets)).hint("rebalance", F.col("bucket")),
                       name, ["bucket"])


def refresh_facts(store: Store, name: str, silver: dict[str, DataFrame], changed: dict[str, DataFrame],
                  buckets: int = BUCKETS) -> list[int]:
    """Brings stored facts to the new states; returns the rewritten buckets."""
    store.write(affected_orders(silver, changed).withColumn("bucket", _bucket(buckets)), f"{name}_affected")
    affected = store.read(f"{name}_affected")
    touched = sorted(r[0] for r in affected.select("bucket").distinct().collect())  # at most ``buckets``
    held = store.read(name).where(F.col("bucket").isin(touched)).join(affected, "order_id", "left_anti")
    fresh = _facts(silver, affected.select("order_id")).withColumn("bucket", _bucket(buckets))
    rows = held.unionByName(fresh)
    store.write(rows.hint("rebalance", F.col("bucket")), f"{name}_fresh", ["bucket"])
    store.drop(f"{name}_affected")
    free(store.spark)
    # written once and moved; a bucket that lost its last order is dropped
    store.replace(name, f"{name}_fresh", [f"bucket={b}" for b in touched])
    return touched
