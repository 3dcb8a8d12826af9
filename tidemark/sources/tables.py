"""Reading the input tables and the retail relabelling of the driver's tables.

The driver ships TPC-H-like tables; the retail entities the engine works on
(customers, products, orders, order_items, payments, returns) are derived from them
by fixed rules.  Each builder is a lazy DataFrame over the parquet scan, so column
pruning and filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import MONEY

INPUT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations"]

# nation (25 rows) and region (5 rows) are fixed-size reference tables, the only
# inputs broadcast by hint; every other join is left to the size-checked planner.
FIXED_SIZE_TABLES = {"region", "nation"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor for the input tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in INPUT_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def retail_customers(t: Tables) -> DataFrame:
    nation = t.nation
    region = t.region
    c = t.customer
    return (c.join(nation, c.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                c.c_custkey.alias("customer_id"),
                c.c_name.alias("name"),
                F.concat(F.lower(c.c_name), F.lit("@example.com")).alias("email"),
                nation.n_name.alias("city"),
                region.r_name.alias("country"),
                c.c_mktsegment.alias("segment"),
                F.date_add(F.lit("1995-01-01").cast(T.DateType()),
                           (c.c_custkey % 365).cast(T.IntegerType())).alias("registration_date"),
                (c.c_acctbal >= 0).alias("is_active")))


def retail_products(t: Tables) -> DataFrame:
    p = t.part
    return p.select(
        p.p_partkey.alias("product_id"), p.p_name.alias("name"), p.p_type.alias("category"),
        p.p_brand.alias("brand"), p.p_retailprice.cast(MONEY).alias("price"),
        p.p_size.alias("stock_qty"), F.lit(True).alias("is_active"))


def _status(o: DataFrame):
    st, pr = o.o_orderstatus, o.o_orderpriority
    return (F.when((st == "P") & (pr == "5-LOW"), "cancelled")
            .when(st == "P", "pending")
            .when((st == "O") & (pr == "1-URGENT"), "shipped")
            .when(st == "O", "confirmed")
            .otherwise("delivered"))


def _by_mod4(key, labels):
    m = key % 4
    return (F.when(m == 0, labels[0]).when(m == 1, labels[1])
            .when(m == 2, labels[2]).otherwise(labels[3]))


def retail_orders(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        o.o_orderkey.alias("order_id"), o.o_custkey.alias("customer_id"),
        o.o_orderdate.alias("order_date"), _status(o).alias("status"),
        _by_mod4(o.o_orderkey, ["web", "mobile", "store", "phone"]).alias("channel"),
        o.o_totalprice.cast(MONEY).alias("total_amount"))


def retail_order_items(t: Tables) -> DataFrame:
    """One row per line; ``line_no`` numbers the lines inside their order.

    The numbering runs over buckets of 4,096 line numbers, so an order with very many
    lines is spread over several tasks (``number_by_key``).
    """
    from tidemark.operators.sequence import number_by_key
    order_cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    li = t.lineitem.select("l_orderkey", *order_cols)
    numbered = number_by_key(li, "l_orderkey", order_cols, F.floor(F.col("l_linenumber") / 4096), out="_n",
                             keep=["l_partkey", "l_quantity", "l_extendedprice",
                                   "l_returnflag"])
    qty = F.col("l_quantity").cast(T.IntegerType())
    price = F.col("l_extendedprice").cast(MONEY)
    return numbered.select(
        F.col("l_orderkey").alias("order_id"), F.col("_n").alias("line_no"), F.col("l_partkey").alias("product_id"),
        qty.alias("quantity"), price.alias("unit_price"),
        (qty * price).cast(MONEY).alias("subtotal"),
        F.col("l_returnflag").alias("return_flag"))


def retail_payments(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    o = orders if orders is not None else retail_orders(t)
    oid = F.col("order_id")
    return (o.filter(F.col("status").isin("confirmed", "shipped", "delivered") & (oid % 6 != 0))
            .select(oid.alias("payment_id"), oid,
                    (F.col("order_date") + F.expr("INTERVAL 1 DAY")).alias("payment_date"),
                    _by_mod4(oid, ["card", "cash", "transfer", "wallet"]).alias("method"),
                    F.col("total_amount").alias("amount"),
                    F.when(oid % 10 == 0, "failed").otherwise("completed").alias("status")))


def retail_returns(t: Tables, orders: DataFrame | None = None,
                   items: DataFrame | None = None) -> DataFrame:
    o = orders if orders is not None else retail_orders(t)
    # the lines' flags need no numbering of the lines
    returned = (t.lineitem.filter(F.col("l_returnflag") == "R")
                .select(F.col("l_orderkey").alias("order_id")).distinct())
    oid = F.col("order_id")
    return (o.filter(F.col("status") == "delivered").join(returned, "order_id", "left_semi")
            .select(oid.alias("return_id"), oid,
                    (F.col("order_date") + F.expr("INTERVAL 10 DAY")).alias("return_date"),
                    _by_mod4(oid, ["defective", "wrong_item", "changed_mind", "damaged"]).alias("reason"),
                    F.lit("pending").alias("status"),
                    F.round(F.col("total_amount") * F.lit(0.8).cast(T.DecimalType(2, 1)), 2)
                    .cast(MONEY).alias("refund_amount")))


class LazyFrames(dict):
    """Name -> DataFrame, each built on first use (some builders run a job)."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        df = self._builders[name]()
        self[name] = df
        return df

    def names(self) -> list[str]:
        return list(self._builders)

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name) -> bool:
        return name in self._builders

    def keys(self):
        return self._builders.keys()

    def values(self):
        return [self[n] for n in self._builders]

    def items(self):
        return [(n, self[n]) for n in self._builders]


def retail_views(t: Tables) -> LazyFrames:
    v: LazyFrames
    v = LazyFrames({
        "customers": lambda: retail_customers(t),
        "products": lambda: retail_products(t),
        "orders": lambda: retail_orders(t),
        "order_items": lambda: retail_order_items(t),
        "payments": lambda: retail_payments(t, v["orders"]),
        "returns": lambda: retail_returns(t, v["orders"], v["order_items"]),
    })
    return v
