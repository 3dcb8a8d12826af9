"""Data-quality operators: rules the source database enforced, rebuilt as jobs.

All are aggregations or anti-joins; partial aggregation runs before every shuffle,
so a key repeated a billion times costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import CANCELLABLE_FROM, NEXT_STATUS


def pk_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the row count (Q1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def pk_summary(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """One row: rows, distinct keys and duplicated keys of ``table`` (Q1)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast(T.LongType()).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("n_duplicate_keys"))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent row (Q2); NULL references are not
    orphans, as in SQL."""
    p = parent.select(F.col(parent_column).alias("_parent_key"))
    return (child.filter(F.col(column).isNotNull())
            .join(p, F.col(column) == F.col("_parent_key"), "left_anti"))


def fk_orphan_counts(tables: dict[str, DataFrame],
                     foreign_keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """Orphan count for every foreign key (Q2), one join per *parent* table: the
    references of all children pointing at a parent are unioned with a tag, counted
    per distinct value, joined once to the parent's keys, and summed per tag (zero
    counts included)."""
    out = None
    parents = list(dict.fromkeys(fk[2] for fk in foreign_keys))
    for parent in parents:
        refs = None
        pcol = None
        for child, col, par, parent_column in foreign_keys:
            if par != parent:
                continue
            pcol = parent_column
            r = tables[child].filter(F.col(col).isNotNull()).select(
                F.lit(child).alias("child_table"), F.lit(col).alias("fk_column"),
                F.col(col).alias("_ref"))
            refs = r if refs is None else refs.unionByName(r)
        keys = tables[parent].select(F.col(pcol).alias("_key"), F.lit(True).alias("_found"))
        # references counted per distinct value first (partial aggregation map-side):
        # a parent referenced by a third of all rows becomes one row with its count,
        # and the join sees unique keys on both sides
        per_value = refs.groupBy("child_table", "fk_column", "_ref").agg(
            F.count(F.lit(1)).alias("_n"))
        counted = (per_value.join(keys, per_value._ref == keys._key, "left")
                   .groupBy("child_table", "fk_column")
                   .agg(F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_n"))),
                                   F.lit(0)).cast("long").alias("n_orphans"))
                   .withColumn("parent_table", F.lit(parent)))
        out = counted if out is None else out.unionByName(counted)
    return out.select("child_table", "fk_column", "parent_table", "n_orphans")


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per required column (Q3): one aggregation pass, then unpivoted."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return (wide.unpivot([], columns, "column_name", "n_nulls")
            .select(F.lit(table).alias("table_name"), "column_name", "n_nulls"))


def insert_ignore(target: DataFrame, incoming: DataFrame, unique: list[str],
                  order: list[str]) -> DataFrame:
    """Insert-only merge with ``ON CONFLICT DO NOTHING`` on a unique key (Q4).

    Incoming rows whose unique key already exists in ``target`` are dropped; among
    incoming rows sharing a key the first by ``order`` wins.
    """
    # First-wins runs before the anti join (the two commute: every row of a key that
    # exists in the target is dropped either way).  Directly over the input, the
    # rank-1 filter gets a partial limit before its shuffle, so a key repeated a
    # billion times ships one row per map task, and the anti join sees unique keys.
    w = Window.partitionBy(*unique).orderBy(*order)
    first = incoming.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    fresh = first.join(target.select(*unique), unique, "left_anti")
    return target.unionByName(fresh)


def next_status(status: Column) -> Column:
    """Next order status in the lifecycle; NULL at the end of it (Q7)."""
    expr = None
    for k, v in NEXT_STATUS.items():
        expr = F.when(status == k, v) if expr is None else expr.when(status == k, v)
    return expr


def legal_transition(prev: Column, cur: Column) -> Column:
    """A status change is legal if it is no change, one lifecycle step, or a
    cancellation from a cancellable status (Q8)."""
    ok = prev == cur
    for k, v in NEXT_STATUS.items():
        ok = ok | ((prev == k) & (cur == v))
    return ok | (prev.isin(CANCELLABLE_FROM) & (cur == "cancelled"))


def status_transitions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Consecutive status pairs per key in log order (Q8), computed by day of the first
    order column (a timestamp), so a key with a huge history is spread over many tasks."""
    from tidemark.operators.sequence import lag_by_key
    pairs = lag_by_key(rows, key, order, "status", F.to_date(order[0]), out="from_status")
    return (pairs.filter(F.col("from_status").isNotNull())
            .select(key, "from_status", F.col("status").alias("to_status")))


def expected_refund(total: Column, share: float = 0.8, fallback: float = 30.0) -> Column:
    """Refund a return should carry: ``share`` of the order total, a missing or zero
    total counting as ``fallback`` (Q9)."""
    base = F.coalesce(F.nullif(total, F.lit(0)), F.lit(fallback).cast(T.DecimalType(12, 2)))
    return F.round(base * F.lit(share).cast(T.DecimalType(3, 2)), 2).cast(T.DecimalType(12, 2))
