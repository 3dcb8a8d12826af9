"""Per-key sequence operators (previous value, row number) without one task per key.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task; a
key holding a third of the data would be a third of the job in one task.  Here each
key is cut into buckets of its order (``bucket``: a column that never falls as the
order rises, such as the day of a timestamp), a window runs over (key, bucket), and
only what crosses buckets is settled per key, on a few rows a bucket.  One method
for all sizes: built-in windows, no probe of the data, nothing run while the plan is
built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lag_by_key(df: DataFrame, key: str, order: list[str], value: str, bucket: Column,
               out: str = "prev_value") -> DataFrame:
    """``df``'s key, order and value columns plus ``out`` = ``value`` of the previous
    row of the same ``key`` in ``order`` (NULL for a key's first row).  The order
    columns must give a total order within a key, and ``bucket`` must not fall along it.

    A row's predecessor is in its bucket, or it is the last row of the key's previous
    bucket: the first and last rows of the buckets, at most two a bucket, go through
    a second window over the key."""
    cols = list(dict.fromkeys([key, *order, value]))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    rows = (df.select(*cols, bucket.alias("_bucket"))
            .select("*", F.row_number().over(inside).alias("_n"),
                    F.lag(value).over(inside).alias("_prev"),
                    F.lead(F.lit(1)).over(inside).alias("_next")))
    later = rows.filter(F.col("_n") > 1).select(*cols, F.col("_prev").alias(out))
    across = Window.partitionBy(key).orderBy("_bucket", *order)
    first = (rows.filter((F.col("_n") == 1) | F.col("_next").isNull())
             .withColumn("_prev", F.lag(value).over(across))
             .filter(F.col("_n") == 1).select(*cols, F.col("_prev").alias(out)))
    return later.unionByName(first)


def number_by_key(df: DataFrame, key: str, order: list[str], bucket: Column,
                  out: str = "row_number", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all of ``df``) plus ``out`` = 1-based position of
    the row within its ``key`` in ``order`` (``row_number()`` over the key), for any
    key size; ``bucket`` as in :func:`lag_by_key`.

    A row's number is its number in its bucket plus the rows of the key's earlier
    buckets; those are counted with partial aggregation, and keys of one bucket have
    none, so the joined side holds only keys that span several buckets.

    Window and join go by the same four columns, which are never null.  A null-safe join on
    key and bucket would hash other expressions than the window, and so shuffle and sort all
    rows a second time."""
    cols = list(dict.fromkeys([key, *(keep if keep is not None else df.columns)]))
    base = df.select(*dict.fromkeys([*cols, *order]), bucket.alias("_bucket"))
    place = []
    for c in (key, "_bucket"):
        number = isinstance(base.schema[c].dataType, T.NumericType)
        known = F.coalesce(F.col(c), F.lit(0)) if number else F.coalesce(F.col(c).cast("string"), F.lit(""))
        base = base.withColumn(f"_none_{len(place)}", F.col(c).isNull()).withColumn(f"_at_{len(place)}", known)
        place += base.columns[-2:]
    inside = Window.partitionBy(*place).orderBy(*order)
    rows = base.select(*cols, *place, F.row_number().over(inside).cast(T.LongType()).alias("_n"))
    earlier = Window.partitionBy(*place[:2]).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (base.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"), F.min("_bucket").alias("_bucket"))
               .select(*place, F.sum("_rows").over(earlier).alias("_offset"))
               .filter(F.col("_offset") > 0))
    return (rows.join(offsets, place, "left")
            .select(*cols, (F.col("_n") + F.coalesce("_offset", F.lit(0))).alias(out)))


__all__ = ["lag_by_key", "number_by_key"]
