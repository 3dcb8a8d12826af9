"""Mergeable exact distinct counts: sets of ids per group and day, rolled up by OR (A2).

A distinct count cannot be added up, a set of ids can: ids fall into buckets of 32,768, and a
day's set of a bucket is a bitmap of 4 KiB, or, while it holds fewer than ``DENSE`` ids, the
list of their places in it.  So a day's sets take no more room than its ids, whether these grow
with time (and fill few buckets a day) or are spread over all buckets.  Months, years and any
coarser groups come from the stored days, never from the rows again: bitmaps by
``bitmap_or_agg``, listed places as distinct rows, those that a bitmap holds left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("day", "month", "year")
DENSE = 1024  # ids; a list of them takes the 4 KiB of a bitmap


def daily_bitmaps(rows: DataFrame, groups: list[str], day: str, identity: str) -> DataFrame:
    """Sets of ``identity`` per group, day and bucket of ids: ``ids``, a bitmap, or ``few``, a list."""
    number, at = F.col(identity), [*groups, "day", "bucket"]
    found = rows.where(number.isNotNull()).select(
        *groups, F.col(day).alias("day"), F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).cast("int").alias("place")).distinct()
    listed = found.groupBy(*at).agg(F.collect_list("place").alias("few"))
    dense = listed.where(F.size("few") >= DENSE).select(*at, F.explode("few").alias("place")) \
        .groupBy(*at).agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("ids"))
    return (listed.where(F.size("few") < DENSE).select(*at, F.lit(None).cast("binary").alias("ids"), "few")
            .unionByName(dense.withColumn("few", F.lit(None).cast("array<int>"))))


def _period(level: str) -> Column:
    return F.col("day") if level == "day" else F.trunc("day", level)


def _in_bitmap(ids: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(ids, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


def distinct_counts(bitmaps: DataFrame, groups: list[str], level: str) -> DataFrame:
    """Distinct ids per group and period of a level, from the sets of its days."""
    at = [*groups, "period", "bucket"]
    days = bitmaps.withColumn("period", _period(level))
    dense = days.where(F.col("ids").isNotNull()).groupBy(*at).agg(F.bitmap_or_agg("ids").alias("ids"))
    places = days.where(F.col("ids").isNull()).select(*at, F.explode("few").alias("place")).distinct()
    held = dense.select(*[F.col(c).alias(f"_{c}") for c in at], F.col("ids").alias("_ids"))
    same = F.lit(True)
    for c in at:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    more = places.join(held, same, "left").where(F.col("_ids").isNull() | ~_in_bitmap(F.col("_ids"), F.col("place")))
    counts = dense.select(*groups, "period", F.bitmap_count("ids").alias("n")).unionByName(
        more.groupBy(*groups, "period").agg(F.count("*").alias("n")))
    return counts.groupBy(*groups, "period").agg(F.sum("n").alias("n_distinct")).withColumn("level", F.lit(level))
