"""Operator 3 (DataFrame functions only): mixing sources to target weights, Pfair.

Each source's documents, in the order of a hash, fill blocks of about ``BLOCK`` characters.
Block i (from 0) of a source of weight w, the weights summing to one, is released at
floor(i / w) and due at ceil((i + 1) / w); earliest-deadline-first over the released blocks
takes one block a slot.  No weight is rounded, and each block keeps its window, so at any
time each source has had its share to within one block.

No window is longer than a range of slots, and the order is settled range by range of the
deadlines.  What waits a range earlier is all due before the range's deadlines, so there
only its number counts, and that follows from the releases; so ranges are separate rows.
A range is as long as the longest window, that is as one block of the rarest source takes.

A source that ends leaves its later slots out, so the others go on in their proportions;
no document is dropped.  ``in_mix`` tells the slots before the first source ends, where the
mix is exact.  Default weights are the square roots of the sources' sizes (temperature 2).
A source of no weight has no part in the mix: its blocks follow after all others, without
release and deadline.

Edge cases: null source is a source of its own, named "(none)" (a source whose name begins so
gets a dot at its end); null text has one character's weight, as an empty one, and a very long
one fills the slots of the blocks that it covers; rows that repeat a doc_id are ordered by
their text's hash; null doc_id rows come in their hash's place; equal deadlines go by source
name; an empty table gives an empty result; further columns are carried along, one with the
name of an added column as ``input_<name>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, set_aside

BLOCK = 65_536  # characters
RANGE = 2048  # slots settled in a row, at least
NEAR = 1e-12  # a quotient this near a whole number is that number
ROWS_A_BUCKET = 2000
NO_SOURCE = "(none)"
ADDED = ["source_name", "block", "slot", "place", "release", "deadline", "in_mix"]


def _source() -> Column:
    s = F.col("source").cast("string")
    return F.when(s.startswith(NO_SOURCE), F.concat(s, F.lit("."))).otherwise(F.coalesce(s, F.lit(NO_SOURCE)))


def _order() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def shares(sizes: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """(source, size, quota): target weight of each source, not rounded; 0 if it has none."""
    if weights is None:
        w = F.sqrt(F.col("size").cast("double"))
    elif weights:
        given = F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))))
        w = F.coalesce(given[F.col("source")], F.lit(0.0))
    else:
        w = F.lit(0.0)
    return sizes.select("source", "size", F.greatest(w, F.lit(0.0)).alias("quota"))


def schedule(quota: DataFrame) -> DataFrame:
    """(source, block, release, deadline, slot) of all blocks of the sources of some weight.

    quota: (source, quota, blocks), ``quota`` being the weight in any unit; without
    ``blocks`` each has as many as its quota, which for whole quotas is one period.
    """
    if "blocks" not in quota.columns:
        quota = quota.withColumn("blocks", F.col("quota"))
    quota = quota.where("quota > 0")
    one = quota.agg(F.sum("quota").cast("double").alias("total"), F.min("quota").cast("double").alias("least")).first()
    total, least = one["total"] or 1.0, one["least"] or 1.0
    span = max(RANGE, int(total / least) + 3)
    blocks = quota.select("source", (F.lit(total) / F.col("quota")).alias("each"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))
    blocks = blocks.select(
        "source", "block", F.floor(F.col("block") * F.col("each") * (1 + NEAR)).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("each") * (1 - NEAR)).alias("deadline"))
    # how many wait at a range's end: releases so far less slots so far, over its least so far
    at = blocks.groupBy("release").agg(F.count("*").alias("n")).withColumn("range", F.floor(F.col("release") / span))
    inside = Window.partitionBy("range").orderBy("release").rowsBetween(Window.unboundedPreceding, -1)
    ranges = at.withColumn("earlier", F.coalesce(F.sum("n").over(inside), F.lit(0))).groupBy("range").agg(
        F.sum("n").alias("n"), F.min(F.col("earlier") - F.col("release")).alias("low"))
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)  # one row a range
    ranges = ranges.withColumn("all", F.sum("n").over(so_far))
    ranges = ranges.withColumn("low", F.min(F.col("low") + F.col("all") - F.col("n")).over(so_far))
    waiting = ranges.select(
        (F.col("range") + 2).alias("range"),
        F.greatest(F.lit(0), F.col("all") - (F.col("range") + 1) * span - F.col("low")).cast("int").alias("waiting"))
    # each block is in the range of its release and the next; its deadline is in one of them
    own = F.floor(F.col("release") / span)
    events = blocks.withColumn("range", F.explode(F.array(own, own + 1))).groupBy("range", "release").agg(
        F.collect_list(F.struct("deadline", "source", "block")).alias("new"))
    events = events.groupBy("range").agg(F.array_sort(F.collect_list(F.struct("release", "new"))).alias("events"))
    events = events.join(waiting, "range", "left")

    def step(state, k):
        now = F.get(F.col("events"), k)
        until = F.get(F.col("events"), k + 1)["release"]
        queue = F.array_sort(F.concat(state["queue"], now["new"]))

        def serve(q):
            n = F.least(F.size(q).cast("long"), F.coalesce(until - now["release"], F.size(q).cast("long"))).cast("int")
            taken = F.transform(F.slice(q, 1, n), lambda x, i: F.struct(
                x["source"].alias("source"), x["block"].alias("block"), x["deadline"].alias("deadline"),
                (now["release"] + i).alias("slot")))
            return F.struct(F.slice(q, n + 1, F.size(q)).alias("queue"),
                            F.concat(state["out"], F.filter(taken, lambda x: x["block"] >= 0)).alias("out"))
        return F.get(F.transform(F.array(queue), serve), 0)

    someone = F.struct(F.lit(-1).cast("long").alias("deadline"), F.lit("").alias("source"),
                       F.lit(-1).cast("long").alias("block"))
    gone = F.get(F.col("events"), 0)["release"] - (F.col("range") - 1) * span
    left = F.greatest(F.lit(0), F.coalesce("waiting", F.lit(0)) - gone).cast("int")
    none = F.expr("cast(array() as array<struct<source:string,block:bigint,deadline:bigint,slot:bigint>>)")
    start = F.struct(
        F.array_repeat(someone, left).cast("array<struct<deadline:bigint,source:string,block:bigint>>").alias("queue"),
        none.alias("out"))
    # each step copies its output, so that is gathered for about sqrt(events) steps at a time
    size = F.size("events")
    run = F.ceil(F.sqrt(size)).cast("int")

    def steps(state, k):
        few = F.aggregate(F.sequence(k * run, F.least((k + 1) * run, size) - 1),
                          F.struct(state["queue"].alias("queue"), none.alias("out")), step)
        return F.get(F.transform(F.array(few), lambda x: F.struct(
            x["queue"].alias("queue"), F.concat(state["out"], x["out"]).alias("out"))), 0)

    out = F.aggregate(F.sequence(F.lit(0), F.floor((size - 1) / run).cast("int")), start, steps)["out"]
    rows = events.select("range", F.explode(out).alias("x")).select("range", "x.*")
    rows = rows.where(F.floor((F.col("deadline") - 1) / span) == F.col("range"))
    return rows.drop("range", "deadline").join(blocks, ["source", "block"]).select(
        "source", "block", "release", "deadline", "slot")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with source_name, block, slot, place (in its block), release, deadline, in_mix.

    (slot, place) orders the mixed corpus.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    docs, columns = set_aside(docs, ["doc_id", "text", "source"], ADDED)
    docs = docs.withColumn("_source", _source())
    docs = docs.withColumn("_size", F.length(F.coalesce("text", F.lit(""))).cast("long") + 1)
    docs = docs.withColumn("_order", _order()).withColumn("_tie", F.md5(F.coalesce("text", F.lit(""))))
    # ranges of the hash, so a source that holds a third of the rows is many tasks
    digits, n = 1, docs.count()
    while 16 ** digits * ROWS_A_BUCKET < n and digits < 15:
        digits += 1
    docs = docs.withColumn("_bucket", F.substring("_order", 1, digits))
    cells = scratch.write(docs.groupBy("_source", "_bucket").agg(F.sum("_size").alias("size")), "cells")
    quota = shares(cells.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("size")), weights)
    quota = scratch.write(quota.withColumn("blocks", F.floor((F.col("size") - 1) / block) + 1), "quotas")
    slots = scratch.write(schedule(quota), "slots")
    running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.write(
        cells.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0))).drop("size"), "offsets")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_order", "doc_id", "_tie").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = docs.join(offsets, ["_source", "_bucket"]).withColumn(
        "_start", F.col("before") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    rows = rows.withColumn("block", F.floor(F.col("_start") / block).cast("long"))
    # the first source to end: no slot after its last block is an exact mix
    total = quota.agg(F.sum("quota").alias("total"))
    end = quota.where("quota > 0").crossJoin(total).agg(
        F.min(F.ceil(F.col("blocks") * (F.col("total") / F.col("quota")) * (1 - NEAR))).alias("_end"))
    # sources of no weight, one row each, after the last slot
    last = slots.agg(F.coalesce(F.max("slot") + 1, F.lit(0)).alias("_last"))
    others = quota.where("quota <= 0").withColumn("_before", F.coalesce(F.sum("blocks").over(
        Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    others = others.crossJoin(last).select(F.col("source").alias("_source"), (F.col("_before") + F.col("_last")).alias("_first"))
    rows = rows.join(slots.withColumnRenamed("source", "_source"), ["_source", "block"], "left")
    rows = rows.join(others, "_source", "left").crossJoin(end)
    rows = rows.withColumn("slot", F.coalesce("slot", F.col("_first") + F.col("block")).cast("long"))
    place = Window.partitionBy("_source", "block").orderBy("_start")
    return rows.select(
        *columns, F.col("_source").alias("source_name"), "block", "slot",
        F.row_number().over(place).cast("long").alias("place"), "release", "deadline",
        F.coalesce((F.col("slot") < F.col("_end")) & F.col("release").isNotNull(), F.lit(False)).alias("in_mix"))


ORACLE = f"""
with recursive d as (
  select doc_id, case when starts_with(source, '{NO_SOURCE}') then source || '.' else coalesce(source, '{NO_SOURCE}') end
           as source_name, length(coalesce(text, '')) + 1 as size,
         md5(coalesce(doc_id::varchar, '')) as o, md5(coalesce(text, '')) as tie from documents),
sizes as (select source_name, sum(size)::bigint as size from d group by 1),
w as (select source_name, (size - 1) // {BLOCK} + 1 as blocks, row_number() over (order by source_name) as k,
        sum(sqrt(size::double)) over () / sqrt(size::double) as each from sizes),
e(slot, pick, done) as (
  select -1::bigint, 0::bigint, list_transform(range(count(*)), lambda x: 0::bigint) from w
  union all
  select slot + 1, p, list_transform(range(len(done)), lambda i: done[i + 1] + (case when i + 1 = p then 1 else 0 end)::bigint)
  from (select e.slot, e.done, (select w.k from w
          where e.done[w.k] < w.blocks and floor(e.done[w.k] * w.each * (1 + {NEAR})) <= e.slot + 1
          order by ceil((e.done[w.k] + 1) * w.each * (1 - {NEAR})), w.k limit 1) as p
        from e where list_sum(e.done) < (select sum(blocks) from w))),
t as (select w.source_name, w.each, e.slot, row_number() over (partition by w.k order by e.slot) - 1 as block
      from e join w on w.k = e.pick),
b as (select d.*, (coalesce(sum(size) over (partition by source_name order by o, doc_id nulls first, tie
        rows between unbounded preceding and 1 preceding), 0))::bigint as start_at from d)
select doc_id, source_name, block::bigint as block, slot,
  row_number() over (partition by source_name, block order by start_at)::bigint as place,
  floor(block * each * (1 + {NEAR}))::bigint as release, ceil((block + 1) * each * (1 - {NEAR}))::bigint as deadline,
  slot < (select min(ceil(blocks * each * (1 - {NEAR}))) from w) as in_mix
from (select *, start_at // {BLOCK} as block from b) join t using (source_name, block)
"""
