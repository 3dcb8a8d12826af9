"""Operator 5 (DataFrame functions only): Merkle fingerprints of texts.

Tree: paragraphs (lines) are leaves with the MD5 of their text, sections (between blank
lines) hash their paragraphs' hashes, and the root, SHA-256 over the sections' hashes, is
the fingerprint.  Both splits lose nothing, so equal roots mean equal texts, and where
roots differ the differing sections and paragraphs locate the edit (``edited_branches``).

Likeness compares below the leaves: each paragraph is a run of pieces, sentence ends or
at most ``PIECE`` characters, and the likeness of two trees is the Dice coefficient of
their sets of distinct pieces.  Two empty texts are alike (1), an empty and another not.

Edge cases: null text counts as empty; rows that repeat a doc_id follow each other in the
order of their texts; rows with a null doc_id come first; the document after the last is
the first, and a sole document follows itself; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

PIECE = 48
_PIECES = rf"(?s).{{1,{PIECE}}}?(?:[.!?]+\s+|\n+|\z)|.{{{PIECE}}}"


def _paragraphs(section: Column) -> Column:
    return F.transform(F.split(section, "\n"), lambda p: F.md5(p))


def tree(text: Column) -> Column:
    """Array of sections, each the array of its paragraphs' hashes."""
    return F.transform(F.split(text, "\n\n"), _paragraphs)


def root(nodes: Column) -> Column:
    return F.sha2(F.concat_ws(" ", F.transform(nodes, lambda s: F.md5(F.concat_ws(" ", s)))), 256)


def pieces(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)),
                                        lambda p: F.xxhash64(p)))


def likeness(a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def edited_branches(a: Column, b: Column) -> Column:
    """Where two trees differ: (section, paragraph) numbers from 0, paragraph -1 where a
    whole section is missing on one side."""
    numbers = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)

    def section(k):
        x, y = F.get(a, k), F.get(b, k)
        inner = F.filter(F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1),
                         lambda p: ~F.get(x, p).eqNullSafe(F.get(y, p)))
        whole = F.array(F.struct(k.alias("section"), F.lit(-1).alias("paragraph")))
        return F.when(x.isNull() | y.isNull(), whole).otherwise(
            F.transform(inner, lambda p: F.struct(k.alias("section"), p.alias("paragraph"))))
    return F.flatten(F.transform(numbers, section))


def with_next(scratch: Scratch, docs: DataFrame, carried: list[str]) -> DataFrame:
    """Adds next_<c> of the next document in ascending doc_id; after the last, the first.

    Documents are dealt to about sqrt(n) ranges of doc_id, each ordered by a task; the
    first document of each range also goes to the range before, so texts are shuffled
    once and no task sees more than a range.
    """
    n, lo, hi = docs.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = lo or 0, hi or 0
    width = max(1, math.ceil((hi - lo + 1) / max(1, math.isqrt(n))))
    docs = docs.withColumn("_at", F.coalesce("doc_id", F.lit(lo - 1))).withColumn(
        "_range", F.floor((F.col("_at") - lo) / width))
    firsts = docs.groupBy("_range").agg(F.min("_at").alias("_at"))
    before = F.lag("_range").over(Window.orderBy("_range"))
    last = F.max("_range").over(Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = scratch.write(
        firsts.select("_at", F.coalesce(before, last).alias("_to"),
                      before.isNull().alias("_wraps")), "firsts")
    ghosts = (docs.join(firsts, "_at").groupBy("_to", "_wraps", "_at")
              .agg(F.min(F.struct("text", *carried)).alias("x"))
              .select(F.col("_to").alias("_range"), "_wraps", "_at", "x.text", *(f"x.{c}" for c in carried)))
    rows = (docs.withColumn("_ghost", F.lit(False)).withColumn("_wraps", F.lit(False))
            .unionByName(ghosts.withColumn("_ghost", F.lit(True)), allowMissingColumns=True))
    order = Window.partitionBy("_range").orderBy("_wraps", "_at", "_ghost", "text")
    return rows.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *carried))).where(
        ~F.col("_ghost")).drop("_at", "_range", "_ghost", "_wraps")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 4) characters replaced by the first as
    many (or all) of the next document.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    full = with_next(scratch, docs.withColumn("pieces", pieces(F.col("text"))), ["pieces"])
    full = full.withColumn("n_chars", F.length("text").cast("long"))
    moved = F.floor(F.col("n_chars") / 4).cast("int")
    full = full.withColumn("edited", F.concat(
        F.left("text", F.col("n_chars").cast("int") - moved), F.left("next_text", moved)))
    full = full.withColumn("edited_pieces", pieces(F.col("edited")))
    return full.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        root(tree(F.col("text"))).alias("fingerprint"), root(tree(F.col("edited"))).alias("edited_fingerprint"),
        likeness(F.col("pieces"), F.col("edited_pieces")).alias("near_edited"),
        likeness(F.col("pieces"), F.col("next_pieces")).alias("near_next"))


ORACLE = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
n as (select *, length(text) as n_chars, row_number() over (order by doc_id nulls first, text) as k,
      count(*) over () as m from d),
e as (select a.doc_id, a.text, a.n_chars, b.text as next_text,
      substr(a.text, 1, a.n_chars - a.n_chars // 4) || substr(b.text, 1, a.n_chars // 4) as edited
      from n a join n b on b.k = a.k % a.m + 1),
p as (select *, list_distinct(regexp_extract_all(text, '{_PIECES}')) as x,
      list_distinct(regexp_extract_all(next_text, '{_PIECES}')) as y,
      list_distinct(regexp_extract_all(edited, '{_PIECES}')) as z from e)
select doc_id, n_chars, sha256(edited) as edited_sha256,
  sha256(array_to_string(list_transform(string_split(text, chr(10) || chr(10)), lambda s:
    md5(array_to_string(list_transform(string_split(s, chr(10)), lambda q: md5(q)), ' '))), ' ')) as fingerprint,
  sha256(array_to_string(list_transform(string_split(edited, chr(10) || chr(10)), lambda s:
    md5(array_to_string(list_transform(string_split(s, chr(10)), lambda q: md5(q)), ' '))), ' ')) as edited_fingerprint,
  case when len(x) + len(z) = 0 then 1.0::double
       else 2.0::double * len(list_intersect(x, z)) / (len(x) + len(z)) end as near_edited,
  case when len(x) + len(y) = 0 then 1.0::double
       else 2.0::double * len(list_intersect(x, y)) / (len(x) + len(y)) end as near_next
from p
"""
