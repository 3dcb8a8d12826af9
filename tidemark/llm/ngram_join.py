"""Operator 8: word-shingle Jaccard self-join with token-combination prefixes.

Documents link when 100 * |A & B| >= 80 * |A | B| on their sets of distinct five-word
shingles.  Tokens are ordered rare classes first.  If two sets link, each lacks at most
t = n - ceil(0.8 n) tokens of the other, so a prefix that would cost more than t tokens
to miss must be hit:

* rare tokens are indexed one by one; a prefix of t + 1 rare tokens is enough;
* frequent tokens fall into small subclasses; two tokens of one subclass form one
  key, so a subclass with c tokens costs c - 1 to miss without sharing a pair, and the
  prefix is extended subclass by subclass until the costs reach t + 1.

Frequent tokens come from a count sketch over all tokens (constant size, built by
grouped aggregation).  Any classification gives the same result; it only moves cost.
Candidates are verified on the whole sets, compared in exact integers.

Edge cases: null or wordless text has an empty set, its own component and no links;
fewer than five words form one shingle; rows with equal sets are one class; a null
doc_id keeps its row with a null component; of rows that repeat a doc_id each keeps the
component of its own set;
further columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Scratch, bounded_batches, link_groups, mix, shard_groups, shared_keys, shingle_sets, text_rows,
)

WORDS = 5
PERCENT = 80
CELLS = 1 << 17  # of each of the sketch's rows
ROWS = 3
PART = 1 << 13  # cells of the sketch that a task sends as one row
LEAST_FREQUENT = 32
MOST_FREQUENT = 1 << 22  # bound on the number of frequent tokens, whatever the input
TOKENS_PER_SHARD = 150_000


def _allowed(n):
    """Tokens that a set of n may lack of a linked one."""
    return n - -(-PERCENT * n // 100)


def _sets(batches):
    for batch, i, j, data, off in text_rows(batches):
        sets = shingle_sets(data, off, WORDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(i, j - i),
             pa.array(np.array([len(s) for s in sets], np.int64)), pa.array(_class_ids(sets)),
             pa.array([histogram(s).tobytes() for s in sets], pa.binary()), batch.column(2).slice(i, j - i)],
            ["doc_id", "n_shingles", "id", "h", "hash"])


def _cells(tokens: np.ndarray) -> list[np.ndarray]:
    """The token's cell in each row of the sketch."""
    h = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    return [((h >> np.uint64(20 * r)) % np.uint64(CELLS)).astype(np.int64) for r in range(ROWS)]


def _sketch(batches):
    count = np.zeros((ROWS, CELLS), dtype=np.int64)
    for _, _, _, data, off in text_rows(batches):
        sets = shingle_sets(data, off, WORDS)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        for r, cell in enumerate(_cells(tokens)):
            count[r] += np.bincount(cell, minlength=CELLS)
    parts = count.reshape(-1, PART)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(parts))), pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())],
        ["part", "counts"])


def _heavy(least: float):
    """Sums the arrays of each part of the sketch, one after the other, and yields its heavy cells."""
    def heavy(batches):
        for part, rows in shard_groups(batches):
            total = np.zeros(PART, dtype=np.int64)
            for (counts,) in rows:
                total += np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part * PART + np.flatnonzero(total > least))], ["cell"])
    return heavy


def frequent_cells(texts: DataFrame, total: int) -> np.ndarray:
    """Which cells hold a frequent token; the sketch's size does not depend on the input."""
    least = max(LEAST_FREQUENT, total // MOST_FREQUENT) + total / CELLS
    hot = (texts.select("text").mapInArrow(_sketch, "part long, counts binary")
           .repartition(ROWS * CELLS // PART, "part").sortWithinPartitions("part")
           .mapInArrow(_heavy(least), "cell long").toPandas())
    out = np.zeros(ROWS * CELLS, dtype=bool)
    out[hot["cell"].to_numpy(dtype=np.int64)] = True
    return out.reshape(ROWS, CELLS)


def signature_keys(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set's prefix, and for each the number of tokens that the set is
    known to miss if this is the first key that it shares with another set.
    tokens: sorted distinct; frequent: a mask."""
    n = len(tokens)
    need = _allowed(n) + 1
    rare = tokens[~frequent]
    if len(rare) >= need or n < 2:
        return mix(rare[:need]), np.arange(min(need, len(rare)))
    keys, missed = [mix(rare)], [np.arange(len(rare))]
    often = tokens[frequent]
    # The number of subclasses follows the set's size in powers of two.  A linked set
    # may be 1/0.8 times as large, so a set near the next power uses both numbers.
    for lv in sorted({_level(n), _level(100 * n // PERCENT)}):
        parts = 1 << lv
        sub = (mix(often ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((often, sub))
        heads = np.flatnonzero(np.diff(sub[order], prepend=-1))
        ends = np.append(heads[1:], len(often))
        cost = len(rare) + np.cumsum(ends - heads - 1)  # without sharing a pair up to here
        last = int(np.searchsorted(cost, need))
        for a, b, c in zip(heads[:last + 1].tolist(), ends[:last + 1].tolist(), cost.tolist(), strict=False):
            t = often[order[a:b]]
            i, j = np.triu_indices(len(t), 1)
            keys.append(mix(t[i] * np.uint64(0x9FB21C651E98DF25) + mix(t[j] + np.uint64(lv + 1))))
            missed.append(np.full(len(i), c - (b - a - 1)))
    return np.concatenate(keys), np.concatenate(missed)


def _level(n: int) -> int:
    return max(0, (n // 6).bit_length() - 1)


def _class_ids(sets) -> np.ndarray:
    """A 64-bit digest of each set names the class of equal sets."""
    return np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=8).digest() for s in sets), np.int64)


def _emit_keys(frequent):
    def emit(batches):
        for _, _, _, data, off in text_rows(batches):
            sets = [s for s in shingle_sets(data, off, WORDS) if len(s)]
            if not sets:
                continue
            ids = _class_ids(sets)
            sizes = [len(s) for s in sets]
            every = np.concatenate(sets)
            cells = _cells(every)
            mask = frequent.value[0][cells[0]]
            if mask.any():
                for r in range(1, ROWS):
                    mask &= frequent.value[r][cells[r]]
            at = np.cumsum([0, *sizes])
            keys = [signature_keys(s, mask[at[k]:at[k + 1]]) for k, s in enumerate(sets)]
            lens = np.array([len(k) for k, _ in keys])
            place = np.minimum(np.concatenate([m for _, m in keys]), (1 << 21) - 1).astype(np.int64)
            rare = np.add.reduceat((~mask).astype(np.int64), at[:-1]) * 1000 // np.array(sizes)
            yield (np.concatenate([k for k, _ in keys]).view(np.int64), np.repeat(ids, lens),
                   np.repeat(np.array(sizes, np.int64) | (rare << 53), lens) | (place << 32))
    return emit


def histogram(tokens: np.ndarray) -> np.ndarray:
    """Token counts by hash cell, about four tokens a cell; 255 stands for that or more."""
    cells = 1 << max(0, (len(tokens) // 4).bit_length() - 1)
    cell = ((tokens >> np.uint64(32)) & np.uint64(cells - 1)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=cells), 255).astype(np.uint8)


def most_common_tokens(x: np.ndarray, y: np.ndarray) -> int:
    """Upper bound on the intersection of two sets, from their histograms."""
    if max(x.max(initial=0), y.max(initial=0)) == 255:
        return 1 << 62
    cells = min(len(x), len(y))
    x, y = (v.reshape(-1, cells).sum(axis=0, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum())


def _possible(batches):
    for batch in batches:
        keep = []
        m, n = (batch.column(k).to_pylist() for k in (2, 3))
        for k, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
            most = most_common_tokens(*(np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y)))
            if 100 * most >= PERCENT * (m[k] + n[k] - most):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).take(pa.array(keep, pa.int64()))


def _token_blobs(batches):
    """Token sets of the wanted classes."""
    for batch, i, j, data, off in text_rows(batches):
        sets = shingle_sets(data, off, WORDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(i, j - i), pa.array([s.tobytes() for s in sets], pa.binary())],
            ["id", "tokens"])


def _overlaps(batches):
    for batch in batches:
        keep = []
        for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
            same = int(np.count_nonzero(y[at] == x)) if len(y) else 0
            if same and 100 * same >= PERCENT * (len(x) + len(y) - same):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).take(pa.array(keep, pa.int64()))


def _text_hash():
    return F.xxhash64("text")


def _verifier(scratch: Scratch, docs: DataFrame, classes: DataFrame):
    """pairs (a, b) of classes -> those whose whole sets link.  Histograms, a hundredth of
    the size, rule out most pairs first; the sets of the rest are compared token by token,
    and are read from the texts once."""
    size = classes.select("id", "n", "h")
    tokens: list[DataFrame] = []

    def both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(table.select(F.col("id").alias(side), *(
                F.col(c).alias(f"{c}_{side}") for c in columns)), side)
        return pairs.select("a", "b", *(f"{c}_{s}" for c in columns for s in "ab"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = scratch.write(
            both(pairs, size, ["n", "h"]).mapInArrow(_possible, "a long, b long"), "possible")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        if tokens:
            ids = ids.join(scratch.together(tokens).select("id"), "id", "left_anti")
        want = scratch.write(classes.join(ids, "id", "left_semi").select("id", "doc_id", "hash", "copies"), "wanted")
        of = docs.withColumn("hash", _text_hash()).join(want, ["doc_id", "hash"]).select("id", "text", "copies")
        # one blob a class: rows that repeat doc_id and text are first reduced to one
        one = of.where("copies = 1").select("id", "text").union(
            of.where("copies > 1").groupBy("id").agg(F.min("text").alias("text")))
        tokens.append(scratch.write(one.mapInArrow(_token_blobs, "id long, tokens binary"), "tokens"))
        every = scratch.together(tokens)
        return both(pairs, every, ["tokens"]).mapInArrow(_overlaps, "a long, b long").distinct()
    return verify


def _may_link(x, y):
    """Size and position filter.  aux holds the set's size (32 bits), the tokens missed if
    the key is the first shared one (21 bits) and the share of rare tokens.  The first key
    that two sets share leaves at most min(size - missed) common tokens."""
    m, n = (v.bitwiseAND(F.lit((1 << 32) - 1)) for v in (x, y))
    left = F.least(*(k - F.shiftright(v, 32).bitwiseAND(F.lit((1 << 21) - 1)) for k, v in ((m, x), (n, y))))
    return (100 + PERCENT) * left >= PERCENT * (m + n)


def _near(x, y):
    """``_may_link`` on arrays."""
    m, n = (v & ((1 << 32) - 1) for v in (x, y))
    left = np.minimum(*(k - ((v >> 32) & ((1 << 21) - 1)) for k, v in ((m, x), (n, y))))
    return (100 + PERCENT) * left >= PERCENT * (m + n)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "ngram")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = scratch.write(
        docs.select("doc_id", "text", _text_hash().alias("hash"))
        .mapInArrow(_sets, "doc_id long, n_shingles long, id long, h binary, hash long"), "sets")
    # the rows of one class have equal sets; its text is found again by doc_id and hash
    same = (sets.where("n_shingles > 0 and doc_id is not null").groupBy("id", "doc_id", "hash")
            .agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n"), F.max("h").alias("h")))
    classes = scratch.write(
        same.groupBy("id").agg(F.min(F.struct("doc_id", "hash", "copies")).alias("at"),
                               F.max("n").alias("n"), F.max("h").alias("h"))
        .select("id", "at.*", "n", "h"), "classes")
    total = int(sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0])
    known = docs.where("doc_id is not null").select("text")
    frequent = spark.sparkContext.broadcast(frequent_cells(known, total))
    shards = max(16, total // TOKENS_PER_SHARD)
    shared = scratch.write(shared_keys(known, _emit_keys(frequent), shards, _near), "shared")
    label = link_groups(scratch, shared, _may_link, _verifier(scratch, docs, classes),
                        rank=lambda aux: F.shiftright(aux, 53))
    member = scratch.write(classes.join(label, "id", "left")
                           .select("id", "doc_id", F.coalesce("label", "id").alias("label")), "labelled")
    least = scratch.write(member.groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    named = scratch.write(member.join(least, "label").select("id", "component_id"), "named")
    return (sets.select("doc_id", "n_shingles", "id").join(named, "id", "left")
            .select("doc_id", "n_shingles",
                    F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component: its smallest doc_id."""
    found = jaccard_components(docs)
    keep = found.where("component_id = doc_id or doc_id is null").select("doc_id").distinct()
    return docs.join(keep.where("doc_id is not null"), "doc_id", "left_semi").unionByName(
        docs.where("doc_id is null"))
