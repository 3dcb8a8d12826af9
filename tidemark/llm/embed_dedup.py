"""Operator 9: near duplicates of embeddings by iterative quantisation.

Rotations for balanced binary codes are learned on a bounded sample (ITQ: principal axes
of the unit vectors, then alternating sign codes and orthogonal Procrustes), two of them
from different starts, 64 bits each.  Every vector is indexed: eight tables of 16-bit
blocks, each vector entered under its block value and all values one bit away, so two
codes meet in a table if their blocks differ in at most two bits; codes within 23 of 128
bits always meet.  Pairs within ``HAMMING`` bits are reranked by the cosine of the
original vectors in double precision.

Vectors of each length that occurs have rotations and tables of their own (a pass a length).

Edge cases: vectors that are null, zero, or hold null or non-finite components link with
nothing, and vectors of different lengths not with each other; equal vectors are one class
and link with each other; rows that repeat a vec_id are vectors of their own with the same
number; a null vec_id keeps its row and links with nothing; a cosine of exactly 0.9 links; an
empty table gives an empty result; further columns (labels) are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Scratch, bounded_batches, by_shard, components, mix, shard_groups, shards_to_tasks,
)

COSINE = 0.9
SAMPLE = 20_000  # vectors that the rotation is learned on, at most
ROTATIONS, BITS, BLOCK = 2, 64, 16
TABLES = ROTATIONS * BITS // BLOCK
HAMMING = 44  # of 128 bits; pairs further apart are not reranked
KEYS_PER_SHARD = 300_000
UNIT = 1024  # members of a cell that are compared at once


def _vectors(batch: pa.RecordBatch, column: int):
    """For each length: rows that hold a usable vector, and these vectors in double precision."""
    col = batch.column(column)
    lengths = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        flat = pc.list_flatten(col.take(pa.array(rows)))
        v = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        good = np.isfinite(v).all(axis=1) & (np.abs(v).max(axis=1) > 0)
        yield rows[good], v[good]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _classes(batches):
    for batch in batches:
        for rows, v in _vectors(batch, 1):
            d = np.frombuffer(b"".join(hashlib.blake2b(x.tobytes(), digest_size=8).digest() for x in v + 0.0),
                              np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(d), pa.array(np.full(len(rows), v.shape[1], np.int32)),
                 pa.array([x.tobytes() for x in v], pa.binary())],
                ["vec_id", "id", "dim", "v"])


def learn_rotation(sample: np.ndarray, start: int = 0, bits: int = BITS, rounds: int = 50) -> np.ndarray:
    """(dim, bits) projection: principal axes, then the rotation that brings the projected
    vectors nearest to their sign codes."""
    dim = sample.shape[1]
    bits_here = min(bits, dim)
    rng = np.random.default_rng(7 + start)
    if not len(sample):
        return np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :bits_here]
    _, axes = np.linalg.eigh(sample.T @ sample)
    axes = axes[:, ::-1][:, :bits_here]
    x = sample @ axes
    r = np.linalg.qr(rng.standard_normal((bits_here, bits_here)))[0]
    for _ in range(rounds):
        code = np.where(x @ r >= 0, 1.0, -1.0)
        u, _, wt = np.linalg.svd(code.T @ x)
        r = (u @ wt).T
    return axes @ r


def codes(v: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """(rows, ROTATIONS) of 64-bit codes."""
    out = np.zeros((len(v), len(projections), BITS), dtype=bool)
    for k, p in enumerate(projections):
        out[:, k, :p.shape[1]] = (_unit(v) @ p) >= 0
    return np.packbits(out.reshape(len(v), -1), axis=1).view(np.uint64)


def _block(code: np.ndarray, table: int) -> np.ndarray:
    word, at = divmod(table * BLOCK, BITS)
    return (code[:, word] >> np.uint64(at)) & np.uint64((1 << BLOCK) - 1)


def _cells(projection, shards: int, dim: int):
    """Each code under four tables' keys, by shard as sorted arrays."""
    flips = np.concatenate([[0], 1 << np.arange(BLOCK)]).astype(np.uint64)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            v = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(-1, dim)
            code = codes(v, projection.value)
            key = np.concatenate([((_block(code, t)[:, None] ^ flips[None, :]) | np.uint64(t << BLOCK)).ravel()
                                  for t in range(TABLES)])
            who = np.tile(np.repeat(np.arange(len(ids)), len(flips)), TABLES)
            shard = (mix(key) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = [(s, order[cut[s]:cut[s + 1]]) for s in range(shards) if cut[s + 1] > cut[s]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int32()),
                 *(pa.array([x[m].tobytes() for _, m in rows], pa.binary())
                   for x in (key.astype(np.uint32), ids[who], code[who]))], ["shard", "key", "id", "code"])
    return run


def _units(batches):
    """The members of each cell in units of bounded size, each two of which are compared
    by a task of its own; small cells travel together."""
    for _, rows in shard_groups(batches):
        yield from _shard_units(rows)


def _shard_units(rows):
    held = []
    for row in rows:
        held.append([np.frombuffer(x.as_buffer(), t).copy()
                     for x, t in zip(row, (np.uint32, np.int64, np.uint64), strict=True)])
        held[-1][2] = held[-1][2].reshape(-1, ROTATIONS)
    key, id_, code = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    order = np.lexsort((id_, key))
    key, id_, code = key[order], id_[order], code[order]
    heads = np.flatnonzero(np.diff(key.astype(np.int64), prepend=-1))
    ends = np.append(heads[1:], len(key))
    size = ends - heads
    small = (size > 1) & (size <= UNIT)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in range(1, 6))],
            ["kind", "key", "id_a", "code_a", "id_b", "code_b"])

    none = np.zeros(0, np.int64)
    pick = np.flatnonzero(np.repeat(small, size))
    # whole small cells, about a unit's worth of comparisons a row
    work = np.where(small, size.astype(np.int64) ** 2, 0)
    unit = np.repeat((np.cumsum(work) - work) // (UNIT * UNIT), size)[pick]
    rows = [(0, key[p], id_[p], code[p], none, none)
            for p in np.split(pick, np.flatnonzero(np.diff(unit)) + 1) if len(p)]
    for a in range(0, len(rows), 64):
        yield batch_of(rows[a:a + 64])
    for h, e in zip(heads[size > UNIT].tolist(), ends[size > UNIT].tolist(), strict=True):
        parts = [(id_[a:min(a + UNIT, e)], code[a:min(a + UNIT, e)]) for a in range(h, e, UNIT)]
        for i, (ia, ca) in enumerate(parts):
            yield batch_of([(1 + (i == j), key[h:h + 1], ia, ca, ib, cb)
                            for j, (ib, cb) in enumerate(parts[i:], i)])


def _near(key, ia, ca, ib, cb):
    """Pairs within HAMMING bits whose first meeting place is this cell."""
    ok = (np.bitwise_count(ca ^ cb).sum(axis=1) <= HAMMING) & (ia != ib)
    key, ia, ca, ib, cb = (v[ok] for v in (key.astype(np.uint64), ia, ca, ib, cb))
    if not len(ia):
        return ia, ib
    table = np.full(len(ia), TABLES, np.uint64)
    place = np.zeros(len(ia), np.uint64)
    for t in reversed(range(TABLES)):
        va, vb = _block(ca, t), _block(cb, t)
        diff = va ^ vb
        apart = np.bitwise_count(diff)
        bit = diff & (~diff + np.uint64(1))  # lowest differing bit
        # equal: the value; one bit apart: the smaller; two: the smaller of the two between
        at = np.where(apart <= 1, np.minimum(va, vb), np.minimum(va ^ bit, vb ^ bit))
        table = np.where(apart <= 2, np.uint64(t), table)
        place = np.where(apart <= 2, at, place)
    own = key == ((table << np.uint64(BLOCK)) | place)
    a, b = ia[own], ib[own]
    return np.minimum(a, b), np.maximum(a, b)


def _pairs(batches):
    for batch in batches:
        for kind, key, *rest in zip(*(batch.column(k) for k in range(6)), strict=True):
            key = np.frombuffer(key.as_buffer(), np.uint32)
            ia, ca, ib, cb = (np.frombuffer(x.as_buffer(), t) for x, t in zip(
                rest, (np.int64, np.uint64) * 2, strict=True))
            ca, cb = (c.reshape(-1, ROTATIONS) for c in (ca, cb))
            if kind.as_py() == 0:
                heads = np.flatnonzero(np.diff(key.astype(np.int64), prepend=-1))
                ends = np.repeat(np.append(heads[1:], len(key)), np.diff(np.append(heads, len(key))))
                reach = ends - np.arange(len(key)) - 1  # later members of the same cell
                i = np.repeat(np.arange(len(key)), reach)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach)
                a, b = _near(key[i], ia[i], ca[i], ia[j], ca[j])
                yield _pair_rows(a, b)
                continue
            same = kind.as_py() == 2
            for k in range(len(ia)):
                s = slice(k + 1, None) if same else slice(None)
                m = len(ib[s])
                a, b = _near(np.repeat(key, m), np.full(m, ia[k]), np.repeat(ca[k:k + 1], m, axis=0), ib[s], cb[s])
                if len(a):
                    yield _pair_rows(a, b)


def _pair_rows(a, b):
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _cosines(dim: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_unit(np.frombuffer(b"".join(batch.column(k).to_pylist()), np.float64).reshape(-1, dim))
                    for k in (2, 3))
            cos = np.einsum("ij,ij->i", x, y)
            keep = pa.array(np.flatnonzero(cos >= COSINE))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cos)], ["a", "b", "cosine"]).take(keep)
    return run


def near_links(scratch: Scratch, classes: DataFrame, dim: int) -> DataFrame:
    """Links (a, b, cosine) between classes (id, v as float64 bytes) of cosine 0.9 or more."""
    spark = scratch.spark
    n = classes.count()
    share = min(1.0, 0.8 * SAMPLE / max(n, 1))  # by hash, so any run takes the same rows
    sample = (classes.where(F.pmod(F.col("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
              .limit(SAMPLE).select("v").collect())
    v = np.frombuffer(b"".join(r["v"] for r in sample), np.float64).reshape(-1, dim) if sample else np.zeros((0, dim))
    unit = _unit(v) if len(v) else v
    projection = spark.sparkContext.broadcast([learn_rotation(unit, k) for k in range(ROTATIONS)])
    keys = n * TABLES * (BLOCK + 1)
    shards = max(12, keys // KEYS_PER_SHARD)
    tasks = shards_to_tasks(spark, shards)
    near = scratch.write(
        classes.select("id", "v").mapInArrow(_cells(projection, shards, dim), "shard int, key binary, id binary, code binary")
        .transform(by_shard, shards)
        .mapInArrow(_units, "kind int, key binary, id_a binary, code_a binary, id_b binary, code_b binary")
        .repartition(2 * tasks).mapInArrow(_pairs, "a long, b long"), "near")
    x = classes.select(F.col("id").alias("a"), F.col("v").alias("x"))
    y = classes.select(F.col("id").alias("b"), F.col("v").alias("y"))
    return scratch.write(near.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                         .mapInArrow(_cosines(dim), "a long, b long, cosine double"), "links")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "embeddings")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = scratch.write(
        vectors.where("vec_id is not null").mapInArrow(_classes, "vec_id long, id long, dim int, v binary"), "rows")
    classes = scratch.write(rows.groupBy("id").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"),
                                                   F.max("dim").alias("dim"), F.max("v").alias("v")), "classes")
    dims = [r["dim"] for r in classes.groupBy("dim").count().where("count > 1").orderBy("dim").collect()]
    links = scratch.together([near_links(scratch, classes.where(F.col("dim") == d), d) for d in dims or [1]])
    both = links.select("a", "b").union(links.select("b", "a")).toDF("id", "other")
    size = classes.select(F.col("id").alias("other"), "n")
    degree = scratch.write(both.join(size, "other").groupBy("id").agg(F.sum("n").alias("others")), "degrees")
    label = components(scratch, links)
    named = classes.join(label, "id", "left").select("id", "vec_id", "n", F.coalesce("label", "id").alias("label"))
    named = scratch.write(named.join(degree, "id", "left"), "named")
    least = scratch.write(named.groupBy("label").agg(F.min("vec_id").alias("component_id")), "least")
    named = scratch.write(named.join(least, "label").select(
        "id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "figures")
    found = scratch.write(rows.select("vec_id", "id").join(named, "id").select("vec_id", "n_links", "component_id"), "found")
    alone = (vectors.where("vec_id is not null").groupBy("vec_id").agg(F.count("*").alias("m"))
             .join(found.groupBy("vec_id").agg(F.count("*").alias("k")), "vec_id", "left")
             .select("vec_id", (F.col("m") - F.coalesce("k", F.lit(0))).alias("m")).where("m > 0")
             .select("vec_id", F.explode(F.expr("array_repeat(0L, cast(m as int))")).alias("n_links"),
                     F.col("vec_id").alias("component_id")))
    null = vectors.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                  F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).unionByName(null).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
