"""Operator 6: best-fit packing through a configuration linear program.

Texts are tokenized in Arrow batches (each worker tokenizes a distinct word once), an end
token follows each document, and only documents longer than a sequence are cut.  The
histogram of piece lengths, at most one row a length whatever the input, is all that
reaches the driver.  There the covering program "fewest configurations that hold every
piece" is solved by multiplicative weights: prices of length classes rise where pieces
are uncovered, a knapsack dynamic program finds the dearest configuration, and the sum of
the chosen ones, scaled to cover once, is rounded down.  Configurations are filled with
exact lengths, and the pieces that rounding left over (and the small ones) go best-fit
into the gaps.  The plan, in ranges of ranks by length, is joined to the pieces, whose
ranks are counted in buckets so that a length that a third of all pieces share is split.

Edge cases: null or empty text is one piece of the end token; a document that fills a
sequence is its own; repeated rows are packed each; doc_id may be null; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import _CODE, _SPACE, Scratch, bounded_batches, mix, shards_to_tasks, slices, utf8, words

SEQUENCE = 4096
END_TOKEN = 1
SMALL = SEQUENCE // 16  # shorter pieces are left to best fit
CLASSES = 48
ROUNDS = 600
STEP = 0.15
CACHE_WORDS = 1 << 20  # a worker's cache of words; it starts afresh beyond
SLICE = 4 << 20  # bytes tokenized at once; each time new words are sorted into the cache
SLOTS = 128  # slots of a mix that are packed together, some 500 sequences
RANKS = 64
CHUNK_PLAN = "chunk long, length long, lo long, hi long, base long, each long, at long"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_cache: dict[str, WordTokens] = {}
_CASED = mix(_CODE + np.arange(256, dtype=np.uint64))


class WordTokens:
    """Token ids of white-space separated words; the tokenizer never joins two words."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self._empty()

    def _empty(self):
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str]):
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in got]
        length = np.array([len(x) for x in ids], np.int64)
        place = len(self.ids) + np.cumsum(length) - length
        flat = np.fromiter((y for x in ids for y in x), np.uint32, int(length.sum()))
        self.ids = np.concatenate([self.ids, flat])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.place = np.concatenate([self.place, place])[order]
        self.length = np.concatenate([self.length, length])[order]

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """All ids of a run of rows, and the rows' offsets in them."""
        # the tokenizer folds case, but for the names of special tokens, as in <|x|>
        h, start, end, w = words(data, offsets, _SPACE, _CASED if (data == 0x3C).any() else _CODE)
        unique, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > CACHE_WORDS:
            self._empty()
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            raw, pick = data.tobytes(), first[new]
            self._learn(unique[new], [raw[a:b].decode() for a, b in zip(
                start[pick].tolist(), end[pick].tolist(), strict=True)])
            at = np.searchsorted(self.known, unique)
        at = at[back]
        length = self.length[at]
        total = np.concatenate([[0], np.cumsum(length)])
        where = np.arange(total[-1]) + np.repeat(self.place[at] - total[:-1], length)
        return self.ids[where], total[w]


def word_tokens(path: str) -> WordTokens:
    """One tokenizer and cache a Python worker."""
    if path not in _cache:
        _cache[path] = WordTokens(path)
    return _cache[path]


def _pieces(path: str, sequence: int):
    def run(batches):
        tokens = word_tokens(path)
        for batch in batches:
            data, off = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            further = batch.columns[2:]  # whole numbers that each piece takes along
            more = list(zip(*(c.to_pylist() for c in further), strict=True)) or [()] * batch.num_rows
            rows = []
            for i, j in slices(off, SLICE):
                flat, at = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                for k in range(i, j):
                    all_ids = np.append(flat[at[k - i]:at[k - i + 1]], np.uint32(END_TOKEN)).astype("<u4")
                    for p, s in enumerate(range(0, len(all_ids), sequence)):
                        part = all_ids[s:s + sequence]
                        rows.append((ids[k], p, s, len(part), zlib.crc32(part.tobytes()), *more[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True) if rows else [[]] * (5 + len(further)),
                    (pa.int64(), pa.int32(), *[pa.int64()] * (3 + len(further))), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", *batch.schema.names[2:]])
    return run


def _knapsack(size: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of each class in the dearest configuration (dynamic program over capacity)."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    order = np.argsort(size)
    s, v = size[order], value[order]
    step = max(1, int(s[0]))  # so many places follow from those before them alone
    for c in range(1, capacity + 1, step):
        d = np.arange(c, min(c + step, capacity + 1))
        m = int(np.searchsorted(s, d[-1], side="right"))
        before = best[c - 1]
        if m:
            rest = d - s[:m, None]
            got = np.where(rest >= 0, v[:m, None] + best[np.maximum(rest, 0)], -1.0)
            k = got.argmax(axis=0)
            most = got[k, np.arange(len(d))]
            so_far = np.maximum.accumulate(np.append(before, most))
            better = most > so_far[:-1]
            best[d] = so_far[1:]
            take[d[better]] = order[k[better]]
        else:
            best[d] = before
    counts, c = np.zeros(len(size), np.int64), capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            counts[take[c]] += 1
            c -= size[take[c]]
    return counts


def solve_configurations(size: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Fractional cover of ``demand`` pieces of each class by configurations, few in sum.

    Multiplicative weights: a class's price falls as it gets covered; each round adds the
    dearest configuration, as much of it as covers a step of its most covered class.
    """
    covered = np.zeros(len(size))
    chosen: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        price = np.exp(-(covered - covered.min()) / STEP) / demand
        a = _knapsack(size, price, capacity)
        amount = float((demand[a > 0] / a[a > 0]).min()) * STEP
        covered += a * amount / demand
        chosen[tuple(a)] = chosen.get(tuple(a), 0.0) + amount
        if covered.min() >= 8.0:
            break
    scale = max(covered.min(), 1e-9)
    if covered.min() <= 0:
        scale = max(1.0, float(covered.max()))
    return [(np.array(a), x / scale) for a, x in chosen.items()]


def pack_lengths(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of a sequence's pieces, in order) with how many sequences use each.

    ``histogram``: how many pieces have each length.  Works on counts, so its size
    follows the number of lengths and not of pieces.
    """
    left = {n: c for n, c in sorted(histogram.items()) if c > 0}
    done: list[tuple[tuple[int, ...], int]] = []
    if left.get(sequence):
        done.append(((sequence,), left.pop(sequence)))
    large = [n for n in left if n > SMALL]
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], count: int):
        open_.setdefault(sequence - sum(pattern), []).append((pattern, count))

    if large:
        # classes of about equal numbers of pieces; each counts as its longest piece
        weight = np.array([left[n] for n in large], dtype=float)
        group = np.minimum((np.cumsum(weight) - weight) / weight.sum() * CLASSES, CLASSES - 1).astype(int)
        names = np.unique(group)
        members = [[large[i] for i in np.flatnonzero(group == g)][::-1] for g in names]
        demand = np.array([sum(left[n] for n in m) for m in members], dtype=float)
        unit = max(1, sequence // 512)
        size = np.array([-(-m[0] // unit) for m in members])
        for a, x in sorted(solve_configurations(size, demand, sequence // unit),
                           key=lambda ax: -float((ax[0] * size).sum())):
            times = int(x)
            slots = [g for g in np.flatnonzero(a) for _ in range(a[g])]
            while times > 0:
                # the longest lengths that are left in each slot's class, as a run
                use: dict[int, int] = {}
                pattern = []
                for k, g in enumerate(slots):
                    if k < len(slots) - 1:
                        n = next((n for n in members[g] if left[n] > use.get(n, 0)), None)
                    else:  # shorter pieces before it leave the last one some room
                        room = sequence - sum(pattern)
                        n = next((n for n in reversed(large) if n <= room and left[n] > use.get(n, 0)), None)
                    if n is None:  # a class has run out: what is left goes best-fit
                        break
                    use[n] = use.get(n, 0) + 1
                    pattern.append(n)
                if len(pattern) < len(slots):
                    break
                run = min([times, *(left[n] // k for n, k in use.items())])
                for n, k in use.items():
                    left[n] -= run * k
                put(tuple(sorted(pattern, reverse=True)), run)
                times -= run
    for n in sorted(left, reverse=True):  # best fit, longest first
        while left[n]:
            room = min((r for r in open_ if r >= n), default=None)
            if room is None:
                fresh = sequence // n
                full, rest = divmod(left[n], fresh)
                if full:
                    put((n,) * fresh, full)
                if rest:
                    put((n,) * rest, 1)
                left[n] = 0
                break
            pattern, count = open_[room].pop()
            if not open_[room]:
                del open_[room]
            fit = min(room // n, left[n])
            run = min(count, left[n] // fit)
            if count > run:
                put(pattern, count - run)
            put(pattern + (n,) * fit, run)
            left[n] -= run * fit
    return done + [x for patterns in open_.values() for x in patterns]


def _plan_rows(patterns):
    """(length, first rank, last rank, first sequence, pieces of that length a sequence,
    offset of the first of them)."""
    rows, rank, base = [], {}, 0
    for pattern, count in patterns:
        at, k = 0, 0
        while k < len(pattern):
            n = pattern[k]
            m = 1
            while k + m < len(pattern) and pattern[k + m] == n:
                m += 1
            lo = rank.get(n, 0)
            rank[n] = lo + m * count
            rows.append((n, lo, rank[n], base, m, at))
            at += m * n
            k += m
        base += count
    return rows


def _place(plan):
    def run(batches):
        length, lo, _, base, each, at = plan.value
        starts = {n: (int(a), int(b)) for n, a, b in zip(
            *(lambda u, f: (u.tolist(), f, np.append(f[1:], len(length))))(*np.unique(length, return_index=True)),
            strict=True)}
        for batch in batches:
            n = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            row = np.zeros(len(n), np.int64)
            for value in np.unique(n):
                a, b = starts[int(value)]
                mine = n == value
                row[mine] = a + np.searchsorted(lo[a:b], rank[mine], side="right") - 1
            inside = rank - lo[row]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(base[row] + inside // each[row]),
                 pa.array(at[row] + inside % each[row] * n)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_pieces(tokenizer, sequence), PIECES)
        .withColumn("deal", (F.rand(11) * (1 << 30)).cast("int")), "pieces")
    # written with the pieces, so rows that are all equal are many buckets too
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "deal"), F.lit(_buckets(pieces)))
    pieces = pieces.withColumn("bucket", bucket)
    cells = scratch.write(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "cells")
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = sorted(_plan_rows(pack_lengths(histogram, sequence)))
    plan = spark.sparkContext.broadcast(
        tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 6)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.join(scratch.write(cells, "before"), ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1)
    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long"))
            .mapInArrow(_place(plan), PIECES + ", sequence_id long, offset long"))


def pack_mixed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, slots: int = SLOTS) -> DataFrame:
    """As ``pack``, for documents with the slot and place of a mix (see mixing.py).

    Each ``slots`` slots have a plan and sequences of their own, so whatever the number of
    sequences read, the mix holds up to the slots that are being read.  Sequences are
    numbered by the first (slot, place) that they hold, slots' range after slots' range.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "slot", "place")
        .mapInArrow(_pieces(tokenizer, sequence), PIECES + ", slot long, place long"), "pieces")
    pieces = pieces.withColumn("chunk", F.floor(F.col("slot") / slots))
    cells = scratch.write(pieces.groupBy("chunk", "length", "slot").agg(F.count("*").alias("n")), "cells")
    plan = scratch.write(
        cells.groupBy("chunk", "length").agg(F.sum("n").alias("n"))
        # few rows but long work: tasks by number, which are not put together by their bytes
        .repartition(shards_to_tasks(spark, _chunks(cells)), "chunk").groupBy("chunk")
        .applyInPandas(_chunk_plan(sequence), CHUNK_PLAN), "plan")
    before = Window.partitionBy("chunk", "length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("chunk", "length", "slot").orderBy("place", "piece")
    ranked = pieces.join(scratch.write(cells, "before"), ["chunk", "length", "slot"]).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1)
    # ranges of ranks, so that a length that many pieces share is many keys
    parts = F.sequence(F.floor(F.col("lo") / RANKS), F.floor((F.col("hi") - 1) / RANKS))
    placed = ranked.withColumn("part", F.floor(F.col("rank") / RANKS)).join(
        plan.withColumn("part", F.explode(parts)), ["chunk", "length", "part"])
    inside = F.col("rank") - F.col("lo")
    placed = placed.where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select(
        "chunk", "slot", "place", "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.floor(inside / F.col("each"))).alias("own"),
        (F.col("at") + inside % F.col("each") * F.col("length")).alias("offset"))
    placed = scratch.write(placed, "placed")
    first = placed.groupBy("chunk", "own").agg(F.min(F.struct("slot", "place")).alias("first"))
    first = scratch.write(first.withColumn("number", F.row_number().over(
        Window.partitionBy("chunk").orderBy("first", "own"))), "first")
    # one row a chunk
    chunks = first.groupBy("chunk").agg(F.count("*").alias("n")).withColumn("earlier", F.coalesce(F.sum("n").over(
        Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = first.join(F.broadcast(chunks.drop("n")), "chunk").select(
        "chunk", "own", (F.col("earlier") + F.col("number") - 1).cast("long").alias("sequence_id"))
    return placed.join(number, ["chunk", "own"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long"))


def _chunk_plan(sequence: int):
    def run(cells):
        import pandas as pd

        rows = _plan_rows(pack_lengths(dict(zip(cells["length"].tolist(), cells["n"].tolist(), strict=True)), sequence))
        out = pd.DataFrame(rows, columns=["length", "lo", "hi", "base", "each", "at"], dtype="int64")
        out.insert(0, "chunk", int(cells["chunk"].iloc[0]))
        return out
    return run


def _chunks(cells: DataFrame) -> int:
    return cells.select("chunk").distinct().count()


def _buckets(pieces: DataFrame) -> int:
    return max(1, pieces.count() // 2000)
