"""Operator 10: interpolated modified Kneser-Ney bigram model, counted in Spark.

Tokens: words of bytes outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased, then one end.
Word and bigram counts are summed by shuffles of per-task counts.  The model is stored in
the shared folder as shards of sorted arrays (word hashes; bigrams of word numbers, those
seen once apart from those with counts; per-word context and continuation figures), which
the scoring workers map into memory, so a worker's memory does not grow with the model.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + g(v) p(w)
    p(w)     = max(k(w) - D'(k(w)), 0) / K + g' / (V + 1)

with k(w) the number of distinct words before w, K their sum, D and D' the three
discounts of Chen and Goodman from the counts of counts, and g, g' the mass they free.
An unseen context gives p(w).  The start of a text is a context of its own.

Edge cases: null or empty text is the end token alone; a null doc_id counts as training
and keeps its row; repeated rows are each counted and scored; an empty training set gives
p = 1 / (V + 1) = 1; further columns are ignored, whatever their names; very long texts are
read whole, a bounded run of rows at a time; ties of counts do not matter.  The shared folder
must be a path that workers can open (a mounted file system); another scheme raises
ValueError, as do more than ``MOST_WORDS`` distinct words (two numbers share a 64-bit key).
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Scratch, bounded_batches, by_shard, mix, shard_groups, shards_to_tasks, slices, text_rows, utf8, words,
)

FOLDS, HELD_OUT = 5, 1
TOKENS_A_FLUSH = 2_000_000
END = np.uint64(0x7C3A9E5D10F2B684)  # the end token's hash
SPLIT = np.uint64(4)  # parts of a context, so that a frequent word's followers spread
WORDS_A_SHARD, BIGRAMS_A_SHARD = 250_000, 600_000
MOST_WORDS = (1 << 32) - 2  # the start of a text has a number too
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def _folder(scratch: Scratch) -> str:
    root = scratch.root
    for prefix in ("file://", "file:"):
        root = root.removeprefix(prefix)
    if "://" in root:
        raise ValueError(f"the model needs a shared folder that workers can open, not {root}")
    return f"{root}/model"


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all; a repeated task writes the same bytes again."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(part, array)
    os.replace(part, f"{folder}/{name}.npy")


class Model:
    """Arrays of one model, mapped into memory on first use."""

    _open: dict[str, Model] = {}

    def __init__(self, folder: str, bases: np.ndarray):
        self.folder, self.bases = folder, bases
        self._arrays: dict[str, np.ndarray] = {}

    @classmethod
    def of(cls, folder: str, bases: np.ndarray) -> Model:
        if folder not in cls._open:
            cls._open.clear()
            cls._open[folder] = cls(folder, bases)
        return cls._open[folder]

    def array(self, name: str) -> np.ndarray:
        if name not in self._arrays:
            path = f"{self.folder}/{name}.npy"
            there = os.path.exists(path)
            self._arrays[name] = np.load(path, mmap_mode="r") if there else np.zeros(0, np.int64)
        return self._arrays[name]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown) and counts of sorted distinct hashes."""
        shards = len(self.bases) - 1
        number = np.full(len(hashes), -1, np.int64)
        count = np.zeros(len(hashes), np.int64)
        cut = np.searchsorted(_shard_of(hashes, shards), np.arange(shards + 1))
        for s in range(shards):
            a, b = cut[s], cut[s + 1]
            keys = self.array(f"words-{s}")
            if a == b or not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, hashes[a:b]), len(keys) - 1)
            hit = keys[at] == hashes[a:b]
            number[a:b][hit] = self.bases[s] + at[hit]
            count[a:b][hit] = self.array(f"counts-{s}")[at[hit]]
        return number, count

    def bigrams(self, keys: np.ndarray, shards: int) -> np.ndarray:
        """Counts of distinct bigram keys."""
        out = np.zeros(len(keys), np.int64)
        shard = _bigram_shard(keys, shards)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            mine = order[cut[s]:cut[s + 1]]
            if not len(mine):
                continue
            for name, counts in (("once", None), ("more", f"times-{s}")):
                have = self.array(f"{name}-{s}")
                if not len(have):
                    continue
                at = np.minimum(np.searchsorted(have, keys[mine]), len(have) - 1)
                hit = have[at] == keys[mine]
                out[mine[hit]] = 1 if counts is None else self.array(counts)[at[hit]]
        return out

    def figures(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context total, freed mass and lower-order probability of word numbers >= 0."""
        shards = len(self.bases) - 1
        out = np.zeros((3, len(number)))
        shard = np.searchsorted(self.bases, number, side="right") - 1
        shard = np.minimum(shard, shards)  # the start context comes after the words
        for s in np.unique(shard):
            mine = shard == s
            out[:, mine] = self.array(f"figures-{s}")[:, number[mine] - self.bases[s]]
        return out[0], out[1], out[2]


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Range shards of word hashes; shards is a power of two."""
    bits = shards.bit_length() - 1
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _bigram_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    k = keys.view(np.uint64)
    return (mix((k >> np.uint64(32)) * SPLIT + (k % SPLIT)) % np.uint64(shards)).astype(np.int64)


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in 32 bits if all fit, else in 64."""
    return n.astype(np.uint32) if n.max(initial=0) < 1 << 32 else n.astype(np.int64)


def _key(before: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Two word numbers of 32 bits each, unsigned, as one."""
    return ((before.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64)).view(np.int64)


def _two(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = key.view(np.uint64)
    return (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _sums(back: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of n by back (0 to its maximum), in whole numbers."""
    order = np.argsort(back, kind="stable")
    return np.add.reduceat(n[order].astype(np.int64), np.searchsorted(back[order], np.arange(back.max() + 1)))


def _tokens(data, off):
    """Token hashes with the end of each row, and the rows' offsets."""
    h, _, _, w = words(data, off)
    return np.insert(h, w[1:], END), w + np.arange(len(w))


def _count_words(batches):
    held, size = [], 0

    def flush():
        key = np.concatenate([k for k, _ in held])
        n = np.concatenate([c for _, c in held])
        key, back = np.unique(key, return_inverse=True)
        n = _sums(back, n)
        for a in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[a:a + 100_000].view(np.int64)), pa.array(n[a:a + 100_000])], ["word", "n"])

    for _, _, _, data, off in text_rows(batches):
        t, _ = _tokens(data, off)
        key, n = np.unique(t, return_counts=True)
        held.append((key, n))
        size += len(key)
        if size >= TOKENS_A_FLUSH:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _store_words(folder: str, shards: int):
    def run(batches):
        word, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in batches:
            word.append(b.column(0).to_numpy())
            n.append(b.column(1).to_numpy())
        word = np.concatenate(word).view(np.uint64)
        n = np.concatenate(n)
        order = np.argsort(word)
        word, n = word[order], n[order]
        of = _shard_of(word, shards)
        for s in np.unique(of):
            _save(folder, f"words-{s}", word[of == s])
            _save(folder, f"counts-{s}", _narrow(n[of == s]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(s)], pa.int32()), pa.array([int((of == s).sum())], pa.int64())], ["shard", "n"])
    return run


def _numbered(model: Model, data, off):
    """Per token: number (-1 unknown), count; rows' offsets."""
    t, at = _tokens(data, off)
    unique, back = np.unique(t, return_inverse=True)
    number, count = model.numbers(unique)
    return number[back], count[back], at


def _pairs(number: np.ndarray, at: np.ndarray, start: int) -> np.ndarray:
    """The number before each token; ``start`` before a row's first."""
    before = np.empty_like(number)
    before[1:] = number[:-1]
    before[at[:-1]] = start
    return before


def _count_bigrams(folder: str, bases: np.ndarray, shards: int):
    def run(batches):
        model = Model.of(folder, bases)
        held, size = [], 0

        def flush():
            key = np.concatenate([k for k, _ in held])
            n = np.concatenate([c for _, c in held])
            key, back = np.unique(key, return_inverse=True)
            n = _sums(back, n)
            shard = _bigram_shard(key, shards)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cut)).tolist():
                mine = order[cut[s]:cut[s + 1]]
                if len(mine):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([key[mine].tobytes()], pa.binary()),
                         pa.array([_narrow(n[mine]).tobytes()], pa.binary())], ["shard", "keys", "n"])

        for _, _, _, data, off in text_rows(batches):
            number, _, at = _numbered(model, data, off)
            key, n = np.unique(_key(_pairs(number, at, bases[-1]), number), return_counts=True)
            held.append((key, n))
            size += len(key)
            if size >= TOKENS_A_FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _store_bigrams(folder: str):
    def run(batches):
        for s, rows in shard_groups(batches):
            parts = []
            for k, n in rows:
                k = np.frombuffer(k.as_buffer(), np.int64).copy()
                n = np.frombuffer(n.as_buffer(), np.uint8)
                parts.append((k, n.view(np.uint32 if len(n) == 4 * len(k) else np.int64).astype(np.int64)))
            key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = _sums(back, np.concatenate([c for _, c in parts]))
            _save(folder, f"once-{s}", key[n == 1])
            _save(folder, f"more-{s}", key[n > 1])
            _save(folder, f"times-{s}", _narrow(n[n > 1]))
            left, right = _two(key)
            left, back = np.unique(left, return_inverse=True)
            yield _figure_rows(0, left, *(_sums(back, x) for x in (n, n == 1, n == 2, n > 2)))
            right, times = np.unique(right, return_counts=True)
            zero = np.zeros(len(right), np.int64)
            yield _figure_rows(1, right, times, zero, zero, zero)
            yield _figure_rows(2, np.arange(1, 5), *(np.array([int((n == c).sum()) for c in range(1, 5)])
                                                     if k == 0 else np.zeros(4, np.int64) for k in range(4)))
    return run


def _figure_rows(kind, id_, *sums):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(id_), kind, np.int32)), pa.array(id_.astype(np.int64)),
         *(pa.array(x.astype(np.int64)) for x in sums)], ["kind", "id", "a", "b", "c", "d"])


def discounts(n: dict[int, int]) -> np.ndarray:
    """D(0..3+) of modified Kneser-Ney from the numbers of items seen 1 to 4 times; where
    these are too few to tell, 0.5, 1 and 1.5 stand in."""
    n1, n2, n3, n4 = (n.get(k, 0) for k in range(1, 5))
    if min(n1, n2, n3, n4) == 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0.0, [0.0, 0.999, 1.999, 2.999])


def _discounted(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.maximum(n - d[np.minimum(n, 3)], 0.0)


def _store_figures(folder, bases, d2, d1, k_sum, freed, vocabulary):
    def run(batches):
        got = [pa.Table.from_batches([b]) for b in batches]
        if not got:
            return
        t = pa.concat_tables(got)
        shard, id_, *sums, cont = (t.column(k).to_numpy() for k in range(7))
        for s in np.unique(shard):
            mine = shard == s
            size = int(bases[s + 1] - bases[s]) if s < len(bases) - 1 else 1
            at = id_[mine] - bases[s]
            total, n1, n2, n3 = (np.bincount(at, weights=x[mine], minlength=size) for x in sums)
            k = np.bincount(at, weights=cont[mine], minlength=size).astype(np.int64)
            mass = np.where(total > 0, (d2[1] * n1 + d2[2] * n2 + d2[3] * n3) / np.maximum(total, 1), 1.0)
            lower = _discounted(k, d1) / max(k_sum, 1) + freed / (vocabulary + 1)
            _save(folder, f"figures-{s}", np.stack([total, mass, lower]))
            yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int32())], ["shard"])
    return run


def _score(folder, bases, shards, d2, freed, total, vocabulary):
    def run(batches):
        model = Model.of(folder, bases)
        base_of = lambda c: np.log10((c + 0.5) / (total + 0.5 * (vocabulary + 1)))
        for batch in batches:
            data, off = utf8(batch.column(2))
            for i, j in slices(off, 4 << 20):
                number, count, at = _numbered(model, data[off[i]:off[j]], off[i:j + 1] - off[i])
                before = _pairs(number, at, bases[-1])
                known = number >= 0
                lower = np.full(len(number), freed / (vocabulary + 1))
                p = lower.copy()
                if vocabulary:
                    ids, back = np.unique(number[known], return_inverse=True)
                    lower[known] = model.figures(ids)[2][back]
                    p = lower.copy()
                    seen = before >= 0
                    ids, back = np.unique(before[seen], return_inverse=True)
                    c_total, mass = (x[back] for x in model.figures(ids)[:2])
                    p[seen] *= np.where(c_total > 0, mass, 1.0)
                    both = known & seen
                    key, back = np.unique(_key(before[both], number[both]), return_inverse=True)
                    c = model.bigrams(key, shards)[back]
                    p[both] += _discounted(c, d2) / np.maximum(c_total[known[seen]], 1)
                ends = at[:-1]
                add = lambda x: np.add.reduceat(x, ends)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(np.diff(at)), pa.array(add((count > 0).astype(np.int64))),
                     pa.array(add(base_of(count))), pa.array(add(np.log10(p)))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "kneser-ney")
    folder = _folder(scratch)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    train = docs.where("not held_out").select("text")

    vocab = scratch.write(train.mapInArrow(_count_words, "word long, n long")
                          .groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    size, total = vocab.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if size > MOST_WORDS:
        raise ValueError(f"{size} distinct words, more than {MOST_WORDS}")
    parts = 1 << max(2, (size // WORDS_A_SHARD).bit_length())
    top = F.shiftrightunsigned("word", 64 - (parts.bit_length() - 1)).cast("int")
    stored = (vocab.withColumn("shard", top).repartition(shards_to_tasks(spark, parts), "shard")
              .select("word", "n").mapInArrow(_store_words(folder, parts), "shard int, n long"))
    held = np.zeros(parts, np.int64)
    for r in stored.collect():  # one row a shard
        held[r["shard"]] = r["n"]
    bases = np.concatenate([[0], np.cumsum(held)])

    shards = max(16, int(total // BIGRAMS_A_SHARD))
    sums = scratch.write(
        train.mapInArrow(_count_bigrams(folder, bases, shards), "shard int, keys binary, n binary")
        .transform(by_shard, shards)
        .mapInArrow(_store_bigrams(folder), "kind int, id long, a long, b long, c long, d long")
        .groupBy("kind", "id").agg(*(F.sum(c).alias(c) for c in "abcd")), "figures")
    d2 = discounts({r["id"]: r["a"] for r in sums.where("kind = 2").collect()})
    cont = sums.where("kind = 1")
    k_sum, n3 = cont.agg(F.coalesce(F.sum("a"), F.lit(0)), F.sum((F.col("a") >= 3).cast("long"))).first()
    by = {r["a"]: r["n"] for r in cont.where("a <= 4").groupBy("a").agg(F.count("*").alias("n")).collect()}
    d1 = discounts(by)
    freed = ((d1[1] * by.get(1, 0) + d1[2] * by.get(2, 0) + d1[3] * (n3 or 0)) / k_sum) if k_sum else 1.0

    edges = F.array(*(F.lit(int(b)) for b in bases[1:]))
    rows = (sums.where("kind < 2").groupBy("id")
            .agg(*(F.sum(F.when(F.col("kind") == 0, F.col(c)).otherwise(0)).alias(c) for c in "abcd"),
                 F.sum(F.when(F.col("kind") == 1, F.col("a")).otherwise(0)).alias("k"))
            .withColumn("shard", F.size(F.filter(edges, lambda e: e <= F.col("id")))))
    rows = rows.select("shard", "id", "a", "b", "c", "d", "k").repartition(
        shards_to_tasks(spark, parts + 1), "shard")
    rows.mapInArrow(_store_figures(folder, bases, d2, d1, k_sum, freed, size), "shard int").collect()

    return (docs.mapInArrow(_score(folder, bases, shards, d2, freed, total, size), SCORES)
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
                    "base_score", "score"))
