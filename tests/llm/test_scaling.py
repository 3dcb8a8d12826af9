"""What the pipeline, line dedup and n-gram join do per group, pair and chunk."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import common, line_dedup, ngram_join, packing


def test_chunks_of_a_mix_are_planned_by_several_tasks(spark, monkeypatch):
    """The plan of a chunk is few rows and long work: chunks must not be put together by bytes."""
    import public_tokenizers

    made = []

    class Seen(common.Scratch):
        def write(self, df, name):
            out = super().write(df, name)
            made.append((name, out))
            return out

    monkeypatch.setattr(packing, "Scratch", Seen)
    d = spark.createDataFrame([(k, f"word {k}", k * 8, 0) for k in range(64)],
                              "doc_id long, text string, slot long, place long")
    out = packing.pack_mixed(d, public_tokenizers.path("word_bpe_49k.json"), slots=32)
    assert out.count() == 64
    plan = dict(made)["plan"]
    assert plan.select("chunk").distinct().count() == 16
    assert plan.select(F.input_file_name()).distinct().count() > 4


def test_knapsack_is_that_of_one_place_after_the_other():
    rng = np.random.default_rng(3)
    for _ in range(30):
        capacity, n = int(rng.integers(5, 300)), int(rng.integers(1, 30))
        size, value = rng.integers(rng.integers(1, 30), capacity + 30, n), rng.random(n)
        best = [0.0]
        for c in range(1, capacity + 1):
            best.append(max([best[-1], *(v + best[c - s] for s, v in zip(size.tolist(), value.tolist()) if s <= c)]))
        counts = packing._knapsack(size, value, capacity)
        assert (counts * size).sum() <= capacity and abs((counts * value).sum() - best[-1]) < 1e-9


def test_near_pairs_of_a_group_and_rows_of_the_rest():
    key = np.array([1, 1, 2, 2, 2, 3, 4, 4, *[5] * 40])
    aux = np.array([0, 1, 0, 1, 9, 0, 0, 0, *[7] * 40])
    more = np.zeros(len(key), dtype=bool)
    more[6] = True  # key 4 has members elsewhere
    rows, a, b = common._near_pairs(key, aux, more, lambda x, y: abs(x - y) < 5)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (2, 3)]
    assert rows.tolist() == list(range(6, 48))  # all of 40 are near each other: stars, not pairs


def test_near_conditions_on_arrays_are_those_of_columns(spark):
    rng = np.random.default_rng(5)
    far = rng.integers(-(1 << 63), 1 << 63, (2, 500))
    far[1, :400] = far[0, :400] ^ [sum(1 << int(k) for k in rng.choice(63, i % 40, replace=False)) for i in range(400)]
    far[1, :50] ^= -(1 << 63)
    sets = rng.integers(5, 60, (2, 500)) | (rng.integers(0, 8, (2, 500)) << 32) | (rng.integers(0, 1000, (2, 500)) << 53)
    for (x, y), near, close in (
            (far, line_dedup._near, lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= line_dedup.BITS_APART),
            (sets, ngram_join._near, ngram_join._may_link)):
        d = spark.createDataFrame([(k, int(a), int(b)) for k, (a, b) in enumerate(zip(x, y))], "k long, a long, b long")
        want = [r.ok for r in d.withColumn("ok", close(F.col("a"), F.col("b"))).orderBy("k").collect()]
        assert near(x, y).tolist() == want and 0 < sum(want) < 500


def test_edits_in_a_band():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    rng = np.random.default_rng(11)
    pairs = [("a" * n, "a" * n) for n in (1, 64, 128)] + [("a" * 64, "b" * 65)]
    for k in range(60):
        a = list(rng.choice(list("abcé世 "), int(rng.integers(1, 200))))
        b = list(a)
        for _ in range(k % 25):
            b.insert(int(rng.integers(0, len(b) + 1)), str(rng.choice(list("abc"))))
            b.pop(int(rng.integers(0, len(b))))
        pairs.append(("".join(a), "".join(b)))
    want = np.array([edits(a, b) for a, b in pairs])
    for most in (0, 3, 31, 250):
        got = line_dedup._edits([a for a, _ in pairs], [b for _, b in pairs], most)
        assert (np.where(want <= most, got == want, got > most)).all()


def test_pairs_are_judged_together_or_left():
    """Pairs of like length are judged in tasks, single long ones are left to ``levenshtein``."""
    import pyarrow as pa

    text = "ten startled badgers watch from under the hedge"
    x = [text] * 300 + ["a" * 5000, "", text]
    y = [f"{text[:k % 40]}{'#' * (k % 15)}{text[k % 40:]}" for k in range(300)] + ["a" * 4999 + "b", text, ""]
    b = pa.RecordBatch.from_arrays(
        [pa.array(range(303)), pa.array(range(303)), pa.array(x), pa.array(y), pa.array([9] * 303, pa.int32())],
        ["a", "b", "x", "y", "most"])
    got = next(line_dedup._judged([b])).to_pylist()
    assert [r["alike"] for r in got] == [k % 15 <= 9 for k in range(300)] + [None] * 3
    assert [r["x"] for r in got] == [None] * 300 + x[300:]
