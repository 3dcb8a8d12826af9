"""Rare shapes of input: clashing names, unlike vector lengths, big counts, hot rows, marks only."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, embed_dedup, kneser_ney, language_id, line_dedup, mixing, packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _clashing(spark, names):
    rows = [(k, f"some words of number {k}\nthe same line for all of them here", "en", f"s{k % 3}", 9, *[-7] * len(names))
            for k in range(30)]
    return spark.createDataFrame(rows, DOCS + "".join(f", `{n}` int" for n in names))


def test_mix_carries_columns_of_clashing_names(spark):
    names = ["block", "slot", "release", "Deadline", "before", "_start", "_source", "size", "a.b", "input_slot"]
    out = mixing.mix(_clashing(spark, names), block=200)
    rows = out.collect()
    assert len(rows) == 30 and len({c.lower() for c in out.columns}) == len(out.columns)
    for name in ("input_block", "input_release", "input_Deadline", "before", "_start", "_source", "size", "a.b",
                 "input_slot", "input_input_slot"):
        assert {r[name] for r in rows} == {-7}, name
    plain = mixing.mix(_clashing(spark, []), block=200).collect()
    key = lambda r: (r.doc_id, r.block, r.slot, r.place, r.release, r.deadline)
    assert sorted(map(key, rows)) == sorted(map(key, plain))


def test_a_source_named_as_none_is_not_the_null_source(spark):
    rows = [(k, "x" * 50, "en", [None, "(none)", "(none).", "a"][k % 4], 50) for k in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), block=100).groupBy("source", "source_name").count().collect()
    assert {(r["source"], r["source_name"], r["count"]) for r in got} == {
        (None, "(none)", 10), ("(none)", "(none).", 10), ("(none).", "(none)..", 10), ("a", "a", 10)}


def test_schedule_with_a_rare_source(spark):
    """One block in 6,001 slots: a range of 6,001 slots or more is one fold."""
    quota = spark.createDataFrame([("often", 6000.0, 12000), ("rare", 1.0, 2)], "source string, quota double, blocks long")
    got = {(r.source, r.block): r.slot for r in mixing.schedule(quota).collect()}
    want, done, slot = {}, {"often": 0, "rare": 0}, 0
    weight = {"often": Fraction(6000, 6001), "rare": Fraction(1, 6001)}
    limit = {"often": 12000, "rare": 2}
    while done != limit:
        ready = [(math.ceil((done[s] + 1) / weight[s]), s) for s in done
                 if done[s] < limit[s] and math.floor(done[s] / weight[s]) <= slot]
        if ready:
            s = min(ready)[1]
            want[s, done[s]] = slot
            done[s] += 1
        slot += 1
    assert got == want


def test_line_dedup_carries_columns_of_clashing_names(spark):
    names = ["_doc", "_kept", "_lines", "_stays", "kept", "k1", "a.b"]
    docs = _clashing(spark, names)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 30 and all({r[n] for r in rows} == {-7} for n in names)
    assert sum("the same line" in r.text for r in rows) == 1


def test_marks_and_digits_are_no_language(spark):
    rows, letters = language_id.presence(pa.array(["́̂", "12 + 3", None, "", "é", "ж"]))
    assert letters.tolist() == [False, False, False, False, True, True]
    docs = [(k, f"{w} " * 30, lang, "s", 1) for k in range(60)
            for w, lang in [(("house water tree", "en") if k % 2 else ("maison arbre rouge", "fr"))]]
    docs += [(100, "́̂", "en", "s", 1), (101, None, "en", "s", 1), (None, "water house", "fr", "s", 1)]
    docs += [(1, "house water tree", "en", "s", 1)] * 3
    table = spark.createDataFrame(docs, DOCS).withColumn("bits", F.lit(1)).withColumn("score", F.lit("x"))
    got = language_id.identify(table).collect()
    assert len(got) == len(docs)
    of = {r.doc_id: r.lang_pred for r in got}
    assert of[100] == of[101] == "und" and of[None] == "en"
    assert all(of[k] == ("en" if k % 2 else "fr") for k in range(60))
    kept = language_id.keep_identified(table, 0.0)
    assert kept.columns == table.columns and kept.count() == len(docs) - 2


def test_training_rows_that_repeat_count_once(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_A_LANGUAGE", 40)
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda bits, langs: seen.append(langs) or ([], 0, 0))
    rows = [(8, "the very same text", "en", "s", 1)] * 500 + [(k, f"text of {k} " + "ab" * k, "en", "s", 1) for k in range(100)]
    language_id.train(spark.createDataFrame(rows, DOCS))
    assert 20 <= len(seen[0]) <= 70


def _components(ids, links):
    label = {i: i for i in ids}
    while True:
        moved = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                moved = True
        if not moved:
            return label


def test_vectors_of_several_lengths_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for dim, clusters in ((32, 12), (7, 6), (1, 1)):
        for _ in range(clusters):
            centre = rng.standard_normal(dim)
            rows += [(centre + rng.standard_normal(dim) * s).tolist() for s in (0.0, 0.0, 0.1, 0.15, 0.2, 1.5)]
    rows += [None, [], [0.0] * 32, [1.0, None, 2.0], [float("nan")] * 7, [math.inf] * 7, [3.0] * 3, [3.0] * 3]
    table = spark.createDataFrame([(k, v, -1, -1) for k, v in enumerate(rows)] + [(None, rows[0], 1, 1)],
                                  "vec_id long, embedding array<double>, id int, dim int")
    unit = {}
    for k, v in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[k] = np.array(v) / np.linalg.norm(v)
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    label = _components(range(len(rows)), links)
    degree = {k: sum(k in x for x in links) for k in range(len(rows))}
    got = embed_dedup.near_duplicates(table).collect()
    assert len(got) == len(rows) + 1
    own = [r for r in got if r.vec_id is not None]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in own} == {
        k: (degree[k], label[k], label[k] == k) for k in range(len(rows))}
    assert [(r.n_links, r.component_id) for r in got if r.vec_id is None] == [(0, None)]
    empty = spark.createDataFrame([], table.schema)
    assert embed_dedup.near_duplicates(empty).count() == 0


def test_bigram_counts_and_word_numbers_beyond_32_bits(tmp_path):
    before = np.array([0, 3_000_000_000, (1 << 32) - 1], np.int64)
    number = np.array([4_000_000_000, 7, 2_500_000_000], np.int64)
    key = kneser_ney._key(before, number)
    assert [x.tolist() for x in kneser_ney._two(key)] == [before.tolist(), number.tolist()]
    n = np.array([1, (1 << 32) + 5, 2], np.int64)
    blob = lambda a, b: pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())],
        ["shard", "keys", "n"])
    batches = [blob(key, kneser_ney._narrow(n)), blob(key[2:], kneser_ney._narrow(n[2:]))]
    rows = [r for b in kneser_ney._store_bigrams(str(tmp_path))(iter(batches)) for r in b.to_pylist()]
    assert {r["id"]: r["a"] for r in rows if r["kind"] == 0} == {0: 1, 3_000_000_000: (1 << 32) + 5, (1 << 32) - 1: 4}
    assert {r["id"]: r["a"] for r in rows if r["kind"] == 1} == {4_000_000_000: 1, 7: 1, 2_500_000_000: 1}
    model = kneser_ney.Model(str(tmp_path), np.array([0, 5]))
    assert model.bigrams(key, 1).tolist() == [1, (1 << 32) + 5, 4]


def test_shards_of_a_task_come_one_by_one(spark):
    rows = spark.range(2000).select((F.col("id") % 50).cast("int").alias("shard"), "id")

    def sizes(batches):
        for shard, group in common.shard_groups(batches):
            ids = [x.as_py() for x, in group]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(ids)])], ["shard", "n"])

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = common.by_shard(rows, 50).mapInArrow(sizes, "shard int, n long").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted((r.shard, r.n) for r in got) == [(k, 40) for k in range(50)]


def test_equal_rows_are_packed_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "_buckets", lambda pieces: 16)
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"))
    rows = packing.pack(docs, TOKENIZER, 64).collect()
    assert len(rows) == 3000
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (t, p, _) in zip(places, places[1:]):
        assert (t == s and p == o + n) or (t != s and p == 0)
    assert len({r.sequence_id for r in rows}) == math.ceil(3000 / (64 // places[0][2]))


def test_line_dedup_keys_go_in_parts_and_lines_are_dropped(spark, monkeypatch):
    one = pa.RecordBatch.from_arrays([pa.array([5], pa.int64()), pa.array([77], pa.int64()), pa.array([bytes(range(128))])],
                                     ["id", "simhash", "bands"])
    keys = [k.tobytes() for p in range(line_dedup.KEY_PARTS) for k, _, _ in line_dedup._emit(p)([one])]
    assert len(keys) == len(set(keys)) == 10 + line_dedup.BANDS
    made = []

    class Seen(common.Scratch):
        def __init__(self, *a):
            super().__init__(*a)
            made.append(self)

    monkeypatch.setattr(line_dedup, "Scratch", Seen)
    docs = _clashing(spark, [])
    assert line_dedup.kept_lines(docs).count() == 1  # digits read alike, so all lines are copies
    left = spark._jvm.java.io.File(made[0].root.removeprefix("file:")).list()
    assert not [x for x in left if x.endswith(("-lines", "-classes", "-wanted", "-normal-forms")) or "-shared-" in x]
