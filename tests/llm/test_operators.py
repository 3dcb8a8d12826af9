"""The corpus operators against brute force, round trips and edge cases on small fixtures."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    common, embed_dedup, fingerprints, kneser_ney, language_id, license_scan, line_dedup, mixing,
    ngram_join, packing, quality,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int"
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _words(n, seed, vocabulary=400):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, vocabulary, n)]


def _fixture():
    base = _words(120, 1)
    texts = [" ".join(base), " ".join(base), " ".join(base[:60] + ["new"] + base[61:]), " ".join(base[:60]),
             None, "", "   \n ", "one two", "ONE two", "one two three four five", "x" * 50_000]
    for k in range(25):  # near copies, each with words of its own
        w = list(base)
        w[4 * k % 118] = f"own{k}"
        texts.append(" ".join(w))
    passage = _words(55, 2)
    for k in range(60):  # a passage that many unlike documents share
        own = _words(12 + 20 * (k % 4), 100 + k, 100_000)
        texts.append(" ".join(own[:6] + passage + own[6:]))
    texts += [" ".join(_words(3000, 9, 50_000)), "Ünï çödé tëxt wïth accents"]
    return [(k, t, "en" if k % 2 else "de", None if k % 7 == 0 else f"s{k % 3}", None, 1) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return _fixture()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _sets(texts, k=5):
    out = []
    for t in texts:
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def _reach(n, links):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return [find(x) for x in range(n)]


def _jaccard_truth(texts):
    s = _sets(texts)
    links = [(a, b) for a in range(len(s)) for b in range(a + 1, len(s))
             if s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    return [len(x) for x in s], _reach(len(s), links)


def test_ngram_join_equals_brute_force(docs, rows):
    got = {r.doc_id: r for r in ngram_join.jaccard_components(docs).collect()}
    sizes, top = _jaccard_truth([r[1] for r in rows])
    assert {k: r.n_shingles for k, r in got.items()} == dict(enumerate(sizes))
    assert {k: r.component_id for k, r in got.items()} == dict(enumerate(top))
    assert {r.doc_id for r in ngram_join.keep_one(docs).collect()} == {k for k, t in enumerate(top) if k == t}


def test_ngram_join_with_every_token_frequent(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "frequent_cells",
                        lambda t, n: np.ones((ngram_join.ROWS, ngram_join.CELLS), bool))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == dict(enumerate(_jaccard_truth([r[1] for r in rows])[1]))


def test_ngram_join_null_and_repeated_ids(spark, empty):
    t = " ".join(_words(30, 3))
    d = spark.createDataFrame([(None, t), (5, t), (5, t), (9, t)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_join.jaccard_components(d).collect())
    assert got == [(-1, -1), (5, 5), (5, 5), (9, 5)]
    assert ngram_join.jaccard_components(empty).count() == 0


def test_histogram_bounds_the_intersection():
    rng = np.random.default_rng(4)
    for n, m, shared in ((50, 50, 40), (400, 320, 300), (9, 8, 8), (2000, 1999, 0)):
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        y = np.concatenate([x[:shared], rng.integers(0, 1 << 63, m - shared).astype(np.uint64)])
        assert ngram_join.most_common_tokens(ngram_join.histogram(x), ngram_join.histogram(y)) >= shared


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    scratch = common.Scratch(spark, "test")
    got = common.components(scratch, spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.label for r in got} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_components_of_later_links(spark):
    rng = np.random.default_rng(8)
    old, new = ([tuple(sorted(p)) for p in rng.integers(0, 90, (n, 2)).tolist() if p[0] != p[1]] for n in (40, 25))
    scratch = common.Scratch(spark, "test")
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    got = common.components(scratch, frame(new), common.components(scratch, frame(old))).collect()
    top = _reach(90, old + new)
    assert sorted((r.id, r.label) for r in got) == [(k, top[k]) for k in sorted({x for p in old + new for x in p})]


def test_line_dedup(spark, empty):
    line = "the quick brown fox jumps over the lazy dog while seventeen startled badgers watch from under a hedge"
    d = spark.createDataFrame([
        (1, f"{line}\nonly here alpha\n\n----", "x"), (2, f"{line.upper()}!\nonly there beta gamma", "x"),
        (3, None, "x"), (4, "", "x"), (None, line, "x"), (5, line, "x"), (5, line, "x"), (6, f"{line}s", "x")],
        "doc_id long, text string, kept string")
    report = {r.doc_id: r for r in line_dedup.line_report(d).collect()}
    assert list(report[1].kept_lines) == [0, 1, 2, 3] and list(report[2].kept_lines) == [1]
    assert (report[3].n_lines, report[3].n_kept) == (0, 0) and report[5].n_kept == 0
    assert list(report[None].kept_lines) == [0]
    out = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(d).select("doc_id", "text").collect()}
    assert (2, "only there beta gamma") in out and (3, None) in out and (5, "") in out
    assert line_dedup.line_report(empty).count() == 0


def test_line_candidates_follow_the_simhash_radius(spark):
    """Every pair of lines within 3 bits and 0.8 edit similarity ends in one group."""
    rng = np.random.default_rng(8)
    base = [" ".join(f"word{x}" for x in rng.integers(0, 5000, 60)) for _ in range(40)]
    texts = base + [t.replace(t.split()[k % 50], "of", 1) for k, t in enumerate(base)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    import pyarrow as pa
    hashes = {}
    for b in line_dedup._lines([pa.RecordBatch.from_arrays(
            [pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])]):
        hashes |= dict(zip(b.column(0).to_pylist(), b.column(4).to_pylist(), strict=True))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    forms = [re.sub(r"\d", "0", t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
             if ((hashes[a] ^ hashes[b]) & common.MASK).bit_count() <= 3
             and edits(forms[a], forms[b]) <= 0.2 * max(len(forms[a]), len(forms[b]))]
    same = [(a, b) for a in range(len(forms)) for b in range(a + 1, len(forms)) if forms[a] == forms[b]]
    top = _reach(len(texts), links + same)
    got = {r.doc_id for r in line_dedup.line_report(d).where("n_kept > 0").collect()}
    assert links and got == {k for k, t in enumerate(top) if k == t}


def test_patience_alignment_and_scan(spark, empty):
    assert license_scan.patience("a b c d e".split(), "a x c d e".split()) == [(0, 0), (2, 2), (3, 3), (4, 4)]
    mit = license_scan.TEMPLATES["MIT"]
    filler = " ".join(_words(40, 5))
    d = spark.createDataFrame([
        (1, f"{filler}\n{mit}\n{filler} Released under the MIT License. {filler} Released under the MIT License."),
        (2, filler + " license of the software"), (3, None), (4, mit.replace("merge", "mix").upper())],
        "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(d).collect()}
    assert got[1].licenses == ["MIT", "MIT notice"] and got[1].n_hits == 3
    assert got[2].n_hits == 0 and got[3].n_hits == 0 and got[4].licenses == ["MIT"]
    assert 0.9 < got[4].best_coverage < 1
    assert license_scan.scan_licenses(empty).count() == 0


def test_pfair_schedule_stays_within_a_block(spark):
    quota = spark.createDataFrame([("a", 500), ("b", 1), ("c", 250), ("d", 7), ("e", 242)], "source string, quota long")
    rows = sorted(mixing.schedule(quota).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(1000))
    done = Counter()
    for t, r in enumerate(rows, 1):
        done[r.source] += 1
        for s, q in (("a", 500), ("b", 1), ("c", 250), ("d", 7), ("e", 242)):
            assert abs(done[s] - q * t / 1000) < 1


def test_mixing_keeps_every_row(docs, rows, empty):
    got = mixing.mix(docs, block=500).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert len({(r.slot, r.place) for r in got}) == len(got)
    assert "label" in mixing.mix(docs).columns and mixing.mix(empty).count() == 0


def test_fingerprints(spark, docs, rows, empty):
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    texts = [r[1] or "" for r in rows]
    import hashlib
    for k, t in enumerate(texts):
        n = len(t) // 4
        edited = t[:len(t) - n] + texts[(k + 1) % len(texts)][:n]
        assert got[k].n_chars == len(t)
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[k].fingerprint == got[k].edited_fingerprint) == (edited == t)
        assert 0 <= got[k].near_edited <= 1 and 0 <= got[k].near_next <= 1
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    one = fingerprints.fingerprints(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and fingerprints.fingerprints(empty).count() == 0
    d = spark.createDataFrame([("a\nb\n\nc", "a\nx\n\nc\n\nd")], "x string, y string").select(
        fingerprints.edited_branches(fingerprints.tree(F.col("x")), fingerprints.tree(F.col("y"))).alias("at")).first()
    assert [(r.section, r.paragraph) for r in d["at"]] == [(0, 1), (2, -1)]


def test_quality_shrinks_and_tells_apart(spark, docs, empty):
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for k in range(400):
        bad, toxic = k % 5 == 0, k % 7 == 0
        w = _words(40, 1000 + k, 300)
        if bad:
            w = [x.upper() + "!!" for x in w]
        if toxic:
            w[3] = w[20] = "vilestuff"
        texts.append((k, " ".join(w), f"host{rng.integers(0, 6)}/p{rng.integers(0, 3)}"))
        if k % 4:
            labels.append((k, 0 if bad else 1, int(toxic)))
    d = spark.createDataFrame([*texts, (None, None, None)], "doc_id long, text string, site string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.rate_documents(d, lab, F.col("site")).collect()
    own = [r for r in got if r.doc_id is not None and r.doc_id % 4 == 0]
    right = sum(r.keep == (r.doc_id % 5 != 0 and r.doc_id % 7 != 0) for r in own)
    assert len(got) == 401 and right >= 0.95 * len(own)
    rates = {r.site: (r.host_quality, r.path_quality) for r in got}
    assert all(0 < x < 1 for pair in rates.values() for x in pair)
    none = quality.rate_documents(docs, lab.limit(0), F.col("source")).collect()
    assert all(r.keep for r in none) and quality.rate_documents(empty, lab, F.col("source")).count() == 0


def test_packing_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(docs, TOKENIZER, 512).collect()
    want = {}
    for k, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[s:s + 512], "<u4")
            want[(k, p)] = (s, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 512
    total = sum(w[1] for w in want.values())
    assert len(by) <= -(-total // 512) * 1.1 + 1
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(5)
    lengths = Counter(np.minimum(4096, rng.lognormal(6.5, 1.0, 60_000).astype(int) + 1).tolist())
    patterns = packing.pack_lengths(lengths)
    held = Counter()
    for p, c in patterns:
        assert sum(p) <= 4096
        for n in p:
            held[n] += c
    assert held == lengths
    assert sum(c for _, c in patterns) <= 1.01 * sum(n * c for n, c in lengths.items()) / 4096 + 1


def test_language_held_out_accuracy(spark, empty):
    syllables = {"aa": ["ka", "to", "ri"], "bb": ["sch", "ung", "ein"], "cc": ["ço", "ãe", "lha"]}
    rng = np.random.default_rng(6)
    rows = []
    for k in range(300):
        lang = "abc"[k % 3] * 2
        rows.append((k, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(30)), lang))
    rows += [(900, None, "aa"), (901, "123 --", None), (None, rows[0][1], None)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by = {r.doc_id: r for r in got}
    assert by[900].lang_pred == by[901].lang_pred == "und" and by[None].lang_pred == "aa"
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert held and all(r.lang_pred == "abc"[r.doc_id % 3] * 2 and 0 <= r.score <= 1 for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert language_id.identify(empty).count() == 0


def test_embedding_recall_and_precision(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((300, 64))
    base[100:180] = base[0] + 0.15 * rng.standard_normal((80, 64))  # a cluster of near copies
    base[200:220] = base[199]
    v = [[float(np.float32(y)) for y in x] for x in base]
    v[250], v[251], v[252], v[253], v[254] = None, [0.0] * 64, [float("nan")] * 64, v[249][:63] + [None], [1.0]
    d = spark.createDataFrame([(k, x, 1) for k, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(d.repartition(4)).collect()}
    good = [k for k in range(300) if not 250 <= k < 255]
    u = np.array([v[k] for k in good])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cos = u @ u.T
    links = [(good[a], good[b]) for a in range(len(good)) for b in range(a + 1, len(good)) if cos[a, b] >= 0.9]
    assert sum(r.n_links for r in got.values()) / 2 >= 0.9 * len(links)
    degree = Counter(x for p in links for x in p)
    assert all(got[k].n_links <= degree[k] for k in range(300)) and got[210].n_links == 20
    assert all(got[k].n_links == 0 and got[k].kept for k in range(250, 255))
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_duplicates(none).count() == 0


def test_kneser_ney_against_plain_python(docs, rows, empty):
    got = {r.doc_id: r for r in kneser_ney.score_texts(docs).collect()}
    toks = {k: [*(w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w), None]
            for k, t, *_ in rows}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in toks}
    uni, pair = Counter(), Counter()
    for k, ws in toks.items():
        if not held[k]:
            uni.update(ws)
            pair.update(zip([0, *ws], ws, strict=False))
    n, v = sum(uni.values()), len(uni)
    left, cont = Counter(), Counter(b for _, b in pair)
    kinds = {}
    for (a, _), c in pair.items():
        left[a] += c
        kinds.setdefault(a, Counter())[min(c, 3)] += 1
    d2 = kneser_ney.discounts(Counter(pair.values()))
    d1 = kneser_ney.discounts(Counter(cont.values()))
    k_sum = sum(cont.values())
    freed = sum(d1[min(c, 3)] for c in cont.values()) / k_sum
    low = lambda w: max(cont[w] - d1[min(cont[w], 3)], 0) / k_sum + freed / (v + 1)

    def p(a, b):
        if not left[a]:
            return low(b)
        mass = sum(d2[j] * m for j, m in kinds[a].items()) / left[a]
        c = pair[(a, b)]
        return max(c - d2[min(c, 3)], 0) / left[a] + mass * low(b)
    assert abs(sum(low(w) for w in uni) + freed / (v + 1) - 1) < 1e-9
    assert abs(sum(p(0, w) for w in uni) + p(0, "never seen") - 1) < 1e-9
    for k, ws in toks.items():
        r = got[k]
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(ws), n, held[k])
        assert r.n_known == sum(uni[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(np.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert r.score == pytest.approx(sum(np.log10(p(a, b)) for a, b in zip([0, *ws], ws, strict=False)))
    assert kneser_ney.score_texts(empty).count() == 0


def _edf(weights, blocks):
    """{(source, block): (release, deadline, slot)} slot by slot, in exact fractions."""
    from fractions import Fraction
    total = sum(Fraction(w) for w in weights.values())
    w = {s: Fraction(x) / total for s, x in weights.items() if x > 0}
    done, out, t = dict.fromkeys(w, 0), {}, 0
    while any(done[s] < blocks[s] for s in w):
        free = [(-(-(done[s] + 1) / w[s] // 1), s) for s in w if done[s] < blocks[s] and done[s] / w[s] // 1 <= t]
        if free:
            d, s = min(free)
            out[(s, done[s])] = (done[s] / w[s] // 1, d, t)
            done[s] += 1
        t += 1
    return out


@pytest.mark.parametrize("count", [5, 60])
def test_schedule_keeps_the_unrounded_weights(spark, monkeypatch, count):
    """Also over many ranges of deadlines, and after sources have ended."""
    monkeypatch.setattr(mixing, "RANGE", 1)
    rng = np.random.default_rng(count)
    weights = {f"s{k:02}": float(x) for k, x in enumerate(rng.uniform(0.03, 1.0, count) ** 1.5 + 0.01)}
    blocks = {s: int(x) for s, x in zip(weights, rng.integers(1, 1500 // count, count), strict=True)}
    quota = spark.createDataFrame([(s, w, blocks[s]) for s, w in weights.items()], "source string, quota double, blocks long")
    got = {(r.source, r.block): (r.release, r.deadline, r.slot) for r in mixing.schedule(quota).collect()}
    assert got == _edf(weights, blocks)
    assert all(r <= t < d for r, d, t in got.values()) and len({t for *_, t in got.values()}) == len(got)


def test_mix_stays_within_a_block_of_the_target_weights(spark):
    """With 0.9 % of one source and none of another, where rounding to a slot would show."""
    weights = {"a": 0.99063, "b": 0.00937}
    d = spark.createDataFrame([(k, "x" * 9, "a" if k % 16 else "b" if k % 32 else "c") for k in range(8000)],
                              "doc_id long, text string, source string")
    got = sorted(mixing.mix(d, weights, block=10).collect(), key=lambda r: r.slot)
    assert len(got) == 8000 and all(r.source == "c" for r in got[-250:])
    assert all(r.release is None and not r.in_mix for r in got[-250:])
    done = Counter()
    for r in got[:-250]:
        done[r.source] += 1
        if r.in_mix:
            assert all(abs(done[s] - w * (r.slot + 1)) < 1 for s, w in weights.items())


@pytest.mark.parametrize("length", [10, 27, 60])
def test_line_dedup_recall_of_edited_words(spark, length):
    """Lines with up to a fifth of their words replaced, against edit similarity alone."""
    rng = np.random.default_rng(length)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(5000)]

    def edits(a, b):
        row = np.arange(len(b) + 1)
        at, b = np.arange(len(b) + 1), np.frombuffer(b.encode(), np.uint8)
        for i, x in enumerate(a.encode(), 1):
            new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != x))])
            row = np.minimum.accumulate(new - at) + at
        return row[-1]
    texts = []
    for k in range(120):
        w = list(rng.choice(vocabulary, length))
        v = list(w)
        for at in rng.choice(length, max(1, round(length * (0.05, 0.1, 0.15, 0.2)[k % 4])), replace=False):
            v[at] = str(rng.choice(vocabulary))
        texts.append((" ".join(w), " ".join(v)))
    true = [k for k, (w, v) in enumerate(texts) if edits(w, v) <= 0.2 * max(len(w), len(v))]
    d = spark.createDataFrame([(2 * k + j, t) for k, pair in enumerate(texts) for j, t in enumerate(pair)],
                              "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.line_report(d).where("n_kept > 0").collect()}
    assert len(true) > 80 and all(2 * k in kept for k in range(120))
    assert all(2 * k + 1 in kept for k in set(range(120)) - set(true))
    assert sum(2 * k + 1 not in kept for k in true) >= 0.93 * len(true)


def test_licence_notices_beside_other_signs(spark):
    """Breaks beyond ASCII, digits and underscores beside words, notices without a unique word."""
    apache, mit, gpl = (license_scan.TEMPLATES[f"{n} notice"] for n in ("Apache-2.0", "MIT", "GPL"))
    texts = {
        1: (apache.replace(" ", "\u00a0"), 1), 2: (f"“{mit[:-1]}”", 1), 3: (f"so—{mit[:-1]}。", 1),
        4: (f"2024{mit[:-1]}2", 1), 5: (f"_{mit[:-1]}_", 1), 6: (f"{mit} {mit} {mit}", 3), 7: (f"{gpl}\n{gpl}\n{gpl}", 3),
        8: (f"Released released under under the the {mit} MIT MIT License license", 1), 9: ("café " + mit.upper(), 1),
        10: ("“under the License”", 0)}
    d = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(d).collect()}
    assert {k: r.n_hits for k, r in got.items()} == {k: n for k, (_, n) in texts.items()}
    assert all(got[k].best_coverage == 1.0 for k in texts if k != 10)


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    """A labelled doc_id in a third of the rows, with one text and with many."""
    monkeypatch.setattr(quality, "TRAIN", 60)
    d = spark.createDataFrame(
        [(k, f"text {k}") for k in range(40)] + [(7, "text 7")] * 500 + [(8, f"other {k}") for k in range(500)],
        "doc_id long, text string").repartition(6)
    lab = spark.createDataFrame([(k, float(k % 2), 0.0) for k in range(40)], "doc_id long, quality double, toxic double")
    got = quality.sample(common.Scratch(spark, "test"), d, lab, 40).collect()
    assert 30 <= len(got) <= 60 and len({(r.doc_id, r.hash) for r in got}) == len(got)
    assert sum(r.doc_id == 7 for r in got) <= 1 and "text" not in got[0].asDict()
    few = quality.sample(common.Scratch(spark, "test"), d.where("doc_id != 8"), lab, 40).collect()
    assert sorted(r.doc_id for r in few) == [k for k in range(40) if k != 8]
