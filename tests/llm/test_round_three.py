"""Periodic runs, conversation repair and adaptive rules against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import adaptive_rules, conversations, periodic, queries
from tidemark.llm.common import mix

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int"
TALK = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# --------------------------------------------------------------------------------- runs

def _runs(w, least):
    """All maximal runs by trying every period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= 2 * q:
                out.setdefault((s, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in out.items() if e - s >= least), key=lambda r: (r[0], r[2]))


def _runs_row(doc_id, text, damage):
    w = _words(text)
    if damage and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = _runs(w, 12)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha(" ".join(kept)))


def test_all_runs_of_short_sequences():
    rng = random.Random(5)
    for _ in range(300):
        k, n = rng.choice([1, 2, 3, 5]), rng.randint(1, 60)
        w = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.4:
            w = w[:5] + [rng.randint(1, k) for _ in range(rng.randint(1, 12))] * rng.randint(2, 5) + w[5:]
        h = mix(np.array(w, dtype=np.uint64))
        assert sorted(map(tuple, periodic.runs_of(h).tolist()), key=lambda r: (r[0], r[2])) == _runs(w, 2)
        assert periodic.find_runs(h) == _runs(w, 12)


def _texts():
    rng = random.Random(2)
    word = lambda k: [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, 90))]
    out = [None, "", " \n\t ", "one", "a " * 12, "a " * 11, "Aa aa " * 6, "é ü é ü " * 5, "x y " * 20,
           "one\vtwo\fone two " * 4, " ".join(word(9) * 3), "same\nline\n" * 30, "a b c " * 3000]
    for k in range(150):
        w = word(4 if k % 3 else 60)
        out.append(" ".join(word(50) + w * (1 + k % 4) + word(50)))
    return out


def _documents(spark, extra=()):
    rows = [(k if k % 11 else k * 7919, t, "en", "s", None, 1) for k, t in enumerate(_texts())]
    rows += [rows[12], rows[12], (None, "a b " * 10, None, None, None, None), *extra]
    return rows, spark.createDataFrame(rows, DOCS).repartition(4)


def test_periodic_runs_equal_brute_force(spark):
    rows, docs = _documents(spark)
    key = lambda r: tuple(str(x) for x in r)
    for damage in (False, True):
        # clashing names are ignored
        got = periodic.periodic_runs(docs.withColumn("runs", F.lit(1)).withColumn("start", F.lit("x")), damage=damage)
        want = [_runs_row(r[0], r[1], damage) for r in rows]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        found = got.collect()
        assert sorted((tuple(r[c] for c in names) for r in found), key=key) == sorted(want, key=key)
        assert all(_sha(r["collapsed"]) == r["collapsed_sha256"] and len(r["runs"]) == r["n_runs"] for r in found)
    assert sum(r[1] > 0 for r in want) > 40
    assert sum(_runs_row(r[0], r[1], False) != _runs_row(r[0], r[1], True) for r in rows) > 5


def test_periodic_runs_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    short = [r for r in docs.collect() if len(_words(r["text"])) < 400]
    assert len(short) > 50 and all(_runs_row(r["doc_id"], r["text"], True) in got for r in short)
    assert len(got) == docs.count()


def test_periodic_runs_of_an_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []


# ------------------------------------------------------------------------- conversations

def _cheapest(rows):
    """(cost, audit, repaired) by dynamic programming over (role, text, must go, truncated)."""
    step = {"0": "user", "s": "user", "u": "assistant", "a": "user"}
    now = {"0": (0, "", ())}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value
            return True
        return False

    def insert():
        while any([better(now, step[q][0], (c + 2, a + "I", t + ((step[q], ""),))) for q, (c, a, t) in list(now.items())]):
            pass

    for role, text, gone, short in rows:
        insert()
        after = {}
        for q, (c, a, t) in now.items():
            better(after, q, (c + 3, a + "D", t))
            if not gone:
                better(after, step[q][0], (c + 2 + short, a + "R", t + ((step[q], text),)))
                if role[:1] in {"0": "su", "s": "u", "u": "a", "a": "u"}[q] and role:
                    better(after, role[0], (c + short, a + "K", t + ((role, text),)))
        now = after
    insert()
    return min(now[q] for q in "0a" if q in now)


def _repair_row(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], _sha(r[2])))
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults, marked = set(), Counter(), []
    for _, role, text in rows:
        solid = re.sub("[\x20\x09-\x0d]", "", text)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                 else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
        faults[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, kept = _cheapest(marked)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            _sha("\n".join(f"{r}:{t}" for r, t in kept)))


def _damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        named = [" " if x is None else x for x in (conv, turn, role, text)]
        k = zlib.crc32(f"{named[0]}:{named[1]}".encode()) % 20
        role, text = ("user" if k == 4 else named[2]), named[3]
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def _talks(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(120):
        n = rng.choice([1, 2, 3, 6, 9, 40]) if conv else 700
        for turn in range(n):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No?", " ", None, "ok", "fine \n", f"turn {turn}.", f"turn {turn} of", "Ü!\v", ""])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]) if conv % 3 else turn, role, text))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi.")]
    rows += [(500, 7, "user", "Same.")] * 40 + [(501, k, "user", "Same.") for k in range(40)]
    rows += [(502, k, "user" if k % 2 else "assistant", f"Long {k}. " * 2000) for k in range(6)]
    return rows, spark.createDataFrame(rows, TALK).repartition(5)


def _want(rows):
    return sorted((_repair_row(c, r) for c, r in _damaged(rows).items()), key=str)


def test_repair_equals_brute_force(spark):
    rows, talks = _talks(spark)
    talks = talks.withColumn("n", F.lit("x")).withColumn("part", F.lit(3)).withColumn("digest", F.lit(0))
    got = conversations.repair(*conversations.damaged(talks))
    assert sorted((tuple(r) for r in got.collect()), key=str) == _want(rows)


def test_repair_of_conversations_cut_into_parts(spark, monkeypatch):
    """Conversations over many parts and tasks: parts' matrices, prices, choice and joining."""
    rows, talks = _talks(spark)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    whole = conversations._solver

    def cut(schema, turns):
        run = whole(schema, turns)

        def with_small_parts(batches):
            conversations.PART_ROWS = 5
            return run(batches)
        return with_small_parts
    monkeypatch.setattr(conversations, "_solver", cut)
    try:
        got = conversations.repair(*conversations.damaged(talks))
        assert sorted((tuple(r) for r in got.collect()), key=str) == _want(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_repaired_turns_are_what_the_hash_says(spark):
    rows, talks = _talks(spark)
    damaged = conversations.damaged(talks)
    kept = {}
    for r in sorted(conversations.repaired_turns(*damaged).collect(), key=lambda r: (r["part"], r["place"])):
        kept.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in conversations.repair(*damaged).collect():
        assert _sha("\n".join(kept.get(r["conv_id"], []))) == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in kept.get(r["conv_id"], [])))


def test_repair_of_the_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op12_conversation_repair(spark, SF).collect()), key=str) == _want(rows)


def test_repair_of_an_empty_table(spark):
    assert conversations.repair(spark.createDataFrame([], TALK)).collect() == []


# --------------------------------------------------------------------------------- rules

def _measures(text):
    text = text or ""
    w = _words(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if _words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_capitals": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text))}


def _verdicts(rows):
    """Kept or not of each (text, lang, source), by plain lists of the rounded values."""
    slack = {"word_length": (500, 500), "symbols": (100, None), "repeated_lines": (200, None),
             "repeated_words": (100, None), "capitals": (100, None)}
    measured = []
    for text, lang, source in rows:
        m = _measures(text)
        share = lambda a, b: 1000 * m[a] // m[b] if m[b] else 0  # noqa: E731, B023
        v = {"word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"),
             "repeated_lines": share("n_dup_lines", "n_lines"), "repeated_words": share("n_repeat_words", "n_words"),
             "capitals": share("n_capitals", "n_letters")}
        measured.append((lang, source, v, m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]))

    def fence(pick):
        some = [v for lang, source, v, bad in measured if not bad and pick(lang, source)]
        out = {}
        for k, (above, below) in slack.items():
            cells = sorted(v[k] >> (s := max(0, v[k].bit_length() - 6)) << s for v in some)
            if cells:
                low, high = (cells[-(-len(cells) * p // 100) - 1] for p in (25, 75))
                spread = 3 * (high - low)
                out[k] = (high + max(spread, above), None if below is None else low - max(spread, below))
        return len(some), out

    whole = fence(lambda a, b: True)[1]
    by = {}
    for lang, source in {(x[0], x[1]) for x in measured}:
        n, lang_fence = fence(lambda a, b: a == lang)  # noqa: B023
        coarse = lang_fence if n >= 200 else whole
        n, own = fence(lambda a, b: (a, b) == (lang, source))  # noqa: B023
        if n < 200:
            by[lang, source] = coarse
        else:
            by[lang, source] = {k: (min(own[k][0], coarse[k][0] + slack[k][0]),
                                    None if slack[k][1] is None else max(own[k][1], coarse[k][1] - slack[k][1])) for k in slack}
    out = []
    for lang, source, v, bad in measured:
        limits = by[lang, source]
        out.append(not bad and all(v[k] <= limits[k][0] and (limits[k][1] is None or v[k] >= limits[k][1]) for k in slack))
    return out


def _rule_rows():
    rng = random.Random(4)
    rows = []
    for k in range(1500):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None])
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8 if lang == "en" else 12))) for _ in range(rng.randint(5, 60))]
        kind = rng.random()
        if kind < 0.1:
            w = [x.upper() + "!!" for x in w]
        elif kind < 0.2:
            w = [x + "###" for x in w]
        elif kind < 0.25:
            w = w[:5] * 20
        rows.append((k, rng.choice([" ", "\n", " \n"]).join(w), lang, source, None, 1))
    rows += [(2000 + k, t, "fr", "rare", None, 1) for k, t in enumerate(_texts())]
    return rows + [rows[0], rows[0], (None, "ä b\rc " * 30, None, "a", 1, 1)]


def test_rules_equal_brute_force(spark):
    rows = _rule_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit(0)).withColumn("n_words", F.lit("x")).repartition(6)
    got = adaptive_rules.rate(docs).select("doc_id", *adaptive_rules.COUNTS, "kept").collect()
    kept = _verdicts([r[1:4] for r in rows])
    want = [(r[0], *(_measures(r[1])[c] for c in adaptive_rules.COUNTS), k) for r, k in zip(rows, kept)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert 300 < sum(kept) < len(rows)


def test_sketches_merge(spark):
    docs = spark.createDataFrame(_rule_rows(), DOCS)
    rows = adaptive_rules._measured(docs).select("*", *[F.expr(v).alias(k) for k, v in adaptive_rules._VALUES.items()]).cache()
    whole = adaptive_rules.sketches(rows, [])
    merged = adaptive_rules.merge(adaptive_rules.sketches(rows, ["lang", "source"]), [])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    rows.unpersist()


def test_rules_of_an_empty_table(spark):
    assert adaptive_rules.rate(spark.createDataFrame([], DOCS)).collect() == []


def test_rules_of_the_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = _verdicts([(r["text"], r["lang"], r["source"]) for r in rows])
    got = {r["doc_id"]: r["kept"] for r in queries.op13_adaptive_rules(spark, SF).collect()}
    assert got == {r["doc_id"]: k for r, k in zip(rows, kept)}
