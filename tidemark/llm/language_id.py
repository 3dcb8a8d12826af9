"""Operator 7: language identification with a blended-spectrum string kernel.

A text is the set of n-grams (1 to 4 bytes, blended) of its normal form: lower case,
letters only, words framed by one space.  The kernel of two texts is the number of n-grams
that both hold, over the geometric mean of their set sizes (presence, not counts).
Nystroem landmarks span its feature space; one-versus-rest kernel ridge regression is
fitted on them from a bounded sample of labelled rows (about ``TRAIN_A_LANGUAGE`` documents
a language, twice that at most), chosen by a hash of doc_id and text outside the held-out
fold.  Whole texts are turned into presence bits in tasks; only those (``CELLS`` / 8 bytes a
document) reach the driver.
Every text is scored whole: presence rows times the landmark matrix, times the weights.

N-grams are hashed to ``CELLS`` cells.  The score is the softmax of the regression values.

Edge cases: null text or one without letters (marks, digits and signs are none) is ``und``
with score 0; ties go to the language that sorts first; without labelled rows every text is
``und``; a null doc_id is training material for nothing but is predicted; rows that repeat
doc_id, text and lang count once in training and get equal predictions; very long texts are
read whole, in bounded batches; an empty table gives an empty result; ``identify`` ignores
further columns, ``keep_identified`` carries them along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, mix, utf8

FOLDS, HELD_OUT = 4, 2
TRAIN_A_LANGUAGE = 400
LANDMARKS = 192
CELLS = 1 << 14
ORDERS = (1, 2, 3, 4)
RIDGE = 1e-3
SHARPNESS = 6.0
UNDETERMINED = "und"
BATCH = 128

_NOT_LETTERS = r"[^\p{L}\p{M}]+"


def normal_forms(texts: pa.Array) -> pa.Array:
    """Lower case, runs of anything but letters as one space, framed by spaces."""
    low = pc.utf8_lower(texts.fill_null(""))
    return pc.replace_substring_regex(pc.binary_join_element_wise(" ", low, " ", ""), _NOT_LETTERS, " ")


def cells(data: np.ndarray) -> np.ndarray:
    """Distinct cells of a normal form's n-grams."""
    seen = np.zeros(CELLS, dtype=bool)
    code = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            break
        code = (code[:len(data) - n + 1] << np.uint64(8)) | data[n - 1:].astype(np.uint64)
        if n in ORDERS:
            seen[(mix(code + np.uint64(n << 40)) >> np.uint64(50)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Presence rows over the cells, scaled to unit length, and which texts have letters."""
    data, off = utf8(normal_forms(texts))
    rows = np.zeros((len(texts), CELLS), dtype=np.float32)
    letters = pc.match_substring_regex(texts, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
    for k in range(len(texts)):
        if letters[k]:
            held = cells(data[off[k]:off[k + 1]])
            rows[k, held] = 1.0 / np.sqrt(len(held))
    return rows, letters


def _features(batches):
    """doc_id, lang, text -> doc_id, lang, presence bits of the texts with letters."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH):
            part = batch.slice(a, BATCH)
            rows, letters = presence(part.column(2))
            pick = pa.array(np.flatnonzero(letters))
            bits = np.packbits(rows[letters] > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pick), part.column(1).take(pick), pa.array([x.tobytes() for x in bits], pa.binary())],
                ["doc_id", "lang", "bits"])


def fit(bits: list[bytes], langs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, landmark matrix, weights) from labelled presence bits."""
    names = sorted(set(langs))
    if not names:
        return [], np.zeros((CELLS, 0), np.float32), np.zeros((0, 0), np.float32)
    rows = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).astype(np.float32)
    rows /= np.sqrt(rows.sum(axis=1, keepdims=True))
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    pick = np.unique(np.linspace(0, len(rows) - 1, min(LANDMARKS, len(rows))).astype(int))
    landmarks = rows[pick].T.copy()
    inner = (rows[pick] @ landmarks).astype(np.float64)
    value, vector = np.linalg.eigh(inner)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    feature = (rows @ landmarks).astype(np.float64) @ root
    # languages weigh the same whatever their share of the sample
    share = np.array([1.0 / langs.count(x) for x in langs])
    share = share / share.mean()
    gram = feature.T @ (feature * share[:, None]) + RIDGE * len(rows) * np.eye(feature.shape[1])
    beta = np.linalg.solve(gram, feature.T @ (target * share[:, None]))
    return names, landmarks, (root @ beta).astype(np.float32)


def _predict(model):
    def run(batches):
        names, landmarks, weights = model.value
        for batch in batches:
            lang, score = [], []
            for a in range(0, batch.num_rows, BATCH):
                rows, letters = presence(batch.column(2).slice(a, BATCH))
                if not names:
                    lang += [UNDETERMINED] * len(rows)
                    score += [0.0] * len(rows)
                    continue
                value = ((rows @ landmarks) @ weights).astype(np.float64)
                e = np.exp(SHARPNESS * (value - value.max(axis=1, keepdims=True)))
                e /= e.sum(axis=1, keepdims=True)
                best = value.argmax(axis=1)
                lang += [names[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
                score += [float(e[k, b]) if ok else 0.0 for k, (b, ok) in enumerate(zip(best, letters, strict=True))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
    return run


def _fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The model from a bounded sample of the labelled rows outside the held-out fold."""
    ready = docs.where((_fold() != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    own = F.xxhash64("doc_id", "text", F.lit("language"))
    count = {r["lang"]: r["n"] for r in ready.groupBy("lang").agg(F.approx_count_distinct(own).alias("n")).collect()}
    if not count:
        return fit([], [])
    # by a hash of the row against each language's rate, so no group is gathered and copies count once
    rate = F.create_map(*(x for k, n in count.items()
                          for x in (F.lit(k), F.lit(min(1.0, TRAIN_A_LANGUAGE / max(n, 1))))))
    place = F.pmod(own, F.lit(1 << 30)) / float(1 << 30)
    rows = (ready.where(place < rate[F.col("lang")]).select("doc_id", "lang", "text")
            .mapInArrow(_features, "doc_id long, lang string, bits binary").distinct()
            .limit(2 * TRAIN_A_LANGUAGE * len(count)).collect())
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], r["bits"]))
    return fit([bytes(r["bits"]) for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    model = spark.sparkContext.broadcast(train(docs))
    return docs.select("doc_id", F.coalesce(_fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text").mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is told with ``least_score`` or more."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(train(docs.withColumn("doc_id", F.col("doc_id").cast("long"))))
    at = docs.columns.index("text")

    def run(batches):
        predict = _predict(model)
        for batch in batches:
            three = pa.RecordBatch.from_arrays([batch.column(at)] * 3, ["doc_id", "held_out", "text"])
            told = next(predict([three]))
            keep = pc.and_(pc.not_equal(told.column(2), UNDETERMINED), pc.greater_equal(told.column(3), least_score))
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
