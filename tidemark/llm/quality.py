"""Operator 4: quality by hierarchical empirical Bayes.

A logistic classifier on hashed word presence and surface figures, fitted on a bounded
sample of labelled documents (``TRAIN`` rows at most, repeated ones once), gives each whole text its evidence.
Then labels, and with less weight the classifier's estimates where there is none, are
summed by path, host and over all rows.  A host's rate is shrunk toward the global rate
and a path's toward its host's, each by a prior strength estimated from the spread of the
rates (method of moments), so sparse sites stay near their parents.  A document's
posterior log odds are its path's log odds plus its own log likelihood ratio.

The same is done for two signals, quality and toxicity.  ``keep``: quality likely and
toxicity unlikely.

Edge cases: null text counts as empty; null site is a site of its own; a label row without
document is unused, of repeated labels the largest counts; without labels every
probability is the prior 0.5 and all is kept; repeated rows are each rated; null doc_id
has no label; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, bounded_batches, mix, slices, utf8, words

TRAIN = 12_000
CELLS = 1 << 18
LEAST_Z = 4.5  # cells whose share differs less between the classes get no weight
RIDGE = 1e-5
SURFACE = 20
SOFT = 0.25  # weight of an unlabelled document's estimate, against a label's 1
SIGNALS = ("quality", "toxic")


def features(texts: pa.Array):
    """For each text its distinct cells (words without punctuation, and their first four
    and five bytes, which inflected forms share) and surface figures."""
    text = texts.fill_null("")
    data, off = utf8(text)
    for i, j in slices(off):
        part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        low, lo = utf8(pc.utf8_lower(text.slice(i, j - i)))
        h, start, end, w = words(low, lo)
        inner, at, stop, w2 = words(low, lo, _APART_WORDS)
        code = np.zeros(len(at), np.uint64)
        cells = [inner]
        for k in range(5):
            there = at + k < stop
            code[there] |= low[at[there] + k].astype(np.uint64) << np.uint64(8 * k)
            if k >= 3:
                cells.append(mix(np.where(there, code + np.uint64(k << 48), inner)))
        cells = [(c >> np.uint64(46)).astype(np.int64) for c in cells]
        upper = (part >= 0x41) & (part <= 0x5A)
        sign = (part < 0x80) & (part > 0x20) & ~upper & ~((part >= 0x61) & (part <= 0x7A)) & ~(
            (part >= 0x30) & (part <= 0x39))
        pair = lambda x: np.append(x[1:] & x[:-1], [False] * min(1, len(x)))
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (
            upper, pair(upper), sign, pair(sign), (part >= 0x30) & (part <= 0x39), part == 0x0A)]
        alone = np.zeros(len(h), dtype=bool)
        alone[end - start == 1] = _APART_WORDS[low[start[end - start == 1]]]
        again = np.zeros(len(h), dtype=bool)
        again[1:] = h[1:] == h[:-1]
        for k in range(j - i):
            a, b = w[k], w[k + 1]
            n, size = b - a, max(1, o[k + 1] - o[k])
            count = [float(c[o[k + 1]] - c[o[k]]) for c in sums]
            odd = [float(alone[a:b].sum()), float(again[a:b].sum())]
            cell = np.unique(np.concatenate([c[w2[k]:w2[k + 1]] for c in cells]))
            yield cell, np.array([
                1.0, *(4 * c / size for c in count), *(np.log1p(c) / 4 for c in count + odd),
                *(4 * c / max(1, n) for c in odd), len(np.unique(h[a:b])) / n if n else 0.0,
                (end[a:b] - start[a:b]).mean() / 10 if n else 0.0, np.log1p(n) / 10])


_APART_WORDS = np.ones(256, dtype=bool)
_APART_WORDS[0x80:] = False
_APART_WORDS[0x61:0x7B] = False


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of the cells and of the surface figures (logistic loss, ridge, adaptive
    gradient steps), the classes weighing the same.  rows: as ``features`` gives them."""
    if not len(rows) or len(set(y.tolist())) < 2:
        return np.zeros(CELLS + SURFACE)
    row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    cell = np.concatenate([c for c, _ in rows])
    # only cells that tell the classes apart: the many others would learn the sample by heart
    n1, n0 = max(1.0, float(y.sum())), max(1.0, float((1 - y).sum()))
    share1 = np.bincount(cell, weights=y[row], minlength=CELLS) / n1
    share0 = np.bincount(cell, weights=1 - y[row], minlength=CELLS) / n0
    both = (share1 * n1 + share0 * n0) / (n1 + n0)
    z = (share1 - share0) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n1 + 1 / n0))
    tells = (np.abs(z) >= LEAST_Z)[cell]
    row, cell = row[tells], cell[tells]
    surface = np.stack([s for _, s in rows])
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, v = np.zeros(CELLS), np.zeros(SURFACE)
    sw, sv = np.full(CELLS, 1e-8), np.full(SURFACE, 1e-8)
    for _ in range(rounds):
        z = np.bincount(row, weights=w[cell], minlength=len(rows)) + surface @ v
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gw = np.bincount(cell, weights=g[row], minlength=CELLS) + RIDGE * w
        gv = surface.T @ g + 1e-6 * v
        sw += gw * gw
        sv += gv * gv
        w -= 0.1 * gw / np.sqrt(sw)
        v -= 0.2 * gv / np.sqrt(sv)
    return np.concatenate([w, v])


def _feature_rows(batches):
    """doc_id, hash, cells and surface figures, once a task for repeated rows."""
    seen = set()
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True))
        new = [k for k, key in enumerate(keys) if not (key in seen or seen.add(key))]
        batch = batch.take(pa.array(new, pa.int64()))
        rows = list(features(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([c.astype("<i4").tobytes() for c, _ in rows], pa.binary()),
             pa.array([s.astype("<f8").tobytes() for _, s in rows], pa.binary())],
            ["doc_id", "hash", "cells", "surface"])


def sample(scratch: Scratch, docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """doc_id, hash, cells, surface and labels of ``TRAIN`` rows at most: one a (doc_id, text),
    however many rows repeat it, and no text.  labels: one row a doc_id, ``n`` in all."""

    def some(df: DataFrame, count: int, *by: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*by, F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
        return df.where(place < min(1.0, 0.9 * TRAIN / max(1, count))).limit(TRAIN)  # bounded, so broadcast

    chosen = scratch.write(some(labels, n, "doc_id"), "chosen")
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"), "text").join(
        F.broadcast(chosen.select("doc_id")), "doc_id")
    # a doc_id may have many texts, so the rows are bounded as well
    keys = scratch.write(rows.select("doc_id", "hash").distinct(), "keys")
    keys = scratch.write(some(keys, keys.count(), "hash", "doc_id"), "sample")
    told = rows.join(F.broadcast(keys), ["doc_id", "hash"]).select("doc_id", "hash", "text").mapInArrow(
        _feature_rows, "doc_id long, hash string, cells binary, surface binary")
    told = told.groupBy("doc_id", "hash").agg(F.min("cells").alias("cells"), F.min("surface").alias("surface"))
    return told.join(F.broadcast(chosen), "doc_id")


def _evidence(models):
    def run(batches):
        weights = np.stack(models.value)
        for batch in batches:
            out = np.zeros((batch.num_rows, len(weights)))
            for k, (cell, surface) in enumerate(features(batch.column(2))):
                out[k] = weights[:, cell].sum(axis=1) + weights[:, CELLS:] @ surface
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(out[:, k]) for k in range(out.shape[1]))],
                ["doc_id", "site", *(f"llr_{s}" for s in SIGNALS)])
    return run


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _strength(n: Column, mean: Column, top: Column) -> Column:
    """Prior strength by the method of moments over groups of n rows and rate mean: the
    spread beyond what sampling explains; rates that spread no more are pooled firmly."""
    spread = F.sum(n * (mean - top) * (mean - top)) / F.sum(n)
    noise = F.sum(top * (1 - top)) / F.sum(n)
    between = F.greatest(spread - noise, F.lit(1e-6))
    inner = F.max(top * (1 - top))
    return F.least(F.greatest(inner / between - 1, F.lit(1.0)), F.lit(1e6))


def site_rates(scratch: Scratch, rated: DataFrame, signal: str) -> DataFrame:
    """(site, rate, prior): rate of a path after both shrinkages; prior: the global rate."""
    paths = scratch.write(
        rated.groupBy("site").agg(F.sum(f"m_{signal}").alias("n"), F.sum(f"x_{signal}").alias("x"))
        .withColumn("host", F.split_part("site", F.lit("/"), F.lit(1))), f"paths-{signal}")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("x").alias("hx"))
    top = hosts.agg(F.sum("hn").alias("tn"), F.sum("hx").alias("tx")).select(
        ((F.col("tx") + 0.5) / (F.col("tn") + 1)).alias("prior"))
    hosts = hosts.crossJoin(top)  # one row
    k1 = hosts.where("hn > 0").agg(
        _strength(F.col("hn"), F.col("hx") / F.col("hn"), F.col("prior")).alias("k1"))
    hosts = hosts.crossJoin(k1).withColumn(
        "host_rate", (F.col("hx") + F.coalesce("k1", F.lit(1.0)) * F.col("prior"))
        / (F.col("hn") + F.coalesce("k1", F.lit(1.0))))
    paths = paths.join(scratch.write(hosts.select("host", "host_rate", "prior"), f"hosts-{signal}"), "host")
    k2 = paths.where("n > 0").agg(
        _strength(F.col("n"), F.col("x") / F.col("n"), F.col("host_rate")).alias("k2"))
    return scratch.write(paths.crossJoin(k2).select(
        "site", F.col("host_rate").alias(f"host_{signal}"),
        ((F.col("x") + F.coalesce("k2", F.lit(1.0)) * F.col("host_rate"))
         / (F.col("n") + F.coalesce("k2", F.lit(1.0)))).alias(f"path_{signal}")), f"rates-{signal}")


def rate_documents(docs: DataFrame, labels: DataFrame, site: Column) -> DataFrame:
    """doc_id, site, host_<s>, path_<s>, p_<s> for both signals, keep.

    ``site``: host, then '/' and the path."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "quality")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(site, F.lit("/")).alias("site"), "text")
    labels = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(s).cast("double").alias(s) for s in SIGNALS))
    n = labels.count()
    rows = sorted(sample(scratch, docs, labels, n).collect(), key=lambda r: (r["doc_id"], r["hash"]))
    models = []
    for s in SIGNALS:
        own = [r for r in rows if r[s] is not None]
        models.append(fit([(np.frombuffer(r["cells"], "<i4"), np.frombuffer(r["surface"], "<f8")) for r in own],
                          np.array([float(r[s]) for r in own])))
    rated = scratch.write(docs.mapInArrow(
        _evidence(spark.sparkContext.broadcast(models)),
        "doc_id long, site string, " + ", ".join(f"llr_{s} double" for s in SIGNALS)), "evidence")
    rated = rated.join(labels, "doc_id", "left")
    for s in SIGNALS:
        # classes weighed the same in fitting, so the classifier's log odds are a ratio
        rated = rated.withColumn(f"m_{s}", F.when(F.col(s).isNotNull(), 1.0).otherwise(SOFT))
        rated = rated.withColumn(f"x_{s}", F.coalesce(F.col(s), _sigmoid(F.col(f"llr_{s}"))) * F.col(f"m_{s}"))
    rated = scratch.write(rated.select("doc_id", "site", *(f"{c}_{s}" for s in SIGNALS for c in ("llr", "m", "x"))), "rated")
    out = rated
    for s in SIGNALS:
        out = out.join(site_rates(scratch, rated, s), "site", "left")
        out = out.withColumn(f"p_{s}", _sigmoid(_logit(F.col(f"path_{s}")) + F.col(f"llr_{s}")))
    keep = (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5) if n else F.lit(True)
    return out.select("doc_id", "site", *(f"{c}_{s}" for s in SIGNALS for c in ("host", "path", "p")),
                      keep.alias("keep"))
