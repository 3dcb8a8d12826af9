"""Quality rules with thresholds that follow each language and source.

Every text is measured once.  What the base rules leave is summed into quantile sketches per
(language, source, measure): counts by value rounded down to ``BITS`` significant bits, so a
quantile is off by less than one part in 2^(BITS-1), a sketch holds at most a few hundred
cells whatever its rows, and sketches merge by adding counts (the sum over sources is the
language's sketch, the sum over languages the corpus's).  A measure's fence is the upper
quartile plus the larger of ``SPREAD`` interquartile ranges and the measure's ``slack`` (a
lower fence likewise), so up to a quarter of a group may be junk without moving it.
A source with fewer than ``ENOUGH`` documents takes its language's fences, a language with
fewer those of the corpus; a source's fence is at most one slack laxer than its language's, so
that a source of junk does not excuse itself.  The fences are joined to the documents, and a
document outside any of them goes.

Measures (whole numbers, per mille where they are shares): mean word length, symbols a word,
repeated lines a line, words in repeated windows a word, capitals (A-Z) a letter (A-Z, a-z).

Defined cases: a null text has no words and fails the base rules; null languages and sources
are groups of their own; repeated rows are measured and counted once each; ties in a sketch
share a cell, and a value equal to its fence stays; very long texts are measured whole;
an empty table gives no rows; ``doc_id`` may be null; other columns are ignored whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import _SPACE, Scratch, bounded_batches, mix, text_rows, words

LEAST_WORDS, MOST_REPEATED = 20, 30  # base rules: words, per cent of words in repeated windows
WINDOW = 8
BITS = 6
SPREAD = 3
ENOUGH = 200
# measure, upper and lower slack (None: no such fence)
MEASURES = [("word_length", 500, 500), ("symbols", 100, None), ("repeated_lines", 200, None),
            ("repeated_words", 100, None), ("capitals", 100, None)]

_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_ODD = [pow(0xE7037ED1A0B428DB, j + 1, 1 << 64) for j in range(WINDOW)]
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True


def _member(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _member(b"#*$%&|<>")
_CAPITAL, _SMALL = _member(bytes(range(0x41, 0x5B))), _member(bytes(range(0x61, 0x7B)))
_POINT = ~_SPACE & ((np.arange(256) & 0xC0) != 0x80)  # first byte of a code point in a word
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters"]


def _a_row(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(key: np.ndarray, row: np.ndarray):
    """Places (in sorted order) whose key occurred before in their row, and those it was met by."""
    both = mix(key + mix(row.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    again = np.flatnonzero(both[order][1:] == both[order][:-1])
    return order[again + 1], order[again]


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """COUNTS of each row's text."""
    rows = len(offsets) - 1
    h, _, _, off = words(data, offsets, code=_EXACT)
    m = max(0, len(h) - WINDOW + 1)
    key = np.zeros(m, np.uint64)
    for j in range(WINDOW):
        key += h[j:j + m] * np.uint64(_ODD[j])
    place = np.arange(m)
    row = np.searchsorted(off, place, side="right") - 1
    inside = np.flatnonzero(place + WINDOW <= off[row + 1])
    later, met = _repeats(mix(key[inside]), row[inside])
    step = np.zeros(len(h) + 1, np.int64)
    twice = np.unique(np.concatenate([inside[later], inside[met]]))
    step[twice] += 1
    np.add.at(step, twice + WINDOW, -1)
    covered = np.cumsum(step[:-1]) > 0
    # lines: the runs of bytes between newlines that hold a word
    line, start, end, _ = words(data, offsets, space=_NEWLINE, code=_EXACT)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_SPACE[data], out=filled[1:])
    real = filled[end] > filled[start]
    line, start = line[real], start[real]
    owner = np.searchsorted(offsets, start, side="right") - 1
    again, _ = _repeats(line, owner)
    capital = _a_row(_CAPITAL[data], offsets)
    return [np.diff(off), _a_row(_POINT[data], offsets), _a_row(_SYMBOL[data], offsets),
            np.bincount(owner[again], minlength=rows), _a_row(covered, off),
            np.bincount(owner, minlength=rows), capital, capital + _a_row(_SMALL[data], offsets)]


def _measured(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name in ("doc_id", "lang", "source")]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in COUNTS])
    names = [f.name for f in schema]

    def run(batches):
        for batch, i, j, data, offsets in text_rows(batches):
            carried = [batch.column(batch.schema.get_field_index(f.name)).slice(i, j - i) for f in kept]
            yield pa.RecordBatch.from_arrays(
                carried + [pa.array(x.astype(np.int64)) for x in measure(data, offsets)], names)

    return docs.select(*[f.name for f in kept], "text").mapInArrow(run, schema)


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) * 1000 DIV {whole} ELSE 0L END"


_VALUES = {
    "word_length": _share("word_chars", "n_words"), "symbols": _share("n_symbols", "n_words"),
    "repeated_lines": _share("n_dup_lines", "n_lines"), "repeated_words": _share("n_repeat_words", "n_words"),
    "capitals": _share("n_capitals", "n_letters")}


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (keys, measure, cell, n) of the quantile sketches of all measures."""
    values = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("value")) for k, _, _ in MEASURES])
    cells = measured.select(*keys, F.explode(values).alias("v")).select(*keys, "v.measure", "v.value")
    low = F.greatest(F.length(F.bin("value")) - BITS, F.lit(0))
    cell = F.expr(f"shiftleft(shiftright(value, {_bits()}), {_bits()})")
    return cells.withColumn("cell", F.when(low > 0, cell).otherwise(F.col("value"))) \
        .groupBy(*keys, "measure", "cell").agg(F.count("*").alias("n"))


def _bits() -> str:
    return f"greatest(length(bin(value)) - {BITS}, 0)"


def merge(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups: counts added up."""
    return cells.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))


def fences(cells: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Per group: its documents and, for each measure, the fences of its sketch."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys, "measure")
    up = cells.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("cell")))

    def quantile(percent):
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("cell")))

    quart = up.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"), quantile(25).alias("low"), quantile(75).alias("high"))
    out = [F.max("total").alias(f"{prefix}docs")]
    for k, above, below in MEASURES:
        at, spread = F.col("measure") == k, SPREAD * (F.col("high") - F.col("low"))
        out.append(F.max(F.when(at, F.col("high") + F.greatest(spread, F.lit(above)))).alias(f"{prefix}{k}_most"))
        if below is not None:
            out.append(F.max(F.when(at, F.col("low") - F.greatest(spread, F.lit(below)))).alias(f"{prefix}{k}_least"))
    return quart.groupBy(*keys).agg(*out)


def _settled(own: DataFrame, lang: DataFrame, whole: DataFrame) -> DataFrame:
    """Fences of each (lang, source), with the coarser ones where documents are few."""
    both = own.join(lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    both = both.crossJoin(F.broadcast(whole))  # one row
    out = ["lang", "source"]
    for k, above, below in MEASURES:
        for side, slack in (("most", above), ("least", below)):
            if slack is None:
                continue
            coarse = F.when(F.col("l_docs") >= ENOUGH, F.col(f"l_{k}_{side}")).otherwise(F.col(f"w_{k}_{side}"))
            mine = F.col(f"s_{k}_{side}")
            bound = F.least(mine, coarse + slack) if side == "most" else F.greatest(mine, coarse - slack)
            out.append(F.when(F.col("s_docs") >= ENOUGH, bound).otherwise(coarse).alias(f"{k}_{side}"))
    return both.select(*out)


def rate(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict, the rules it broke, and the verdict."""
    scratch = Scratch(docs.sparkSession, "rules")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = _measured(docs)
    rows = scratch.write(rows.select("*", failed.alias("base_failed"), *[F.expr(v).alias(k) for k, v in _VALUES.items()]), "measured")
    cells = scratch.write(sketches(rows.where(~F.col("base_failed")), ["lang", "source"]), "sketches")
    by_lang = merge(cells, ["lang"])
    limits = _settled(fences(cells, ["lang", "source"], "s_"), fences(by_lang, ["lang"], "l_"),
                      fences(merge(by_lang, []), [], "w_"))
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    broken = []
    for k, _, below in MEASURES:
        out = F.col(k) > F.col(f"{k}_most")
        if below is not None:
            out = out | (F.col(k) < F.col(f"{k}_least"))
        broken.append(F.when(out, F.lit(k)))
    # documents that fail the base rules are in no sketch and may have no fences
    broken = F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(F.array_compact(F.array(*broken)))
    return joined.withColumn("broken", broken).select(
        "doc_id", "lang", "source", *COUNTS, *_VALUES, "base_failed", "broken", (F.size("broken") == 0).alias("kept"))

