"""Operator 2: licence scan by patience alignment.

Words are lower-case runs of letters, and runs of digits read as one sign.  Wherever a
distinctive word of a template occurs, a window of the text around the place that the
template would then have is aligned with it: words that occur once in both are anchors,
the longest increasing subsequence of them is kept, and the gaps between anchors are
aligned the same way until nothing more matches.  Coverage is the share of the template's
words that are aligned; 0.8 or more is a hit, and of overlapping hits the one that covers
most words stays.

Before that, whole texts are screened by hashed words: a text that lacks more of a
template's distinctive words than 0.8 coverage allows is not aligned.  The screen parts
words as the alignment does: whatever is no letter, in any script, is a break.

A window that reaches beyond the template may hold a word of it twice, which then is no
anchor, so the template's very span is aligned as well, at every place.

Edge cases: null or empty text has no hits; a licence that occurs twice is two hits; ties
go to the longer template, then to the earlier place; repeated rows are each scanned; a
null doc_id keeps its row; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices, utf8, words

COVERAGE = 0.8

# Public licence notices and the openings of public licence texts.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
           "and associated documentation files (the \"Software\"), to deal in the Software without "
           "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
           "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
           "Software is furnished to do so, subject to the following conditions: The above copyright notice "
           "and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                         "file except in compliance with the License. You may obtain a copy of the License at",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of "
                  "the GNU General Public License as published by the Free Software Foundation, either version "
                  "3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met: Redistributions of source code must retain the "
           "above copyright notice, this list of conditions and the following disclaimer.",
}
# Words too common to look for a template by.
COMMON = frozenset(
    "a above all an and any are as at be by can copies copy file following for forms free from in including is "
    "it list may no not of on or out that the this to under use version whom with without work you your #".split())

_WORD = re.compile(r"[^\W\d_]+|\d+")
_BREAK = re.compile(r"[\W\d_]+")
# of ASCII, only small letters are in words (the texts are in lower case)
_APART = np.ones(256, dtype=bool)
_APART[0x61:0x7B] = False
_APART[0x80:] = False
HIT = "array<struct<license:string,coverage:double,start:int,end:int>>"


def text_words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) in characters; digits read as '#'."""
    return [("#" if m[0].isdigit() else m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def screened(text: pa.Array) -> pa.Array:
    """Texts in lower case with a blank for whatever beyond ASCII is no letter."""
    low = pc.utf8_lower(text)
    odd = pc.fill_null(pc.invert(pc.string_is_ascii(low)), False)
    if not pc.any(odd).as_py():
        return low
    return pa.array([_BREAK.sub(" ", x) if o else x for x, o in zip(low.to_pylist(), odd.to_pylist(), strict=True)],
                    low.type)


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of two word lists: unique common words, their longest
    increasing subsequence, and the same again in the gaps."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        # equal ends need no anchor
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once: list[dict[str, int]] = []
        for w, lo, hi in ((a, a0, a1), (b, b0, b1)):
            at: dict[str, int] = {}
            for k in range(lo, hi):
                at[w[k]] = -1 if w[k] in at else k
            once.append(at)
        pairs = sorted((i, once[1][w]) for w, i in once[0].items() if i >= 0 and once[1].get(w, -1) >= 0)
        chain = _increasing(pairs)
        last = (a0 - 1, b0 - 1)
        for i, j in [*chain, (a1, b1)]:
            if chain:
                todo.append((last[0] + 1, i, last[1] + 1, j))
            last = (i, j)
        out += chain
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that increases in both members (piles with back links)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[pile], at[pile] = j, k
        back.append(at[pile - 1] if pile else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


class Templates:
    """Word lists, distinctive words and how many of these a hit may lack."""

    def __init__(self, texts: dict[str, str]):
        self.words = {n: [w for w, _, _ in text_words(t)] for n, t in texts.items()}
        self.marks = {n: {w: k for k, w in reversed(list(enumerate(ws))) if w not in COMMON}
                      for n, ws in self.words.items()}
        self.need = {n: max(1, len(self.marks[n]) - int((1 - COVERAGE) * len(ws) + 1e-9))
                     for n, ws in self.words.items()}
        every = sorted({w for m in self.marks.values() for w in m})
        data, off = utf8(pa.array(every))
        h, _, _, _ = words(data, off, _APART)
        order = np.argsort(h)
        self.hashes = h[order]
        self.member = np.array([[w in self.marks[n] for n in self.words] for w in every], dtype=np.int64)[order]
        self.least = np.array([self.need[n] for n in self.words])

    def possible(self, hashes: np.ndarray) -> np.ndarray:
        """Which templates a text with these word hashes may hold."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        held = np.unique(at[self.hashes[at] == hashes])
        return self.member[held].sum(axis=0) >= self.least

    def scan(self, text: str, which: np.ndarray) -> list[dict]:
        tokens = text_words(text)
        plain = [w for w, _, _ in tokens]
        places: dict[str, list[int]] = {}
        for k, w in enumerate(plain):
            places.setdefault(w, []).append(k)
        found = []
        for ok, (name, template) in zip(which, self.words.items(), strict=True):
            if not ok:
                continue
            slack = len(template) // 4 + 2
            starts = sorted({p - k for w, k in self.marks[name].items() for p in places.get(w, ())})
            last = None
            for s in starts:
                spans = [(max(0, s), s + len(template))] if s + len(template) > 0 else []
                # the window at ``last`` holds the template of places close after it as well
                if last is None or s - last >= max(1, slack // 2):
                    last = s
                    spans.append((max(0, s - slack), s + len(template) + slack))
                for lo, hi in spans:
                    pairs = patience(plain[lo:hi], template)
                    if len(pairs) >= COVERAGE * len(template):
                        found.append((len(pairs), len(template), name, lo + pairs[0][0], lo + pairs[-1][0]))
        found.sort(key=lambda x: (-x[0], -x[1], x[3], x[2]))
        kept: list[tuple] = []
        for hit in found:
            if all(hit[4] < k[3] or hit[3] > k[4] for k in kept):
                kept.append(hit)
        return [{"license": n, "coverage": c / m, "start": tokens[a][1], "end": tokens[b][2]}
                for c, m, n, a, b in sorted(kept, key=lambda x: x[3])]


def _scan(texts: dict[str, str]):
    def run(batches):
        templates = Templates(texts)
        kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()),
                                   ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            data, off = utf8(screened(batch.column(1)))
            hits = [[] for _ in range(batch.num_rows)]
            for i, j in slices(off):
                h, _, _, w = words(data[off[i]:off[j]], off[i:j + 1] - off[i], _APART)
                # one look-up for all texts of the slice; most hold no distinctive word
                at = np.minimum(np.searchsorted(templates.hashes, h), len(templates.hashes) - 1)
                marked = np.concatenate([[0], np.cumsum(templates.hashes[at] == h)])
                for k in np.flatnonzero(marked[w[1:]] > marked[w[:-1]]).tolist():
                    which = templates.possible(h[w[k]:w[k + 1]])
                    if which.any():
                        hits[i + k] = templates.scan(batch.column(1)[i + k].as_py(), which)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, kind)], ["doc_id", "hits"])
    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_hits, licenses (distinct names), best_coverage, hits (spans in characters)."""
    bounded_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(templates or TEMPLATES), f"doc_id long, hits {HIT}")
    return found.select(
        "doc_id", F.size("hits").alias("n_hits"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["license"]))).alias("licenses"),
        F.coalesce(F.array_max(F.transform("hits", lambda x: x["coverage"])), F.lit(0.0)).alias("best_coverage"),
        "hits")
