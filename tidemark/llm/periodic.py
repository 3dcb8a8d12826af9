"""Periodic runs of words by suffix trees and Lyndon roots.

A run is a maximal stretch of words with smallest period q (words q apart are equal) that
is at least max(``LEAST``, 2 q) long.  By the runs theorem every run holds a Lyndon word of
length q, under the order of the words or its reverse, that is the longest Lyndon word
beginning at its place.  Those words end at the next smaller suffix, which the ranks of the
suffixes give; each is a candidate, extended to both sides by longest common extensions.
They come from Ukkonen's suffix trees of the words and of their reversal: the common
extension of two places is the depth of their leaves' lowest common ancestor, which is the
least depth between their visits in the Euler tour, answered in constant time by a sparse
table over the tour.

Trees are built where a run can be.  A run of length L and period q repeats L - q >= 6
words in a row at distance q, so every word of it lies in a stretch of words that are
covered by six-word windows occurring twice in that stretch; all other words are left out
beforehand, exactly.

Map only: a document is one row's work, nothing is shuffled, and no row depends on another,
so repeated rows give repeated results.  Defined cases: a null text has no words; a text
without words or runs has ``n_runs`` 0, nulls for the longest run, and the hash of its words;
a null doc_id is never damaged; of equally long runs the first, then the one of the least
period counts as longest; very long texts are taken whole, with memory in proportion to
the longest repetitive stretch (times its logarithm for the tables); an empty table gives
no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import bounded_batches, mix, text_rows, words

LEAST = 12  # least length of a run
WINDOW = 6  # of L >= max(12, 2 q) words, L - q >= 6 equal the words q before them
_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_ODD = [pow(0xE7037ED1A0B428DB, j + 1, 1 << 64) for j in range(WINDOW)]


# ------------------------------------------------------------------------ suffix trees

def suffix_tree(s: list[int]):
    """Ukkonen's tree of symbols >= 1, closed by the symbol 0: (start, end, children)."""
    s = [*s, 0]
    whole = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        need = 0  # inner node of this step that still lacks its suffix link
        while waiting:
            if not length:
                edge = i
            here = kids[node]
            child = here.get(s[edge])
            if child is None:
                here[s[edge]] = len(start)
                start.append(i)
                end.append(whole)
                link.append(0)
                kids.append(None)
                if need:
                    link[need] = node
                    need = 0
            else:
                span = min(end[child], i + 1) - start[child]
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                middle = start[child] + length
                if s[middle] == c:
                    length += 1
                    if need:
                        link[need] = node
                    break
                split = len(start)
                here[s[edge]] = split
                start.append(start[child])
                end.append(middle)
                link.append(0)
                kids.append({s[middle]: child, c: split + 1})
                start[child] = middle
                start.append(i)
                end.append(whole)
                link.append(0)
                kids.append(None)
                if need:
                    link[need] = split
                need = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, end, kids


def euler_tour(tree, n: int, falling: bool = False):
    """Suffixes in the order of the tour, and before each the least depth since the last one.

    Children by their first symbol, rising, or falling with the closing symbol still first.
    """
    start, end, kids = tree
    suffixes, least = [], []
    stack = [(0, 0, 0)]
    while stack:
        node, depth, turn = stack.pop()
        below = kids[node]
        depth += end[node] - start[node]
        if below is None:
            suffixes.append(n + 1 - depth)
            least.append(turn)
            continue
        order = sorted(below, reverse=falling)
        if falling and order[-1] == 0:
            order.insert(0, order.pop())
        for k in order[:0:-1]:
            stack.append((below[k], depth, depth))
        stack.append((below[order[0]], depth, turn))
    return suffixes, least


class Extensions:
    """Longest common prefix of any two suffixes: least depth of the tour between them."""

    def __init__(self, suffixes, least):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.rows = [np.array(least, np.int32)]
        width = 1
        while 2 * width <= len(least):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one of lesser rank (the closing suffix is least of all)."""
    out = [0] * (len(rank) - 1)
    stack = [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return out


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """All runs [start, length, period] (length >= 2 periods) of a sequence, by start, period."""
    n = len(symbols)
    s = (np.unique(symbols, return_inverse=True)[1] + 1).tolist()
    tree = suffix_tree(s)
    suffixes, least = euler_tour(tree, n)
    ahead = Extensions(suffixes, least)
    falling = np.empty(n + 1, np.int64)
    falling[euler_tour(tree, n, True)[0]] = np.arange(n + 1)
    behind = Extensions(*euler_tour(suffix_tree(s[::-1]), n))
    at = np.arange(n)
    i = np.concatenate([at, at])
    j = np.array(_next_smaller(ahead.rank.tolist()) + _next_smaller(falling.tolist()))
    begin = i - behind(n - i, n - j)
    stop = j + ahead(i, j)
    keep = stop - begin >= 2 * (j - i)
    found = np.stack([begin, stop - begin, j - i], axis=1)[keep]
    return np.unique(found[np.lexsort((found[:, 2], found[:, 0]))], axis=0)


# --------------------------------------------------------------------- where runs can be

def _windows(h: np.ndarray) -> np.ndarray:
    m = max(0, len(h) - WINDOW + 1)
    out = np.zeros(m, np.uint64)
    for j in range(WINDOW):
        out += h[j:j + m] * np.uint64(_ODD[j])
    return mix(out)


def _stretches(h: np.ndarray):
    """Ranges of words covered by windows that occur twice in the same range."""
    key = _windows(h)
    alive = np.ones(len(key), bool)
    zone = np.zeros(len(key), np.int64)
    while alive.any():
        at = np.flatnonzero(alive)
        both = mix(key[at] + mix(zone[at].astype(np.uint64)))
        _, back, count = np.unique(both, return_inverse=True, return_counts=True)
        left = at[count[back] > 1]
        if len(left) == len(at):
            break
        alive[:] = False
        alive[left] = True
        # windows that overlap or touch share a range
        zone[left] = np.cumsum(np.diff(left, prepend=left[:1] - WINDOW - 1) > WINDOW)
    at = np.flatnonzero(alive)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at, prepend=at[0] - WINDOW - 1) > WINDOW)
    last = np.append(cut[1:], len(at)) - 1
    return [(a, b + WINDOW) for a, b in zip(at[cut].tolist(), at[last].tolist(), strict=True)]


def find_runs(h: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of at least ``least`` words, by start, then period."""
    out = []
    for a, b in _stretches(h):
        if b - a >= least:
            found = runs_of(h[a:b])
            found = found[found[:, 1] >= least]
            found[:, 0] += a
            out.extend(map(tuple, found.tolist()))
    out.sort(key=lambda r: (r[0], r[2]))
    return out


def _maybe(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows in which some window occurs twice."""
    key = _windows(h)
    place = np.arange(len(key))
    row = np.searchsorted(off, place, side="right") - 1
    inside = place + WINDOW <= off[row + 1]
    key, row = mix(key[inside] + mix(row[inside].astype(np.uint64))), row[inside]
    order = np.argsort(key)
    twice = np.flatnonzero(key[order][1:] == key[order][:-1])
    out = np.zeros(len(off) - 1, bool)
    out[row[order[twice]]] = True
    return out


def _damage(doc_id, n: int) -> np.ndarray | None:
    """Original word of each place of a document whose tail is made periodic, else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


# -------------------------------------------------------------------------- the operator

_RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")


def periodic_runs(docs: DataFrame, least: int = LEAST, damage: bool = False, spans: bool = True) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period,
    exponent_milli), SHA-256 of the list of runs and of the text without repetitions, and with
    ``spans`` the runs themselves and that text.

    A word goes when a run contains it after the run's first period; kept words are joined by
    one space.  ``damage`` makes the tails of a fixed tenth of the documents periodic first.
    """
    bounded_batches(docs.sparkSession)
    schema = T.StructType().add("doc_id", docs.schema["doc_id"].dataType)
    for c in ("n_runs", "start", "length", "period", "exponent_milli"):
        schema = schema.add(c, "long")
    schema = schema.add("runs_sha256", "string").add("collapsed_sha256", "string")
    if spans:
        schema = schema.add("runs", T.ArrayType(_RUN)).add("collapsed", "string")

    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch, i, j, data, offsets in text_rows(batches):
            h, _, _, off = words(data, offsets, code=_EXACT)
            maybe = _maybe(h, off)
            ids = batch.column(batch.schema.get_field_index("doc_id")).slice(i, j - i)
            raw = data.tobytes()
            rows = []
            for k, doc_id in enumerate(ids.to_pylist()):
                a, b = int(off[k]), int(off[k + 1])
                text = raw[int(offsets[k]):int(offsets[k + 1])].split()
                mine = h[a:b]
                source = _damage(doc_id, b - a) if damage else None
                if source is not None:
                    mine = mine[source]
                found = find_runs(mine, least) if source is not None or maybe[k] else []
                if found:
                    step = np.zeros(b - a + 1, np.int64)
                    for s, length, q in found:
                        step[s + q] += 1
                        step[s + length] -= 1
                    kept = np.flatnonzero(np.cumsum(step[:-1]) == 0)
                    if source is not None:
                        kept = source[kept]
                    text = [text[w] for w in kept.tolist()]
                elif source is not None:
                    text = [text[w] for w in source.tolist()]
                collapsed = b" ".join(text)
                row = {"doc_id": doc_id, "n_runs": len(found),
                       "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
                       "collapsed_sha256": hashlib.sha256(collapsed).hexdigest()}
                if found:
                    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
                    row |= {"start": s, "length": n, "period": q, "exponent_milli": 1000 * n // q}
                if spans:
                    row |= {"runs": [{"start": s, "length": n, "period": q} for s, n, q in found],
                            "collapsed": collapsed.decode()}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
