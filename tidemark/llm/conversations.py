"""Conversation structure repair: auction shortest paths over an integer-cost lattice.

A conversation is cut into edits: keep a row (0), give it the role user or assistant (2),
delete it (3, required for blank and repeated rows), insert an empty user or assistant turn
(2); a truncated row that stays adds 1.  The role initials of what remains must read
``(s?(ua)+)?``.  A lattice node is (rows consumed, last initial), an edit is an arc, and the
cheapest repair is a shortest path, found by Bertsekas's auction: the path in hand is
extended along an arc that attains its end's price, or contracted after that price was
raised to the least arc length plus price.  Where it ends, every arc of every shortest path
is tight (price equals length plus price); of the tight arcs that lead on to the goal, the
trace takes the one with the least initial in each node.

A required deletion commutes with everything and has the least initial, so it is never an
arc: it counts 3 and stands right after the edit of the row before it.

Work is by rows, not by conversations.  Equal rows of one turn are counted before they are
shuffled, a row's first occurrence is marked by an aggregate, and rows are range-partitioned
by (conversation, turn, role, digest of the text), so that a conversation with a third of all
rows is spread over many tasks.  A task solves those conversations that begin and end inside
it; the others leave parts of at most ``PART_ROWS`` lattice rows with their 4 x 4 matrix of
costs from state to state.  The parts' matrices form a lattice of their own, whose prices,
again by auction, are the goal prices of the parts.  Rows of a conversation are brought
together only to be hashed, streamed part by part.

Defined cases: a null role or text is one space (so a null text is blank); a null turn sorts
first and is left out of ``gaps``; rows of one turn stand by role, then by the SHA-256 of
their text (equal rows are adjacent); a null conv_id is a conversation of its own; an empty
table gives no rows; a text of any length is one row's matter; columns other than the four
are ignored whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import Scratch, bounded_batches

BLOCK, FAN = 16, 8  # lattice rows, and matrices, solved by one auction
PART_ROWS, PART_BYTES = 2048, 4 << 20  # lattice rows and text of one part
SPACE = r"\x20\x09-\x0D"

NONE = 1 << 40  # price of what cannot be reached
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what an insertion or a new role makes of a state
END = (0, 4, 2, 0)  # cost from each state to a complete conversation: insertions only
TAIL = ("", "II", "I", "")
NAMES = ("", "system", "user", "assistant")
LETTERS = "DIKR"
_KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}


# --------------------------------------------------------------------------- the auction

def auction(cost: np.ndarray, to: np.ndarray, price: np.ndarray, origins: np.ndarray) -> np.ndarray:
    """Prices [lane, node] after a shortest path from each of the lane's origins to the goal.

    ``cost`` and ``to`` are [lane, node, slot], the goal is the last node (arcs to itself at no
    cost).  ``price`` holds the first prices, none above the length plus price of an arc, and
    is raised in place; origins [lane, k] are nodes that reach the goal, -1 for none, served
    in turn.  All lanes move in step.
    """
    lanes, nodes, _ = cost.shape
    goal = nodes - 1
    for k in range(origins.shape[1]):
        rows = np.flatnonzero(origins[:, k] >= 0)
        at = origins[rows, k].astype(np.int64)
        path = np.zeros((len(rows), nodes + 1), np.int32)
        path[:, 0] = at
        depth = np.zeros(len(rows), np.int64)
        n = np.arange(len(rows))
        step = 0
        while len(rows):
            ends = to[rows, at]
            through = cost[rows, at] + price[rows[:, None], ends]
            slot = through.argmin(axis=1)
            least = through[n, slot]
            forward = price[rows, at] >= least  # tight: extend; else raise the price, contract
            price[rows, at] = least
            depth = np.where(forward, np.minimum(depth + 1, nodes), np.maximum(depth - 1, 0))
            path[n[forward], depth[forward]] = ends[n, slot][forward]
            at = path[n, depth].astype(np.int64)
            step += 1
            if step % 16 == 0:
                open_ = at != goal
                if not open_.all():
                    rows, at, path, depth = rows[open_], at[open_], path[open_], depth[open_]
                    n = np.arange(len(rows))
    return price


def _live(cost, to, price) -> np.ndarray:
    """Nodes with a tight path to the goal: one sweep from the last level back, in which
    insertions (arcs within a level) are followed after the arcs to later levels."""
    lanes, nodes, slots = cost.shape
    live = np.zeros((lanes, nodes), bool)
    live[:, -1] = True
    each = np.arange(lanes)[:, None, None]
    for base in range(nodes - 5, -1, -4):
        here = slice(base, base + 4)
        tight = cost[:, here] + price[each, to[:, here]] == price[:, here, None]
        for _ in range(3):
            live[:, here] = (tight & live[each, to[:, here]]).any(axis=2)
    return live


def _row_lattice(blocks, exits):
    """Lattice of each block of rows [(initial, truncated)], left at the given prices, and its
    first prices: from each level on, the sum of the cheapest edits of the rows to come."""
    levels = max(len(b) for b in blocks) + 1
    nodes = 4 * levels + 1
    cost = np.full((len(blocks), nodes, 4), NONE, np.int64)
    to = np.full((len(blocks), nodes, 4), nodes - 1, np.int64)
    price = np.zeros((len(blocks), nodes), np.int64)
    cost[:, -1, 0] = 0
    lane, node, slot, head, length = [], [], [], [], []

    def arc(a, b, c, d, e):
        lane.append(a)
        node.append(b)
        slot.append(c)
        head.append(d)
        length.append(e)

    for b, rows in enumerate(blocks):
        ahead = int(min(exits[b]))
        for i in range(len(rows), -1, -1):
            if i < len(rows):
                initial, short = rows[i]
                ahead += short if initial in _KEEPS else min(3, 2 + short)
            price[b, 4 * i:4 * i + 4] = ahead
        for i, (initial, short) in enumerate(rows):
            keeps = _KEEPS.get(initial, {})
            for q in range(4):
                x = 4 * i + q
                arc(b, x, 0, x + 4, 3)
                arc(b, x, 1, 4 * i + NEXT[q], 2)
                if q in keeps:
                    arc(b, x, 2, 4 * i + 4 + keeps[q], short)
                arc(b, x, 3, 4 * i + 4 + NEXT[q], 2 + short)
        for q in range(4):
            arc(b, 4 * len(rows) + q, 0, nodes - 1, int(exits[b][q]))
    cost[lane, node, slot] = length
    to[lane, node, slot] = head
    return cost, to, price


def _matrix_lattice(mats, exits):
    """Lattice of each lane's sequence of cost matrices [lane, n, 4, 4], and its first prices."""
    lanes, n = mats.shape[:2]
    nodes = 4 * (n + 1) + 1
    cost = np.full((lanes, nodes, 4), NONE, np.int64)
    to = np.full((lanes, nodes, 4), nodes - 1, np.int64)
    cost[:, :4 * n] = mats.reshape(lanes, 4 * n, 4)
    to[:, :4 * n] = (4 * np.repeat(np.arange(1, n + 1), 4)[:, None] + np.arange(4))[None]
    cost[:, 4 * n:4 * n + 4, 0] = exits
    cost[:, -1, 0] = 0
    least = np.concatenate([mats.min(axis=(2, 3)), exits.min(axis=1)[:, None]], axis=1)
    ahead = np.cumsum(least[:, ::-1], axis=1)[:, ::-1]
    price = np.concatenate([np.repeat(ahead, 4, axis=1), np.zeros((lanes, 1), np.int64)], axis=1)
    return cost, to, price


def _matrices(lattice, reach) -> np.ndarray:
    """Costs [lane, from, to] between the states at both ends; one auction a destination."""
    lanes = len(reach)
    out = np.full((lanes, 4, 4), NONE, np.int64)
    for q in range(4):
        exits = np.full((lanes, 4), NONE, np.int64)
        exits[:, q] = 0
        price = auction(*lattice(exits), np.where(reach[:, :, q], np.arange(4)[None], -1))
        out[:, :, q] = np.where(reach[:, :, q], price[:, :4], NONE)
    return out


def row_matrices(blocks) -> np.ndarray:
    reach = np.zeros((len(blocks), 4, 4), bool)
    reach[:, :, USER:] = True  # by an insertion, or by deletions alone
    reach[:, START, START] = reach[:, SYSTEM, SYSTEM] = True
    reach[:, START, SYSTEM] = [any(initial == "s" for initial, _ in b) for b in blocks]
    out = np.full((len(blocks), 4, 4), NONE, np.int64)
    for a in range(0, len(blocks), 256):
        part = blocks[a:a + 256]
        out[a:a + 256] = _matrices(lambda e, part=part: _row_lattice(part, e), reach[a:a + 256])
    return out


_STAY = np.where(np.eye(4, dtype=bool), 0, NONE).astype(np.int64)


def _grouped(mats: np.ndarray) -> np.ndarray:
    """Sequence [n, 4, 4] in groups of FAN, filled up by matrices that change nothing."""
    groups = -(-len(mats) // FAN)
    fill = np.broadcast_to(_STAY, (groups * FAN - len(mats), 4, 4))
    return np.concatenate([mats, fill]).reshape(groups, FAN, 4, 4)


def _tree(mats: np.ndarray) -> list[np.ndarray]:
    """The matrices, their products by groups, the products of those, up to a single one."""
    out = [mats]
    while len(out[-1]) > 1:
        groups = _grouped(out[-1])
        reach = groups[:, 0] < NONE
        for k in range(1, FAN):
            reach = (reach[:, :, :, None] & (groups[:, k] < NONE)[:, None]).any(axis=2)
        out.append(_matrices(lambda e, g=groups: _matrix_lattice(g, e), reach))
    return out


def product(mats: np.ndarray) -> np.ndarray:
    """Costs across a whole sequence of matrices [n, 4, 4]."""
    return _tree(mats)[-1][0]


def prices_along(mats: np.ndarray, entries: np.ndarray, exits: np.ndarray) -> np.ndarray:
    """Price [n + 1, 4] of each state before, between and after the matrices; NONE for states
    that no cheapest path from the entries (boolean [4]) passes."""

    def inside(groups, begin, end):
        cost, to, price = _matrix_lattice(groups, end)
        price = auction(cost, to, price, np.where(begin, np.arange(4)[None], -1))
        price = np.where(_live(cost, to, price), price, NONE)[:, :-1]
        return price.reshape(len(groups), groups.shape[1] + 1, 4)

    levels = _tree(mats)
    along = inside(levels[-1][None], np.asarray(entries)[None], np.asarray(exits)[None])[0]
    for level in levels[-2::-1]:
        found = inside(_grouped(level), along[:-1] < NONE, along[1:])
        along = np.concatenate([found[:, :-1].reshape(-1, 4)[:len(level)], along[-1:]])
    return along


def _trace(cost, to, price, live, origin):
    """Letters of the least tight path from each lane's origin, and the state it leaves in."""
    lanes, nodes, _ = cost.shape
    at = origin.astype(np.int64)
    rows = np.arange(lanes)
    letters = [[] for _ in range(lanes)]
    left = np.zeros(lanes, np.int64)
    while len(rows):
        ends = to[rows, at]
        fits = (cost[rows, at] + price[rows[:, None], ends] == price[rows, at][:, None]) & live[rows[:, None], ends]
        slot = fits.argmax(axis=1)
        head = ends[np.arange(len(rows)), slot]
        out = head == nodes - 1
        left[rows[out]] = at[out] % 4
        for r, s in zip(rows[~out].tolist(), slot[~out].tolist(), strict=True):
            letters[r].append(LETTERS[s])
        rows, at = rows[~out], head[~out]
    return ["".join(x) for x in letters], left.tolist()


def _solve_blocks(tasks):
    """(letters, state left) of each (rows, entry state, exit prices)."""
    out = [None] * len(tasks)
    by_size = sorted(range(len(tasks)), key=lambda k: len(tasks[k][0]))
    for a in range(0, len(by_size), 512):  # lanes of like sizes move together
        some = by_size[a:a + 512]
        cost, to, price = _row_lattice([tasks[k][0] for k in some], [tasks[k][2] for k in some])
        origin = np.array([tasks[k][1] for k in some])
        price = auction(cost, to, price, origin[:, None])
        letters, left = _trace(cost, to, price, _live(cost, to, price), origin)
        for k, x, q in zip(some, letters, left, strict=True):
            out[k] = (x, q)
    return out


def solve(problems):
    """{entry: (letters, state left)} of each (rows, entry states, exit prices)."""
    tasks, where, plans = [], {}, []

    def task(rows, entry, exits, key):
        where[key] = len(tasks)
        tasks.append((rows, entry, exits))

    blocks = {p: [rows[a:a + BLOCK] for a in range(0, len(rows), BLOCK)]
              for p, (rows, _, _) in enumerate(problems) if len(rows) > BLOCK}
    flat = [b for x in blocks.values() for b in x]
    mats, used = (row_matrices(flat) if flat else None), 0
    for p, (rows, entries, exits) in enumerate(problems):
        if p not in blocks:
            for q in entries:
                task(rows, q, exits, (p, 0, q))
            continue
        mine = mats[used:used + len(blocks[p])]
        used += len(mine)
        price = prices_along(mine, np.isin(np.arange(4), entries), np.asarray(exits))
        for k, b in enumerate(blocks[p]):
            for q in np.flatnonzero(price[k] < NONE).tolist():
                task(b, q, price[k + 1], (p, k, q))
    done = _solve_blocks(tasks)
    for p, (_, entries, _) in enumerate(problems):
        found = {}
        for q in entries:
            text, state = [], q
            for k in range(len(blocks.get(p, [0]))):
                letters, state = done[where[(p, k, state)]]
                text.append(letters)
            found[q] = ("".join(text), state)
        plans.append(found)
    return plans


def part_matrix(rows) -> np.ndarray:
    """Costs across a part's lattice rows; none: states stay as they are."""
    if not rows:
        return _STAY
    return product(row_matrices([rows[a:a + BLOCK] for a in range(0, len(rows), BLOCK)]))


# ----------------------------------------------------------------- parts of conversations

class _Part:
    """Consecutive rows of one conversation: counts, and its lattice rows with their texts."""

    __slots__ = ("conv", "seq", "rows", "blank", "duplicate", "truncated", "illegal", "turns",
                 "low", "high", "first", "last", "ahead", "lattice", "roles", "texts", "after", "size")

    def __init__(self, conv, seq):
        self.conv, self.seq = conv, seq
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None
        self.ahead = self.size = 0
        self.lattice, self.roles, self.texts, self.after = [], [], [], []

    def add(self, turn, role, text, copies, blank, short, is_first):
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        if self.rows:
            self.illegal += (self.last + initial) not in ("su", "ua", "au")
        else:
            self.first = initial
        self.illegal += copies - 1
        self.last = initial
        self.rows += copies
        gone = copies
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - is_first
            if is_first:
                gone -= 1
                self.truncated += short
                self.lattice.append((initial, int(short)))
                self.roles.append(role)
                self.texts.append(text)
                self.after.append(0)
                self.size += len(text)
        if self.after:
            # the row's own copies, or a row that must go, right after the last kept edit
            self.after[-1] += gone
        else:
            self.ahead += gone

    def full(self):
        return len(self.lattice) >= PART_ROWS or self.size >= PART_BYTES


def _apply(letters, state, part_roles, part_texts, after, ahead, tail=""):
    """Audit and repaired (role, text) pairs of a part, from the edits of its lattice rows."""
    audit, turns, row = ["D" * ahead], [], 0
    for x in letters + tail:
        audit.append(x)
        if x == "I":
            state = NEXT[state]
            turns.append((NAMES[state], ""))
            continue
        if x == "K":
            state = _KEEPS[part_roles[row][:1]][state]
            turns.append((part_roles[row], part_texts[row]))
        elif x == "R":
            state = NEXT[state]
            turns.append((NAMES[state], part_texts[row]))
        audit.append("D" * after[row])
        row += 1
    return "".join(audit), turns


def _cost(audit: str, letters: str, lattice) -> int:
    """3 a deletion, 2 an insertion or new role, 1 a truncated row that stays."""
    rows = [x for x in letters if x != "I"]
    stays = sum(short for x, (_, short) in zip(rows, lattice, strict=True) if x != "D")
    return 3 * audit.count("D") + 2 * (audit.count("I") + audit.count("R")) + stays


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _schema(conv_type) -> T.StructType:
    s = T.StructType().add("conv_id", conv_type).add("part", "long")
    for c in [*COUNTS, "rows", "turns", "low", "high"]:
        s = s.add(c, "long")
    s = s.add("audit", "string").add("repaired_sha256", "string")
    s = s.add("first", "string").add("last", "string").add("ahead", "long")
    s = s.add("initials", T.ArrayType(T.StringType())).add("short", T.ArrayType(T.LongType()))
    s = s.add("after", T.ArrayType(T.LongType())).add("matrix", T.ArrayType(T.LongType()))
    return s.add("roles", T.ArrayType(T.StringType())).add("texts", T.ArrayType(T.StringType()))


def _span(low, high, turns):
    return 0 if low is None else high - low + 1 - turns


def _solver(schema: T.StructType, turns: bool):
    """Sorted rows of a partition to finished conversations and to parts of the open ones."""
    arrow = to_arrow_schema(schema)

    def finished(parts):
        plans = solve([(p.lattice, [START], END) for p in parts])
        for p, plan in zip(parts, plans, strict=True):
            letters, state = plan[START]
            audit, rest = _apply(letters, START, p.roles, p.texts, p.after, p.ahead, TAIL[state])
            row = {
                "conv_id": p.conv, "gaps": _span(p.low, p.high, p.turns), "blank": p.blank,
                "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal,
                "cost": _cost(audit, letters, p.lattice), "audit": audit,
                "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rest).encode()).hexdigest()}
            if turns:
                row |= {"roles": [r for r, _ in rest], "texts": [t for _, t in rest]}
            yield row

    def left_open(parts, pid):
        for p in parts:
            yield {"conv_id": p.conv, "part": (pid << 40) | p.seq, "blank": p.blank, "duplicate": p.duplicate,
                   "truncated": p.truncated, "illegal": p.illegal, "rows": p.rows, "turns": p.turns,
                   "low": p.low, "high": p.high, "first": p.first, "last": p.last, "ahead": p.ahead,
                   "initials": [x for x, _ in p.lattice], "short": [x for _, x in p.lattice], "after": p.after,
                   "matrix": part_matrix(p.lattice).ravel().tolist(), "roles": p.roles, "texts": p.texts}

    def run(batches):
        pid = TaskContext.get().partitionId()
        seq, whole, size = 0, [], 0
        part, edge, begun = None, True, None  # edge: the conversation may go on in another task
        mark = None

        def send(rows):
            return pa.RecordBatch.from_pylist(list(rows), schema=arrow)

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("conv_id", "turn", "role", "digest", "mark", "n", "blank", "short", "text")]
            for conv, turn, role, digest, kind, n, blank, short, text in zip(*cols, strict=True):
                if kind == 0:
                    mark = (conv, turn, role, digest)
                    if part is not None and conv == begun:
                        continue
                if part is None or conv != begun:
                    if part is not None:
                        if edge:
                            yield send(left_open([part], pid))
                        else:
                            whole.append(part)
                            size += part.size
                        edge = False
                    else:
                        edge = True  # the task's first conversation may have begun in the one before
                    begun, part, seq = conv, _Part(conv, seq), seq + 1
                    if len(whole) >= 512 or size >= PART_BYTES:
                        yield send(finished(whole))
                        whole, size = [], 0
                elif part.full():
                    yield send(left_open([part], pid))
                    part, edge, seq = _Part(conv, seq), True, seq + 1
                if kind and n > 0:
                    part.add(turn, role, text, n, blank, short, mark == (conv, turn, role, digest))
        if whole:
            yield send(finished(whole))
        if part is not None:
            yield send(left_open([part], pid))

    return run


# ------------------------------------------------------- conversations over several parts

def _exit_prices(pdf):
    """Prices at the end of each part, and which states it may begin in, from the matrices."""
    import pandas as pd
    pdf = pdf.sort_values("part")
    mats = np.array([np.array(m, np.int64).reshape(4, 4) for m in pdf["matrix"]])
    price = prices_along(mats, np.arange(4) == START, np.array(END))
    return pd.DataFrame({"part": pdf["part"].to_numpy(), "entry": price[:-1].tolist(), "exit": price[1:].tolist()})


def _paths(batches):
    """Edits of each part from every state that it may begin in."""
    for batch in batches:
        rows = batch.to_pylist()
        plans = solve([(list(zip(r["initials"], r["short"], strict=True)),
                        [q for q in range(4) if r["entry"][q] < NONE], r["exit"]) for r in rows])
        yield pa.RecordBatch.from_arrays([
            batch.column(batch.schema.get_field_index("conv_id")),
            pa.array([r["part"] for r in rows], pa.int64()),
            pa.array([[p.get(q, (None, None))[0] for q in range(4)] for p in plans], pa.list_(pa.string())),
            pa.array([[p.get(q, (None, None))[1] for q in range(4)] for p in plans], pa.list_(pa.int64()))],
            ["conv_id", "part", "letters", "leaves"])


def _choose(pdf):
    """Each part's entry state, following the parts in order from the start."""
    import pandas as pd
    pdf = pdf.sort_values("part")
    state, entry = START, []
    for leaves in pdf["leaves"]:
        entry.append(state)
        state = int(leaves[state])
    letters = [x[q] for x, q in zip(pdf["letters"], entry, strict=True)]
    tail = [""] * (len(entry) - 1) + [TAIL[state]]
    return pd.DataFrame({"part": pdf["part"].to_numpy(), "letters": letters, "state": entry, "tail": tail})


def _joiner(schema: T.StructType, turns: bool):
    """Parts in order, one after the other, to the conversations' results."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        now, parts = None, None

        def result():
            return pa.RecordBatch.from_pylist([now | {
                "gaps": _span(now["low"], now["high"], now["turns"]), "audit": "".join(parts["audit"]),
                "repaired_sha256": parts["hash"].hexdigest()}], schema=arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        yield result()
                    now = {"conv_id": r["conv_id"], "low": None, "high": None, "turns": 0, "last": None, "rows": 0,
                           **dict.fromkeys(COUNTS, 0)}
                    parts = {"audit": [], "hash": hashlib.sha256(), "turns": 0}
                audit, rest = _apply(r["letters"], r["state"], r["roles"], r["texts"], r["after"], r["ahead"], r["tail"])
                for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                    now[c] += r[c]
                now["cost"] += _cost(audit, r["letters"], list(zip(r["initials"], r["short"], strict=True)))
                if r["low"] is not None:
                    now["turns"] -= now["high"] == r["low"]
                    now["low"] = r["low"] if now["low"] is None else now["low"]
                    now["high"] = r["high"]
                if r["rows"]:
                    if now["rows"]:
                        now["illegal"] += now["last"] + r["first"] not in ("su", "ua", "au")
                    now["last"] = r["last"]
                    now["rows"] += r["rows"]
                parts["audit"].append(audit)
                for role, text in rest:
                    parts["hash"].update(("\n" if parts["turns"] else "").encode())
                    parts["hash"].update(f"{role}:{text}".encode())
                    parts["turns"] += 1
                if turns and rest:
                    yield pa.RecordBatch.from_pylist([{
                        "conv_id": r["conv_id"], "part": r["part"],
                        "roles": [x for x, _ in rest], "texts": [x for _, x in rest]}], schema=arrow)
        if now is not None:
            yield result()

    return run


def _solved(rows: DataFrame, copies: Column | None, turns: bool) -> tuple[DataFrame, T.StructType]:
    spark = rows.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "conversations")
    gone = F.col("n") <= 0
    given = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce((F.lit(1) if copies is None else copies).cast("long"), F.lit(1)).alias("n"))
    # a row without copies only says that its conversation is there
    given = given.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(F.sha2("text", 256)).alias("digest"),
        F.greatest("n", F.lit(0)).alias("n"), F.when(~gone, F.col("text")).alias("text"))
    kinds = scratch.write(given.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("n").alias("n"), F.first("text").alias("text")).select(
        "*", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        F.col("text").rlike(rf"[^.!?{SPACE}][{SPACE}]*\z").alias("short")), "rows")
    first = kinds.where("n > 0 and not blank").groupBy("conv_id", "role", "digest").agg(
        F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("turn"))
    first = first.select("conv_id", F.when(~F.col("untimed"), F.col("turn")).alias("turn"), "role", "digest",
                         F.lit(0).alias("mark"))
    order = ["conv_id", "turn", "role", "digest"]
    ranged = kinds.withColumn("mark", F.lit(1)).unionByName(first, allowMissingColumns=True) \
        .repartitionByRange(*order).sortWithinPartitions(*order, "mark")
    schema = _schema(rows.schema["conv_id"].dataType)
    out = scratch.write(ranged.select(*order, "mark", "n", "blank", "short", "text")
                        .mapInArrow(_solver(schema, turns), schema), "parts")
    open_ = out.where(F.col("part").isNotNull())
    prices = open_.select("conv_id", "part", "matrix").groupBy("conv_id").applyInPandas(
        _exit_prices, "part long, entry array<long>, exit array<long>")
    paths = open_.select("conv_id", "part", "initials", "short").join(prices, "part").mapInArrow(
        _paths, T.StructType().add("conv_id", rows.schema["conv_id"].dataType).add("part", "long")
        .add("letters", T.ArrayType(T.StringType())).add("leaves", T.ArrayType(T.LongType())))
    chosen = paths.groupBy("conv_id").applyInPandas(
        _choose, "part long, letters string, state long, tail string")
    joined = open_.drop("audit", "repaired_sha256", "gaps", "cost", "matrix").join(chosen, "part")
    joined = joined.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    whole = joined.mapInArrow(_joiner(schema, turns), schema)
    return out.where(F.col("part").isNull()).unionByName(whole), schema


RESULT = ["conv_id", *COUNTS, "audit", "repaired_sha256"]


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): counts of the faults, the cost
    and the edits' initials of the cheapest repair, and the hash of the repaired turns.

    ``copies``: how often a row stands (0: only its conversation is known).
    """
    return _solved(rows, copies, False)[0].where(F.col("audit").isNotNull()).select(*RESULT)


def repaired_turns(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired conversations: conv_id, part and place (in that order), role, text."""
    found = _solved(rows, copies, True)[0].where(F.col("roles").isNotNull())
    found = found.select("conv_id", F.coalesce("part", F.lit(0)).alias("part"), F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "x"))
    return found.select("conv_id", "part", "place", F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The fixed damage by CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space), and each
    row's copies: 0 drops it, 1 empties the text, 2 takes ``[.!?]`` out of it, 3 repeats it,
    4 makes its role user."""
    blank = F.lit(" ")
    by = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                          F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text = F.coalesce("text", blank)
    out = rows.select(
        "conv_id", "turn", F.when(by == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(by == 1, "").when(by == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(by == 0, 0).when(by == 3, 2).otherwise(1).alias("_copies"))
    return out, F.col("_copies")
