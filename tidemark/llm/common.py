"""Shared helpers: shared-folder tables, vectorised word hashing, key groups, components.

Word hashing works on the UTF-8 bytes of a whole Arrow batch at once: a word is a run
of bytes outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased, hashed to 64 bits.
"""

from __future__ import annotations

import time
import uuid
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

CHUNK_BYTES = 1 << 20
MASK = (1 << 64) - 1


class Scratch:
    """Tables written under the cluster's shared folder (``spark.checkpoint.dir``).

    A written table cuts the lineage, survives a lost executor, and is read back
    without the partitioning of the plan that made it, so that a later join on a hot
    key gets an exchange on both sides and AQE can split it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._freed = time.monotonic()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        self._free()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def together(self, tables: list[DataFrame]) -> DataFrame:
        """Written tables of one schema as one scan, so plans do not grow with their number."""
        out = self.spark.read.schema(tables[0].schema).parquet(*(t._scratch_path for t in tables))
        out._scratch_parts = tables
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Deletes written tables that nothing will read again."""
        for df in tables:
            self.drop(*getattr(df, "_scratch_parts", ()))
            path = getattr(df, "_scratch_path", None)
            if path:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def _free(self) -> None:
        """Shuffle files of finished steps go when the driver collects its garbage; many
        steps on a small driver heap would otherwise hold them all on disk."""
        if time.monotonic() - self._freed > 3:
            self.free()

    def free(self) -> None:
        self._freed = time.monotonic()
        self.spark._jvm.System.gc()


def set_aside(docs: DataFrame, used: list[str], added=()) -> tuple[DataFrame, list]:
    """``docs`` with the ``used`` columns as they are and all others under names that no step
    uses, and the columns that give all back in their order.  One that has the name of an
    ``added`` column comes back as ``input_<name>``."""
    taken = {c.lower() for c in [*docs.columns, *added]}
    here, back = [], []
    for k, c in enumerate(docs.columns):
        if c in used:
            here.append(F.col(c))
            back.append(F.col(c))
            continue
        name = c
        while name.lower() in {x.lower() for x in added} or (name != c and name.lower() in taken):
            name = f"input_{name}"
        quoted = c.replace("`", "``")
        here.append(F.col(f"`{quoted}`").alias(f"_carried_{k}"))
        back.append(F.col(f"_carried_{k}").alias(name))
    return docs.select(*here), back


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes as well as rows: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


# ---------------------------------------------------------------------- word hashing

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (three multiply/xor-shift steps), elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_CODE[0x41:0x5B] = _CODE[0x61:0x7B]  # A-Z as a-z
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        p = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=np.uint64)
        p[0] = 1
        _powers[name] = np.multiply.accumulate(p)
    return _powers[name]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges of at most ``most`` bytes, one row at least, so memory stays bounded."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE,
          code: np.ndarray = _CODE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of each word and the word offsets of each row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    cuts = offsets[:-1]
    first[cuts[cuts < n]] = True  # a word never runs over a row's end
    last = np.empty(n, dtype=bool)
    last[:-1] = ~inside[1:] | first[1:]
    last[-1] = True
    first &= inside
    last &= inside
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(code[data] * _power("up", _BASE, n)[:n], out=total[1:])
    h = (total[end] - total[start]) * _power("down", _INVERSE, n)[start]
    h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return h, start, end, np.searchsorted(start, offsets).astype(np.int64)


_STEP = [pow(0xE7037ED1A0B428DB, j + 1, 1 << 64) for j in range(64)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row.

    Fewer than k words: the whole sequence as one; no words: empty.
    """
    h, _, _, off = words(data, offsets)
    with np.errstate(over="ignore"):
        m = max(0, len(h) - k + 1)
        rolled = np.full(m, np.uint64(k), dtype=np.uint64)
        for j in range(k):
            rolled += h[j:j + m] * np.uint64(_STEP[j])
        rolled = mix(rolled)
        out = []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            if b - a >= k:
                s = np.sort(rolled[a:b - k + 1])
                if len(s) > 1:
                    keep = np.empty(len(s), dtype=bool)
                    keep[0] = True
                    np.not_equal(s[1:], s[:-1], out=keep[1:])
                    s = s[keep]
                out.append(s)
            elif b > a:
                s = np.uint64(b - a)
                for j in range(b - a):
                    s = s + h[a + j] * np.uint64(_STEP[j])
                out.append(mix(np.array([s], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def text_rows(batches, text: str = "text"):
    """(RecordBatch, row range, bytes, offsets) in slices of bounded size."""
    for batch in batches:
        data, off = utf8(batch.column(batch.schema.get_field_index(text)))
        for i, j in slices(off):
            yield batch, i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]


# ----------------------------------------------------------------------- key groups

SHARED = "pair boolean, key long, id long, aux long"
MORE_HUBS = 4
TASK_ENTRIES = 64  # of a key that a task sends to the key's shard
PAIRED_GROUP = 512  # members of a key whose pairs are all looked at where they meet
PAIRS_A_MEMBER = 4


def _planes(x: np.ndarray) -> bytes:
    """Bytes by significance, so that the many zero bytes of small numbers lie together."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _pack(key, id_, aux, more) -> bytes:
    names, back = np.unique(id_, return_inverse=True)
    return b"".join((np.array([len(key), len(names)], np.int64).tobytes(), key.tobytes(), names.tobytes(),
                     _planes(back.astype(np.uint32)), _planes(aux), more.astype(np.uint8).tobytes()))


def _unpack(blob: bytes):
    n, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    at = [16]

    def take(kind, count):
        out = np.frombuffer(blob, kind, count, at[0])
        at[0] += out.nbytes
        return out

    def planes(kind, width):
        return np.ascontiguousarray(take(np.uint8, width * n).reshape(width, n).T).view(kind).ravel()

    key, names = take(np.int64, n), take(np.int64, m)
    return key, names[planes(np.uint32, 4)], planes(np.int64, 8), take(np.uint8, n)


def shared_keys(source: DataFrame, emit, shards: int, near) -> DataFrame:
    """What the keys that two or more ids hold have to tell: rows (key, id, aux) of their
    members, or (pair, a, b) of ids that share a key and are near.

    ``emit(batches)`` yields int64 arrays (key, id, aux), as many times as it likes.
    Keys travel as sorted arrays by shard, and a task sends ``TASK_ENTRIES`` entries a key at
    most: the further ids are known to be shared and go round-robin instead, so one hot key
    never fills a shard.

    ``near(x, y)``: ``link_groups``' cheap condition on arrays of aux.  A group that is whole in
    its shard gives its near pairs if they are few, else the members that are near another.
    """

    def out(batches):
        held, size = [], 0

        def flush():
            key, id_, aux = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((id_, key))
            key, id_, aux = key[order], id_[order], aux[order]
            n = len(key)
            new = np.ones(n, dtype=bool)
            new[1:] = key[1:] != key[:-1]
            same = np.zeros(n, dtype=bool)  # the very same (key, id) again
            same[1:] = ~new[1:] & (id_[1:] == id_[:-1])
            heads = np.flatnonzero(new)
            place = np.cumsum(~same) - np.repeat(np.cumsum(~same)[heads], np.diff(np.append(heads, n)))
            extra = ~same & (place >= TASK_ENTRIES)
            some = ~same & ~extra
            more = np.logical_or.reduceat(extra, heads)[np.cumsum(new) - 1]
            shard = (mix(key.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            shard[extra] = (mix(id_[extra].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            for kind, pick in ((0, np.flatnonzero(some)), (1, np.flatnonzero(extra))):
                if not len(pick):
                    continue
                pick = pick[np.argsort(shard[pick], kind="stable")]
                flag = more[pick]
                at = np.flatnonzero(np.diff(shard[pick], prepend=-1))
                ends = np.append(at[1:], len(pick))
                rows = [(int(shard[pick[a]]), kind,
                         _pack(key[pick[a:b]], id_[pick[a:b]], aux[pick[a:b]], flag[a:b]))
                        for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "blob"])

        for key, id_, aux in emit(batches):
            held.append((key.astype(np.int64, copy=False), id_.astype(np.int64, copy=False),
                         aux.astype(np.int64, copy=False)))
            size += len(key)
            if size >= 1_000_000:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def gather(batches):
        for _, rows in shard_groups(batches):
            held = []
            for kind, blob in rows:
                key, id_, aux, more = _unpack(blob.as_buffer())
                if kind.as_py():
                    yield _rows(key, id_, aux)
                else:
                    held.append((key.copy(), id_.copy(), aux.copy(), more.copy()))
            if not held:
                continue
            key, id_, aux, more = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((id_, key))
            key, id_, aux, more = key[order], id_[order], aux[order], more[order]
            new = np.ones(len(key), dtype=bool)  # an id may come from several tasks
            new[1:] = (key[1:] != key[:-1]) | (id_[1:] != id_[:-1])
            more = np.maximum.reduceat(more, np.flatnonzero(new))
            key, id_, aux = key[new], id_[new], aux[new]
            keep, a, b = _near_pairs(key, aux, more > 0, near)
            for x in np.split(np.arange(len(a)), range(100_000, len(a), 100_000)):
                yield _rows(np.minimum(id_[a[x]], id_[b[x]]), np.maximum(id_[a[x]], id_[b[x]]), np.zeros(len(x), np.int64), True)
            for x in np.split(keep, range(100_000, len(keep), 100_000)):
                yield _rows(key[x], id_[x], aux[x])

    dealt = source.mapInArrow(out, "shard int, kind int, blob binary").transform(by_shard, shards)
    return dealt.mapInArrow(gather, SHARED)


def _near_pairs(key, aux, more, near):
    """Places of the members that stay as rows, and of each two that are a near pair.
    key: sorted; more: whether members of the key are elsewhere."""
    heads = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    size = np.diff(np.append(heads, len(key)))
    more = np.logical_or.reduceat(more, heads)
    rows = np.repeat(more | (size > PAIRED_GROUP), size)
    pairs = [(np.zeros(0, np.int64),) * 2]
    here = ~more & (size > 1) & (size <= PAIRED_GROUP)
    for n in np.unique(size[here]).tolist():
        i, j = np.triu_indices(n, 1)
        first = heads[here & (size == n)]
        step = max(1, 1_000_000 // len(i))
        for f in (first[k:k + step, None] for k in range(0, len(first), step)):
            close = near(aux[f + i], aux[f + j])
            few = close.sum(axis=1) <= PAIRS_A_MEMBER * n
            g, at = np.nonzero(close)
            x, y, listed = f[g, 0] + i[at], f[g, 0] + j[at], few[g]
            pairs.append((x[listed], y[listed]))
            rows[x[~listed]] = rows[y[~listed]] = True
    return np.flatnonzero(rows), *(np.concatenate(c) for c in zip(*pairs, strict=True))


def _rows(key, id_, aux, pair: bool = False) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), pair)), *(pa.array(x, pa.int64()) for x in (key, id_, aux))],
        ["pair", "key", "id", "aux"])


def by_shard(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (shard, ...) dealt by shard and in its order, so a task that gets several
    shards holds one of them at a time (``shard_groups``)."""
    return rows.repartition(shards_to_tasks(rows.sparkSession, shards), "shard").sortWithinPartitions("shard")


def shard_groups(batches):
    """(shard, iterator of its rows' other columns) of batches in the order of their first
    column."""
    rows = (row for batch in batches for row in zip(
        batch.column(0).to_pylist(), *batch.columns[1:], strict=True))
    for shard, group in groupby(rows, key=lambda row: row[0]):
        yield shard, (row[1:] for row in group)


def shards_to_tasks(spark: SparkSession, shards: int) -> int:
    return max(1, min(shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def link_groups(scratch: Scratch, shared: DataFrame, close, verify, rank=lambda x: F.lit(0)) -> DataFrame:
    """Labels (id, label) of the components that the verified links of all pairs of ids in
    any key group make; ids without links have no row.

    shared: written table of ``shared_keys``, dropped once read.  close(x, y): cheap condition on
    two aux columns that every true link fulfils on some shared key.  verify: pairs (a, b) of
    ids -> links (a, b).  rank(x): members of the lowest rank are hubs first.

    The near pairs of small groups come first, all at once.  Then rounds of stars: each member
    is compared with its group's first members by (rank, id), the hubs, unless links have
    joined the two already; hubs then leave their groups.  Once a
    group's members are in one component it is done, so a group of many near copies takes few
    rounds and not all its pairs.  A round has ``MORE_HUBS`` times the hubs of the one before,
    and once comparing all pairs left between components takes no more than the next
    round, they are compared: no link between components is lost, and the number of rounds is
    at most the logarithm of the largest group.
    """
    first = Window.partitionBy("key").orderBy(rank(F.col("aux")), "id")
    star = scratch.write(shared.where("pair").select(F.col("key").alias("a"), F.col("id").alias("b")).distinct(), "star")
    found = scratch.write(verify(star), "star-links")
    label = components(scratch, found)
    scratch.drop(found)
    stars = [star]
    open_, pairs, rows = _open_groups(scratch, shared.where("not pair").select("key", "id", "aux"), label)
    scratch.drop(shared)
    n_hubs = MORE_HUBS  # the pairs stand for the first round
    while pairs > n_hubs * rows:
        # the limit on row_number is taken within each task before the shuffle
        hubs = scratch.write(
            open_.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n_hubs)
            .select("key", F.struct("id", "aux", "label").alias("hub")), "hubs")
        star = (open_.join(hubs, "key").where(F.col("label") != F.col("hub.label"))
                .where(close(F.col("aux"), F.col("hub.aux")))
                .select(F.least("hub.id", "id").alias("a"), F.greatest("hub.id", "id").alias("b")).distinct())
        star = scratch.write(star.join(scratch.together(stars), ["a", "b"], "left_anti"), "star")
        found = scratch.write(verify(star), "star-links")
        stars.append(star)
        earlier, label = label, components(scratch, found, label)
        scratch.drop(earlier, found)
        member = open_.join(hubs.select("key", F.col("hub.id").alias("id")), ["key", "id"], "left_anti")
        before = open_
        open_, pairs, rows = _open_groups(scratch, member.select("key", "id", "aux"), label)
        scratch.drop(hubs, before)
        n_hubs *= MORE_HUBS
    if not rows:
        return label
    seen = scratch.together(stars)
    x, y = (open_.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "aux", "label")))
            for s in "xy")
    pairs = (x.join(y, "key").where("id_x < id_y and label_x <> label_y")
             .where(close(F.col("aux_x"), F.col("aux_y")))
             .select(F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct()
             .join(seen, ["a", "b"], "left_anti"))
    more = scratch.write(verify(scratch.write(pairs, "pairs")), "more-links")
    return components(scratch, more, label)


def _open_groups(scratch: Scratch, member: DataFrame, label: DataFrame) -> tuple[DataFrame, float, int]:
    """The members (key, id, aux, label) of keys that hold several components, the number of
    their pairs between components and of their rows."""
    now = scratch.write(member.join(label, "id", "left")
                        .select("key", "id", "aux", F.coalesce("label", "id").alias("label")), "labelled")
    # pairs of a key between components: (all pairs) - (pairs within a component)
    by = now.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = scratch.write(
        by.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"),
                              F.count("*").alias("labels"))
        .where("labels > 1").select("key", ((F.col("n") * F.col("n") - F.col("own")) / 2).alias("pairs"),
                                    "n"), "mixed")
    pairs, rows = mixed.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    open_ = scratch.write(now.join(mixed.select("key"), "key", "left_semi"), "open")
    scratch.drop(now, mixed)
    return open_, pairs, rows


def components(scratch: Scratch, links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(id, label): label is the smallest id reachable over links (a, b).

    before: written labels of earlier links; ``links`` then need to hold the new ones only,
    which are drawn between the earlier components.  Alternating large-star and small-star
    rounds, each a grouped minimum and a join on written tables, until every id is the least
    of its neighbourhood or has one neighbour; ids without links have no row.  Nothing
    reaches the driver but the number of ids that are neither.
    """
    ends = links.select("a", "b")
    if before is not None:
        x, y = (before.select(F.col("id").alias(c), F.col("label").alias(f"{c}_label")) for c in "ab")
        ends = (ends.join(x, "a", "left").join(y, "b", "left")
                .select(*(F.coalesce(f"{c}_label", c).alias(c) for c in "ab")))
    edges = scratch.write(
        ends.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                                    F.count("*").alias("n")), "large")
        if least.where("m < u and n > 1").count() == 0:
            break
        old, first = edges, least
        edges = scratch.write(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct(), "large-star")
        least = scratch.write(edges.groupBy("u").agg(F.min("v").alias("m")), "small")
        near, large = edges.join(least, "u"), edges
        edges = scratch.write(
            near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        scratch.drop(old, first, large, least)
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    labels = stars.union(stars.select("label", "label").distinct())
    if before is not None:
        moved = (before.join(stars.toDF("label", "to"), "label", "left")
                 .select("id", F.coalesce("to", "label").alias("label")))
        labels = moved.union(labels.join(before.select("id"), "id", "left_anti"))
    labels = scratch.write(labels, "labels")
    scratch.drop(edges, least)
    return labels
