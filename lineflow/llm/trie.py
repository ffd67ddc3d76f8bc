"""Prefix trie of conversations by truncation peeling.

A conversation becomes a path: 16 bytes of hash for each turn. Spark sorts paths by
ranges, so that the conversations of a node lie together, and hot paths are cut over
several tasks. A task descends from its greatest depth: conversations that end there join
the nodes that survived from below, equal prefixes are regrouped into nodes of this depth,
the last turn is stripped, and what has been summed goes on to the depth above.

Nodes that a task shares with its neighbours are prefixes of its first or last path. It
hands on what it has summed for them as a chain, one row for each of the two paths.
Chains are peeled again in the same way, by fewer tasks, until one task can hold them:
there are two for each task, however many conversations there were. Ids of members go to
the hash of a node in order, those of cut nodes as strings of many ids.

Results in odd cases: a null role or text is an empty one; rows without a conv_id are left
out; turns of one number are in order of a hash of role and text, and repeated ones each
count; equal conversations share all nodes; an empty table has no node, not even a
root; other columns are not looked at. A conversation's hashes come together in one row, 24
bytes a turn.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineflow.llm.common import written

STEP = 16
#: Bytes of paths of a range, and of chains that one task peels.
RANGE_BYTES, CHAIN_BYTES = 16 << 20, 32 << 20
#: Ids of members in one row.
IDS = 1 << 15
#: Nodes sent to every task with their ids, 24 bytes each; more are joined by a shuffle.
SENT_NODES, SALTS = 100_000, 64
NONE = hashlib.sha256(b"").hexdigest()
_MOST = np.iinfo(np.int64).max

#: What a task gives: finished nodes, chains of nodes shared with neighbours, ids of members, and hashes of whole lists of them.
NODE, CHAIN, MEMBERS, HASH = range(4)
_COLUMNS = [
    ("kind", pa.int32()), ("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("up", pa.binary()), ("key", pa.binary()), ("path", pa.binary()), ("sizes", pa.list_(pa.int64())), ("own", pa.binary()), ("seq", pa.int64()),
]
_SCHEMA = "kind int, part int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, up binary, key binary, path binary, sizes array<long>, own binary, seq long"
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(turns: DataFrame, family: int = 1) -> DataFrame:
    """(family, convs array<struct<conv_id, turns array<struct<h hex string, size>>>>): conversations c with one c - c % family.

    Texts don't leave their task: a turn is its order, a hash and its size.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    h = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id is not null").select(
        (F.col("conv_id") - F.col("conv_id") % family).cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("a"), F.coalesce("turn", F.lit(0)).alias("b"), h.alias("h"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    ordered = rows.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    plain = F.transform("t", lambda t: F.struct(t["h"].alias("h"), t["size"].alias("size")))
    return ordered.groupBy("family").agg(F.collect_list(F.struct("conv_id", plain.alias("turns"))).alias("convs"))


def paths(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) -> (conv_id, path, sizes)."""
    return convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["h"]), "")).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows -> (conv_id, path, sizes) of each conversation."""
    return paths(turns_of(turns).select(F.explode("convs").alias("c")).select("c.*"))


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """sequences() of conversations that branch off: the first h turns of conversation c - c % family, then c's own after its first h; h = crc32(c) % most."""
    convs = turns_of(turns, family)
    first = F.get(F.filter("convs", lambda c: c["conv_id"] == F.col("family")), F.lit(0))["turns"]
    each = convs.select(F.slice(F.coalesce(first, F.expr("array()").cast("array<struct<h:string,size:bigint>>")), 1, most).alias("first"), F.explode("convs").alias("c"))
    h = (F.crc32(F.col("c.conv_id").cast("string").cast("binary")) % most).cast("int")
    own = F.slice("c.turns", h + 1, F.greatest(F.size("c.turns"), F.lit(1)))
    return paths(each.select("c.conv_id", F.concat(F.slice("first", F.lit(1), h), own).alias("turns")))


def _common(a: bytes, b: bytes) -> int:
    n, most = 0, min(len(a), len(b)) // STEP
    while n < most and a[n * STEP : n * STEP + STEP] == b[n * STEP : n * STEP + STEP]:
        n += 1
    return n


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.md5(path[: depth * STEP]).digest()


def _ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


class Peeling:
    """What one task knows of its distinct paths, in order, and the peeling of them."""

    def __init__(self) -> None:
        self.paths: list[bytes] = []
        self.sizes: list[np.ndarray] = []
        self.ends: list[str | None] = []
        self.members: dict[int, list[int]] = {}
        self.own: list[np.ndarray] = []  # rows of depth, path, and the five sums of what is attached there

    def add(self, path: bytes, sizes: np.ndarray) -> bool:
        """Whether this path is new."""
        if self.paths and self.paths[-1] == path:
            return False
        self.paths.append(path)
        self.sizes.append(sizes)
        self.ends.append(None)
        return True

    def close_members(self, last: bool = False) -> None:
        """The path before the newest one (or the newest) has all members that this task has: hash them, unless the node may be cut."""
        i = len(self.paths) - (1 if last else 2)
        if i > 0 and not last:
            self.ends[i] = hashlib.sha256(_ids(self.members.pop(i)).encode()).hexdigest()

    def levels(self, closed: bool) -> Iterator[dict]:
        """Finished nodes by depth, from the greatest up, as columns; then chains of the others, if not closed."""
        m, length = len(self.paths), np.array([len(p) // STEP for p in self.paths])
        lcp = np.array([-1, *map(_common, self.paths, self.paths[1:])])
        flat, offset = np.concatenate(self.sizes), np.concatenate([[0], np.cumsum(length)])
        own = np.concatenate(self.own)
        own = own[np.argsort(own[:, 0], kind="stable")]
        deepest = int(length.max())
        edge = np.searchsorted(own[:, 0], np.arange(deepest + 2))
        chains = {i: np.tile([0, _MOST, 0, 0, 0], (length[i] + 1, 1)) for i in ({0, m - 1} if not closed else ())}
        held = np.zeros(0, np.int64)  # first path of each surviving node
        sums, done = np.zeros((0, 5), np.int64), None  # what it hands up; finished ones, without their parent
        for depth in range(deepest, -1, -1):
            here = own[edge[depth] : edge[depth + 1]]
            entries = np.unique(np.concatenate([held, here[:, 1]]))
            start = entries[lcp[entries] < depth]
            total = np.tile(np.array([0, _MOST, 0, 0, 0]), (len(start), 1))
            for first, x in ((held, sums), (here[:, 1], here[:, 2:])):
                group = np.searchsorted(start, first, "right") - 1
                for k in (0, 2, 3, 4):
                    np.add.at(total[:, k], group, x[:, k])
                np.minimum.at(total[:, 1], group, x[:, 1])
            shared = np.zeros(len(start), bool)
            if not closed:
                if length[m - 1] >= depth:
                    shared[-1] = True
                    chains[m - 1][depth] = total[-1]
                if length[0] >= depth:
                    shared[0] = True
                    chains[0][depth] = total[0]
                    if len(start) == 1 and m > 1 and length[m - 1] >= depth:
                        chains[m - 1][depth] = [0, _MOST, 0, 0, 0]  # counted once
            if done is not None:
                group = np.searchsorted(start, done["start"], "right") - 1
                above = shared[group]
                done |= {"parent": np.where(above, 0, total[group, 1]), "known": ~above, "up": [_key(self.paths[s], depth) if o else None for s, o in zip(done["start"].tolist(), above.tolist())]}
                yield done
            leaves = np.where(total[:, 2] == 0, 1, total[:, 3])
            saved = total[:, 4] + ((total[:, 0] - 1) * flat[offset[start] + depth - 1] if depth else 0)
            f = ~shared
            done = {"start": start[f], "depth": depth, "conv_id": total[f, 1], "n": total[f, 0], "kids": total[f, 2], "leaves": leaves[f], "saved": saved[f], "ends": [self.ends[s] if length[s] == depth else NONE for s in start[f].tolist()]}
            for s in start[shared & (length[start] == depth)].tolist():
                if self.ends[s]:
                    yield {"hash": self.ends[s], "key": _key(self.paths[s], depth)}
            held, sums = start, np.where(f[:, None], np.stack([total[:, 0], total[:, 1], np.ones(len(start), np.int64), leaves, saved], 1), np.array([0, _MOST, 0, 0, 0]))
        if closed:
            yield done | {"parent": np.zeros(len(done["start"]), np.int64), "known": np.zeros(len(done["start"]), bool), "up": [None] * len(done["start"])}
        for i, chain in chains.items():
            yield {"chain": i, "own": chain.astype("<i8").tobytes()}


def _row(**values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(name)], kind) for name, kind in _COLUMNS], [name for name, _ in _COLUMNS])


def _nodes(x: dict, part: int, keys: list[bytes | None]) -> Iterator[pa.RecordBatch]:
    n = len(x["start"])
    columns = {
        "kind": np.full(n, NODE, np.int32), "part": np.full(n, part, np.int32), "conv_id": x["conv_id"], "depth": np.full(n, x["depth"], np.int64), "parent_conv_id": pa.array(x["parent"], mask=~x["known"]), "n_convs": x["n"],
        "n_children": x["kids"], "n_leaves": x["leaves"], "saved_tokens": x["saved"], "ends_sha256": x["ends"], "up": x["up"], "key": keys,
    }
    if n:
        whole = pa.RecordBatch.from_arrays([pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in _COLUMNS], [name for name, _ in _COLUMNS])
        for at in range(0, n, 10_000):
            yield whole.slice(at, 10_000)


def peel(batches: Iterator[pa.RecordBatch], closed: bool = False) -> Iterator[pa.RecordBatch]:
    """Peels a task's rows (path, sizes, conv_id, own), in order of path and conv_id: conversations have a conv_id, chains have own."""
    task, part, first = Peeling(), TaskContext.get().partitionId(), True
    for batch in batches:
        sizes = batch.column("sizes")
        values, offsets = sizes.values.to_numpy(), sizes.offsets.to_numpy()
        columns = (batch.column(c).to_pylist() for c in ("path", "conv_id", "own"))
        for path, conv_id, own, a, b in zip(*columns, offsets.tolist(), offsets[1:].tolist()):
            first = conv_id is not None
            new, i, depth = task.add(path, values[a:b]), len(task.paths) - 1, len(path) // STEP
            if own is not None:
                sums = np.frombuffer(own, "<i8").reshape(-1, 5)
                task.own.append(np.column_stack([np.arange(depth + 1), np.full(depth + 1, i), sums]))
            elif new:
                task.close_members()
                task.members[i] = [conv_id]
            else:
                task.members[i].append(conv_id)
            if own is None and new:
                task.own.append(np.array([[depth, i, 0, conv_id, 0, 0, 0]]))
            if own is None:
                task.own[-1][0, 2] += 1
    if not task.paths:
        return
    for i, members in task.members.items():  # of the first and the last path
        for seq, at in enumerate(range(0, len(members), IDS)):
            yield _row(kind=MEMBERS, part=part, key=_key(task.paths[i], len(task.paths[i])), seq=seq, ends_sha256=_ids(members[at : at + IDS]))
    for x in task.levels(closed):
        if "chain" in x:
            yield _row(kind=CHAIN, part=part, path=task.paths[x["chain"]], sizes=task.sizes[x["chain"]], own=x["own"])
        elif "hash" in x:
            yield _row(kind=HASH, part=part, key=x["key"], ends_sha256=x["hash"])
        else:
            if not first:  # chains don't know the members
                x["ends"] = [None] * len(x["start"])
            keys = [None] * len(x["start"]) if first else [_key(task.paths[s], x["depth"]) for s in x["start"].tolist()]
            yield from _nodes(x, part, keys)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, whose rows come in order."""
    key, state = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    yield out()
                key, state = k, hashlib.sha256(ids.encode())
    if key is not None:
        yield out()


def trie(convs: DataFrame, range_bytes: int = RANGE_BYTES, chain_bytes: int = CHAIN_BYTES) -> DataFrame:
    """(conv_id, path, sizes) -> one row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = written(convs.select("conv_id", "path", "sizes", F.lit(None).cast("binary").alias("own")), "trie-paths")
    size = convs.agg(F.coalesce(F.sum(F.length("path") + 8 * F.size("sizes") + 48), F.lit(0))).first()[0]
    ordered = lambda rows, n: rows.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    cut = written(ordered(convs, max(1, -(-size // range_bytes))).mapInArrow(peel, _SCHEMA), "trie-nodes")
    ids, hashes = cut.where(F.col("kind") == MEMBERS), cut.where(F.col("kind") == HASH).select("key", "ends_sha256")
    streamed = ids.select("key", "part", "seq", F.col("ends_sha256").alias("ids")).repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_hashes, "key binary, ends_sha256 string")

    finished, rounds = [cut.where(F.col("kind") == NODE)], []
    closed = False
    while not closed:
        chains = cut.where(F.col("kind") == CHAIN).select("path", "sizes", "conv_id", "own")
        n, size = chains.agg(F.count("*"), F.coalesce(F.sum(F.length("own") + F.length("path")), F.lit(0))).first()
        parts = min(-(-size // chain_bytes), n // 4)
        closed = parts <= 1
        rows = chains.coalesce(1).sortWithinPartitions("path") if closed else ordered(chains, parts)
        cut = written(rows.mapInArrow(functools.partial(peel, closed=closed), _SCHEMA), "trie-chains")
        rounds.append(cut.where(F.col("kind") == NODE))
    late = functools.reduce(DataFrame.unionByName, rounds).drop("ends_sha256").join(hashes.unionByName(streamed), "key", "left")
    late = written(late.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE))), "trie-shared")

    nodes = finished[0].unionByName(late)
    named = late.select(F.col("key").alias("up"), F.col("conv_id").alias("of"))
    under = nodes.where("up is not null")
    if late.count() <= SENT_NODES:
        under = under.join(F.broadcast(named), "up")
    else:  # a node may have most of the others under it
        salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        under = under.withColumn("salt", F.pmod("part", F.lit(SALTS))).join(salted, ["up", "salt"])
    under = under.withColumn("parent_conv_id", F.col("of"))
    return nodes.where("up is null").select(NODES).unionByName(under.select(NODES))
