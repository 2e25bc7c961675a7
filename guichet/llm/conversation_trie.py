"""Prefix trie of conversations by union-find over neighbours in sorted order.

Conversations are sequences of turn digests of fixed width, so that byte order is a trie's
order. Equal sequences are one. Sorted sequences that are next to each other share a number
of turns; going through these edges from the deepest to the shallowest and joining what they
connect, every joint is a branching node, and the turns between two joints are nodes with
one child each.

Sequences are sorted into parts of bounded size. A part builds its forest alone: what no
neighbouring part shares is final, what one may share (prefixes of its first and last
sequence) is contracted to one row of sums per node, and these rows are added up across
parts. A node counts as new only where its first sequence is, so that sums come out exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guichet.llm.runs import by_run
from guichet.llm.store import written

_WIDTH = 16  # bytes of a turn's digest
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: each conversation's turns in order, a null turn first, as digests of role and text and code points of the text.

    Null role and text are empty. Turns with the same number are in the order of their
    digests. Rows without a conv_id take no part.
    """
    role_, text_ = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_))
    narrow = rows.select(F.col(f"`{conv}`").alias("conv_id"), F.struct(F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.length(text_).alias("points")).alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.digest.alias("digest"), t.points.alias("points")))
    return narrow.filter("conv_id is not null").groupBy("conv_id").agg(turns.alias("turns"))


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two sequences share."""
    n = min(len(a), len(b)) // _WIDTH
    if a[: n * _WIDTH] == b[: n * _WIDTH]:
        return n
    x, y = (np.frombuffer(s, np.uint64, 2 * n) for s in (a, b))
    return int(np.flatnonzero(x != y)[0]) // 2


def _prefix_keys(seq: bytes, most: int) -> list[bytes]:
    """A key for each prefix of up to ``most`` turns."""
    state, out = hashlib.blake2b(digest_size=16), []
    for k in range(most + 1):
        if k:
            state.update(seq[(k - 1) * _WIDTH : k * _WIDTH])
        out.append(state.digest())
    return out


class _Forest:
    """The nodes of one part. Columns of ``out``: see _NODES; a shared node has a key, a node below one its parent's key."""

    def __init__(self, seqs: list[bytes], points: list[list[int]], convs: list[int], n: list[int], ends: list[str], before: bytes | None, after: bytes | None) -> None:
        self.seqs, self.points, self.n, self.ends = seqs, points, n, ends
        m = len(seqs)
        inner = [_shared(a, b) for a, b in zip(seqs, seqs[1:], strict=False)]
        self.left = -1 if before is None else _shared(before, seqs[0])
        self.right = -1 if after is None else _shared(seqs[-1], after)
        self.left_keys, self.right_keys = _prefix_keys(seqs[0], self.left), _prefix_keys(seqs[-1], self.right)
        length = [len(s) // _WIDTH for s in seqs]
        edges = [*inner, self.right]
        # Of each component, at its first sequence: where it ends, its topmost node's depth and sums, and the nodes that wait for that one to be final.
        self.parent, self.last, self.depth, self.conv = list(range(m)), list(range(m)), length, list(convs)
        self.members, self.leaves = list(n), [int(length[i] > edges[i]) for i in range(m)]
        self.children, self.saved, self.end = [0] * m, [0] * m, list(ends)
        self.waiting: list[list[int]] = [[] for _ in range(m)]
        self.out: tuple[list, ...] = tuple([] for _ in range(10))
        for i in sorted(range(m - 1), key=lambda i: -inner[i]):
            self._join(self._find(i), self._find(i + 1), inner[i])
        self._rise(0, -1)

    def _find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _key(self, c: int, depth: int) -> bytes | None:
        """Key of a component's node, if neighbouring parts have it too."""
        if c == 0 and depth <= self.left:
            return self.left_keys[depth]
        if self.last[c] == len(self.seqs) - 1 and depth <= self.right:
            return self.right_keys[depth]
        return None

    def _join(self, a: int, b: int, depth: int) -> None:
        for c in (a, b):
            if self.depth[c] > depth:
                self._rise(c, depth)
        self.parent[b], self.last[a] = a, self.last[b]
        self.conv[a] = min(self.conv[a], self.conv[b])
        for sums in (self.members, self.leaves, self.children, self.saved):
            sums[a] += sums[b]
        self.end[a] = self.end[a] or self.end[b]
        few, many = sorted((self.waiting[a], self.waiting[b]), key=len)
        many += few
        self.waiting[a], self.waiting[b] = many, []

    def _rise(self, c: int, to: int) -> None:
        """The component's node is final, and so is the chain above it down from ``to``; its next node is at that depth."""
        n, conv, points = self.members[c], self.conv[c], self.points[c]
        seen = self.left if c == 0 else -1  # nodes up to this depth are new in an earlier part
        for depth in range(self.depth[c], to, -1):
            self.saved[c] += (n - (depth > seen)) * points[depth - 1] if depth else 0
            key = self._key(c, depth)
            above = self._key(c, depth - 1) if depth else None
            row, at = (key, above, conv, depth, None, n, self.children[c], self.leaves[c], self.saved[c], self.end[c]), len(self.out[0])
            for column, value in zip(self.out, row, strict=True):
                column.append(value)
            for child in self.waiting[c]:
                if key is None:
                    self.out[4][child] = conv
                else:
                    self.out[1][child] = key
            self.waiting[c], self.children[c], self.end[c] = [at], int(depth > seen), None
        self.depth[c] = to


_NODES = "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


def _forests(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    names = [c.split()[0] for c in _NODES.split(", ")]
    for first, last in zip(begins.tolist(), begins[1:].tolist(), strict=False):
        part = table.slice(first, last - first).sort_by("seq")
        columns = [part[c].to_pylist() for c in ("seq", "points", "conv_id", "n", "ends")]
        before, after = (next((x for x in part[c].drop_null().to_pylist()), None) for c in ("before", "after"))
        forest = _Forest(*columns, before, after)
        rows = len(forest.out[0])
        for at in range(0, rows, 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000], k) for c, k in zip(forest.out, kinds, strict=True)], names)


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the joined strings of each key, which come in order."""
    key, state, keys, ends = None, None, [], []
    for batch in batches:
        for name, part in zip(batch["key"], batch["part"], strict=True):
            if name.as_py() != key:
                if state is not None:
                    keys.append(key)
                    ends.append(state.hexdigest())
                key, state = name.as_py(), hashlib.sha256(part.as_py().encode())
            else:
                state.update(("," + part.as_py()).encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["key", "ends"])
        keys, ends = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends"])


def _ends(sequences: DataFrame, block: int) -> DataFrame:
    """key, ends: the digest of the conv_ids of each sequence in ascending order.

    Ids are joined in blocks of at most ``block`` neighbouring numbers, and the blocks of a
    sequence are streamed, so that a sequence that a third of all conversations have is no group in memory.
    """
    number = F.floor(F.col("conv_id") / F.lit(block)).cast("long")
    parts = sequences.groupBy("key", number.alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("part"))
    return parts.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_streamed_digests, "key binary, ends string")


def _parted(distinct: DataFrame, part_bytes: int, parts: int | None) -> DataFrame:
    """The sequences sorted into parts; a part's first row has the last sequence before it and the first one after it."""
    size = distinct.agg(F.sum(F.octet_length("seq") + F.lit(128)).alias("n")).first()["n"] or 0
    parts = parts or max(distinct.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes))
    ranged = written(distinct.repartitionByRange(parts, "seq").withColumn("part", F.spark_partition_id().cast("long")))
    # One row per part: a bounded window.
    order = Window.orderBy("part")
    bounds = ranged.groupBy("part").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    bounds = bounds.select("part", F.col("first").alias("seq"), F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    return ranged.join(written(bounds), ["part", "seq"], "left")


def prefix_trie(conversations: DataFrame, *, part_bytes: int = 8 << 20, parts: int | None = None, block: int = 4096) -> DataFrame:
    """The nodes of the trie over ``conversations`` (conv_id, unique; turns with digest and points).

    One row per distinct sequence of first turns, the empty one included: conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves (childless
    nodes in the subtree, itself included), saved_tokens (over the subtree, code points of a
    node's last turn for each member but one), ends_sha256 (of the sorted conv_ids that end here).
    A conversation without turns ends at the root; a table without conversations has no nodes. A
    conversation's own turns are one row, 36 bytes a turn; no other group is held whole.
    """
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t.digest), ""))
    sequences = conversations.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t.points.cast("int")).alias("points"))
    sequences = written(sequences.withColumn("key", F.unhex(F.md5("seq"))))
    counts = sequences.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    counts = counts.join(_ends(sequences, block), "key")
    distinct = written(sequences.select("key", "conv_id", "seq", "points").join(counts, ["key", "conv_id"]).select("seq", "points", "conv_id", "n", "ends"))
    nodes = written(by_run(_parted(distinct, part_bytes, parts), ["part"], _forests, _NODES))

    def total(c: str) -> Column:
        return F.sum(c).alias(c)

    shared = nodes.filter("key is not null").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *(total(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends").alias("ends")
    )
    shared = written(shared)
    above = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    columns = ["parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    final = nodes.filter("key is null").select(*columns).unionByName(shared.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    final = final.join(above, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return final.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))
