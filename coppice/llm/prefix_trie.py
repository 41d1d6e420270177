"""The trie of conversation prefixes, from a sorted list of conversations.

A conversation is the sequence of its turns' digests (128 bits of SHA-256 of role and
text), one string of bytes with 16 bytes a turn. Sorted, the conversations below a node
stand together, and the depth of the deepest common node of two neighbours is their
common prefix (LCP) in turns. The trie is then the merge tree of the neighbours: taken
in descending depth, each LCP edge joins two components by union-find, and the joined
component is the branching node at that depth; the turns between its depth and that of
the component around it are nodes with one child and the same members.

The sorted list is cut into range partitions, each with the last conversation before it
and the first one behind it. A node whose LCP at both cuts is smaller lies in one
partition and is finished there. What is left of a partition is contracted to its open
nodes, those on the path of the conversations at its cuts: one row for each depth.
All that a node counts is a sum over its conversations, if what two of them share is
counted for the first in order, so equal open nodes of different partitions are merged
by adding. A second walk takes the merged nodes along and gives out everything else.

The members that end at a node are neighbours with equal bytes, ordered by id; those of
an open node are written as pieces of the joined text and digested one piece after the
other.

Rows to a task: conversations are spread by (bytes, id), so copies of one conversation
fill as many partitions as they need. Between partitions pass at most the open nodes, a
row a depth and cut. A conversation's digests (16 bytes a turn, and 8 for the length of
its text) are one row, which bounds a conversation to some million turns.

Edge cases: a null role or text is an empty one, equal turn numbers are ordered by digest,
rows without a conversation id belong to no conversation, repeated rows are turns of their
own, columns of other names are not read, and a table without conversations gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import text_or_empty
from coppice.store import Store

BASE_EVERY = 5
#: Turns taken over from the base conversation: fewer than this many.
HEAD_TURNS = 9
TURN_BYTES = 16
#: Ids of a piece of the list of members that end at an open node.
PIECE_IDS = 100_000

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
OPEN = "key binary, parent_key binary, depth long, part int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, piece long, ends string"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order as (digest in hex, bytes of the text)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.sha2(named.cast("binary"), 256).substr(1, 2 * TURN_BYTES)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    known = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    listed = known.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD_TURNS).cast("int")


def rebuilt(listed: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of the one at the multiple of five below.

    A row per conversation on both sides, at most five of them for one base.
    """
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(BASE_EVERY))
    is_base = F.pmod(F.col("conv_id"), F.lit(BASE_EVERY)) == 0
    heads = listed.where(is_base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    joined = listed.withColumns({"base": base, "h": head_length(F.col("conv_id"))}).join(heads, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    return joined.select("conv_id", F.when(head.isNotNull(), F.concat(head, own)).otherwise(own).alias("turns"))


def paths(listed: DataFrame) -> DataFrame:
    """``(conv_id, path, sizes)``: the turns' digests as one string of bytes, and the bytes of their texts."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return listed.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))


def prefix_trie(conversations: DataFrame, store: Store) -> DataFrame:
    """All nodes of the trie of ``rebuilt`` conversations."""
    return trie(paths(rebuilt(sequences(conversations))), store)


def trie(listed: DataFrame, store: Store) -> DataFrame:
    """All nodes of the trie of ``(conv_id, path, sizes)``; ids are distinct."""
    order = ["path", "conv_id"]
    ordered = listed.repartitionByRange(*order).sortWithinPartitions(*order)
    written = store.keep(ordered.withColumn("part", F.spark_partition_id()), "sorted")
    shared = _with_neighbours(written)

    opened = store.keep(_walk(shared, None), "open")
    sums = opened.groupBy("key", "depth").agg(
        F.first("parent_key", ignorenulls=True).alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    merged = store.keep(sums, "merged")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    ends = _digests(opened.where("ends IS NOT NULL").select("key", "part", "piece", "ends"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    top = merged.join(parents, "parent_key", "left").join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )

    # The merged nodes go back to the partitions that hold a part of them.
    held = opened.where("piece = 0").select("key", "part").join(merged.select("key", "depth", "conv_id"), "key")
    known = held.select("part", F.lit(-2).alias("kind"), F.col("key").alias("path"), "conv_id", F.array("depth").alias("sizes"))
    return _walk(shared.unionByName(known), True).unionByName(top)


def _with_neighbours(written: DataFrame) -> DataFrame:
    """The rows of each partition with the last row before it (kind -1) and the first one behind it (1).

    The numbers of the partitions that hold rows go to the driver, the rows do not.
    """
    row = F.struct("path", "conv_id", "sizes")
    cuts = written.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    parts = sorted(r["part"] for r in written.select("part").distinct().collect())
    for kind, end, beside in ((-1, "last", zip(parts[1:], parts)), (1, "first", zip(parts, parts[1:]))):
        to = written.sparkSession.createDataFrame([*beside], "to int, part int")
        ends = to.join(cuts, "part").select(F.col("to").alias("part"), F.lit(kind).alias("kind"), f"{end}.*")
        written = (written if "kind" in written.columns else written.withColumn("kind", F.lit(0))).unionByName(ends)
    return written


def _walk(rows: DataFrame, give_out: bool | None) -> DataFrame:
    """Builds each partition's forest; gives out its open nodes, or with ``give_out`` all other nodes."""
    schema = pa.schema([(n, _KINDS[t]) for n, t in (f.split() for f in (NODES if give_out else OPEN).split(", "))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns), schema.types)], schema=schema)

        forest = None
        for batch in batches:
            fields = (batch.column(c).to_pylist() for c in ("part", "kind", "path", "conv_id", "sizes"))
            for part, kind, path, conv, sizes in zip(*fields):
                if forest is None or forest.part != part:
                    if forest:
                        yield from map(made, filter(None, forest.finish()))
                    forest = _Forest(part, bool(give_out))
                forest.add(kind, path, conv, sizes)
        if forest:
            yield from map(made, filter(None, forest.finish()))

    order = ["part", "kind", "path", "conv_id"]
    dealt = rows.select("part", "kind", "path", "conv_id", "sizes").repartition("part").sortWithinPartitions(*order)
    return dealt.mapInArrow(walk, NODES if give_out else OPEN)


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    most = min(len(a), len(b)) // TURN_BYTES
    for k in range(min(most, 8)):
        if a[k * TURN_BYTES : (k + 1) * TURN_BYTES] != b[k * TURN_BYTES : (k + 1) * TURN_BYTES]:
            return k
    if most <= 8:
        return most
    x, y = (np.frombuffer(p, np.uint64, 2 * most).reshape(-1, 2) for p in (a, b))
    differ = (x != y).any(axis=1)
    return int(differ.argmax()) if differ.any() else most


def path_key(path: bytes, depth: int) -> bytes:
    """Names the node at ``depth`` on ``path``."""
    return hashlib.sha256(path[: depth * TURN_BYTES]).digest()


class _Forest:
    """The conversations of one partition, and the nodes made of them.

    ``lcp[i]`` is the common prefix of rows i-1 and i; the first and the last entry are
    those across the cuts, -1 at the ends of the list. A component is named by a row of
    it through ``up`` and holds rows ``low`` to ``high`` - 1, which share ``top`` turns.
    """

    def __init__(self, part: int, give_out: bool):
        self.part, self.give_out = part, give_out
        self.ids: list[int] = []
        self.sizes: list[np.ndarray] = []
        self.lcp: list[int] = []
        self.known: dict[bytes, int] = {}
        self.last = self.first_path = None
        self.cut = -1

    def add(self, kind: int, path: bytes, conv: int, sizes: list[int]) -> None:
        if kind == -2:  # a merged node: its key and its smallest member
            self.known[path] = conv
            return
        shared = -1 if self.last is None else common_turns(self.last, path)
        if kind == 1:
            self.cut = shared
        elif kind == 0:
            self.lcp.append(shared)
            self.ids.append(conv)
            self.sizes.append(np.array(sizes, np.int64))
            if self.first_path is None:
                self.first_path = path
        if kind != 1:
            self.last = path

    def finish(self) -> Iterator[list[tuple]]:
        """Lists of rows, in bounded portions."""
        if not self.ids:
            return
        n = len(self.ids)
        self.lcp.append(self.cut)
        self.left, self.right = self.lcp[0], self.lcp[n]
        self.rows: list[tuple] = []
        self.up = list(range(n))
        self.low, self.high = list(range(n)), list(range(1, n + 1))
        self.top = [len(s) for s in self.sizes]
        self.ended = [1] * n  # members that end at the top; they are the first in order
        self.least = list(self.ids)
        self.kids = [0] * n
        self.leaves = [int(self.top[i] > self.lcp[i + 1]) for i in range(n)]
        self.saved = [0] * n  # below the top
        self.waiting: list[list[tuple]] = [[] for _ in range(n)]  # nodes whose parent is the top

        lcp = np.array(self.lcp[1:n], np.int64)
        for i in (np.argsort(-lcp, kind="stable") + 1).tolist():
            self._merge(self._find(i - 1), self._find(i), self.lcp[i])
            if len(self.rows) > 10_000:
                yield self._taken()
        whole = self._find(0)
        self._close(whole, 0)
        self._node(whole, 0)
        yield self._taken()

    def _taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def _find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Joins two neighbouring components to the node at ``depth``, which is the lesser of their tops at most."""
        for c in (a, b):
            self._close(c, depth)
        if self.high[a] - self.low[a] < self.high[b] - self.low[b]:
            a, b = b, a
        self.up[b] = a
        # Rows that end here come first in order, and all rows of the earlier component if that is not one child.
        self.ended[a] += self.ended[b]
        self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        self.least[a] = min(self.least[a], self.least[b])
        for values in (self.kids, self.leaves, self.saved):
            values[a] += values[b]
        self.waiting[a] += self.waiting[b]
        self.waiting[b] = []

    def _close(self, c: int, depth: int) -> None:
        """Gives out the nodes of a component above ``depth``; it is then one child of the node there."""
        if self.top[c] == depth:
            return
        low, count = self.low[c], self.high[c] - self.low[c]
        for t in range(self.top[c], depth, -1):
            self._node(c, t)
            self.ended[c] = 0
            new = int(self.lcp[low] < t)  # else an earlier partition counts this node
            self.saved[c] += (count - new) * int(self.sizes[low][t - 1])
            self.kids[c] = new
        self.top[c] = depth

    def _node(self, c: int, depth: int) -> None:
        """The node at ``depth`` that holds all of component ``c``."""
        low, high = self.low[c], self.high[c]
        count = high - low
        is_open = (low == 0 and self.left >= depth) or (high == len(self.ids) and self.right >= depth)
        own = (count - int(self.lcp[low] < depth)) * int(self.sizes[low][depth - 1]) if depth else 0
        ends = self.ids[low : low + self.ended[c]]
        if not is_open:
            least = self.least[c]
        elif self.give_out:
            least = self.known[self._key(c, depth)]
        else:
            least = None
        if self.give_out:
            self.rows += [(*row[:2], least, *row[3:]) for row in self.waiting[c]]
            row = (least, depth, None, count, self.kids[c], self.leaves[c], self.saved[c] + own, _joined_digest(ends))
            if is_open:
                self.waiting[c] = []
            elif depth:
                self.waiting[c] = [row]
            else:
                self.waiting[c] = []
                self.rows.append(row)
        elif is_open:
            key = self._key(c, depth)
            parent = self._key(c, depth - 1) if depth else None
            head = (key, parent, depth, self.part, self.least[c], count, self.kids[c], self.leaves[c], self.saved[c] + own)
            pieces = [",".join(map(str, ends[k : k + PIECE_IDS])) for k in range(0, len(ends), PIECE_IDS)] or [None]
            self.rows += [(*(head if k == 0 else (*head[:4], None, None, None, None, None)), k, piece) for k, piece in enumerate(pieces)]

    def _key(self, c: int, depth: int) -> bytes:
        """Open nodes lie on the path of the first or of the last row."""
        path = self.first_path if self.low[c] == 0 else self.last
        return path_key(path, depth)


def _joined_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _digests(pieces: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: digest of a node's pieces joined by commas, one after the other."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = running = None
        rows = []
        for batch in batches:
            for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if now != key:
                    if running:
                        rows.append((now, running.hexdigest()))
                    now, running = key, hashlib.sha256(ends.encode())
                else:
                    running.update(b"," + ends.encode())
        if running:
            rows.append((now, running.hexdigest()))
        if rows:
            keys, found = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])

    dealt = pieces.repartition("key").sortWithinPartitions("key", "part", "piece")
    return dealt.mapInArrow(digest, "key binary, ends_sha256 string")
