"""Dendrograms: merge rows in order, with both ways of naming clusters.

``slot`` ids name a cluster by its smallest point id. ``cluster`` ids are tree
ids: points are 0..n-1 by id order, and the merge of step s makes n + s.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.tiles import columns
from coppice.operators.blocks import HOT_SHARE
from coppice.operators.components import connected_components, spread
from coppice.operators.mst import BLOCK_ROWS, euclidean_mst
from coppice.operators.rank import global_rank
from coppice.store import Store, empty

DENDROGRAM = (
    "step long, slot_a long, slot_b long, cluster_a long, cluster_b long, "
    "distance double, new_size long"
)
DENDROGRAM_COLUMNS = [
    "step", "slot_a", "slot_b", "cluster_a", "cluster_b", "distance", "new_size",
]
LEAF_EDGES = 200_000  # ranked edges that one task replays

_ENDS = ["slot", "node", "size"]


def single_linkage(
    points: DataFrame, block_rows: int = BLOCK_ROWS, leaf_edges: int = LEAF_EDGES
) -> DataFrame:
    """Single-linkage dendrogram of ``points(id, features)``."""
    store = Store(points.sparkSession, "single")
    edges = euclidean_mst(points, block_rows, store=store)
    return mst_to_dendrogram(edges, leaf_edges, store)


def mst_to_dendrogram(
    edges: DataFrame,
    leaf_edges: int = LEAF_EDGES,
    store: Store | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Merge rows of a spanning tree ``(u, v, w)``, edges taken in order of (w, u, v).

    The ranked edges are halved again and again. The lower half of a part is
    contracted to its components, which become the ends of the upper half, so
    both halves can go on independently. A part of at most ``leaf_edges`` edges
    is replayed by one task.
    """
    spark = edges.sparkSession
    store = store or Store(spark, "dendrogram")
    order = order or ["w", "u", "v"]
    rest = [c for c in edges.columns if c not in ("u", "v")]
    base = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), *rest)
    ranked = global_rank(base, order, store)
    facts = ranked.agg(
        F.count(F.lit(1)).alias("m"), F.min("u").alias("lo"), F.max("v").alias("hi")
    ).first()
    count = facts["m"]
    if count == 0:
        return empty(spark, DENDROGRAM)
    n = count + 1
    work = ranked.select(
        "rank",
        F.col("w").alias("distance"),
        F.lit(0).cast("long").alias("part"),
        *_leaf("u", facts["lo"]),
        *_leaf("v", facts["lo"]),
    )
    if facts["hi"] - facts["lo"] + 1 != n:
        work = _number_leaves(work, n, store)
    first = 0
    done = None
    if count > leaf_edges and order == ["w", "u", "v"]:
        done, work, first = _join_copies(work, n, count, store)
        if first == count:
            return done
    parts = 1
    if count - first > leaf_edges:
        for _ in range(math.ceil(math.log2((count - first) / leaf_edges))):
            parts *= 2
            work = _halve(work, n, first, count, parts, store)
    tasks = max(1, min(parts, 10_000))
    schema = DENDROGRAM
    if parts > 1:
        work = work.repartition(tasks, "part")

    def replay(table: pa.Table) -> pa.Table:
        return _replay(table, n)

    made = store.keep(work.groupBy("part").applyInArrow(replay, schema), "merges")
    return made if done is None else done.unionByName(made)


def _join_copies(work: DataFrame, n: int, count: int, store: Store) -> tuple[DataFrame | None, DataFrame, int]:
    """Merges of equal points without a replay: ``(merges, rest of the edges, number of merges)``.

    Copies hang at height 0 on the smallest of them and have no other edge. They come first
    and in the order of (u, v), so a copy's rank in its group tells size and cluster. The rest of
    the edges begins with the whole groups. Edges of height 0 in any other form stay as they are.
    """
    zero = work.where("distance = 0")
    facts = zero.agg(
        F.count(F.lit(1)).alias("rows"), F.max("rank").alias("end"), F.count_distinct("v_slot").alias("copies")
    ).first()
    first = facts["rows"]
    if not first or facts["end"] != first - 1 or facts["copies"] < first:
        return None, work, 0
    groups = zero.groupBy("u_slot").agg(F.min("rank").alias("begin"), F.max("rank").alias("end"))
    groups = store.keep(groups, "groups")
    many = groups.count()
    rest = work.where("distance > 0")
    taken = groups.select("u_slot").union(rest.select("u_slot")).union(rest.select("v_slot"))
    taken = taken.select(F.col("u_slot").alias("v_slot"))
    if not zero.join(spread(taken, first), "v_slot", "left_semi").isEmpty():
        return None, work, 0
    # Groups above a fixed share of the rows, of which there are few, join by broadcast.
    hot = F.col("end") - F.col("begin") + 1 > count / HOT_SHARE
    frequent = F.broadcast(groups.where(hot))
    others = zero.join(frequent, "u_slot", "left_anti")
    placed = zero.join(frequent, "u_slot").unionByName(others.join(spread(groups.where(~hot), many), "u_slot"))
    behind = F.col("rank") - F.col("begin")
    merges = placed.select(
        F.col("rank").alias("step"),
        F.col("u_slot").alias("slot_a"),
        F.col("v_slot").alias("slot_b"),
        F.when(behind > 0, F.col("rank") - 1 + n).otherwise(F.col("u_node")).alias("cluster_a"),
        F.col("v_node").alias("cluster_b"),
        "distance",
        (behind + 2).alias("new_size"),
    )
    if first == count:
        return store.keep(merges, "copies"), work, first
    for e in ("u", "v"):
        whole = groups.select(
            F.col("u_slot").alias(f"{e}_slot"), (F.col("end") + n).alias("node"),
            (F.col("end") - F.col("begin") + 2).alias("size"),
        )
        rest = rest.join(spread(whole, many), f"{e}_slot", "left")
        rest = rest.withColumns({f"{e}_{c}": F.coalesce(c, f"{e}_{c}") for c in ("node", "size")}).drop("node", "size")
    return store.keep(merges, "copies"), store.keep(rest, "distinct"), first


def _leaf(end: str, lowest: int) -> list[Column]:
    return [
        F.col(end).alias(f"{end}_slot"),
        (F.col(end) - lowest).alias(f"{end}_node"),
        F.lit(1).cast("long").alias(f"{end}_size"),
    ]


def _number_leaves(work: DataFrame, points: int, store: Store) -> DataFrame:
    """Node numbers of points whose ids are not a run of integers."""
    ids = work.select(F.explode(F.array("u_slot", "v_slot")).alias("id")).distinct()
    numbers = store.keep(global_rank(ids, ["id"], store), "numbers")
    for end in ("u", "v"):
        names = numbers.select(
            F.col("id").alias(f"{end}_slot"), F.col("rank").alias(f"{end}_node")
        )
        work = work.drop(f"{end}_node").join(spread(names, points), f"{end}_slot")
    return store.keep(work, "numbered")


def _halve(work: DataFrame, n: int, first: int, count: int, parts: int, store: Store) -> DataFrame:
    """Split every part of the ranks from ``first`` on at its middle and contract the lower half."""
    span = 2 * n  # node ids are below this, so part * span + node is a key
    child = F.floor((F.col("rank") - first) * parts / F.lit(count - first)).cast("long")
    split = work.withColumn("child", child)
    low = split.where(F.col("child") % 2 == 0)
    ends = [
        low.select(
            (F.col("child") * span + F.col(f"{e}_node")).alias("id"),
            F.col(f"{e}_slot").alias("slot"),
            F.col(f"{e}_size").alias("size"),
            F.col("rank"),
        )
        for e in ("u", "v")
    ]
    links = low.select(
        (F.col("child") * span + F.col("u_node")).alias("u"),
        (F.col("child") * span + F.col("v_node")).alias("v"),
    )
    comps = connected_components(links, store=store)
    many = comps.count()
    seen = ends[0].union(ends[1]).groupBy("id").agg(
        F.first("slot").alias("slot"), F.first("size").alias("size"), F.max("rank").alias("rank")
    )
    member = comps.join(spread(seen, many), "id")
    merged = member.groupBy("comp").agg(
        F.min("slot").alias("slot"),
        F.sum("size").alias("size"),
        (F.max("rank") + n).alias("node"),
    )
    table = store.keep(
        comps.join(spread(merged, many), "comp").select("id", *[F.col(c).alias(f"new_{c}") for c in _ENDS]),
        "contracted",
    )
    high = split.where(F.col("child") % 2 == 1)
    for e in ("u", "v"):
        high = high.withColumn("id", (F.col("child") - 1) * span + F.col(f"{e}_node"))
        high = high.join(spread(table, many), "id", "left")
        for c in _ENDS:
            high = high.withColumn(f"{e}_{c}", F.coalesce(f"new_{c}", f"{e}_{c}"))
        high = high.drop("id", *[f"new_{c}" for c in _ENDS])
    return store.keep(low.unionByName(high).drop("part").withColumnRenamed("child", "part"), "half")


def _replay(table: pa.Table, n: int) -> pa.Table:
    """Merge rows of one part; ends are named by the clusters they start in."""
    table = table.sort_by("rank")
    rank, distance = columns(table, "rank", "distance")
    ends = {e: [c.tolist() for c in columns(table, *[f"{e}_{c}" for c in _ENDS])] for e in "uv"}
    top: dict[int, int] = {}
    state: dict[int, tuple[int, int, int]] = {}

    def root(x: int) -> int:
        path = []
        while top[x] != x:
            path.append(x)
            x = top[x]
        for p in path:
            top[p] = x
        return x

    for slot, node, size in (t for e in "uv" for t in zip(*ends[e])):
        top[node] = node
        state[node] = (slot, node, size)
    rows = []
    for k, x, y in zip(rank.tolist(), ends["u"][1], ends["v"][1]):
        x, y = root(x), root(y)
        (sx, cx, nx), (sy, cy, ny) = state[x], state[y]
        rows.append((min(sx, sy), max(sx, sy), cx, cy, nx + ny))
        if nx < ny:
            x, y = y, x
        top[y] = x
        state[x] = (min(sx, sy), n + k, nx + ny)
    slot_a, slot_b, a, b, size = np.array(rows, dtype=np.int64).T
    return pa.table(
        {
            "step": rank,
            "slot_a": slot_a,
            "slot_b": slot_b,
            "cluster_a": a,
            "cluster_b": b,
            "distance": distance,
            "new_size": size,
        }
    )


def number_merges(merges: DataFrame, points: DataFrame, store: Store) -> DataFrame:
    """Order unnumbered merges and name their clusters.

    ``merges``: slot_a, slot_b, distance, new_size, the sort key ``key_w, key_a,
    key_b``, and ``last_a, last_b``, the slot absorbed by the latest earlier
    merge of either cluster (null for a point). Each slot is absorbed once, so
    that slot names the merge.
    """
    ranked = global_rank(merges, ["key_w", "key_a", "key_b", "new_size"], store, "step")
    ranked = store.keep(ranked, "steps")
    facts = points.agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")
    ).first()
    n = facts["n"]
    steps = ranked.select(
        F.col("slot_b").alias("absorbed"), F.lit(True).alias("made"), F.col("step").alias("at")
    )
    numbers = None
    if n and facts["hi"] - facts["lo"] + 1 != n:
        numbers = store.keep(global_rank(points.select("id"), ["id"], store), "numbers")
    for side in ("a", "b"):
        # Points have no earlier merge: their own slot spreads them over the join.
        ranked = ranked.withColumn("made", F.col(f"last_{side}").isNotNull())
        ranked = ranked.withColumn("absorbed", F.coalesce(f"last_{side}", "slot_b"))
        ranked = ranked.join(steps, ["made", "absorbed"], "left").drop("made", "absorbed")
        if numbers is None:
            leaf = F.col(f"slot_{side}") - F.lit(facts["lo"])
        else:
            ranked = ranked.join(
                numbers.select(F.col("id").alias(f"slot_{side}"), "rank"), f"slot_{side}"
            )
            leaf = F.col("rank")
        ranked = ranked.withColumn(f"cluster_{side}", F.coalesce(F.col("at") + n, leaf))
        ranked = ranked.drop("at", "rank")
    return store.keep(ranked.select(*DENDROGRAM_COLUMNS), "merges")


def slots_to_tree_ids(merges: DataFrame, store: Store | None = None) -> DataFrame:
    """Add ``cluster_a, cluster_b`` to ``(step, slot_a, slot_b, distance, new_size)``.

    The merge before this one in the same slot is found on the next rank of
    (slot, step), not in a window over the slot, since one slot can hold most rows.
    """
    store = store or Store(merges.sparkSession, "tree-ids")
    rows = merges.select("step", "slot_a", "slot_b", "distance", "new_size")
    by_slot = store.keep(global_rank(rows, ["slot_a", "step"], store), "by-slot")
    before = by_slot.select(
        (F.col("rank") + 1).alias("rank"),
        F.col("slot_a").alias("before"),
        F.col("slot_b").alias("absorbed"),
    )
    same = F.col("before") == F.col("slot_a")
    rows = by_slot.join(before, "rank", "left").withColumn("last_a", F.when(same, F.col("absorbed")))
    last = by_slot.groupBy("slot_a").agg(F.max(F.struct("step", "slot_b")).alias("m"))
    last = last.select(F.col("slot_a").alias("slot_b"), F.col("m.slot_b").alias("last_b"))
    rows = rows.join(last, "slot_b", "left").withColumn("key_w", F.col("step").cast("double"))
    rows = rows.withColumn("key_a", F.col("slot_a")).withColumn("key_b", F.col("slot_b"))
    return number_merges(rows, point_ids(merges), store)


def tree_ids_to_slots(
    merges: DataFrame, leaf_edges: int = LEAF_EDGES, store: Store | None = None
) -> DataFrame:
    """Slots of a dendrogram given as ``(step, cluster_a, cluster_b, distance, new_size)``.

    Following the first child down from any cluster ends at one of its points;
    linking those points of both children gives a spanning tree to replay.
    """
    store = store or Store(merges.sparkSession, "slots")
    n = merges.count() + 1
    down = merges.select(
        (F.col("step") + n).alias("id"), F.col("cluster_a").alias("up")
    )
    down = store.keep(down, "first-child")
    while not down.where(F.col("up") >= n).isEmpty():
        ahead = down.select(F.col("id").alias("up"), F.col("up").alias("next"))
        down = down.join(ahead, "up", "left").select("id", F.coalesce("next", "up").alias("up"))
        down = store.keep(down, "first-child")
    edges = merges.select("step", "distance", "cluster_a", "cluster_b")
    for side in ("a", "b"):
        leaf = down.select(F.col("id").alias(f"cluster_{side}"), F.col("up").alias(f"leaf_{side}"))
        edges = edges.join(leaf, f"cluster_{side}", "left").withColumn(
            f"leaf_{side}", F.coalesce(f"leaf_{side}", f"cluster_{side}")
        )
    tree = edges.select(
        F.col("leaf_a").alias("u"), F.col("leaf_b").alias("v"), F.col("distance").alias("w"), "step"
    )
    made = mst_to_dendrogram(tree, leaf_edges, store, order=["step"])
    given = merges.select("step", "cluster_a", "cluster_b")
    return made.drop("cluster_a", "cluster_b").join(given, "step").select(*DENDROGRAM_COLUMNS)


def point_ids(merges: DataFrame) -> DataFrame:
    """All point ids of a dendrogram: each is absorbed once, but for the smallest."""
    first = merges.agg(F.min("slot_a").alias("id")).where("id is not null")
    return merges.select(F.col("slot_b").alias("id")).union(first)


def top_merges(merges: DataFrame, count: int = 10) -> DataFrame:
    """The first ``count`` merges, in order."""
    return merges.orderBy("step").limit(count)
