"""Exact Euclidean minimum spanning tree.

1. Equal points collapse to the smallest id; each copy is one edge of weight 0.
2. Points are placed in spatial blocks; every block builds its own tree.
3. Pairs of blocks whose boxes are near enough add the edges between them that
   are in the tree of their union. The tree of the whole lies in the union of the
   trees of parts that cover all pairs, so no true edge is lost.
4. Rounds over the remaining edge table pick the lightest edge of every
   component, contract, and keep one edge per pair of components.

Steps 3 and 4 repeat for growing distances. After a stage with distance r all
tree edges up to r are known, and block pairs that have become one component are
never compared.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.functions.tiles import (
    block_tree,
    bottlenecks,
    bridges,
    columns,
    coordinates,
    distances,
    edge_table,
    lightest_forest,
)
from coppice.functions.vectors import edge_key
from coppice.operators.blocks import (
    BLOCK_ROWS,
    Blocks,
    Layout,
    Wanted,
    block_pairs,
    check_points,
    distinct_points,
    over_tiles,
    place,
    tiles,
)
from coppice.operators.components import follow_to_end
from coppice.store import Store, empty

EDGES = "u long, v long, w double"
ONE_STAGE_BLOCKS = 24  # with fewer blocks all pairs are compared at once
GROWTH = 4.0
MAX_STAGES = 60
TAIL_EDGES = 50_000  # contracted edges that one task may finish
HELD_EDGES = 1_000_000  # found edges that a task holds before it thins them out


def euclidean_mst(
    points: DataFrame,
    block_rows: int = BLOCK_ROWS,
    one_stage_blocks: int = ONE_STAGE_BLOCKS,
    tail_edges: int = TAIL_EDGES,
    store: Store | None = None,
) -> DataFrame:
    """``points(id, features)`` -> the n-1 tree edges ``(u, v, w)`` with u < v.

    Ties of equal weight go to the smaller (u, v), so the tree is unique and does
    not depend on the layout.
    """
    spark = points.sparkSession
    store = store or Store(spark, "mst")
    checked = check_points(points)
    if checked.rows <= 1:
        return empty(spark, EDGES)
    reps, copies, count = distinct_points(checked, store)
    parts = []
    if copies is not None:
        parts.append(copies.select("u", "v", F.lit(0.0).alias("w")))
    if count > 1:
        layout = place(reps.drop("copies"), count, checked.dim, store, block_rows)
        parts.append(_tree_of_distinct(layout, store, one_stage_blocks, tail_edges))
    edges = parts[0]
    for more in parts[1:]:
        edges = edges.unionByName(more)
    return store.keep(edges.select("u", "v", "w"), "tree")


def _tree_of_distinct(
    layout: Layout, store: Store, one_stage_blocks: int, tail_edges: int
) -> DataFrame:
    block = ["node", "chunk"]
    parallel = layout.placed.sparkSession.sparkContext.defaultParallelism
    spread = layout.placed.repartition(max(parallel, math.ceil(layout.blocks / 4)), *block)
    schema = "id long, features array<double>, node long, chunk long, up long, up_w double"
    treed = store.keep(spread.groupBy(*block).applyInArrow(_grow_block, schema), "blocks")
    inner = treed.where("up >= 0").select(
        F.least("id", "up").alias("u"), F.greatest("id", "up").alias("v"), F.col("up_w").alias("w")
    )
    forest = _Forest(store, tail_edges)
    forest.add(inner)
    whole = layout.blocks <= one_stage_blocks
    reach = math.inf if whole else _typical_edge(treed)
    above = None
    labels = None
    for stage in range(MAX_STAGES):
        pairs = block_pairs(layout, _nodes(layout, treed, labels, reach), above)
        work = store.keep(tiles(pairs), "tiles")
        count = work.count()
        if count:
            found = over_tiles(treed, work, count, layout.block_cells, _join_blocks, EDGES)
            forest.add(store.keep(found, "bridges"))
        forest.contract(reach)
        if math.isinf(reach):
            break
        labels = forest.labels(treed.select("id"))
        if labels.agg(F.count_distinct("comp")).first()[0] <= 1:
            break
        above, reach = reach, (reach * GROWTH if stage < MAX_STAGES - 2 else math.inf)
    return forest.tree()


def _typical_edge(treed: DataFrame) -> float:
    """Median over the blocks of the longest edge of a block's tree."""
    longest = treed.groupBy("node", "chunk").agg(F.max("up_w").alias("w")).where("w > 0")
    found = longest.agg(F.percentile_approx("w", 0.5).alias("w")).first()["w"]
    return found if found else math.inf


def _nodes(
    layout: Layout, treed: DataFrame, labels: DataFrame | None, reach: float
) -> DataFrame:
    nodes = layout.summary.withColumn("reach", F.lit(reach))
    if labels is None:
        none = F.lit(None).cast("long")
        return nodes.withColumn("comp_lo", none).withColumn("comp_hi", none)
    comps = treed.select("id", "node").join(labels, "id").groupBy("node")
    return nodes.join(
        comps.agg(F.min("comp").alias("comp_lo"), F.max("comp").alias("comp_hi")), "node"
    )


def _grow_block(table: pa.Table) -> pa.Table:
    table = table.sort_by("id")
    (ids,) = columns(table, "id")
    x = coordinates(table)
    up, up_w = block_tree(distances(x, x), ids)
    return table.select(["id", "features", "node", "chunk"]).append_column(
        "up", pa.array(up)
    ).append_column("up_w", pa.array(up_w))


def _join_blocks(blocks: Blocks, wanted: Wanted) -> pa.Table:
    """Edges between blocks; of those of all pairs at hand only the ones in their common tree.

    Whenever ``HELD_EDGES`` more are found, those outside the tree of what is at hand go.
    """
    sides = {}
    for name in sorted({n for pair in wanted for n in pair}):
        tree = columns(blocks[name], "id", "up", "up_w")
        sides[name] = (coordinates(blocks[name]), *tree, bottlenecks(*tree))
    trees = [(np.minimum(i, up)[up >= 0], np.maximum(i, up)[up >= 0], w[up >= 0]) for _, i, up, w, _ in sides.values()]

    def thinned(found):
        u, v, w = (np.concatenate(c) for c in zip(*found, *trees))
        taken = lightest_forest(u, v, w, np.arange(len(u)) < sum(len(f[0]) for f in found))
        return u[taken], v[taken], w[taken]

    found, held, kept = [], 0, 0
    for a, b in wanted:
        found.append(bridges(sides[a], sides[b]))
        held += len(found[-1][0])
        if held - kept > HELD_EDGES:
            found = [thinned(found)]
            held = kept = len(found[0][0])
    if not found:
        return edge_table([], [], [])
    return edge_table(*(found[0] if len(wanted) == 1 else thinned(found)))


@dataclass
class _Forest:
    """Edge table under contraction: ``a, b`` are the components of ``u, v``."""

    store: Store
    tail_edges: int
    edges: DataFrame | None = None
    chosen: list[DataFrame] = field(default_factory=list)
    roots: DataFrame | None = None  # (id, up): all moves so far, composed

    def add(self, found: DataFrame) -> None:
        """Add edges between points, relabelled by the moves so far."""
        fresh = found.select(F.col("u").alias("a"), F.col("v").alias("b"), "w", "u", "v")
        if self.roots is not None:
            fresh = _renamed(fresh, self.roots)
        self.edges = fresh if self.edges is None else self.edges.unionByName(fresh)

    def contract(self, reach: float) -> None:
        """Add all tree edges of weight up to ``reach`` to the chosen ones."""
        live = self.store.keep(_lightest_per_pair(self.edges), "edges")
        waiting = None
        if not math.isinf(reach):
            waiting = live.where(F.col("w") > reach)
            live = live.where(F.col("w") <= reach)
        left = live.count()
        started = False
        while left:
            if started and left <= self.tail_edges:
                move = self._finish(live)
                live = None
            else:
                move = self._round(live)
                live = self.store.keep(_lightest_per_pair(_renamed(live, move)), "edges")
            started = True
            self._move(move)
            left = live.count() if live is not None else 0
        if waiting is not None and self.roots is not None:
            waiting = _renamed(waiting, self.roots)
        self.edges = None if waiting is None else self.store.keep(waiting, "waiting")

    def _move(self, move: DataFrame) -> None:
        """Compose the moves so far with one more ``(id, up)``; ids without a move stay themselves."""
        if self.roots is None:
            self.roots = self.store.keep(move, "roots")
            return
        step = move.select(F.col("id").alias("up"), F.col("up").alias("next"))
        onward = self.roots.join(step, "up", "left").select("id", F.coalesce("next", "up").alias("up"))
        fresh = move.join(self.roots.select("id"), "id", "left_anti").select("id", "up")
        self.roots = self.store.keep(onward.unionByName(fresh), "roots")

    def _round(self, live: DataFrame) -> DataFrame:
        """Every component takes its lightest edge; returns the moves ``(id, up)``."""
        key = edge_key("w", "u", "v")
        offers = live.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("id"), key.alias("e"), F.col("b").alias("to")),
                    F.struct(F.col("b").alias("id"), key.alias("e"), F.col("a").alias("to")),
                )
            ).alias("o")
        ).select("o.id", "o.e", "o.to")
        best = offers.groupBy("id").agg(F.min(F.struct("e", "to")).alias("m"))
        picks = self.store.keep(best.select("id", "m.to", "m.e.w", "m.e.u", "m.e.v"), "picks")
        self.chosen.append(picks.select("u", "v", "w"))
        # Two components that pick each other share the edge: the smaller stays.
        back = picks.select(F.col("id").alias("to"), F.col("to").alias("back"))
        stays = (F.col("back") == F.col("id")) & (F.col("id") < F.col("to"))
        up = picks.join(back, "to").select(
            "id", F.when(stays, F.col("id")).otherwise(F.col("to")).alias("up")
        )
        return follow_to_end(self.store.keep(up, "up"), self.store)

    def _finish(self, live: DataFrame) -> DataFrame:
        """Settle a contracted remainder of at most ``tail_edges`` edges in one task."""
        schema = "u long, v long, w double, id long, up long"
        out = live.groupBy().applyInArrow(_finish_tail, schema)
        out = self.store.keep(out, "tail")
        self.chosen.append(out.where("u is not null").select("u", "v", "w"))
        return out.where("id is not null").select("id", "up")

    def labels(self, points: DataFrame) -> DataFrame:
        """``(id, comp)``: the component of every point after all moves so far."""
        if self.roots is None:
            return self.store.keep(points.select("id", F.col("id").alias("comp")), "labels")
        found = points.select("id").join(self.roots, "id", "left")
        return self.store.keep(found.select("id", F.coalesce("up", "id").alias("comp")), "labels")

    def tree(self) -> DataFrame:
        """All chosen edges; one can be chosen from both of its ends."""
        out = self.chosen[0]
        for more in self.chosen[1:]:
            out = out.unionByName(more)
        return out.distinct()


def _renamed(edges: DataFrame, move: DataFrame) -> DataFrame:
    a = move.select(F.col("id").alias("a"), F.col("up").alias("ua"))
    b = move.select(F.col("id").alias("b"), F.col("up").alias("ub"))
    return (
        edges.join(a, "a", "left")
        .join(b, "b", "left")
        .select(
            F.coalesce("ua", "a").alias("a"), F.coalesce("ub", "b").alias("b"), "w", "u", "v"
        )
        .where("a <> b")
    )


def _lightest_per_pair(edges: DataFrame) -> DataFrame:
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    best = edges.groupBy(*ends).agg(F.min(F.struct("w", "u", "v")).alias("e"))
    return best.select("a", "b", "e.w", "e.u", "e.v")


def _finish_tail(table: pa.Table) -> pa.Table:
    table = table.sort_by([("w", "ascending"), ("u", "ascending"), ("v", "ascending")])
    a, b, u, v, w = columns(table, "a", "b", "u", "v", "w")
    top: dict[int, int] = {}

    def root(x: int) -> int:
        path = []
        while top.setdefault(x, x) != x:
            path.append(x)
            x = top[x]
        for p in path:
            top[p] = x
        return x

    taken = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            top[max(x, y)] = min(x, y)
            taken.append(k)
    names = np.fromiter(top, dtype=np.int64, count=len(top))
    roots = np.array([root(x) for x in top], dtype=np.int64)
    edges = pa.table({"u": u[taken], "v": v[taken], "w": w[taken]})
    moves = pa.table({"id": names, "up": roots})
    return pa.concat_tables([edges, moves], promote_options="default").select(
        ["u", "v", "w", "id", "up"]
    )
