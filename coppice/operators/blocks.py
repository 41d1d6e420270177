"""Spatial blocks of bounded size, and the pairs of blocks that can matter.

Points are split level by level at approximate quantiles of the widest side of
their node, so every node of the split tree has a box. A lower bound on the distance between two boxes then rules
out whole pairs of blocks. The layout never changes a result, only the work.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.operators.components import spread
from coppice.store import Store

BLOCK_ROWS = 2048  # points in one block: a task holds a few BLOCK_ROWS^2 doubles
FAN_OUT = 8  # children of one node of the split tree
BOX_DIMS = 8  # dimensions kept in a box: any subset gives a valid lower bound
SAMPLE_ROWS = 20_000  # rows looked at to choose those dimensions
BROADCAST_NODES = 65_536  # largest node table that is broadcast
HOT_SHARE = 1000  # a key with more than 1/1000 of the rows is hot: at most 999 keys
TILES_PER_TASK = 16
SLACK = 1e-9  # relative room for rounding in a lower bound
SQUARES_PER_CORE = 8  # squares of blocks that a core gets where there are many tiles
GROUP_CELLS = 4_000_000  # numbers in the rows of one side of a square: 32 MB
ROW_CELLS = 30  # what a row takes besides its features: ids, keys, tree edge, found edges


@dataclass
class Checked:
    """Facts of a points table that passed validation."""

    points: DataFrame
    rows: int
    dim: int


def check_points(points: DataFrame) -> Checked:
    """Reject null, ragged, empty or non-finite features and repeated ids."""
    bad = F.exists(
        "features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    facts = points.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("id").alias("ids"),
        F.count("features").alias("vectors"),
        F.count_distinct("id").alias("distinct_ids"),
        F.min(F.size("features")).alias("lo"),
        F.max(F.size("features")).alias("hi"),
        F.count_if(bad).alias("bad"),
    ).first()
    if facts["rows"] == 0:
        return Checked(points, 0, 0)
    if facts["ids"] < facts["rows"] or facts["distinct_ids"] < facts["rows"]:
        raise ValueError("point ids must be present and distinct")
    if facts["vectors"] < facts["rows"] or facts["bad"]:
        raise ValueError("features must be present and finite")
    if facts["lo"] != facts["hi"] or facts["lo"] < 1:
        raise ValueError("features must all have the same positive length")
    return Checked(points, facts["rows"], facts["hi"])


def distinct_points(checked: Checked, store: Store) -> tuple[DataFrame, DataFrame | None, int]:
    """Collapse equal points to the smallest id.

    Returns ``(id, features, copies)``, the links ``(u, v)`` from that id to each
    other copy (None when all points differ), and the number of distinct points.
    A group of copies may hold most rows: the count is pre-aggregated, and groups
    above a fixed share of the rows, of which there are few, join by broadcast.
    """
    points = checked.points.select("id", F.col("features").cast("array<double>"))
    grouped = points.groupBy("features").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")
    )
    reps = store.keep(grouped.select("id", "features", "copies"), "distinct")
    count = reps.count()
    if count == checked.rows:
        return reps, None, count
    many = reps.where("copies > 1").select(F.col("id").alias("u"), "features", "copies")
    hot = many.where(F.col("copies") * HOT_SHARE > checked.rows)
    if hot.isEmpty():
        links = points.join(spread(many, count), "features")
    else:
        cold = many.where(F.col("copies") * HOT_SHARE <= checked.rows)
        hot = F.broadcast(hot)
        links = points.join(hot, "features").unionByName(
            points.join(hot, "features", "left_anti").join(spread(cold, count), "features")
        )
    links = links.where("id <> u").select("u", F.col("id").alias("v"))
    return reps, store.keep(links, "copies"), count


@dataclass
class Layout:
    """Points placed in the nodes of a split tree."""

    placed: DataFrame  # id, features, ..., node, chunk
    summary: DataFrame  # node, chunks, lo_i, hi_i
    levels: int
    fan_out: int
    boxes: int  # dimensions in a box
    blocks: int  # upper estimate of the number of blocks
    dims: list[int]  # the dimensions in a box
    block_cells: int  # numbers in the rows of one block


def place(points: DataFrame, rows: int, dim: int, store: Store, block_rows: int) -> Layout:
    """Split ``points`` into about ``rows / block_rows`` blocks.

    A node that stays above ``block_rows`` (many equal coordinates) is cut into
    chunks by a hash of the id; chunks share the node's box.
    """
    wanted = max(math.ceil(rows / block_rows), min(4, math.ceil(rows / 64)))
    levels = max(1, math.ceil(math.log(wanted, FAN_OUT) - 1e-9))
    fan_out = max(2, math.ceil(wanted ** (1 / levels) - 1e-9)) if wanted > 1 else 1
    dims = _widest_dims(points, rows, dim)
    placed = points.withColumn("node", F.lit(0).cast("long"))
    for level in range(levels if fan_out > 1 else 0):
        shares = [i / fan_out for i in range(1, fan_out)]
        sides = []
        for d in dims:
            x = F.col("features")[d]
            cuts = F.percentile_approx(x, shares, 1000).alias("cuts")
            sides.append(F.struct((F.max(x) - F.min(x)).alias("width"), F.lit(-d).alias("at"), cuts))
        # Equal slices of the widest side: a side of few values would leave nodes that no cut divides.
        widest = placed.groupBy("node").agg(F.array_max(F.array(*sides)).alias("m"))
        cuts = store.keep(widest.select("node", (-F.col("m.at")).alias("dim"), "m.cuts"), "cuts")
        if fan_out**level <= BROADCAST_NODES:
            cuts = F.broadcast(cuts)
        x = F.get("features", F.col("dim"))
        child = sum(((x > F.col("cuts")[i]).cast("long") for i in range(fan_out - 1)), F.lit(0))
        placed = placed.join(cuts, "node").withColumn("node", F.col("node") * fan_out + child)
        placed = placed.drop("cuts", "dim")
    summary = placed.groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.min(F.col("features")[d]).alias(f"lo_{i}") for i, d in enumerate(dims)],
        *[F.max(F.col("features")[d]).alias(f"hi_{i}") for i, d in enumerate(dims)],
    )
    chunks = F.ceil(F.col("rows") / block_rows).cast("long")
    summary = store.keep(summary.withColumn("chunks", chunks), "nodes")
    sizes = summary.select("node", "chunks")
    if fan_out**levels <= BROADCAST_NODES:
        sizes = F.broadcast(sizes)
    placed = placed.join(sizes, "node")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).drop("chunks")
    blocks = fan_out**levels + math.ceil(rows / block_rows)
    return Layout(placed, summary, levels, fan_out, len(dims), blocks, dims, block_rows * (dim + ROW_CELLS))


def _widest_dims(points: DataFrame, rows: int, dim: int) -> list[int]:
    """Dimensions with the largest spread; a sample only steers the layout."""
    if dim <= BOX_DIMS:
        return list(range(dim))
    share = min(1.0, SAMPLE_ROWS / rows)
    seen = points.sample(share, seed=1).select(F.posexplode("features"))
    spread = seen.groupBy("pos").agg(F.var_pop("col").alias("s"))
    top = spread.orderBy(F.desc("s"), "pos").limit(BOX_DIMS).collect()
    return [r["pos"] for r in top] or list(range(BOX_DIMS))


def box_gap(p: str, q: str, boxes: int) -> Column:
    """Lower bound on the distance between points of boxes ``p`` and ``q``."""
    total = F.lit(0.0)
    for i in range(boxes):
        gap = F.greatest(
            F.lit(0.0),
            F.col(f"{p}.lo_{i}") - F.col(f"{q}.hi_{i}"),
            F.col(f"{q}.lo_{i}") - F.col(f"{p}.hi_{i}"),
        )
        total = total + gap * gap
    return F.sqrt(total) * (1 - SLACK)


def block_pairs(layout: Layout, nodes: DataFrame, above: float | None = None) -> DataFrame:
    """Pairs of nodes ``(p, q, p_chunks, q_chunks)``, p <= q, worth comparing.

    ``nodes`` is the summary plus ``reach``, the largest distance that still
    matters to a node, and ``comp_lo, comp_hi``, the range of component labels in
    it. A pair is kept when the gap of its boxes is at most the larger reach
    (and greater than ``above``, if given) and it is not all one component. The
    split tree is walked from the root with joins on the parent node, so a pair
    of distant regions is dropped before its blocks are ever paired.
    """
    facts = ["reach", "comp_lo", "comp_hi", "chunks"]
    boxes = [f"{side}_{i}" for i in range(layout.boxes) for side in ("lo", "hi")]
    merge = {"reach": F.max, "comp_lo": F.min, "comp_hi": F.max, "chunks": F.max}
    merge |= {b: (F.min if b.startswith("lo") else F.max) for b in boxes}
    pairs = None
    for level in range(1, layout.levels + 1):
        height = layout.fan_out ** (layout.levels - level)
        kids = nodes.withColumn("node", F.floor(F.col("node") / height))
        if height > 1:
            kids = kids.groupBy("node").agg(*[merge[c](c).alias(c) for c in facts + boxes])
        kids = kids.withColumn("parent", F.floor(F.col("node") / layout.fan_out))
        a, b = kids.alias("a"), kids.alias("b")
        if pairs is None:
            grown = a.join(b, F.col("a.parent") == F.col("b.parent"))
        else:
            grown = pairs.join(a, F.col("p") == F.col("a.parent"))
            grown = grown.join(b, F.col("q") == F.col("b.parent"))
        gap = box_gap("a", "b", layout.boxes)
        whole = (F.least("a.comp_lo", "b.comp_lo")) == (F.greatest("a.comp_hi", "b.comp_hi"))
        keep = (F.col("a.node") <= F.col("b.node")) & ~F.coalesce(whole, F.lit(False))
        keep &= gap <= F.greatest("a.reach", "b.reach")
        if above is not None and level == layout.levels:
            keep &= gap > above
        pairs = grown.where(keep).select(
            F.col("a.node").alias("p"),
            F.col("b.node").alias("q"),
            F.col("a.chunks").alias("p_chunks"),
            F.col("b.chunks").alias("q_chunks"),
        )
    return pairs


def tiles(pairs: DataFrame, same_block: bool = False) -> DataFrame:
    """Chunk pairs ``(p, i, q, j)`` of the node pairs; a block with itself on request."""
    ij = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("p_chunks") - 1)))
    ij = ij.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("q_chunks") - 1)))
    order = F.col("i") <= F.col("j") if same_block else F.col("i") < F.col("j")
    return ij.where((F.col("p") < F.col("q")) | order).select(
        "p", F.col("i").cast("long").alias("i"), "q", F.col("j").cast("long").alias("j"), "p_chunks", "q_chunks"
    )


TILE = ["p", "i", "q", "j"]


SQUARE = ["pg", "ig", "qg", "jg"]
Blocks = dict[tuple[int, int], pa.Table]
Wanted = list[tuple[tuple[int, int], tuple[int, int]]]


def _group(node: str, chunk: str, chunks: str, size: int) -> tuple[Column, Column]:
    """Neighbouring nodes of one chunk, or neighbouring chunks of one node."""
    many = F.col(chunks) > 1
    by_node = F.when(many, -1 - F.col(node)).otherwise(F.floor(F.col(node) / size)).cast("long")
    return by_node, F.when(many, F.floor(F.col(chunk) / size)).otherwise(0).cast("long")


def over_tiles(
    placed: DataFrame,
    tile_list: DataFrame,
    count: int,
    block_cells: int,
    compare: Callable[[Blocks, Wanted], pa.Table],
    schema: str,
) -> DataFrame:
    """The rows that ``compare`` returns for squares of tiles: blocks by name, pairs of names.

    Tiles of neighbouring blocks go together, so a block is sent once to a square and not
    once to each of its tiles. The side of a square is bounded by its points and by the
    number of squares, which grows with the cores: a block is copied about as often as the
    square root of that number tells, however many blocks there are. The number of tasks
    follows the blocks that are sent, so a task holds about one full square.
    """
    parallel = placed.sparkSession.sparkContext.defaultParallelism
    size = math.isqrt(count // (SQUARES_PER_CORE * parallel))
    size = max(1, min(size, GROUP_CELLS // max(1, block_cells)))
    pg, ig = _group("p", "i", "p_chunks", size)
    qg, jg = _group("q", "j", "q_chunks", size)
    work = tile_list.select(*TILE, pg.alias("pg"), ig.alias("ig"), qg.alias("qg"), jg.alias("jg"))
    ends = [work.select(*SQUARE, F.col(n).alias("node"), F.col(c).alias("chunk")) for n, c in ("pi", "qj")]
    ends = ends[0].union(ends[1]).distinct()
    squares = math.ceil(count / size**2)
    tasks = max(1, min(squares, 3 * parallel), math.ceil(squares / TILES_PER_TASK))
    if count * block_cells > tasks * GROUP_CELLS:  # two blocks a tile at most: only then a task could get too many
        tasks = max(tasks, math.ceil(ends.count() * block_cells / (2 * GROUP_CELLS)))
    sent = placed.join(ends, ["node", "chunk"]).repartition(tasks, *SQUARE)
    names = [f"w_{c}" for c in SQUARE]  # other names: both sides come of one table
    work = work.withColumnsRenamed(dict(zip(SQUARE, names))).repartition(tasks, *names)

    def square(rows: pa.Table, tiles_: pa.Table) -> pa.Table:
        blocks = _named_blocks(rows.drop_columns(SQUARE))
        wanted = [((t["p"], t["i"]), (t["q"], t["j"])) for t in tiles_.select(TILE).to_pylist()]
        return compare(blocks, sorted((a, b) for a, b in wanted if a in blocks and b in blocks))

    return sent.groupBy(*SQUARE).cogroup(work.groupBy(*names)).applyInArrow(square, schema)


def _named_blocks(rows: pa.Table) -> Blocks:
    """The rows of every block, by node and chunk."""
    if not len(rows):
        return {}
    rows = rows.sort_by([("node", "ascending"), ("chunk", "ascending")])
    node, chunk = rows.column("node").to_numpy(), rows.column("chunk").to_numpy()
    starts = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (chunk[1:] != chunk[:-1])])
    ends = np.r_[starts[1:], len(rows)]
    return {(int(node[a]), int(chunk[a])): rows.slice(a, b - a) for a, b in zip(starts, ends)}
