"""Connected components by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.store import Store

SPREAD_ROWS = 100_000  # tables of more rows are joined by a shuffle, and never sent whole through the driver


def spread(table: DataFrame, rows: int) -> DataFrame:
    """A side of a join that stays distributed if it has many rows, however small its files are."""
    return table.hint("merge") if rows > SPREAD_ROWS else table


def hop(links: DataFrame, rows: int = 0) -> DataFrame:
    """Follow ``(id, up)`` pointers one step, which doubles the distance they cover; ``moved`` tells which did."""
    ahead = links.select(F.col("id").alias("up"), F.col("up").alias("next"))
    onward = F.coalesce("next", "up")
    return links.join(spread(ahead, rows), "up", "left").select(
        "id", onward.alias("up"), (onward != F.col("up")).alias("moved")
    )


def follow_to_end(links: DataFrame, store: Store) -> DataFrame:
    """Pointers of a forest, each to its root, after a logarithmic number of written steps."""
    rows = links.count()
    links = store.keep(hop(links.select("id", "up"), rows), "hops")
    while not links.where("moved").isEmpty():
        links = store.keep(hop(links.select("id", "up"), rows), "hops")
    return links.select("id", "up")


def connected_components(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    u: str = "u",
    v: str = "v",
    store: Store | None = None,
) -> DataFrame:
    """``(id, comp)`` where ``comp`` is the smallest id of the component.

    ``vertices(id)`` adds vertices without an edge. A round lets every vertex hook
    to its smallest neighbour, follows the hooks to their roots by doubling, relabels
    the edges, and drops loops and repeats. Hooks only ever go to a smaller id, so the
    smallest one stays, and the larger end of every edge hooks, so each round shrinks
    the graph: a chain in the order of its ids takes one round of a logarithmic number
    of doublings. A hub costs one row per task before the shuffle (``min`` is
    pre-aggregated); its relabel join is one that adaptive skew handling splits,
    because the other side holds one row per vertex.
    """
    spark = edges.sparkSession
    store = store or Store(spark, "components")
    pairs = edges.select(F.col(u).alias("a"), F.col(v).alias("b"))
    every = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    if vertices is not None:
        every = every.union(vertices.select("id"))
    live = store.keep(pairs.where("a <> b").distinct(), "edges")
    roots = None
    known = 0
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        up = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        links = store.keep(up.select("id", F.least("id", "m").alias("up")), "links")
        links = follow_to_end(links, store)
        rows = links.count()
        live = store.keep(_relabel(live, spread(links, rows)), "edges")
        roots = links if roots is None else store.keep(_compose(roots, spread(links, rows)), "roots")
        known = known or rows  # the first round has every vertex with an edge
    comp = every.distinct()
    if roots is None:
        return comp.withColumn("comp", F.col("id"))
    return store.keep(comp.join(spread(roots, known), "id", "left").select("id", F.coalesce("up", "id").alias("comp")), "components")


def _relabel(edges: DataFrame, links: DataFrame) -> DataFrame:
    a = links.select(F.col("id").alias("a"), F.col("up").alias("ua"))
    b = links.select(F.col("id").alias("b"), F.col("up").alias("ub"))
    return (
        edges.join(a, "a")
        .join(b, "b")
        .where("ua <> ub")
        .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
        .distinct()
    )


def _compose(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Every vertex of the first round with its root after one more round."""
    step = links.select(F.col("id").alias("up"), F.col("up").alias("next"))
    return roots.join(step, "up", "left").select("id", F.coalesce("next", "up").alias("up"))


def component_sizes(components: DataFrame) -> DataFrame:
    """``(comp, size)``."""
    return components.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))


def component_count(components: DataFrame) -> DataFrame:
    """One row, ``components``."""
    return components.agg(F.count_distinct("comp").alias("components"))
