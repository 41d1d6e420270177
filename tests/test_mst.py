import math

import numpy as np
import pyarrow as pa
import pytest

from conftest import HAND_TRACE, kruskal, pair_list, rows_of, same_merges
from coppice.operators.dendrogram import (
    mst_to_dendrogram,
    single_linkage,
    slots_to_tree_ids,
    tree_ids_to_slots,
)
from coppice.operators.mst import euclidean_mst
from coppice.operators.nearest import closest_pair, nearest_neighbors, pairwise_distances

STAGED = {"block_rows": 16, "one_stage_blocks": 1, "tail_edges": 0}


def edges_of(df):
    return sorted((r.u, r.v, r.w) for r in df.collect())


def tied_grid(n=90, seed=1):
    """Integer grid, a third of the points equal, scattered ids."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 7, (n, 2)).astype(float)
    rows[: n // 3] = rows[0]
    return rows, rng.permutation(5 * n)[:n]


def two_regions(n=90, seed=2):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, 3))
    rows[n // 2 :] += 500
    return rows, np.arange(n)


def test_hand_trace(make_points):
    edges = edges_of(euclidean_mst(make_points(HAND_TRACE)))
    assert [(u, v) for u, v, _ in edges] == [
        (0, 1), (0, 2), (1, 3), (3, 4), (4, 5), (4, 9), (5, 7), (5, 8), (6, 7),
    ]
    merges = rows_of(single_linkage(make_points(HAND_TRACE)))
    assert [(r[3], r[4], round(r[5], 6), r[6]) for r in merges] == [
        (0, 1, 1.0, 2), (10, 2, 1.0, 3), (6, 7, 1.0, 2), (3, 4, 1.414214, 2), (13, 9, 1.414214, 3),
        (11, 14, 2.0, 6), (15, 5, 2.236068, 7), (16, 12, 2.236068, 9), (17, 8, 2.236068, 10),
    ]
    assert [(r[1], r[2]) for r in merges] == [
        (0, 1), (0, 2), (6, 7), (3, 4), (3, 9), (0, 3), (0, 5), (0, 6), (0, 8),
    ]


@pytest.mark.parametrize("data", [tied_grid, two_regions])
@pytest.mark.parametrize("layout", [{}, STAGED], ids=["one-stage", "staged"])
def test_tree_does_not_depend_on_the_layout(make_points, data, layout):
    rows, ids = data()
    assert edges_of(euclidean_mst(make_points(rows, ids), **layout)) == kruskal(rows, ids)[0]


def test_replay_in_parts(make_points, spark):
    rows, ids = tied_grid(60)
    edges, merges = kruskal(rows, ids)
    table = spark.createDataFrame(edges, "u long, v long, w double")
    found = mst_to_dendrogram(table, leaf_edges=20)
    same_merges(rows_of(found), merges)


def test_both_cluster_names(spark):
    rows, _ = tied_grid(40)
    merges = kruskal(rows, range(40))[1]
    schema = (
        "step long, slot_a long, slot_b long, cluster_a long, cluster_b long, "
        "distance double, new_size long"
    )
    table = spark.createDataFrame(merges, schema)
    same_merges(rows_of(tree_ids_to_slots(table.drop("slot_a", "slot_b"))), merges)
    named = rows_of(slots_to_tree_ids(table.drop("cluster_a", "cluster_b")))
    # From slots alone the first name belongs to the smaller slot.
    assert [{r[3], r[4]} for r in named] == [{r[3], r[4]} for r in merges]


def test_small_and_bad_inputs(make_points, spark):
    none = spark.createDataFrame([], "id long, features array<double>")
    for points in (none, make_points([(1, 2)])):
        assert single_linkage(points).isEmpty()
        assert pairwise_distances(points).isEmpty()
        assert nearest_neighbors(points).isEmpty()
        assert closest_pair(points).isEmpty()
    assert edges_of(euclidean_mst(make_points([(0, 0), (3, 4)], [9, 4]))) == [(4, 9, 5.0)]
    assert edges_of(euclidean_mst(make_points([(1, 1)] * 4))) == [(0, k, 0.0) for k in (1, 2, 3)]
    for bad in ([(0, 0), (1,)], [(0, float("nan"))] * 2, [(float("inf"), 0)] * 2):
        with pytest.raises(ValueError):
            euclidean_mst(make_points(bad))
    with pytest.raises(ValueError):
        euclidean_mst(make_points([(0, 0), (1, 1)], [3, 3]))


def test_pairs_and_neighbours(make_points):
    rows, ids = tied_grid()
    pairs = pair_list(rows, ids)
    points = make_points(rows, ids)
    found = sorted((r.w, r.u, r.v) for r in pairwise_distances(points, block_rows=16).collect())
    assert found == pairs
    nearest = {}
    for w, u, v in pairs:
        nearest.setdefault(u, (v, w))
        nearest.setdefault(v, (u, w))
    near = nearest_neighbors(points, block_rows=16)
    assert {r.id: (r.other, r.w) for r in near.collect()} == nearest
    assert [tuple(r) for r in closest_pair(points).collect()] == [(*pairs[0][1:], pairs[0][0])]


def test_growing_gaps_take_one_chain(spark, make_points):
    """x = k^2: every point picks the one before it."""
    rows = [(k * k,) for k in range(60)]
    found = euclidean_mst(make_points(rows), block_rows=8, tail_edges=0)
    assert sorted((r["u"], r["v"]) for r in found.collect()) == [(k, k + 1) for k in range(59)]


def test_squares_of_tiles_send_a_block_once(make_points, monkeypatch):
    """Many dimensions and many tiles: the same rows, with fewer copies of the points than tiles ask for."""
    from coppice.operators import blocks, mst, nearest

    rng = np.random.default_rng(5)
    rows = rng.normal(size=(160, 12))
    rows[40:60] = rows[:20] + 1e-9  # nearly equal: far below the rounding of a matrix product
    sent = []
    whole = blocks.over_tiles

    def watched(placed, work, count, *rest):
        monkeypatch.setattr(blocks, "SQUARES_PER_CORE", 0.25)
        found = whole(placed, work, count, *rest)
        sent.append((count, found.count()))
        return found

    monkeypatch.setattr(blocks.math, "isqrt", lambda k: int(k**0.5))
    for module in (mst, nearest):
        monkeypatch.setattr(module, "over_tiles", watched)
    points = make_points(rows)
    assert edges_of(euclidean_mst(points, 8)) == kruskal(rows, range(160))[0]
    count, found = sent[0]
    assert count > 100 and found < 10 * count  # a square gives the edges of one tree, not those of every tile
    best = {}
    for w, u, v in pair_list(rows, range(160)):
        for p, q in ((u, v), (v, u)):
            best[p] = min(best.get(p, (np.inf, -1)), (w, q))
    assert {r.id: (r.w, r.other) for r in nearest_neighbors(points, 8).collect()} == best


def test_nearest_rows_of_a_block():
    from coppice.functions.tiles import distances, nearest_rows

    rng = np.random.default_rng(6)
    for x, y in [
        (rng.integers(0, 3, (60, 10)).astype(float), rng.integers(0, 3, (50, 10)).astype(float)),
        (1e6 + rng.normal(size=(40, 9)) * 1e-4, 1e6 + rng.normal(size=(45, 9)) * 1e-4),
        (rng.normal(size=(1, 9)) * 1e200, rng.normal(size=(3, 9)) * 1e200),
    ]:
        with np.errstate(over="ignore"):
            dist = distances(x, y)
            for (at, w), table in zip(nearest_rows(x, y), (dist, dist.T)):
                assert (at == table.argmin(axis=1)).all() and (w == table.min(axis=1)).all()
    x = rng.integers(0, 2, (30, 9)).astype(float)
    dist = distances(x, x)
    np.fill_diagonal(dist, np.inf)
    ((at, w),) = nearest_rows(x, x, same=True)
    assert (at == dist.argmin(axis=1)).all() and (w == dist.min(axis=1)).all()


def test_copies_are_merged_without_a_replay(make_points, monkeypatch):
    """Only the edges between different points are left to the parts, and all rows stay right."""
    from coppice.operators import dendrogram

    rng = np.random.default_rng(8)
    rows = rng.integers(0, 4, (120, 2)).astype(float)
    rows[:50] = rows[0]
    ids = rng.permutation(600)[:120]
    replayed = []
    halve = dendrogram._halve
    monkeypatch.setattr(dendrogram, "_halve", lambda work, *rest: (replayed.append(work.count()), halve(work, *rest))[1])
    for leaf_edges in (4, 100):
        found = rows_of(single_linkage(make_points(rows, ids), leaf_edges=leaf_edges))
        same_merges(found, kruskal(rows, ids)[1])
    assert replayed and max(replayed) == len(np.unique(rows, axis=0)) - 1
    same_merges(rows_of(single_linkage(make_points(rows[:50]), leaf_edges=4)), kruskal(rows[:50], range(50))[1])


def test_a_tree_whose_copies_have_other_edges(spark):
    """Points 1 and 2 equal 0, but the longer edges hang on them and not on 0."""
    edges = [(0, 1, 0.0), (0, 2, 0.0), (1, 3, 1.0), (2, 4, 2.0), (4, 5, 3.0)]
    tree = spark.createDataFrame(edges, "u long, v long, w double")
    assert rows_of(mst_to_dendrogram(tree, 2)) == [
        (0, 0, 1, 0, 1, 0.0, 2), (1, 0, 2, 6, 2, 0.0, 3), (2, 0, 3, 7, 3, 1.0, 4),
        (3, 0, 4, 8, 4, 2.0, 5), (4, 0, 5, 9, 5, 3.0, 6),
    ]


def watched_repartition(monkeypatch):
    """Rows and partitions of every table that is dealt by key from here on."""
    from pyspark.sql.classic.dataframe import DataFrame

    dealt, deal = [], DataFrame.repartition

    def watched(self, parts, *cols):
        dealt.append((self.count(), parts))
        return deal(self, parts, *cols)

    monkeypatch.setattr(DataFrame, "repartition", watched)
    return dealt


def test_pairs_send_a_point_as_often_as_the_cores_ask(make_points, spark, monkeypatch):
    """However many blocks there are; and all pairs come once where groups are small or empty."""
    from coppice.operators import blocks, nearest

    rng = np.random.default_rng(9)
    rows, ids = rng.integers(0, 9, (150, 3)).astype(float), rng.permutation(600)[:150]
    wanted = [(u, v, w) for w, u, v in pair_list(rows, ids)]
    points = make_points(rows, ids)
    dealt = watched_repartition(monkeypatch)
    copies = math.isqrt(2 * blocks.SQUARES_PER_CORE * spark.sparkContext.defaultParallelism)
    assert edges_of(pairwise_distances(points, block_rows=2)) == sorted(wanted)
    assert max(sent for sent, _ in dealt) <= 150 * copies
    monkeypatch.setattr(nearest, "GROUP_CELLS", 30)
    assert edges_of(pairwise_distances(points, block_rows=4)) == sorted(wanted)


def test_a_side_of_few_values_does_not_leave_large_nodes(make_points, spark):
    """Four values against many: the wide side is cut, and blocks of one node need no cut by hash."""
    from coppice.operators.blocks import place
    from coppice.store import Store

    rng = np.random.default_rng(10)
    rows = np.c_[rng.integers(0, 4, 1500), rng.uniform(0, 1e4, 1500)].astype(float)
    layout = place(make_points(rows), 1500, 2, Store(spark, "test"), 8)
    assert max(r.chunks for r in layout.summary.collect()) <= 2


def test_tasks_follow_the_blocks_that_are_sent(make_points, monkeypatch):
    """A task gets about one full square of rows, and not more as tiles grow."""
    from coppice.operators import blocks

    rng = np.random.default_rng(11)
    rows = rng.normal(size=(200, 12))
    monkeypatch.setattr(blocks, "GROUP_CELLS", 16 * 42)  # two blocks of eight rows to a side
    dealt = watched_repartition(monkeypatch)
    points = make_points(rows)
    assert edges_of(euclidean_mst(points, 8, one_stage_blocks=1000)) == kruskal(rows, range(200))[0]
    assert max(sent / parts for sent, parts in dealt) <= 40


def test_found_edges_are_thinned_out_on_the_way(monkeypatch):
    """A task holds few more edges than its points, and gives the same ones."""
    from coppice.operators import mst

    rng = np.random.default_rng(12)
    grown = {}
    for k in range(6):
        x = rng.integers(0, 30, (20, 2)).astype(float)
        table = pa.table({
            "id": np.arange(20) * 6 + k, "features": x.tolist(), "node": np.full(20, k), "chunk": np.zeros(20, dtype=int)
        })
        grown[k, 0] = mst._grow_block(table)
    wanted = [((a, 0), (b, 0)) for a in range(6) for b in range(a + 1, 6)]
    whole = mst._join_blocks(grown, wanted).to_pylist()
    sizes, forest = [], mst.lightest_forest
    monkeypatch.setattr(mst, "HELD_EDGES", 10)
    monkeypatch.setattr(mst, "lightest_forest", lambda u, *rest: (sizes.append(len(u)), forest(u, *rest))[1])
    thinned = mst._join_blocks(grown, wanted).to_pylist()
    assert sorted(map(str, thinned)) == sorted(map(str, whole))
    assert len(sizes) > 1 and max(sizes) < 120 + 120 + 40 + 10
