from coppice.operators.components import component_count, component_sizes, connected_components


def comps(spark, edges, vertices=None):
    table = spark.createDataFrame(edges, "u long, v long")
    ids = None if vertices is None else spark.createDataFrame([(i,) for i in vertices], "id long")
    return connected_components(table, ids)


def test_unions_of_five(spark):
    """The same unions, one after the other, as a union-find would take them."""
    edges = [(0, 1), (2, 3), (1, 2), (0, 3), (4, 0)]
    counts = []
    for k in (0, 1, 2, 3, 5):
        found = comps(spark, edges[:k], range(5))
        counts.append(component_count(found).first()[0])
    assert counts == [5, 4, 3, 2, 1]
    assert [tuple(r) for r in component_sizes(found).collect()] == [(0, 5)]
    parted = dict(comps(spark, edges[:2], range(5)).collect())
    assert parted == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_long_chain_hub_and_loop(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(999, k) for k in range(300, 340)]
    found = dict(comps(spark, chain + hub + [(7, 7)]).collect())
    assert {found[k] for k in range(100, 161)} == {100}
    assert {found[k] for k in [999, *range(300, 340)]} == {300}
    assert found[7] == 7


def test_chain_takes_logarithmic_steps(spark):
    """Four thousand vertices in the order of their ids: one round, about log n hops."""
    from coppice.store import Store

    store = Store(spark, "chain")
    edges = spark.range(4000).selectExpr("id as u", "id + 1 as v")
    found = connected_components(edges, store=store)
    assert component_sizes(found).collect()[0].asDict() == {"comp": 0, "size": 4001}
    # The edges, links, hops of one round, the relabelled edges and the result.
    assert store._made <= 4 + 14
    store.drop()


def test_dropped_store_leaves_nothing(spark):
    from pathlib import Path

    from coppice.store import Store

    store = Store(spark, "dropped")
    kept = store.keep(spark.range(3), "rows")
    assert kept.count() == 3 and Path(store.root.removeprefix("file:")).exists()
    store.drop()
    assert not Path(store.root.removeprefix("file:")).exists()


def test_many_pointers_stay_out_of_the_driver(spark, monkeypatch):
    """Pointer tables of many rows are not collected for a broadcast, however small their files are."""
    from coppice.operators import components

    monkeypatch.setattr(components, "SPREAD_ROWS", 10)
    links = spark.range(1, 200).selectExpr("id", "id - 1 AS up")
    plan = components.hop(links, 199)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    edges = spark.range(1, 200).selectExpr("id AS u", "id - 1 AS v")
    assert {r.comp for r in components.connected_components(edges).collect()} == {0}
