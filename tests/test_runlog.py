"""Speedups when one dataset name stands for several sizes."""

from coppice.plans import runlog


def test_summary_has_one_row_per_configuration(spark):
    rows = [
        ("x", "cpu", "set", n, 2, "unknown", "single", threads, None, 100.0 * n / threads)
        for n in (100, 200)
        for threads in (1, 2)
    ]
    schema = (
        "executable string, implementation_type string, dataset string, n long, d int, dataset_source string,"
        " linkage string, threads int, block_size int, runtime_ms double"
    )
    log = spark.createDataFrame(rows, schema)
    found = runlog.summarize(log).collect()
    # The last baseline in key order is that of n = 200.
    assert [(r["n"], r["threads"], r["speedup_vs_1_thread"]) for r in found] == [
        (100, 1, 2.0),
        (100, 2, 4.0),
        (200, 1, 1.0),
        (200, 2, 2.0),
    ]
    # Without an order of baselines the join is a merge: a row for each baseline.
    medians = runlog.median_per_config(log)
    assert runlog.with_speedup(medians).count() == 8


def test_part_numbers_beyond_five_digits(spark, tmp_path):
    from coppice.sources.dendrograms import read_exchange

    for number in (99_999, 100_000, 7):
        (tmp_path / f"part-{number:05d}-x.csv").write_text(
            f"cluster_a,cluster_b,distance,new_size\n{number},1,1.0,2\n"
        )
    found = read_exchange(spark, str(tmp_path)).orderBy("step").collect()
    assert [r["cluster_a"] for r in found] == [7, 99_999, 100_000]


def test_pivot_of_too_many_values(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(runlog, "PIVOT_COLUMNS", 2)
    rows = spark.createDataFrame([("a", k, float(k)) for k in (1, 2, 3)], "dataset string, threads int, runtime_ms double")
    with pytest.raises(ValueError):
        runlog.pivot_median(rows)
    found = runlog.pivot_median(rows, columns=[1, 3]).first()
    assert (found["1"], found["3"]) == (1.0, 3.0)
