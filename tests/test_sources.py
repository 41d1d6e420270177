import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import kruskal, rows_of, same_merges
from coppice.functions import (
    command_line,
    dataset_source,
    implementation_type,
    is_mst,
    missing_as_empty,
    parse_runtime,
    ratio,
    short_error,
)
from coppice.operators.rank import global_rank
from coppice.plans import runlog
from coppice.sources import convert, dendrograms, points
from coppice.sources import runlog as files
from coppice.store import Store


def test_read_points(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    (tmp_path / "p.csv").write_text("x,y,label\n1,2,0\n3.5,4,1\n\n5,6,1\n")
    found = points.read_points(spark, path, label_col="label").orderBy("id").collect()
    assert [(r.id, list(r.features), r.label) for r in found] == [
        (0, [1.0, 2.0], 0), (1, [3.5, 4.0], 1), (2, [5.0, 6.0], 1),
    ]
    # Without the role the label is one more coordinate.
    assert points.points_profile(points.read_points(spark, path)).first()[:2] == (3, 3)
    table = spark.read.csv(path, header=True)
    assert tuple(points.dataset_profile(table).first()) == (3, 2, True)
    (tmp_path / "bad.csv").write_text("x,y\n1,two\n")
    with pytest.raises(Exception):
        points.read_points(spark, str(tmp_path / "bad.csv"), id_col="x").collect()


def test_converters(spark, tmp_path):
    raw = spark.createDataFrame(
        [(1.0, 2.0, "b"), (3.0, 4.0, "a"), (5.0, 6.0, None), (7.0, 8.0, "b")],
        "a0 double, a1 double, class string",
    )
    found = convert.convert_labelled(raw).orderBy("x").collect()
    assert [tuple(r) for r in found] == [(1, 2, 1), (3, 4, 0), (5, 6, -1), (7, 8, 1)]
    assert convert.coordinate_names(3) == ["x0", "x1", "x2"]
    for name, text in (("one", "0,1,7\n2,3,8\n"), ("two", "4,5,9\n")):
        (tmp_path / name).write_text(text)
    both = convert.union_headerless(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert both.columns == ["x0", "x1", "label"]
    assert sorted(r.label for r in both.collect()) == [7, 8, 9]


def test_dendrogram_files(spark, tmp_path):
    rows = np.random.default_rng(1).normal(size=(20, 2))
    merges = kruskal(rows, range(20))[1]
    schema = (
        "step long, slot_a long, slot_b long, cluster_a long, cluster_b long, "
        "distance double, new_size long"
    )
    table = spark.createDataFrame(merges, schema)
    dendrograms.write_dendrogram(table, str(tmp_path / "full"))
    assert rows_of(dendrograms.read_dendrogram(spark, str(tmp_path / "full"))) == merges
    dendrograms.write_exchange(table, str(tmp_path / "short"))
    back = rows_of(dendrograms.read_exchange(spark, str(tmp_path / "short")))
    assert [r[0] for r in back] == list(range(19))
    short = [(r[1], r[2], r[4]) for r in back]
    assert short == [(r[3], r[4], r[6]) for r in merges]


def test_exchange_text_is_that_of_c(spark, tmp_path):
    """Line by line what printf("%.15g") writes, also for whole, tiny and huge numbers and for halves of the last digit."""
    heights = [0.0, 1.0, 2.5, 1 / 3, 2**0.5, 1e-7, 123456789012345.6, 1e15, 1.5e300, 0.1 + 0.2, 1.0000000000000005, 100.0]
    rows = [(k, k, k + 1, k, k + 1, h, 2) for k, h in enumerate(heights)]
    schema = "step long, slot_a long, slot_b long, cluster_a long, cluster_b long, distance double, new_size long"
    dendrograms.write_exchange(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "c"))
    lines = [line for part in sorted((tmp_path / "c").glob("part-*")) for line in part.read_text().splitlines()]
    lines = [line for k, line in enumerate(lines) if k == 0 or not line.startswith("cluster_a")]
    assert lines == ["cluster_a,cluster_b,distance,new_size"] + ["%d,%d,%.15g,2" % (k, k + 1, h) for k, h in enumerate(heights)]


LOG = [
    # executable, dataset, n, threads, block size, runtime
    ("mst_cpu", "random_n500", 500, 1, None, 10.0),
    ("mst_cpu", "random_n500", 500, 1, None, 14.0),
    ("mst_cpu", "random_n500", 500, 2, None, 6.0),
    ("mst_cpu", "random_n500", 500, 2, None, None),
    ("mst_cpu", "donut3", 999, 2, None, 9.0),
    ("matrix_cuda", "donut3", 999, None, 64, 3.0),
]


def run_log(spark):
    schema = "executable string, dataset string, n long, threads int, block_size int, runtime_ms double"
    log = spark.createDataFrame(LOG, schema)
    return log.select(
        "*",
        implementation_type("executable").alias("implementation_type"),
        dataset_source("dataset").alias("dataset_source"),
        F.lit(2).alias("d"),
        F.lit("single").alias("linkage"),
    )


def test_summary(spark):
    log = run_log(spark)
    found = {
        (r.executable, r.dataset, r.threads, r.block_size): (
            r.reps, r.median_runtime_ms, r.speedup_vs_1_thread,
        )
        for r in runlog.summarize(log).collect()
    }
    assert found == {
        ("mst_cpu", "random_n500", 1, None): (2, 12.0, 1.0),
        ("mst_cpu", "random_n500", 2, None): (1, 6.0, 2.0),
        ("mst_cpu", "donut3", 2, None): (1, 9.0, None),
        ("matrix_cuda", "donut3", None, 64): (1, 3.0, None),
    }
    grid = runlog.pivot_median(log.where("threads is not null"), order="n").collect()
    assert [tuple(r) for r in grid] == [("random_n500", 12.0, 6.0), ("donut3", None, 9.0)]
    assert runlog.plane_series(runlog.summarize(log)).count() == 2
    assert runlog.runtime_series(log, "mst_cpu").count() == 4


def test_spread_median_is_the_same(spark):
    rng = np.random.default_rng(8)
    rows = [(None if k % 3 else "a", float(v)) for k, v in enumerate(rng.integers(0, 40, 500))]
    log = spark.createDataFrame(rows, "key string, v double").repartition(5)
    plain = sorted(map(str, runlog.median_per_config(log, ["key"], "v").collect()))
    spread = sorted(map(str, runlog.median_per_config(log, ["key"], "v", group_rows=0).collect()))
    assert plain == spread


def test_run_log_files(spark, tmp_path):
    fields = [f.split() for f in files.RUN_LOG.split(", ")]
    at = datetime.datetime(2024, 5, 6, 7, 8, 9)
    row = [{"string": None, "long": 5, "int": None, "double": None, "boolean": True, "timestamp": at}[t] for _, t in fields]
    log = spark.createDataFrame([tuple(row)], files.RUN_LOG)
    files.write_log(log, str(tmp_path / "log"))
    assert files.read_run_log(spark, str(tmp_path / "log")).collect() == log.collect()
    summary = runlog.summarize(run_log(spark))
    files.write_log(summary, str(tmp_path / "summary"))
    back = files.read_summary(spark, str(tmp_path / "summary"))
    both = files.union_summaries(back, summary.drop("linkage"))
    assert both.count() == 8
    assert [r[0] for r in files.names(both, "dataset").collect()] == ["donut3", "random_n500"]
    with pytest.raises(ValueError, match="threads"):
        files.union_summaries(back.drop("threads"))


def test_text_functions(spark):
    rows = spark.createDataFrame(
        [("ok\nruntime_ms:  1.5e2\n",), ("runtime_ms: .\nruntime_ms: 3",), ("none " * 90,)], "t string"
    )
    found = rows.select(parse_runtime("t"), F.length(short_error("t"))).collect()
    assert [r[0] for r in found] == [150.0, None, None]
    assert found[2][1] == 300
    one = spark.range(1).select(
        command_line(F.lit("run"), F.lit("--threads"), F.lit(4)),
        missing_as_empty(F.lit(None).cast("int")),
        ratio(F.lit(0.0), F.lit(2.0)),
        ratio(F.lit(6.0), F.lit(2.0)),
        is_mst(F.lit("MST_CPU")),
        *[dataset_source(F.lit(n)) for n in ("complex9", "optdigits", "random_n7", "other")],
    )
    assert tuple(one.first()) == (
        "run --threads 4", "", None, 3.0, True, "milaan9 structured dataset",
        "UCI Optical Recognition of Handwritten Digits", "synthetic random 2D dataset", "unknown",
    )


def test_global_rank(spark):
    table = spark.range(1000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(50))).repartition(7)
    ranked = global_rank(table, ["k", "id"], Store(spark, "rank")).collect()
    in_order = sorted(ranked, key=lambda r: (r.k, r.id))
    assert [r["rank"] for r in in_order] == list(range(1000))
