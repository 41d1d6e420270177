"""Medians, speedups, pivots and series over benchmark run logs.

The log columns can be named freely, so the same plans serve any table with
keys, a degree of parallelism and a measured value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.classify import RANDOM_PREFIX, ratio
from coppice.operators.rank import running_total
from coppice.store import Store

# The key columns of a configuration and the series of the reports.
CONFIG = [
    "executable", "implementation_type", "dataset", "n", "d", "dataset_source",
    "linkage", "threads", "block_size",
]
BASE_KEYS = ["executable", "dataset", "linkage"]
SHOWN_SETS = [
    "random_n500", "random_n1000", "random_n2000", "random_n5000",
    "donut3", "complex9", "diamond9",
]
SPEEDUP_SETS = ["random_n500", "random_n2000", "random_n5000", "complex9", "optdigits"]
THREADS = [1, 2, 3, 4, 8, 12, 16]

PIVOT_COLUMNS = 1_000  # values that a pivot turns into columns by itself
GROUP_ROWS = 1_000_000  # rows of one configuration that the built-in median may hold


def median_per_config(
    log: DataFrame,
    keys: list[str] = CONFIG,
    value: str = "runtime_ms",
    name: str | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Exact median and repetition count per configuration; failed runs are left out.

    The built-in median holds the values of a group in one task, so it is used
    only when no configuration has more than ``group_rows`` rows. Beyond that,
    equal values are counted before the shuffle and the counted values are sorted
    over all partitions, so that a configuration with most of the rows is spread
    like any other; the middle values are those whose span of positions holds the
    middle position. A null key is a key like any other.
    """
    name = name or f"median_{value}"
    timed = log.dropna(subset=[value]).select(*keys, value)
    largest = timed.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= group_rows:
        return timed.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("reps"), F.median(value).alias(name)
        )
    store = Store(log.sparkSession, "median")
    counted = timed.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("times"))
    spans = running_total(counted, [*keys, value], "times", store)
    after = F.col("before") + F.col("times")
    groups = spans.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min("before").alias("first"), F.max(after).alias("end")
    )
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    reps = F.col("end") - F.col("first")
    holds = [
        (F.col("before") <= middle) & (middle < after)
        for middle in (
            F.col("first") + F.floor((reps - 1) / 2), F.col("first") + F.floor(reps / 2)
        )
    ]
    middles = spans.join(groups, same).where(holds[0] | holds[1])
    return middles.groupBy(*keys).agg(
        F.max(reps).alias("reps"),
        ((F.min(value) + F.max(value)) / 2).alias(name),
    )


def with_speedup(
    medians: DataFrame,
    keys: list[str] = BASE_KEYS,
    degree: str = "threads",
    value: str = "median_runtime_ms",
    name: str = "speedup_vs_1_thread",
    measured: Column | None = None,
    last_by: list[str] | None = None,
) -> DataFrame:
    """Add the value at degree 1 over the own value; rows outside ``measured`` get null.

    ``last_by`` makes one baseline of several with equal ``keys``: the last in that
    order. Without it the join is a merge, and a row is there once for each baseline.
    The medians are written once, so the log behind them is not read twice.
    """
    medians = Store(medians.sparkSession, "speedup").keep(medians, "medians")
    measured = F.col(degree).isNotNull() if measured is None else measured
    base = medians.where(measured & (F.col(degree) == 1)).select(
        *keys, F.col(value).alias("base_value")
    )
    if last_by is not None:
        base = medians.where(measured & (F.col(degree) == 1)).groupBy(*keys).agg(
            F.max_by(F.col(value), F.struct(*last_by)).alias("base_value")
        )
    joined = medians.join(base, keys, "left")
    speedup = F.when(measured, ratio("base_value", value))
    return joined.withColumn(name, speedup).drop("base_value")


def summarize(log: DataFrame) -> DataFrame:
    """The run summary: one row per configuration with median, repetitions and speedup, in key order.

    Where a baseline repeats (one dataset name with several n) the last one in key order counts.
    """
    keys = [k for k in CONFIG if k != "implementation_type"]
    out = with_speedup(
        median_per_config(log, keys),
        measured=F.col("threads").isNotNull() & F.col("block_size").isNull(),
        last_by=keys,
    )
    return out.select(*keys, "reps", "median_runtime_ms", "speedup_vs_1_thread").orderBy(*keys)


def pivot_median(
    rows: DataFrame,
    index: str = "dataset",
    column: str = "threads",
    value: str = "runtime_ms",
    columns: list | None = None,
    order: str | None = None,
) -> DataFrame:
    """Median by ``index`` (rows) and ``column``; rows ordered by the smallest ``order``.

    Without ``columns`` the different values become columns; more than ``PIVOT_COLUMNS`` of them are an error.
    """
    if columns is None:
        found = rows.select(column).distinct().orderBy(column).limit(PIVOT_COLUMNS + 1).collect()
        if len(found) > PIVOT_COLUMNS:
            raise ValueError(f"{column} has more than {PIVOT_COLUMNS} values; name the columns that are wanted")
        columns = [r[0] for r in found]
    medians = median_per_config(rows, [index, column], value)
    grid = medians.groupBy(index).pivot(column, columns).agg(F.first(f"median_{value}"))
    if order is None:
        return grid.orderBy(index)
    at = rows.groupBy(index).agg(F.min(order).alias("_order"))
    return grid.join(at, index).orderBy("_order", index).drop("_order")


def runtime_series(rows: DataFrame, executable: str | None = None) -> DataFrame:
    """Random sets, in the order a runtime-against-n chart needs them."""
    out = rows.where(F.col("dataset").startswith(RANDOM_PREFIX))
    if executable is not None:
        out = out.where(F.col("executable") == executable)
    return out.orderBy("threads", "block_size", "n")


def plane_series(summary: DataFrame) -> DataFrame:
    """Random sets of the plane at the reported thread counts."""
    kept = summary.where(
        F.col("dataset").startswith(RANDOM_PREFIX) & (F.col("d") == 2) & F.col("threads").isin(THREADS)
    )
    return kept.orderBy("threads", "n")


def speedup_series(summary: DataFrame, datasets: list[str] = SPEEDUP_SETS) -> DataFrame:
    """Speedup against threads for the chosen datasets."""
    return summary.where(F.col("dataset").isin(datasets)).orderBy("dataset", "threads")


def block_size_series(rows: DataFrame) -> DataFrame:
    """Runtime against block size of the GPU runs."""
    return rows.where("implementation_type = 'cuda'").orderBy("dataset", "block_size")


def shown_subset(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("dataset").isin(SHOWN_SETS))


def dataset_sizes(rows: DataFrame) -> DataFrame:
    """``(dataset, n)``, and the largest thread count seen with it."""
    return rows.groupBy("dataset").agg(
        F.min("n").alias("n"), F.max("threads").alias("max_threads")
    )
