"""A global rank without a single-partition window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.store import Store

ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def global_rank(df: DataFrame, keys: list[str], store: Store, name: str = "rank") -> DataFrame:
    """Add a 0-based rank over ``keys``, which must order the rows totally.

    Range partitions are sorted and written once, so the numbers are fixed; only
    one row count per partition reaches the driver.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = store.keep(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", ROW_BITS)
    counts = written.groupBy(part.alias("p")).count().orderBy("p").collect()
    if len(counts) <= 1:
        first = counts[0]["p"] if counts else 0
        return written.withColumn(name, F.col("_at") - (first << ROW_BITS)).drop("_at")
    before = [0, *accumulate(r["count"] for r in counts)][: len(counts)]
    offsets = spark.createDataFrame(
        [(r["p"], at - (r["p"] << ROW_BITS)) for r, at in zip(counts, before)],
        "_p long, _shift long",
    )
    # One row per range partition of the shuffle above.
    return (
        written.withColumn("_p", part)
        .join(F.broadcast(offsets), "_p")
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_at", "_p", "_shift")
    )


def running_total(df: DataFrame, keys: list[str], amount: str, store: Store) -> DataFrame:
    """Add ``before``: the sum of ``amount`` over all rows that sort before this one.

    Like ``global_rank``: sums run inside the range partitions, and one total per
    partition reaches the driver.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    part = F.shiftright(F.monotonically_increasing_id(), ROW_BITS)
    written = store.keep(ordered.withColumn("_p", part), "ordered")
    totals = written.groupBy("_p").agg(F.sum(amount).alias("t")).orderBy("_p").collect()
    before = [0, *accumulate(r["t"] for r in totals)][: len(totals)]
    offsets = df.sparkSession.createDataFrame(
        [(r["_p"], at) for r, at in zip(totals, before)], "_p long, _start long"
    )
    inside = Window.partitionBy("_p").orderBy(*keys)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        written.withColumn("_sum", F.sum(amount).over(inside) - F.col(amount))
        .join(F.broadcast(offsets), "_p")
        .withColumn("before", F.col("_sum") + F.col("_start"))
        .drop("_p", "_sum", "_start")
    )
