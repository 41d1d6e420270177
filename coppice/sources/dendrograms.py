"""Dendrogram files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.operators.dendrogram import DENDROGRAM, DENDROGRAM_COLUMNS

# The columns of the exchange format.
EXCHANGE = "cluster_a long, cluster_b long, distance double, new_size long"
EXCHANGE_COLUMNS = ["cluster_a", "cluster_b", "distance", "new_size"]


def write_dendrogram(merges: DataFrame, path: str, digits: int | None = None) -> None:
    """CSV with a header, all columns, in step order over the part files.

    Doubles are written so that they read back equal; ``digits=15`` gives the
    short form of the exchange format (``short_number``).
    """
    _write(merges.select(*DENDROGRAM_COLUMNS), path, digits)


def write_exchange(merges: DataFrame, path: str, slots: bool = False) -> None:
    """The four-column form, 15 digits; slot ids or tree ids as cluster names."""
    a, b = ("slot_a", "slot_b") if slots else ("cluster_a", "cluster_b")
    rows = merges.select(
        "step", F.col(a).alias("cluster_a"), F.col(b).alias("cluster_b"), "distance", "new_size"
    )
    _write(rows, path, 15, EXCHANGE_COLUMNS)


def short_number(column: str, digits: int = 15) -> Column:
    """A double with so many significant digits as C prints it: no trailing zeros, correctly rounded.

    ``format_string`` keeps the zeros and rounds the shortest decimal form, which is not the double itself.
    """

    @F.arrow_udf("string")
    def printed(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.{digits}g}" for v in values.to_pylist()], pa.string())

    return printed(F.col(column))


def _write(rows: DataFrame, path: str, digits: int | None, columns: list[str] | None = None) -> None:
    if digits is not None:
        rows = rows.withColumn("distance", short_number("distance", digits))
    ordered = rows.orderBy("step")
    if columns:
        ordered = ordered.select(*columns)
    ordered.write.csv(path, header=True)


def read_dendrogram(spark: SparkSession, path: str) -> DataFrame:
    """A dendrogram written by ``write_dendrogram``."""
    return spark.read.schema(DENDROGRAM).option("mode", "FAILFAST").csv(path, header=True)


def read_exchange(spark: SparkSession, path: str) -> DataFrame:
    """The four-column form, with the step numbered from the file order."""
    from coppice.sources.points import number_rows

    rows = spark.read.schema(EXCHANGE).option("mode", "FAILFAST").csv(path, header=True)
    numbered = number_rows(rows, EXCHANGE_COLUMNS)
    return numbered.select(F.col("id").alias("step"), *EXCHANGE_COLUMNS)
