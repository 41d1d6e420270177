"""Converters from source datasets to points tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.operators.rank import global_rank
from coppice.store import Store

LABEL = "label"


def coordinate_names(count: int) -> list[str]:
    """``x, y`` in the plane, else ``x0, x1, ...``."""
    return ["x", "y"] if count == 2 else [f"x{i}" for i in range(count)]


def encode_labels(table: DataFrame, column: str, name: str = LABEL) -> DataFrame:
    """Add the code of ``column``: its place among the sorted distinct values; null is -1.

    Only the distinct values are ranked. The codes are joined back as they come:
    Spark broadcasts them while they are small and shuffles beyond that.
    """
    store = Store(table.sparkSession, "labels")
    values = table.select(column).where(F.col(column).isNotNull()).distinct()
    codes = global_rank(values, [column], store, name)
    coded = table.join(codes.withColumn(name, F.col(name).cast("int")), column, "left")
    return coded.withColumn(name, F.coalesce(name, F.lit(-1)))


def convert_labelled(table: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rename the coordinates and code the last column as ``label``.

    ``keep`` names columns, such as a row key, that pass through unchanged.
    """
    keep = keep or []
    *coords, label = [c for c in table.columns if c not in keep]
    coded = encode_labels(table, label, "_code")
    named = [F.col(c).alias(n) for c, n in zip(coords, coordinate_names(len(coords)))]
    return coded.select(*keep, *named, F.col("_code").alias(LABEL))


def union_headerless(spark: SparkSession, paths: list[str], field_type: str = "double") -> DataFrame:
    """All rows of headerless files with equal width: ``x0, ..., label``."""
    width = len(spark.read.csv(paths, header=False).columns)
    names = [f"x{i}" for i in range(width - 1)]
    fields = [f"{n} {field_type}" for n in names] + [f"{LABEL} int"]
    reader = spark.read.schema(", ".join(fields)).option("mode", "FAILFAST")
    return reader.csv(paths, header=False)


def write_points(table: DataFrame, path: str) -> None:
    table.write.csv(path, header=True)
