"""Points tables: reading, column roles, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.operators.rank import global_rank
from coppice.store import Store

LABEL = "label"


def read_points(
    spark: SparkSession,
    path: str | list[str],
    id_col: str | None = None,
    label_col: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """``(id, features[, label])`` from CSV with a header, or from parquet.

    The header is never data, blank lines are dropped, and a field that is not a
    number fails the read. Without ``id_col`` rows are numbered in file order.
    ``columns`` names the CSV fields when there is no need to look at the file.
    """
    paths = [path] if isinstance(path, str) else path
    if all(p.rstrip("/").endswith(".parquet") for p in paths):
        table = spark.read.parquet(*paths)
    else:
        names = columns or spark.read.csv(paths, header=True).columns
        schema = ", ".join(f"`{c}` double" for c in names)
        reader = spark.read.schema(schema).option("mode", "FAILFAST")
        table = reader.csv(paths, header=True, enforceSchema=False)
    if id_col is None:
        table = number_rows(table, columns=table.columns)
        id_col = "id"
    return as_points(table, id_col, label_col)


def number_rows(table: DataFrame, columns: list[str], store: Store | None = None) -> DataFrame:
    """Add a 0-based ``id`` in file order: part number, file name, then position in the file.

    Part numbers have five digits or more, so they are compared as numbers.
    """
    store = store or Store(table.sparkSession, "numbered")
    # A text scan splits files in order, and the id grows with the split.
    placed = table.select(
        *columns,
        F.expr("try_cast(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1) as long)").alias("_part"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = store.keep(placed, "read")
    ranked = global_rank(placed, ["_part", "_file", "_start", "_row"], store, "id")
    return ranked.drop("_part", "_file", "_start", "_row")


def as_points(
    table: DataFrame,
    id_col: str,
    label_col: str | None = None,
    feature_cols: list[str] | None = None,
) -> DataFrame:
    """Assemble the feature vector: every column but the id and the label, in order."""
    if feature_cols is None:
        feature_cols = [c for c in table.columns if c not in (id_col, label_col)]
    features = F.array(*[F.col(f"`{c}`").cast("double") for c in feature_cols])
    return _points(table, id_col, features, label_col)


def vector_points(
    table: DataFrame, id_col: str, vector_col: str, label_col: str | None = None
) -> DataFrame:
    """Points from a table that already holds the vectors."""
    return _points(table, id_col, F.col(vector_col).cast("array<double>"), label_col)


def _points(table: DataFrame, id_col: str, features: Column, label_col: str | None) -> DataFrame:
    out = [F.col(id_col).cast("long").alias("id"), features.alias("features")]
    if label_col is not None:
        out.append(F.col(label_col).cast("int").alias(LABEL))
    return table.select(*out)


def dataset_profile(table: DataFrame, label_col: str = LABEL) -> DataFrame:
    """One row ``(n, d, has_labels)`` of a table with one column per coordinate."""
    labelled = label_col in table.columns
    return table.agg(F.count(F.lit(1)).alias("n")).select(
        "n",
        F.lit(len(table.columns) - labelled).cast("int").alias("d"),
        F.lit(labelled).alias("has_labels"),
    )


def points_profile(points: DataFrame) -> DataFrame:
    """The same row for a points table; ``d`` is the vector length."""
    return points.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("features")).cast("int").alias("d")
    ).select("n", "d", F.lit(LABEL in points.columns).alias("has_labels"))
