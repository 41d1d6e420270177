"""Run logs and their summaries as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.functions.classify import stamp

# The columns of the run log and of its summary.
RUN_LOG = (
    "executable string, implementation_type string, dataset string, n long, d int, "
    "dataset_source string, has_labels boolean, linkage string, threads int, block_size int, "
    "rep int, runtime_ms double, error string, timestamp timestamp, host string, "
    "platform string, cpu string, hardware_note string, command string"
)
RUN_SUMMARY = (
    "executable string, dataset string, n long, d int, dataset_source string, linkage string, "
    "threads int, block_size int, reps long, median_runtime_ms double, "
    "speedup_vs_1_thread double"
)


def _read(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    reader = spark.read.schema(schema).option("nullValue", "").option("mode", "FAILFAST")
    return reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path, header=True)


def read_run_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Empty fields are null."""
    return _read(spark, path, RUN_LOG)


def read_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read(spark, path, RUN_SUMMARY)


def write_log(log: DataFrame, path: str) -> None:
    """Run log or summary; null is written as an empty field."""
    if "timestamp" in log.columns:
        log = log.withColumn("timestamp", stamp("timestamp"))
    log.write.csv(path, header=True, nullValue="", emptyValue="")


def union_summaries(*summaries: DataFrame, required: set[str] | None = None) -> DataFrame:
    """All rows of the summaries; columns missing from one are null."""
    out = summaries[0]
    for more in summaries[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    # The columns the reports need.
    required = required or {
        "dataset", "n", "d", "threads", "median_runtime_ms", "speedup_vs_1_thread",
    }
    missing = sorted(required - set(out.columns))
    if missing:
        raise ValueError(f"the summaries lack {', '.join(missing)}")
    return out


def names(log: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values."""
    return log.select(column).distinct().orderBy(F.col(column))
