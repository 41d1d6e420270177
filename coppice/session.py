"""Session defaults used by the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session; on a cluster use the session the cluster gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("coppice")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
