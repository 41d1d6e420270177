"""Written tables that cut the lineage of the iterative operators.

Each round of a loop is written to a shared folder and read back. That drops the
plan and its size estimates, and a lost executor costs a re-read of files instead
of a replay of every earlier round.
"""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own. A cluster
    session must name a shared one, because a folder of one machine is invisible
    to the others.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    # One folder for all calls of the application; only this machine runs it.
    folder = Path(tempfile.gettempdir()) / f"coppice-{spark.sparkContext.applicationId}"
    folder.mkdir(mode=0o700, exist_ok=True)
    return str(folder)


class Store:
    """One sub-folder of the shared folder, for the tables of one operator call.

    Results read lazily from it, so ``drop`` it only after they are used.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._made = 0

    def path(self, label: str) -> str:
        self._made += 1
        return f"{self.root}/{self._made:03d}-{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return a frame that reads the written table."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(_all_nullable(df.schema)).parquet(path)


    def drop(self) -> None:
        """Delete the sub-folder with all its tables."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
