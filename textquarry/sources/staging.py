"""Cutting lineage where a result is used more than once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    A session that runs in one process may go without: a temporary folder is set then. With several machines
    a local folder would lose what other machines write, so a missing setting is an error there.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="textquarry-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/textquarry-{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Service calls behind it then happen once however often it is used, and losing
    an executor afterwards costs no recomputation.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Staged:
    """Staged copies of one job, deleted together."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def written_once(self, df: DataFrame, name: str) -> DataFrame:
        path = staging_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, keep: int = 0) -> None:
        """Delete all copies but the newest `keep`."""
        cut = len(self.paths) - keep
        for path in self.paths[:cut]:
            delete_path(self.spark, path)
        self.paths = self.paths[cut:]


@contextmanager
def staged(spark: SparkSession) -> Iterator[Staged]:
    """Staged copies that are gone when the block ends, also by an error."""
    copies = Staged(spark)
    try:
        yield copies
    finally:
        copies.delete()
