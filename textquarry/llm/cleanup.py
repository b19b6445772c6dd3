"""Shuffle files that are not needed any more."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block, Spark deletes the shuffle files of an action when it ends, not when the driver happens to collect garbage.

    For jobs that write each result once and read it from there.
    """
    before = spark.conf.get(FREE, "false")
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE, before)
