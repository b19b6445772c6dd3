"""Connected components by alternating stars, in shuffles that no large component slows down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.sources.staging import delete_path, staging_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a")
    return linked.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        least.select("a", F.col("least").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that it reaches, for every node of an edge.

    edges: a and b of one ordered type, null nowhere. Loops and repeated edges do no harm. Both stars group by one
    node with partial minima, and their joins have one row per node on one side, so a node with very many neighbours
    is split by adaptive execution. Each round is written to the shared folder and the one before is deleted.
    """
    spark = edges.sparkSession
    least, most = F.least("a", "b"), F.greatest("a", "b")
    start = edges.filter("a <> b").select(most.alias("a"), least.alias("b")).distinct()
    schema = start.schema

    def written(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = staging_path(spark, "star")
        df.write.parquet(path)
        back = spark.read.schema(schema).parquet(path)
        mark = F.xxhash64("a", "b")
        seen = back.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.shiftrightunsigned(mark, 24))).first()
        return back, path, tuple(seen)

    now, path, mark = written(start)
    while mark[0]:
        new, new_path, new_mark = written(_small_star(_large_star(now)).filter("a > b").distinct())
        delete_path(spark, path)
        now, path, same = new, new_path, new_mark == mark
        mark = new_mark
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
