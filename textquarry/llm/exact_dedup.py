"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

A batch is reduced to one row per digest with partial maxima and counts, so a text that fills a third of the
batch costs no task more than the others. A sort-merge anti-join with the index, whose side needs neither shuffle nor sort
across buckets, leaves the new digests; these are appended. Texts never leave their scan.

Defined cases: null counts as the empty text; equal means the same bytes of UTF-8, no change made; of equal texts of
one batch the row with the largest doc_id stays (rows with that same doc_id all count as kept; a null doc_id stays only if
there is no other); texts of earlier batches keep the row of that batch; a batch added again gives the same result
and appends nothing; empty batches and further columns do no harm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.sources.staging import staged, written_once


class DigestIndex:
    """A table of the session's catalog with digest, keep_id and batch, a row per different text."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        """buckets: for a new table, as many as shuffle partitions unless told otherwise."""
        self.spark = spark
        self.table = table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._next = f"{table}_next"
        if not spark.catalog.tableExists(table):
            if spark.catalog.tableExists(self._next):  # a compaction broke off before its last step
                spark.sql(f"ALTER TABLE {self._next} RENAME TO {table}")
            else:
                self._write(spark.createDataFrame([], "digest string, keep_id bigint, batch string"), "error")

    def _write(self, rows: DataFrame, mode: str, table: str | None = None) -> None:
        dealt = rows.repartition(self.buckets, "digest")
        (
            dealt.write.mode(mode)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .saveAsTable(table or self.table)
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append the new texts of a batch; give back what becomes of each row.

        doc_id, keep_id (the row that stays), group_size (rows of the batch with this text), kept and text_sha256.
        """
        digests, settled = self._settle(docs, batch)
        # With copies of one text in a third of the rows, adaptive execution splits the side of the documents.
        stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("_old").isNull()
        return digests.join(settled, "digest").select(
            "doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("digest").alias("text_sha256")
        )

    def _settle(self, docs: DataFrame, batch: str) -> tuple[DataFrame, DataFrame]:
        """Append the new texts; the digest of every row, and per digest keep_id, group_size and whether an earlier batch held it."""
        text = F.coalesce(F.col("text"), F.lit(""))
        digests = written_once(docs.select("doc_id", F.sha2(text, 256).alias("digest")), "digests")
        found = digests.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        own = written_once(found, "digest-groups")
        new = own.select("digest", "keep_id", F.lit(batch).alias("batch"))
        self._write(new.join(self.rows().hint("merge"), "digest", "left_anti"), "append")
        earlier = self.rows().filter(F.col("batch") != batch).select("digest", F.col("keep_id").alias("_held"), F.lit(True).alias("_old"))
        keep = F.when(F.col("_old"), F.col("_held")).otherwise(F.col("keep_id")).alias("keep_id")
        joined = own.join(earlier.hint("merge"), "digest", "left").select("digest", keep, "group_size", "_old")
        return digests, written_once(joined, "digest-settled")  # the next join is then not bound to the index's buckets

    def compact(self) -> None:
        """Write each bucket as one sorted file. If it breaks off, the index is found whole when it is opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._next}")
        with staged(self.spark) as copies:
            # a copy without buckets: else Spark takes the files for dealt by digest already and writes a file for each of them
            self._write(copies.written_once(self.rows(), "digest-index"), "error", self._next)
        self.spark.sql(f"DROP TABLE {self.table}")
        self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.table}")
        self.spark.catalog.refreshTable(self.table)

    def drop(self) -> None:
        for table in (self.table, self._next):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Dedup one table in two batches, the larger half of doc_id first, with an index of its own that is dropped in the end.

    The batches are added, the index is compacted between them, and group_size counts the rows of both.
    """
    index = DigestIndex(docs.sparkSession, f"textquarry_digests_{uuid.uuid4().hex}")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5, 100)).first()[0]  # where to cut changes no result
    upper = F.coalesce(F.col("doc_id") >= F.lit(middle).cast("bigint"), F.lit(False))
    try:
        digests, settled = index._settle(docs.where(upper), "upper")
        index.compact()
        more, later = index._settle(docs.where(~upper), "lower")
    finally:
        index.drop()
    # a text of both batches has the keep_id of the first in both
    whole = settled.unionByName(later).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    # With copies of one text in a third of the rows, adaptive execution splits the side of the documents.
    return digests.unionByName(more).join(whole, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )
