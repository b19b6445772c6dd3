"""The stored table of embedded chunks, replaced document by document.

Nothing stored is ever changed. A load appends a version: first its rows, as a folder of Parquet below `rows`,
then its document ids below `commits`. With the success mark that Spark's writer puts there last, the version
counts. Of a document the rows of its newest counting version are the stored ones. So a load writes just its own
rows, and one that ends anywhere leaves all documents as they were.

A compaction appends a version too, a base, with which all older ones stop counting. Their files stay until the next
compaction, so that a reader who has begun may end.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.providers import VECTOR_DIMENSION
from ..schemas import VECTOR_ROW
from .staging import delete_path

SAMPLE_ROWS = 3
_STORED = T.StructType([*VECTOR_ROW.fields, T.StructField("version", T.StringType())])
_COMMIT = "document_id string, version string"
_BASE = "-base"


class TableError(RuntimeError):
    """Rows were refused, or stored rows are not what they should be."""


def to_vector_rows(embedded: DataFrame) -> DataFrame:
    """Embedded chunks in stored form, metadata as JSON text, which they may be already."""
    is_text = isinstance(embedded.schema["metadata"].dataType, T.StringType)
    return embedded.select(
        "chunk_id",
        "document_id",
        "content",
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.col("metadata") if is_text else F.to_json("metadata").alias("metadata"),
        F.current_timestamp().alias("last_modified"),
    )


def defects(dimension: int) -> dict[str, Column]:
    """Counts of what disqualifies rows from being stored."""
    return {
        "without_document": F.count_if(F.col("document_id").isNull() | (F.col("document_id") == "")),
        "without_embedding": F.count_if(F.col("embedding").isNull()),
        "wrong_dimension": F.count_if(F.size("embedding") != dimension),
    }


def integrity(rows: DataFrame, dimension: int, *keys: str) -> DataFrame:
    """Counts per key of stored rows and of those that are damaged."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(F.size("embedding"), F.lit(-1)) != dimension).alias("wrong_dimension"),
        F.count_if(F.coalesce("content", F.lit("")) == "").alias("empty_content"),
        F.count_if(
            F.try_parse_json(F.coalesce(F.nullif("metadata", F.lit("")), F.lit("{}"))).isNull()
        ).alias("invalid_metadata"),
    )


def checked(rows: DataFrame, dimension: int) -> DataFrame:
    """The rows themselves, if all of them can be stored."""
    counts = [c.alias(n) for n, c in defects(dimension).items()]
    found = rows.agg(F.count(F.lit(1)).alias("rows"), *counts).first().asDict()
    if not found.pop("rows"):
        raise TableError("no chunks to store")
    if any(found.values()):
        raise TableError(f"chunks refused: { {k: v for k, v in found.items() if v} }")
    twice = rows.groupBy("chunk_id").count().where("count > 1").take(1)
    if twice:
        raise TableError(f"chunk id occurs more than once: {twice[0].chunk_id}")
    return rows


def mismatches(sent: DataFrame, stored: DataFrame) -> None:
    """Fail if the integrity counts of stored documents are not those of what was sent."""
    expected = sent.groupBy("document_id").agg(F.count(F.lit(1)).alias("expected"))
    damaged = F.col("wrong_dimension") + F.col("empty_content") + F.col("invalid_metadata") > 0
    wrong = (
        expected.join(stored, "document_id", "left")
        .where((F.coalesce("rows", F.lit(0)) != F.col("expected")) | damaged)
        .take(5)
    )
    if wrong:
        raise TableError(f"stored chunks do not match: {wrong}")


def sample_each(rows: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Of every document the k rows with the least digests of seed and chunk_id, ties by content: a random sample that needs no order of rows.

    A task sends k rows of a document at most, and samples of parts merge into that of the whole.
    """
    mark = F.sha2(F.concat_ws("/", F.lit(str(seed)), F.coalesce("chunk_id", F.lit(""))), 256)
    first = Window.partitionBy("document_id").orderBy("_mark", F.col("content"))
    numbered = rows.withColumn("_mark", mark).withColumn("_n", F.row_number().over(first))
    return numbered.where(F.col("_n") <= k).drop("_mark", "_n")


def load_report(rows: DataFrame, *by: str) -> DataFrame:
    """documents, chunks and characters for every combination of `by` and of any part of it; grouping: a bit for each column that is left out."""
    return rows.cube(*by).agg(
        F.grouping_id().alias("grouping"),
        F.countDistinct("document_id").alias("documents"),
        F.count(F.lit(1)).alias("chunks"),
        F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("characters"),
    )


@dataclass
class ChunkTable:
    """One writer at a time; readers at any time."""

    spark: SparkSession
    path: str
    dimension: int = VECTOR_DIMENSION

    def _names(self, part: str) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []

    def versions(self) -> list[str]:
        """The versions that count, oldest first; their number is that of loads since the last compaction."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        marks = {v: path(f"{self.path}/commits/{v}/_SUCCESS") for v in self._names("commits")}
        counted = [v for v, mark in marks.items() if mark.getFileSystem(conf).exists(mark)]
        base = max((v for v in counted if v.endswith(_BASE)), default="")
        return [v for v in counted if v >= base]

    def _new_version(self, kind: str = "") -> str:
        seen = [*self._names("rows"), *self._names("commits")]
        number = max((int(v.split("-")[0]) for v in seen), default=0) + 1
        return f"{number:012d}-{uuid.uuid4().hex[:8]}{kind}"

    def _rows(self, *versions: str) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], _STORED)
        return self.spark.read.schema(_STORED).parquet(*(f"{self.path}/rows/{v}" for v in versions))

    def _superseded(self, versions: list[str]) -> DataFrame:
        """Documents and versions of theirs that newer ones have replaced: as many as there were replacements."""
        commits = self.spark.read.schema(_COMMIT).parquet(*(f"{self.path}/commits/{v}" for v in versions))
        every = commits.groupBy("document_id").agg(F.array_sort(F.collect_set("version")).alias("all"))
        old = every.where(F.size("all") > 1).select("document_id", F.explode(F.expr("slice(all, 1, size(all) - 1)")).alias("version"))
        return old

    def read(self) -> DataFrame:
        versions = self.versions()
        rows = self._rows(*versions)
        if len(versions) > 1:
            rows = rows.join(self._superseded(versions), ["document_id", "version"], "left_anti")
        return rows.select(*VECTOR_ROW.names)

    def _commit(self, version: str) -> None:
        documents = self._rows(version).select("document_id", "version").distinct()
        documents.write.mode("overwrite").parquet(f"{self.path}/commits/{version}")

    def upsert(self, embedded: DataFrame) -> DataFrame:
        """Replace the documents of `embedded`; nothing counts if any row is refused. Returns the stored rows."""
        version = self._new_version()
        rows = to_vector_rows(embedded).withColumn("version", F.lit(version))
        rows.write.parquet(f"{self.path}/rows/{version}")
        incoming = self._rows(version)
        try:
            checked(incoming, self.dimension)
        except TableError:
            delete_path(self.spark, f"{self.path}/rows/{version}")
            raise
        self._commit(version)
        return incoming

    def compact(self) -> None:
        """Write all stored rows as one version. It may end anywhere and be run again.

        Versions that had stopped counting before, by an earlier compaction or an interrupted load, are deleted. Those that stop
        counting now stay for readers that have begun; another call deletes them.
        """
        old = self.versions()
        for part in ("commits", "rows"):
            for v in self._names(part):
                if v not in old:
                    delete_path(self.spark, f"{self.path}/{part}/{v}")
        if len(old) > 1:
            version = self._new_version(_BASE)
            self.read().withColumn("version", F.lit(version)).write.parquet(f"{self.path}/rows/{version}")
            self._commit(version)

    def counts(self) -> DataFrame:
        return self.read().groupBy("document_id").agg(F.count(F.lit(1)).alias("rows"))

    def sample(self, document_id: str) -> DataFrame:
        """A few random rows of a document."""
        return self.read().where(F.col("document_id") == document_id).orderBy(F.rand()).limit(SAMPLE_ROWS)

    def sample_each(self, k: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
        """k random rows of every document, the same for one seed."""
        return sample_each(self.read(), k, seed)

    def sanity_check(self, incoming: DataFrame) -> None:
        """Compare what is stored of the incoming documents with what was sent, all of it.

        incoming: rows that upsert() gave; just their version is read again.
        """
        version = incoming.select("version").first()
        stored = self._rows(version[0]) if version else self._rows()
        mismatches(incoming, integrity(stored, self.dimension, "document_id"))
