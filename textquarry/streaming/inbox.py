"""The batch stages triggered by files arriving in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.providers import EmbeddingProvider, TitleProvider
from ..operators.html import clean_html
from ..plans.ingest import chunk_batches, load_batches
from ..sources.chunk_table import ChunkTable
from ..sources.files import decode_text, document_id, file_kind, with_titles

#: Loads after which the table is compacted.
COMPACT_AT = 32
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def newest_versions(files: DataFrame, how: str = "left_semi") -> DataFrame:
    """Of several files with one document id in a trigger, the one written last; with `left_anti` the others.

    Only names and times are aggregated, with a partial step before the shuffle.
    """
    newest = files.groupBy("document_id").agg(F.max(F.struct("modificationTime", "path")).alias("v"))
    return files.join(newest.select("v.path"), "path", how)


def watch_inbox(
    spark: SparkSession,
    inbox: str,
    table: ChunkTable,
    embedder: EmbeddingProvider,
    checkpoint: str,
    titles: TitleProvider | None = None,
    left_out: str | None = None,
) -> StreamingQuery:
    """Ingest the HTML and Markdown files that are new since the last run, in nested folders too, then stop.

    Each trigger replaces whole documents, so a repeated one changes nothing. Below `left_out` (by default a folder beside the
    checkpoint) each trigger writes the files of other kinds, those without a text and those of which a newer one has the same document id as
    `rejects`, and lost batches as `dead-letters`, under its number, so that a repeated one replaces its own. So every file ends in the
    table or in a list. After COMPACT_AT loads the table is compacted.
    """
    lost = left_out or f"{checkpoint.rstrip('/')}-left-out"
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .load(inbox)
        .withColumn("kind", file_kind(F.col("path")))
        .withColumn("document_id", document_id(F.col("path")))
    )

    def ingest(every: DataFrame, epoch: int) -> None:
        taken = F.coalesce(F.col("kind").isin("html", "markdown"), F.lit(False))
        other = every.where(~taken).select("path", F.lit("not taken by the inbox").alias("error"))
        batch = every.where(taken)
        older = newest_versions(batch.drop("content"), "left_anti").select("path", F.lit("a newer file has the same document id").alias("error"))
        # one pass over the contents: Markdown rows go past the page cleaner as null
        text = newest_versions(batch).withColumn("text", decode_text(F.col("content"))).drop("content")
        is_page = F.col("kind") == "html"
        cleaned = clean_html(text.withColumn("html", F.when(is_page, F.col("text"))))
        failed = cleaned.where(F.col("error").isNotNull()).select("path", "error")
        other.unionByName(older).unionByName(failed).write.mode("overwrite").json(f"{lost}/rejects/{epoch}")
        documents = cleaned.where(F.col("error").isNull()).select(
            "document_id", F.when(is_page, F.col("clean_text")).otherwise(F.col("text")).alias("clean_text")
        )
        load_batches(chunk_batches(with_titles(documents), titles), embedder, table, f"{lost}/dead-letters/{epoch}")
        if len(table.versions()) > COMPACT_AT:
            table.compact()

    return (
        arrivals.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
