"""The stages put together: files → clean text → chunks → embeddings → table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.providers import EmbeddingProvider, TitleProvider
from ..operators import embed, html, pdf_layout
from ..operators.chunk import BATCH_SIZE, CHUNK_SIZE, OVERLAP
from ..schemas import FREE_CHUNK
from ..sources import files, jsonl, pdf_words
from ..sources.chunk_table import ChunkTable
from ..sources.staging import staged, written_once

#: Writes a frame once under a name and gives back what was written.
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass
class Cleaned:
    """Documents with text, and files that gave none with the reason."""

    documents: DataFrame
    rejects: DataFrame


def clean_files(spark: SparkSession, paths: str | list[str], keep: Keep = written_once) -> Cleaned:
    """Clean every supported file below `paths`, each kind with its own scan.

    The outcome is written once by `keep`: texts and rejects come from the same pass.
    """
    columns = ["path", "document_id", "clean_text", "error"]
    no_error, no_text = F.lit(None).cast("string"), F.lit(None).cast("string")
    markdown = files.read_markdown(spark, paths).withColumn("error", no_error)
    pages = html.clean_html(files.spread(files.read_html(spark, paths)))
    # Reading a PDF is costly, and its words, plain texts and errors go different ways.
    pdf = keep(pdf_words.read_pdf_pages(files.scan(spark, paths, "pdf")), "pdf-pages")
    pdf_texts = pdf_layout.clean_pdf_words(pdf_words.words_of(pdf), pdf_words.page_rows(pdf)).select(
        F.col("doc_id").alias("path"), files.document_id(F.col("doc_id")).alias("document_id"), "clean_text", no_error.alias("error")
    )
    unread = pdf.where(F.col("error").isNotNull()).withColumn("clean_text", no_text)
    unknown = files.rejects(spark, paths).withColumns({"document_id": no_text, "clean_text": no_text})
    parts = [markdown, pages, pdf_texts, unread, unknown]
    outcome = keep(reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]), "cleaned")
    failed = F.col("error").isNotNull()
    return Cleaned(
        outcome.where(~failed).select("document_id", "clean_text"),
        outcome.where(failed).select("path", "error"),
    )


def chunk_batches(
    documents: DataFrame,
    titles: TitleProvider | None = None,
    size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
    calls_at_once: int | None = None,
    log_path: str | None = None,
    keep: Keep = written_once,
) -> DataFrame:
    """Documents with titles to batches of finished chunks."""
    batches = embed.document_batches(documents, size, overlap, batch_size)
    if titles is not None:
        batches = embed.titled(embed.dealt_out(batches, calls_at_once), titles)
        if log_path:
            batches = keep(batches, "titles")
            jsonl.write_call_log(embed.title_log(batches, getattr(titles, "model", "")), log_path)
    return embed.with_sections(batches)


@dataclass
class LoadReport:
    total: int
    succeeded: int
    failed: int


def load_batches(
    batches: DataFrame,
    embedder: EmbeddingProvider,
    table: ChunkTable,
    dead_letter_path: str | None = None,
    log_path: str | None = None,
    calls_at_once: int | None = None,
) -> LoadReport:
    """Embed batches, report lost ones, and replace the documents of the others.

    A document without any embedded chunk keeps its old rows. Of one that lost
    only some batches the new rows are stored and the old ones go. The answers are
    staged until the load ends, in whatever way.
    """
    with staged(table.spark) as copies:
        return _load(batches, embedder, table, dead_letter_path, log_path, calls_at_once, copies.written_once)


def _load(
    batches: DataFrame,
    embedder: EmbeddingProvider,
    table: ChunkTable,
    dead_letter_path: str | None,
    log_path: str | None,
    calls_at_once: int | None,
    keep: Keep,
) -> LoadReport:
    seen = Observation("load")
    answered = embed.embed_batches(batches, embedder, calls_at_once)
    size = F.size("chunks")
    answered = answered.observe(
        seen,
        F.coalesce(F.sum(size), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("answer.error").isNull(), size)), F.lit(0)).alias("succeeded"),
    )
    answered = keep(answered, "answers")
    counts = seen.get
    report = LoadReport(counts["total"], counts["succeeded"], counts["total"] - counts["succeeded"])
    if report.failed and dead_letter_path:
        jsonl.write_dead_letters(embed.dead_letter_texts(answered), dead_letter_path)
    if log_path:
        model, call_size = getattr(embedder, "model", ""), getattr(embedder, "call_size", BATCH_SIZE)
        jsonl.write_call_log(embed.call_log(answered, model, table.dimension, call_size), log_path)
    if report.succeeded:
        table.sanity_check(table.upsert(embed.succeeded(embed.embedded_chunks(answered))))
    return report


def load_chunk_files(
    spark: SparkSession,
    path: str,
    embedder: EmbeddingProvider,
    table: ChunkTable,
    dead_letter_path: str | None = None,
    batch_size: int = BATCH_SIZE,
) -> LoadReport:
    """Load chunk rows from JSON lines, with whatever their metadata hold."""
    batches = embed.stored_batches(jsonl.read_chunks(spark, path, FREE_CHUNK), batch_size)
    return load_batches(batches, embedder, table, dead_letter_path)


def ingest_files(
    spark: SparkSession,
    paths: str | list[str],
    embedder: EmbeddingProvider,
    table: ChunkTable,
    *,
    document_id: str | None = None,
    title: str | None = None,
    meta: DataFrame | None = None,
    titles: TitleProvider | None = None,
    clean_path: str | None = None,
    chunks_path: str | None = None,
    dead_letter_path: str | None = None,
    log_path: str | None = None,
    batch_size: int = BATCH_SIZE,
) -> tuple[LoadReport, DataFrame]:
    """Everything from files to the table; returns the counts and the rejected files.

    Of what is staged on the way just the list of rejects is left.
    """
    with staged(spark) as copies:
        cleaned = clean_files(spark, paths, copies.written_once)
        rejects = written_once(cleaned.rejects, "rejects")
        documents = cleaned.documents
        if document_id:
            documents = documents.withColumn("document_id", F.lit(document_id))
        documents = files.with_titles(documents, meta, title)
        if clean_path:
            jsonl.write_clean_texts(documents, clean_path)
        batches = chunk_batches(documents, titles, batch_size=batch_size, log_path=log_path, keep=copies.written_once)
        if chunks_path:
            # titles may come from a service: name the chunks once, then use them twice
            batches = copies.written_once(batches, "batches")
            jsonl.write_chunks(embed.batches_to_chunks(batches), chunks_path)
        return load_batches(batches, embedder, table, dead_letter_path, log_path), rejects
