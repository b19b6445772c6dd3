"""Command line: `python -m textquarry.plans.cli clean|chunk|ingest`."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.providers import DigestEmbedder, HttpEmbedder, HttpTitles, ProviderError
from ..operators.embed import batches_to_chunks
from ..sources import files, jsonl
from ..sources.chunk_table import ChunkTable, TableError
from ..sources.staging import staged
from .ingest import chunk_batches, clean_files, ingest_files

LOG = logging.getLogger("textquarry")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="textquarry")
    steps = parser.add_subparsers(dest="step", required=True)

    clean = steps.add_parser("clean", help="clean documents to text")
    clean.add_argument("--input-file", required=True)
    clean.add_argument("--output-dir", default="data/clean")

    chunk = steps.add_parser("chunk", help="chunk cleaned text")
    chunk.add_argument("--input-file", required=True)
    chunk.add_argument("--document-id")
    chunk.add_argument("--title")
    chunk.add_argument("--output-dir", default="data/chunks")

    ingest = steps.add_parser("ingest", help="clean, chunk, embed and store")
    ingest.add_argument("--input-file", required=True)
    ingest.add_argument("--document-id")
    ingest.add_argument("--title")
    ingest.add_argument("--meta-file")
    ingest.add_argument("--clean-output-dir", default="data/clean")
    ingest.add_argument("--chunks-output-dir", default="data/chunks")
    ingest.add_argument("--dead-letter-dir", default="data/dead_letters")
    ingest.add_argument("--loader-batch-size", type=int, default=16)
    ingest.add_argument("--table", default="data/rag_chunks")
    ingest.add_argument("--dimension", type=int, default=1536)
    ingest.add_argument("--embedding-url", help="without it a digest stands in for embeddings")
    ingest.add_argument("--embedding-model", default="")
    for step in (clean, ingest):
        step.add_argument("--rejects-dir", default="data/rejects", help="folder for the list of files that were left out")
    for step in (chunk, ingest):
        step.add_argument("--disable-llm", action="store_true", help="never call a title service")
        step.add_argument("--log-dir", help="folder for records of service calls")
        step.add_argument("--title-url")
        step.add_argument("--title-model", default="")
    return parser


def _must_exist(path: str) -> None:
    if not any(c in path for c in "*?[{") and "://" not in path and not Path(path).exists():
        raise FileNotFoundError(path)


def _titles(args: argparse.Namespace) -> HttpTitles | None:
    return HttpTitles(args.title_url, args.title_model) if args.title_url and not args.disable_llm else None


def _one_supported(path: str) -> None:
    """A single named file of an unsupported kind is an error, in a folder it is a reject."""
    if Path(path).is_file() and Path(path).suffix.lower() not in files.KINDS:
        raise ValueError(f"Unsupported file extension: {Path(path).suffix or '<none>'}")


def _refuse(rejects: DataFrame, path: str, folder: str) -> None:
    """Add the files that were left out to JSON lines in `folder`; a single named file is an error."""
    first = rejects.first()
    if first is None:
        return
    if Path(path).is_file():
        raise ValueError(first.error)
    rejects.write.mode("append").json(folder)
    LOG.error("files left out: %s, named in %s", rejects.count(), folder)


def run_clean(spark: SparkSession, args: argparse.Namespace) -> None:
    _one_supported(args.input_file)
    with staged(spark) as copies:
        cleaned = clean_files(spark, args.input_file, copies.written_once)
        _refuse(cleaned.rejects, args.input_file, args.rejects_dir)
        jsonl.write_clean_texts(cleaned.documents, args.output_dir)


def run_chunk(spark: SparkSession, args: argparse.Namespace) -> None:
    texts = files.read_clean_texts(spark, args.input_file)
    if args.document_id:
        texts = texts.withColumn("document_id", F.lit(args.document_id))
    documents = files.with_titles(texts, title=args.title)
    with staged(spark) as copies:
        batches = chunk_batches(documents, _titles(args), log_path=args.log_dir, keep=copies.written_once)
        jsonl.write_chunks(batches_to_chunks(batches), args.output_dir)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    _one_supported(args.input_file)
    meta = None
    if args.meta_file and not args.title:
        _must_exist(args.meta_file)
        meta = files.read_meta(spark, args.meta_file)
        if not meta.where(~F.col("valid")).isEmpty():
            raise ValueError(f"Unable to parse metadata JSON: {args.meta_file}")
        if args.document_id or Path(args.input_file).is_file():
            own = args.document_id or Path(args.input_file).stem
            meta = meta.withColumn("document_id", F.lit(own))
    embedder = (
        HttpEmbedder(args.embedding_url, args.embedding_model, dimension=args.dimension)
        if args.embedding_url
        else DigestEmbedder(args.dimension)
    )
    report, rejects = ingest_files(
        spark,
        args.input_file,
        embedder,
        ChunkTable(spark, args.table, args.dimension),
        document_id=args.document_id,
        title=args.title or None,
        meta=meta,
        titles=_titles(args),
        clean_path=args.clean_output_dir,
        chunks_path=args.chunks_output_dir,
        dead_letter_path=args.dead_letter_dir,
        log_path=args.log_dir,
        batch_size=args.loader_batch_size,
    )
    LOG.info("total=%s succeeded=%s failed=%s", report.total, report.succeeded, report.failed)
    _refuse(rejects, args.input_file, args.rejects_dir)


# Exit codes per step for a missing file, bad input, a failed load, anything else.
EXIT_CODES = {"clean": (1, 2, 3, 3), "chunk": (1, 2, 2, 2), "ingest": (1, 2, 4, 3)}
_STEPS = {"clean": run_clean, "chunk": run_chunk, "ingest": run_ingest}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = _parser().parse_args(argv)
    missing, invalid, load, other = EXIT_CODES[args.step]
    try:
        _must_exist(args.input_file)
        _STEPS[args.step](spark or SparkSession.builder.getOrCreate(), args)
    except FileNotFoundError:
        LOG.exception("input not found")
        return missing
    except ValueError:
        LOG.exception("invalid input")
        return invalid
    except (ProviderError, TableError):
        LOG.exception("loading failed")
        return load
    except (PySparkException, Exception):
        LOG.exception("unexpected error")
        return other
    return 0


if __name__ == "__main__":
    sys.exit(main())
