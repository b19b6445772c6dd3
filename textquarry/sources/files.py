"""Document files: names, kinds, decoding and titles."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import universal_newlines
from . import folders

# Which suffix is cleaned how, and signs with which a path names several.
_PATTERN = "*?[]{}\\"
KINDS = {".pdf": "pdf", ".html": "html", ".htm": "html", ".md": "markdown", ".markdown": "markdown"}


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*\z", 1)


def suffix(path: Column) -> Column:
    """Last dot and what follows, unless the dot is first or last in the name."""
    return F.regexp_extract(file_name(path), r"(?s)\A.+(\.[^.]+)\z", 1)


def stem(path: Column) -> Column:
    name = file_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix(path)))


def file_kind(path: Column) -> Column:
    """How a file is cleaned; null for an unsupported suffix."""
    found = F.lower(suffix(path))
    kind = F.lit(None).cast("string")
    for ending, name in KINDS.items():
        kind = F.when(found == ending, name).otherwise(kind)
    return kind


def document_id(path: Column, explicit: Column | None = None) -> Column:
    """The explicit id where there is one, else the file stem."""
    own = stem(path)
    return own if explicit is None else F.coalesce(F.nullif(explicit, F.lit("")), own)


def unsupported(path: Column) -> Column:
    return F.concat(
        F.lit("Unsupported file extension: "), F.coalesce(F.nullif(suffix(path), F.lit("")), F.lit("<none>"))
    )


def scan(spark: SparkSession, paths: str | list[str], *kinds: str) -> DataFrame:
    """`(path, document_id, content)` of the files of some kinds.

    The name filter works on the listing, so files of other kinds are not opened.
    """

    def any_case(text: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)

    endings = ",".join(any_case(e) for e, k in KINDS.items() if k in kinds)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{{{endings}}}").load(paths)
    return files.where(file_kind(F.col("path")).isin(*kinds)).select(
        "path", document_id(F.col("path")).alias("document_id"), "content"
    )


def rejects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`(path, error)` of files with a suffix no cleaner takes; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
    return files.where(file_kind(F.col("path")).isNull()).select(
        "path", unsupported(F.col("path")).alias("error")
    )


@F.arrow_udf(T.StringType())
def _decode_ignoring(content: pa.Array) -> pa.Array:
    decoded = [None if b is None else b.decode("utf-8", "ignore") for b in content.to_pylist()]
    return pa.array(decoded, type=pa.string())


def decode_text(content: Column) -> Column:
    """UTF-8 text of a file, invalid bytes dropped, line ends as in text mode.

    Only files that are not valid UTF-8 are handed to Python.
    """
    as_text = content.cast("string")
    valid = F.is_valid_utf8(as_text)
    repaired = _decode_ignoring(F.when(~valid, content))
    return universal_newlines(F.when(valid, as_text).otherwise(repaired))


def decode_strict(content: Column) -> Column:
    """UTF-8 text of a file; an invalid one fails the query."""
    return universal_newlines(F.validate_utf8(content.cast("string")))


def read_markdown(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = scan(spark, paths, "markdown")
    return files.select("path", "document_id", decode_text(F.col("content")).alias("clean_text"))


def read_html(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = scan(spark, paths, "html")
    return files.select("path", "document_id", decode_text(F.col("content")).alias("html"))


def read_clean_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files written by the cleaning step, decoded strictly.

    A folder on a file system of the machine's own is listed and read by tasks: Spark would hold each file on the driver and take 32 of them to a task.
    """
    folder = folders.local_path(spark, paths) if isinstance(paths, str) else None
    if folder is not None and os.path.isdir(folder) and not set(folder) & set(_PATTERN):
        files = folders.read_files(spark, folder)
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    # The cleaning step has a folder `document_id=...` for each document, named with %XX for special signs.
    named = F.regexp_extract("path", "/document_id=([^/]+)/[^/]+$", 1)
    own = F.nullif(F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B"))), F.lit(""))
    return files.select(
        "path",
        F.coalesce(own, document_id(F.col("path"))).alias("document_id"),
        decode_strict(F.col("content")).alias("clean_text"),
    )


def read_meta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`(document_id, title, valid)` from JSON files named after their documents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).withColumn("value", decode_text(F.col("content")))
    return files.select(
        document_id(F.col("path")).alias("document_id"),
        F.get_json_object("value", "$.title").alias("title"),
        F.try_parse_json("value").isNotNull().alias("valid"),
    )


def effective_title(explicit: Column, meta: Column, document: Column) -> Column:
    """An explicit title wins; metadata counts only without one, and an empty choice gives the id."""
    return F.coalesce(F.nullif(F.coalesce(explicit, meta), F.lit("")), document)


def with_titles(documents: DataFrame, meta: DataFrame | None = None, title: str | None = None) -> DataFrame:
    """Add `title` to documents from one explicit title, or from a table of them, or from the id.

    Of several titles for one id the last in order is taken, so documents never multiply.
    """
    explicit = F.lit(title).cast("string")
    if meta is None:
        none = F.lit(None).cast("string")
        return documents.withColumn("title", effective_title(explicit, none, F.col("document_id")))
    known = meta.groupBy("document_id").agg(F.max("title").alias("_meta"))
    return (
        documents.join(known, "document_id", "left")
        .withColumn("title", effective_title(explicit, F.col("_meta"), F.col("document_id")))
        .drop("_meta")
    )


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows over all cores where the input has fewer splits than that, rows with the same `keys` to one task.

    Cleaning and chunking cost far more than moving the text once; an input of
    ordinary size has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
