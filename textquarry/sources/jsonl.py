"""Chunk rows as JSON lines, clean texts as files, and dead letters as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CHUNK
from . import folders
from .files import spread


#: Spark names the files of one write part-<task>-<id of the write>-c<file>.
_RUN = r"^part-\d+-([0-9a-f-]{36})-c\d+"


def read_chunks(spark: SparkSession, path: str | list[str], schema: T.StructType = CHUNK) -> DataFrame:
    """Chunk rows; blank lines are skipped and the schema is never inferred.

    Of a document that several runs of `write_chunks` have written, the newest run counts. Files of one run have its id in their names, and
    runs that follow one another are told apart by when their files were written; files of other origin count as the oldest run.

    Which files count is found first, from the document ids alone: files of which every document counts are read as they are, those of which none
    does not at all, and only the rows of files between the two are joined with the newest runs.
    """
    files = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = files.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_run": F.regexp_extract("_metadata.file_name", _RUN, 1),
            "_at": F.col("_metadata.file_modification_time"),
        }
    )
    last = F.max(F.struct(F.col("_run") != "", "_at", "_run"))["_run"].alias("_newest")
    newest = rows.groupBy(F.col("document_id").alias("_document")).agg(last)
    same = F.col("document_id").eqNullSafe(F.col("_document"))
    counts = F.col("_run") == F.col("_newest")
    held = rows.select("document_id", "_run", "_file").distinct()
    of_file = held.join(newest, same).groupBy("_file").agg(F.bool_and(counts).alias("whole"), F.bool_or(counts).alias("any"))
    found = of_file.where("any").collect()  # a name for each file, as the listing holds them

    def of(whole: bool) -> DataFrame:
        return rows.where(F.col("_file").isin([f["_file"] for f in found if f["whole"] == whole]))

    read = of(True).select(*schema.names)
    if all(f["whole"] for f in found):
        return read
    return read.unionAll(of(False).join(newest, same & counts, "left_semi").select(*schema.names))


def parse_lines(lines: DataFrame, schema: T.StructType = CHUNK) -> DataFrame:
    """The same from a column `value` of lines, for sources other than files."""
    return lines.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "").select(
        F.inline(F.array(F.from_json("value", schema, {"mode": "FAILFAST"})))
    )


def chunk_line(*columns: str) -> Column:
    return F.to_json(F.struct(*(columns or CHUNK.names)))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Add files with one JSON object per line; for `read_chunks` they replace what earlier runs have written of the same documents.

    Other documents in the folder stay. Non-ASCII text stays literal. A run that breaks off leaves no files that count.
    """
    chunks.select(*CHUNK.names).write.mode("append").json(path)


def write_clean_texts(documents: DataFrame, path: str) -> None:
    """One text file folder per document, `document_id=...`, replacing earlier ones.

    Making a file costs far more than moving its text, so an input of few splits is dealt out first. On a file system of the machine's own
    tasks make folders and files themselves: Hadoop would start a process for the rights of each, and move them one by one on the driver.
    """
    dealt = spread(documents.select("document_id", "clean_text"), "document_id")
    folder = folders.local_path(documents.sparkSession, path)
    if folder is not None:
        folders.write_texts(dealt, folder)
        return
    (
        dealt.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("lineSep", "\n")
        .partitionBy("document_id")
        .text(path)
    )


def read_written_texts(spark: SparkSession, path: str) -> DataFrame:
    """Clean texts back from `write_clean_texts`."""
    reader = spark.read.schema("value string, document_id string")  # else 007 would come back as 7
    files = reader.text(path, wholetext=True)
    return files.select(
        "document_id",
        F.regexp_replace("value", r"\n\z", "").alias("clean_text"),
    )


def write_dead_letters(letters: DataFrame, path: str) -> None:
    """Append text reports, a folder per document; each ends with an empty line."""
    reports = letters.select("document_id", F.regexp_replace("value", r"\n\z", "").alias("value"))
    reports.write.mode("append").option("lineSep", "\n").partitionBy("document_id").text(path)


def write_call_log(records: DataFrame, path: str) -> None:
    """Append service call records."""
    records.write.mode("append").json(path)
