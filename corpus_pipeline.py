"""A training corpus from a table of documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes it as Parquet to the shared folder and reads it again
as the next stage's documents.

Each stage sets how many bytes Spark sends to Python at once, for as long as the session lives, since a stage's result is read after it has
returned. What the JVM and a Python worker hold for a task goes by that, not by how many rows a partition has; results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textquarry.llm import decontaminate, language_id, mixing, near_copies, token_files
from textquarry.sources.staging import staged

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A batch is over with the row that reaches so many bytes: a little less than two of near_copies' packs.
BATCH = 15 << 18


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters and those in no language that was learned go."""
    return language_id.with_language(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that 5-word shingles with a similarity of 0.8 or more link, or op2's fingerprints, the document with the smallest id stays."""
    return near_copies.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their weights; what an epoch takes of a document is one row."""
    return mixing.mixed_texts(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files, and what they hold of each row."""
    return token_files.token_files(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_batches(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(ARROW_BYTES, str(BATCH))
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _in_batches(with_language)),
    ("near_dedup", _in_batches(without_near_copies)),
    ("decontamination", _in_batches(without_benchmark)),
    ("mixing", _in_batches(mixed)),
    ("token_ids", _in_batches(token_ids)),
]

#: Fingerprints, tiling and tokens are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. The stages' tables are deleted, each when its successor is written."""
    with staged(spark) as copies:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = copies.written_once(stage(spark, docs, sf_dir), name)
            copies.delete(keep=1)
        # The last stage has written its files when it returns; what it gives is read from them.
        return STAGES[-1][1](spark, docs, sf_dir)
