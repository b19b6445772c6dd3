"""Token totals by source, language and tokenizer version, maintained by signed batches.

A batch holds inserts, deletes and revised counts. It is reduced to additive sums per group with partial aggregation, and these are
written as one folder named by the batch; the batch counts once Spark's writer has put its success mark there.
Committing a batch again changes nothing, and one that was interrupted is written anew. Totals are sums over
committed batches; compaction folds them into one base that names the batches in it, so a reader sees each batch once
at every moment.

Defined cases: null sources and languages are groups of their own; a null count counts as 0; a null operation or one that is not known is an
error; groups whose documents and tokens are all gone stay with zeros; an empty batch is a batch; repeated rows count
each time; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import slices, words
from textquarry.llm.pieces import unit_tokens
from textquarry.sources.staging import delete_path, staged, staging_path, written_once

GROUPS = ("source", "lang", "tokenizer_version")
SUMS = "source string, lang string, tokenizer_version string, documents bigint, tokens bigint"
BASE = SUMS + ", batches array<string>"
#: Versions of the counts: words between white space, and word pieces.
WORDS, PIECES = "words-1", "word-bpe-49k-1"
#: Batches in which documents arrive.
PARTS = 4


def _counts(docs: DataFrame, tokenizer_file: str | None) -> DataFrame:
    """source, lang, part, words and pieces of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text")
            kept = [batch.column(c) for c in ("source", "lang", "part")]
            sizes = [np.diff(words(texts).offsets), unit_tokens(tokenizer_file).sizes(texts)]
            columns = [*kept, *(pa.array(x, pa.int64()) for x in sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["source", "lang", "part", "words", "pieces"])

    schema = "source string, lang string, part int, words bigint, pieces bigint"
    return docs.select("source", "lang", "part", "text").mapInArrow(run, schema)


def changes(rows: DataFrame, operation: str, n_tokens: Column | str = "n_tokens", old: Column | None = None) -> DataFrame:
    """Rows of a batch: operation insert, delete or revise, the count, and for revise the count before."""
    n = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    before = F.lit(0) if old is None else old
    return rows.select(*GROUPS, F.lit(operation).alias("operation"), n.alias("n_tokens"), before.alias("old_n_tokens"))


class TokenRollup:
    """Totals below a folder of the shared store; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _names(self, part: str) -> list[str]:
        """Committed folders of a part. Batches since the last compaction, which their number bounds."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        made = [x.getPath() for x in fs.listStatus(path)]
        mark = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(x.getName() for x in made if fs.exists(mark(x, "_SUCCESS")))

    def _base(self) -> DataFrame | None:
        names = self._names("base")
        return self.spark.read.schema(BASE).parquet(f"{self.folder}/base/{names[-1]}") if names else None

    def batches(self) -> set[str]:
        """Names of all batches that count."""
        base = self._base()
        row = None if base is None else base.select("batches").first()
        return set(self._names("batches")) | set(row[0] if row else ())

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add a batch, rows as changes() gives them; False if it had been committed already."""
        name = quote(batch, safe="")
        if name in self.batches():
            return False
        n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_n_tokens", F.lit(0))
        operation = F.col("operation")
        wrong = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(operation, F.lit("null")))).cast("long")
        tokens = (
            F.when(operation == "insert", n).when(operation == "delete", -n).when(operation == "revise", n - old).otherwise(wrong)
        )
        documents = F.when(operation == "insert", 1).when(operation == "delete", -1).otherwise(0)
        sums = rows.groupBy(*GROUPS).agg(
            F.sum(documents).cast("long").alias("documents"), F.sum(tokens.cast("long")).alias("tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.folder}/batches/{name}")
        return True

    def totals(self) -> DataFrame:
        base = self._base()
        row = None if base is None else base.select("batches").first()
        held = set(row[0] if row else ())
        new = [f"{self.folder}/batches/{x}" for x in self._names("batches") if x not in held]
        parts = [] if base is None else [base.filter("documents IS NOT NULL").drop("batches")]
        if new:
            parts.append(self.spark.read.schema(SUMS).parquet(*new))
        if not parts:
            return self.spark.createDataFrame([], SUMS)
        rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        return rows.groupBy(*GROUPS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def compact(self) -> None:
        """Fold all committed batches into a new base, then delete what it replaces. It may end anywhere and be run again."""
        names = sorted(self.batches())
        old = self._names("base")
        listed = F.array(*(F.lit(x) for x in names)).cast("array<string>")
        number = int(old[-1]) + 1 if old else 1
        rows = self.totals().withColumn("batches", listed)
        mark = self.spark.range(1).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[:-1]), listed.alias("batches")
        )
        rows.union(mark).write.mode("overwrite").parquet(f"{self.folder}/base/{number:012d}")
        for path in [*(f"base/{x}" for x in old), *(f"batches/{x}" for x in self._names("batches") if x in names)]:
            delete_path(self.spark, f"{self.folder}/{path}")


def history(counts: DataFrame) -> list[tuple[str, DataFrame]]:
    """Batches by name, in order, after which the totals are those of `counts` (source, lang, part, words, pieces).

    The documents arrive in PARTS batches, with their words as preliminary counts of pieces, too; then the counts of pieces are
    revised; then those of one part are withdrawn, and restored.
    """

    def version(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumn("tokenizer_version", F.lit(name))

    def both(rows: DataFrame, operation: str, pieces: str) -> DataFrame:
        return changes(version(rows, WORDS), operation, "words").union(changes(version(rows, PIECES), operation, pieces))

    arrivals = [(f"arrivals/{i}", both(counts.where(F.col("part") == i), "insert", "words")) for i in range(PARTS)]
    revised = changes(version(counts, PIECES), "revise", "pieces", F.col("words"))
    last = counts.where(F.col("part") == PARTS - 1)
    changed = [("revised", revised), ("withdrawn", both(last, "delete", "pieces")), ("restored", both(last, "insert", "pieces"))]
    return [*arrivals, *changed]


def token_totals(docs: DataFrame, folder: str | None = None, tokenizer_file: str | None = None) -> DataFrame:
    """Totals of all documents, maintained through the batches of `history`, each committed twice, and compactions.

    With a folder the rollup stays there, and asking again for the same documents changes nothing.
    """
    spark = docs.sparkSession
    rollup = TokenRollup(spark, folder or staging_path(spark, "token-rollup"))
    try:
        with staged(spark) as copies:
            parted = docs.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int"))
            counts = copies.written_once(_counts(parted, tokenizer_file), "token-counts")
            for name, rows in history(counts):
                rollup.commit(name, rows)
                rollup.commit(name, rows)
                if name == "revised":
                    rollup.compact()
        rollup.compact()
        return rollup.totals() if folder else written_once(rollup.totals(), "token-totals")
    finally:
        if not folder:
            delete_path(spark, rollup.folder)
