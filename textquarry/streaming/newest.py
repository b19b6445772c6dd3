"""The newest version of every document, kept from trigger to trigger."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Newest(StatefulProcessor):
    """Per key: version and digest of the newest row so far. A trigger passes on its newest row if that one is newer."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "version bigint, digest string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self.seen.get()
        newest, best = tuple(before) if before is not None else None, None
        for row in rows:  # a stream: a key's rows are never held together
            at = row["_version"], row["_digest"]
            if newest is None or at > newest:
                newest, best = at, row
        if best is not None:
            self.seen.update(newest)
            yield Row(**{c: best[c] for c in self.columns})

    def close(self) -> None:
        pass


def newest_versions(
    spark: SparkSession, inbox: str, schema: str, target: str, checkpoint: str, by: str, version: str, files_at_once: int | None = None
) -> None:
    """Reads the Parquet files in `inbox` that are new since the last run and adds to `target` the rows that make a document newer.

    `version` is an integer; of rows with one version the one with the larger digest counts, so the order of arrival changes nothing. A row that comes late,
    after a newer one, is dropped in whatever trigger it comes: the state holds a version and a digest per document, no
    text, and forgets none. Rows without key or version are left out. `current` reads what counts from `target`. A run
    that broke off is repeated from the checkpoint and adds its rows once.
    """
    source = spark.readStream.schema(schema)
    if files_at_once:
        source = source.option("maxFilesPerTrigger", files_at_once)
    rows = source.parquet(inbox)
    kind = rows.schema
    arrivals = rows.where(F.col(by).isNotNull() & F.col(version).isNotNull()).select(
        F.col(by).alias("_key"),
        F.col(version).cast("bigint").alias("_version"),
        F.sha2(F.to_json(F.struct(*rows.columns)), 256).alias("_digest"),
        *rows.columns,
    )
    newer = arrivals.groupBy("_key").transformWithState(_Newest(rows.columns), StructType(kind.fields), "append", "none")
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        run = (
            newer.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def current(spark: SparkSession, target: str, schema: str, by: str, version: str) -> DataFrame:
    """Of every document the newest row that newest_versions() has written."""
    rows = spark.read.schema(schema).parquet(target)
    digest = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    newest = F.max_by(F.struct(*rows.columns), F.struct(F.col(version), digest))
    return rows.groupBy(F.col(by).alias("_key")).agg(newest.alias("_row")).select("_row.*")
