"""Windows over event times: sliding ones of fixed length, and sessions that end after a pause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sliding(events: DataFrame, by: str, time: str, width: str, step: str, *measures: Column) -> DataFrame:
    """`by`, window_start, window_end and the measures of each window of `width` that begins at a multiple of `step`.

    Events are aggregated per task before the shuffle, so a key with many events costs no more than others. Rows with a
    null time are in no window; null keys are one key.
    """
    each = events.groupBy(by, F.window(time, width, step).alias("_window")).agg(*measures)
    return each.select(
        by,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *(c for c in each.columns if c not in (by, "_window")),
    )


def sessions(events: DataFrame, by: str, time: str, pause: str, *measures: Column) -> DataFrame:
    """`by`, session_start, session_end (the last event and the pause) and the measures of each run of events at most `pause` apart.

    The same on tables and on streams with a watermark. Rows with a null time are in no session; null keys are one key.
    """
    each = events.groupBy(by, F.session_window(time, pause).alias("_window")).agg(*measures)
    return each.select(
        by,
        F.col("_window.start").alias("session_start"),
        F.col("_window.end").alias("session_end"),
        *(c for c in each.columns if c not in (by, "_window")),
    )


def write_sessions(
    spark: SparkSession,
    inbox: str,
    schema: str,
    target: str,
    checkpoint: str,
    by: str,
    time: str,
    pause: str,
    late: str,
    *measures: Column,
) -> None:
    """Adds to `target` the sessions that are over, of all Parquet files in `inbox` that are new since the last run.

    A session is over when an event later than its end by `late` was seen; until then it stays in the state, also from run to run, and events
    that come up to `late` after others join it or join two into one. Later ones are dropped. A run that broke off is repeated from
    the checkpoint and writes each session once. `close_sessions` ends those that are open.
    """
    events = spark.readStream.schema(schema).parquet(inbox).withColumn(time, F.col(time).cast("timestamp"))
    run = (
        sessions(events.withWatermark(time, late), by, time, pause, *measures)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def close_sessions(spark: SparkSession, inbox: str, schema: str, time: str, at: str) -> None:
    """Puts a row with nothing but a time into `inbox`; the next run writes all sessions that are over by then.

    The row opens a session of the null key itself, which is never over.
    """
    empty = spark.createDataFrame([], schema)
    columns = [F.lit(at if f.name == time else None).cast(f.dataType).alias(f.name) for f in empty.schema]
    spark.range(1).select(*columns).write.mode("append").parquet(inbox)
