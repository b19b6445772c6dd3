"""The nearest stored vectors by cosine, exact.

Queries lie in blocks of some BLOCK rows, each broadcast. A task scores its rows against a block, TILE rows at a time, as a product of
matrices, and keeps the best `k` of each query; what the tasks keep is merged. So no row is made for a pair of vectors, and all
pairs are looked at.

Cosines are rounded to DIGITS digits before they are ordered, ties by ascending id. Rows without id or vector, and vectors that are empty, hold a
null or no finite number, have no length, or have another dimension than the query, take no part. A query does not find its own id. Of
rows with one id each counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged, written_once

BLOCK, TILE = 2048, 2048
DIGITS = 9
_FOUND = "query bigint, id bigint, cosine double"


def _usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    named = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    kept = named.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).where(whole)
    return kept.withColumn("length", length).where((F.col("length") > 0) & (F.col("length") < float("inf")))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Unit vectors of one dimension."""
    values = batch.column("vector").flatten().to_numpy()
    return values.reshape(batch.num_rows, -1) / batch.column("length").to_numpy()[:, None]


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """The first k rows of each query. found: query, id and cosine in columns."""
    found = found[np.lexsort((found["id"], -found["cosine"], found["query"]))]
    first = np.searchsorted(found["query"], found["query"])
    return found[np.arange(len(found)) - first < k]


_ROW = np.dtype([("query", "i8"), ("id", "i8"), ("cosine", "f8")])


def _near_batches(told: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = told.value
        best = np.zeros(0, _ROW)
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                tile = batch.slice(i, TILE)
                sizes = tile.column("vector").value_lengths().to_numpy()
                tile = tile.filter(pa.array(sizes == units.shape[1]))
                if not tile.num_rows:
                    continue
                own = tile.column("id").to_numpy()
                cosine = np.round(units @ _matrix(tile).T, DIGITS)
                cosine[ids[:, None] == own] = -np.inf
                if len(own) > k:
                    least = np.partition(cosine, len(own) - k, axis=1)[:, len(own) - k]
                    q, r = np.nonzero((cosine >= least[:, None]) & np.isfinite(cosine))
                else:
                    q, r = np.nonzero(np.isfinite(cosine))
                new = np.empty(len(q), _ROW)
                new["query"], new["id"], new["cosine"] = q, own[r], cosine[q, r]
                best = _best(np.concatenate([best, new]), k)
        columns = [pa.array(ids[best["query"]]), pa.array(best["id"]), pa.array(best["cosine"] + 0.0)]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "cosine"])

    return run


def in_blocks(queries: DataFrame, k: int, part: Callable[[Broadcast], DataFrame]) -> DataFrame:
    """The k first of what `part` finds for each block of queries, told ids and unit vectors of one dimension."""
    spark = queries.sparkSession
    with staged(spark) as copies:
        asked = copies.written_once(queries.withColumn("dimension", F.size("vector")), "queries")
        found = spark.createDataFrame([], _FOUND)
        order = Window.partitionBy("query").orderBy(F.desc("cosine"), "id")
        for dimension, number in asked.groupBy("dimension").count().collect():
            blocks = -(-number // BLOCK)
            for b in range(blocks):
                chosen = asked.where((F.col("dimension") == dimension) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b))
                block = chosen.select("id", "vector", "length").toArrow().combine_chunks()
                if not block.num_rows:
                    continue
                told = spark.sparkContext.broadcast((block.column("id").to_numpy(), _matrix(block.to_batches()[0])))
                ranked = part(told).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                found = found.union(copies.written_once(ranked.select(*found.columns), "near"))
                told.destroy()
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return written_once(ranked.select("query", "rank", "id", "cosine"), "nearest")


def nearest(queries: DataFrame, rows: DataFrame, k: int, id_column: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """query, rank (from 1), id and cosine of the k nearest rows of each query; both tables have the id and the vector."""
    with staged(rows.sparkSession) as copies:
        stored = copies.written_once(_usable(rows, id_column, vector), "vectors")
        asked = _usable(queries, id_column, vector)
        return in_blocks(asked, k, lambda told: stored.mapInArrow(_near_batches(told, k), _FOUND))
