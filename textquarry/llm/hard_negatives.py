"""Hard negatives by a secondary sort: one shuffle that sorts pairs by anchor, descending score and id, read as a stream.

Anchors lie in blocks of some ANCHORS, each broadcast. A task scores its rows against a block, TILE rows at a time, as a product of integer
matrices. A first pass finds the positives of each anchor from the best of each task. In the second pass a task sends, for each
anchor, the positives that it has and of its negatives those that come first in the window of some positive; no other can be an answer.
Keys of twenty bytes hold anchor, falling score and id, so that their order as bytes is the order wanted. After
repartitionAndSortWithinPartitions an iterator reads each anchor's pairs from the highest score down: a positive opens a window, a negative is given
out for each window that it lies in and that is not full, and nothing but the open windows is held.

Defined cases: rows without vec_id, label or vector, or with a component that is null, NaN or infinite, take no part; of rows with one vec_id
the one with the smallest (label, vector) does; a shorter vector counts as zero where it ends; a positive below zero has an empty window;
components whose products may exceed 2^62 over TILE are an error; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textquarry.sources.staging import staged, written_once

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
ANCHORS, TILE = 2048, 1024
EVERY = 100

_KEY = ">IQQ"
_LEAST = np.iinfo(np.int64).min
_ANSWER = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


class Block(NamedTuple):
    """Anchors: ids, labels and vectors, a row each; once known, positives as three columns: anchor, score, id."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positives: np.ndarray


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and whole-number vector of the rows that take part."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.select("vec_id", moved.alias("label"), F.transform("embedding", lambda x: F.floor(x * 256)).alias("vector"))
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    sizes = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy()
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b, exact."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    most = n * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= (1 << 62) // TILE:
        raise ValueError("components are too large for scores of 64 bits")
    return a @ b.T


def _highest(score: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the n highest chosen scores, of equal ones the first columns: rows and columns."""
    many = score.shape[1]
    code = np.where(chosen, score * many + (many - 1 - np.arange(many)), _LEAST)
    if many > n:
        cut = np.partition(code, many - n, axis=1)[:, many - n : many - n + 1]
        return np.nonzero((code >= cut) & chosen)
    return np.nonzero(chosen)


def _cut(found: np.ndarray, n: int) -> np.ndarray:
    """The first n of each anchor by falling score and rising id. found: anchor, score and id in columns."""
    found = found[np.lexsort((found[:, 2], -found[:, 1], found[:, 0]))]
    first = np.searchsorted(found[:, 0], found[:, 0])
    return found[np.arange(len(found)) - first < n]


def _tiles(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some rows at a time: their ids, ascending; scores with the anchors; who is a possible positive, who a negative."""
    for batch in batches:
        for i in range(0, batch.num_rows, TILE):
            tile = batch.slice(i, TILE)
            order = np.argsort(tile.column("vec_id").to_numpy())
            ids = tile.column("vec_id").to_numpy()[order]
            same = block.labels[:, None] == tile.column("label").to_numpy()[order]
            score = scores(block.vectors, _matrix(tile.column("vector"))[order])
            yield ids, score, same & (block.ids[:, None] != ids), ~same


def _positive_batches(told: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, 3), np.int64)
        for ids, score, positive, _ in _tiles(told.value, batches):
            a, r = _highest(score, positive, POSITIVES)
            best = _cut(np.concatenate([best, np.stack([a, score[a, r], ids[r]], 1)]), POSITIVES)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.T], names=["anchor", "score", "id"])

    return run


def bounds(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score of a negative, as whole numbers; an empty window is one upside down."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def _pair_batches(told: Broadcast):
    """Keys, and whether the pair is a positive one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = told.value
        anchor, value, _ = block.positives.T
        # The k-th positive of all anchors that have so many.
        kth = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        first = [np.zeros((0, 3), np.int64)] * POSITIVES
        found = []
        for ids, score, positive, negative in _tiles(block, batches):
            known = np.zeros(positive.shape, bool)
            at = np.minimum(np.searchsorted(ids, block.positives[:, 2]), len(ids) - 1)
            hit = ids[at] == block.positives[:, 2]
            known[anchor[hit], at[hit]] = True
            a, r = np.nonzero(known & positive)
            found.append(np.stack([a, score[a, r], ids[r], np.ones(len(a), np.int64)], 1))
            for k in range(POSITIVES):
                own = anchor[kth == k]
                if not len(own):
                    continue
                low, high = bounds(value[kth == k])
                part = score[own]
                within = negative[own] & (part >= low[:, None]) & (part <= high[:, None])
                a, r = _highest(part, within, NEGATIVES)
                first[k] = _cut(np.concatenate([first[k], np.stack([own[a], part[a, r], ids[r]], 1)]), NEGATIVES)
        negatives = np.unique(np.concatenate(first), axis=0)
        rows = np.concatenate([*found, np.c_[negatives, np.zeros(len(negatives), np.int64)]])
        keys = [struct.pack(_KEY, a, (1 << 63) - 1 - s, i + (1 << 63)) for a, s, i, _ in rows.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(rows[:, 3] > 0)], names=["key", "positive"])

    return run


def mined(pairs: Iterator[tuple[bytes, bool]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Read sorted pairs; give anchor, positive, rank, negative and the scores of both."""
    now, positives, windows, zeros = None, 0, [], []
    for key, positive in pairs:
        anchor, fall, up = struct.unpack(_KEY, key)
        score, i = (1 << 63) - 1 - fall, up - (1 << 63)
        if anchor != now:
            now, positives, windows, zeros = anchor, 0, [], []
        if positive:
            positives += 1
            if positives > POSITIVES or score < 0:
                continue
            window = [i, score, 0]
            windows.append(window)
            # Only a window at zero can hold scores as high as its positive's, which may have come before it by their ids.
            for other in zeros if score == 0 else []:
                window[2] += 1
                yield anchor, i, window[2], other, 0, 0
            continue
        if score == 0 and len(zeros) < NEGATIVES:
            zeros.append(i)
        for window in windows:
            p, above, many = window
            if many < NEGATIVES and LOW * above <= 100 * score <= HIGH * above:
                window[2] += 1
                yield anchor, p, many + 1, i, above, score


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    spark = embeddings.sparkSession
    with staged(spark) as copies:
        rows = copies.written_once(prepared(embeddings), "vectors")
        anchors = rows.filter(F.col("vec_id") % EVERY == 0)
        blocks = -(-anchors.count() // ANCHORS)
        answers = spark.createDataFrame([], _ANSWER)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for b in range(blocks):
            chosen = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
            if not chosen.num_rows:
                continue
            ids, labels = (chosen.column(c).to_numpy() for c in ("vec_id", "label"))
            vectors = _matrix(chosen.column("vector").combine_chunks())
            told = spark.sparkContext.broadcast(Block(ids, labels, vectors, np.zeros((0, 3), np.int64)))
            each = rows.mapInArrow(_positive_batches(told), "anchor bigint, score bigint, id bigint")
            order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
            best = each.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= POSITIVES)
            best = best.select("anchor", "score", "id").orderBy("anchor", "k").toArrow()  # POSITIVES an anchor
            positives = np.stack([best.column(c).to_numpy() for c in ("anchor", "score", "id")], 1)
            ranked = spark.sparkContext.broadcast(Block(ids, labels, vectors, positives))
            pairs = rows.mapInArrow(_pair_batches(ranked), "key binary, positive boolean")
            dealt = pairs.rdd.map(lambda r: (bytes(r[0]), r[1])).repartitionAndSortWithinPartitions(
                tasks, lambda key: int.from_bytes(key[:4], "big")
            )
            names = spark.sparkContext.broadcast(ids)
            lines = dealt.mapPartitions(lambda part, names=names: ((int(names.value[x[0]]), *x[1:]) for x in mined(part)))
            answers = answers.union(copies.written_once(spark.createDataFrame(lines, _ANSWER), "negatives"))
            for held in (told, ranked, names):
                held.destroy()
        return written_once(answers, "hard-negatives")
