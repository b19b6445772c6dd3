"""Ranked lexical search by hashed max-sketches.

A term's impact in a document is what it adds to a score for a weight of one. A document's sketch has CELLS cells; its terms are dealt over
them by hash, and a cell holds the largest impact of its terms. The weights of an item's terms times the cells that they hash to are no less
than the document's score; for a batch of documents and all items of a block that is one product of matrices. The documents of a batch are
scored exactly in descending order of this bound, some at a time, until the next bound is below the item's LIMIT-th best score so far.

Tasks keep the best of what they have seen; these are merged for groups of tasks, then all. Items lie in blocks of some BLOCK_ITEMS items and
BLOCK_TERMS terms, each broadcast for two passes over the documents: one counts documents, terms and in how many documents an item's term is,
the other ranks. Only a single larger item makes a larger block.

Defined cases: a null text has no terms; documents without terms and items without terms have no rows; a null doc_id comes last among
equal scores; rows with one doc_id rank one by one, and so do benchmark rows with one item_id or none, each with ranks of its own; empty
tables give an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import row_of, separators, slices, words
from textquarry.sources.staging import staged, written_once

LIMIT = 20
CELLS = 1024
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 18
#: Documents scored exactly at a time, tasks whose best are merged first.
AT_ONCE, TASKS = 64, 256
#: What rounding to 32 bits may take from a bound.
SLACK = 1.001

#: All of ASCII but letters and digits separates terms.
TABLE = separators(bytes(x for x in range(128) if not chr(x).isalnum()))

_BEST = "item bigint, doc_id bigint, score bigint"


class Items(NamedTuple):
    """A block of items. terms: all their terms as hashes, ascending; item i has terms which[i], how_often[i] times each."""

    number: np.ndarray
    terms: np.ndarray
    which: list[np.ndarray]
    how_often: list[np.ndarray]


class Weighted(NamedTuple):
    """A block with what the corpus says: weights of its terms, and the counts of documents and of all terms."""

    items: Items
    weight: np.ndarray
    documents: int
    length: int


def _terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different terms of each text: rows, hashes and how often; and the number of terms of each row."""
    found = words(batch.column("text"), TABLE)
    row = row_of(found.offsets)
    order = np.lexsort((found.hashes, row))
    row, hashes = row[order], found.hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return row[first], hashes[first], np.diff(first, append=len(row)), np.diff(found.offsets)


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        row, hashes, often, _ = _terms(batch)
        cuts = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (hashes.view(np.int64), often.astype(np.int64))]
        yield pa.RecordBatch.from_arrays([batch.column("item"), *lists], names=["item", "hashes", "often"])


def _place(terms: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where hashes are in `terms`, and which are there at all."""
    at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
    return at, terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)


def _count_batches(block: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = block.value.terms
        within, documents, length = np.zeros(len(terms), np.int64), 0, 0
        for batch in slices(batches):
            _, hashes, _, sizes = _terms(batch)
            at, known = _place(terms, hashes)
            np.add.at(within, at[known], 1)
            documents, length = documents + int((sizes > 0).sum()), length + int(sizes.sum())
        used = np.flatnonzero(within)
        # -1 and -2 stand for the documents and all their terms.
        columns = [np.r_[used, -1, -2].astype(np.int64), np.r_[within[used], documents, length].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "number"])

    return run


def impacts(often: np.ndarray, size: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What terms add to a score for a weight of one; size: the terms of their documents."""
    m = 75 + (25 * size * documents) // length
    return (1_000_000_000 * often) // (1000 * often + 12 * m)


class _Best:
    """The best documents of each item of a block, of those seen so far."""

    def __init__(self, weighted: Weighted):
        self.weighted = weighted
        items = weighted.items
        self.score: list[np.ndarray] = [np.zeros(0, np.int64) for _ in items.number]
        self.doc: list[np.ndarray] = [np.zeros((0, 2), np.int64) for _ in items.number]
        cell = (items.terms % np.uint64(CELLS)).astype(np.int64)
        bound = np.zeros((CELLS, len(items.number)))
        self.by_term = []
        for i, (which, often) in enumerate(zip(items.which, items.how_often, strict=True)):
            w = weighted.weight[which] * often
            np.add.at(bound[:, i], cell[which], w)
            self.by_term.append(w)
        self.bound = bound.astype(np.float32)

    def add(self, batch: pa.RecordBatch) -> None:
        weighted = self.weighted
        row, hashes, often, sizes = _terms(batch)
        if not len(row):
            return
        impact = impacts(often, sizes[row], weighted.documents, weighted.length)
        sketch = np.zeros(batch.num_rows * CELLS, np.float32)
        np.maximum.at(sketch, row * CELLS + (hashes % np.uint64(CELLS)).astype(np.int64), impact.astype(np.float32))
        bounds = (sketch.reshape(-1, CELLS) @ self.bound).astype(np.float64) * SLACK
        # What is exact: the documents' terms that any item has.
        at, known = _place(weighted.items.terms, hashes)
        at, impact, row = at[known], impact[known], row[known]
        cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
        ids = batch.column("doc_id")
        doc = np.stack([ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()], 1)
        own = np.zeros(len(weighted.items.terms), np.int64)
        for i, which in enumerate(weighted.items.which):
            least = self.score[i][-1] if len(self.score[i]) == LIMIT else 1
            open_ = np.flatnonzero(bounds[:, i] >= least)
            if not len(open_):
                continue
            open_ = open_[np.argsort(-bounds[open_, i], kind="stable")]
            own[which] = self.by_term[i]
            for k in range(0, len(open_), AT_ONCE):
                some = open_[k : k + AT_ONCE]
                if len(self.score[i]) == LIMIT and bounds[some[0], i] < self.score[i][-1]:
                    break
                many = cuts[some + 1] - cuts[some]
                there = np.repeat(cuts[some] - np.cumsum(many) + many, many) + np.arange(many.sum())
                sums = np.zeros(len(some), np.int64)
                np.add.at(sums, np.repeat(np.arange(len(some)), many), own[at[there]] * impact[there])
                self._take(i, sums[sums > 0], doc[some][sums > 0])
            own[which] = 0

    def _take(self, i: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.r_[self.score[i], score], np.concatenate([self.doc[i], doc])
        order = np.lexsort((doc[:, 1], doc[:, 0], -score))[:LIMIT]
        self.score[i], self.doc[i] = score[order], doc[order]

    def rows(self) -> pa.RecordBatch:
        number = np.repeat(self.weighted.items.number, [len(s) for s in self.score])
        doc = np.concatenate([np.zeros((0, 2), np.int64), *self.doc])
        score = np.concatenate([np.zeros(0, np.int64), *self.score])
        columns = [pa.array(number), pa.array(doc[:, 1], mask=doc[:, 0] > 0), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


def _best_batches(weighted: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(weighted.value)
        for batch in slices(batches):
            best.add(batch)
        yield best.rows()

    return run


def _block(items: DataFrame) -> Items:
    found = items.collect()
    hashes = [np.array(r["hashes"], np.int64).view(np.uint64) for r in found]
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    return Items(
        np.array([r["item"] for r in found], np.int64),
        terms,
        [np.searchsorted(terms, h) for h in hashes],
        [np.array(r["often"], np.int64) for r in found],
    )


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    """The best LIMIT rows of each value of keys; their tasks send no more than these."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= LIMIT)


def best_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the LIMIT documents with the highest scores above 0 for each item."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with staged(spark) as copies:
        asked = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
        asked = copies.written_once(asked.withColumn("item", F.monotonically_increasing_id()), "items")
        items = asked.select("item", "text").mapInArrow(_item_batches, "item bigint, hashes array<bigint>, often array<bigint>")
        items = copies.written_once(items.filter(F.size("hashes") > 0), "item-terms")
        number, terms = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
        blocks = max(-(-number // BLOCK_ITEMS), -(-terms // BLOCK_TERMS))
        best = spark.createDataFrame([], _BEST)
        for b in range(blocks):
            block = _block(items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b))
            told = spark.sparkContext.broadcast(block)
            counts = texts.mapInArrow(_count_batches(told), "term bigint, number bigint").groupBy("term").agg(F.sum("number"))
            counts = dict(tuple(r) for r in counts.collect())  # as many as the block has terms
            documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
            if documents:
                within = np.zeros(len(block.terms), np.int64)
                within[list(counts)] = list(counts.values())
                weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * within + 1))).astype(np.int64)
                ranked = spark.sparkContext.broadcast(Weighted(block, weight, documents, length))
                rows = texts.mapInArrow(_best_batches(ranked), _BEST).withColumn("tasks", (F.spark_partition_id() / TASKS).cast("int"))
                rows = _first(_first(rows, "item", "tasks"), "item")
                best = best.union(copies.written_once(rows.select("item", "doc_id", "score"), "best"))
                ranked.destroy()
            told.destroy()
        rows = _first(best, "item").join(asked.select("item", "item_id"), "item")
        return written_once(rows.select("item_id", "rank", "doc_id", "score"), "ranked")
