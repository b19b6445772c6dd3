"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits in lower case; punctuation, symbols and white space of ASCII separate them. Runs
of MIN_TILE tokens that a document shares with a benchmark item are the seeds; they are found by hash, with a bit table before the exact
look-up. For each seeded pair, the longest common run of unmarked tokens is marked as a tile on both sides, again
and again, until none of MIN_TILE tokens is left; runs of one length are compared by the differences of running
Karp-Rabin sums, and the longest length is found by bisection. The part of the item's tokens under tiles is its coverage.
Tiles may lie in any order, so passages in another order are caught as well.

Benchmarks are read in blocks of bounded size, each against all documents in one narrow pass: no shuffle of texts,
and what is broadcast never exceeds a block. Memory for a pair grows with the length of both texts, not with their product.

Defined cases: items with fewer than MIN_TILE tokens match where they occur whole; those without any never match; null texts have no
tokens; of equal runs the first in the item, then the first in the document is marked; repeated rows give repeated pairs;
an empty table on either side gives no pairs and drops no document; further columns are kept by `clean`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import PUNCTUATION, mixed, slices, words

MIN_TILE = 5
MIN_COVERAGE = 0.5
#: A block of benchmark items ends after so many tokens, or with the item that exceeds them.
BLOCK_TOKENS = 1 << 20
_BASE = 0x27D4EB2F165667C5
_BITS = 24


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, and the offsets of rows."""
    found = words(pc.utf8_lower(texts), PUNCTUATION)
    return found.hashes, found.offsets


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n values in a row, across row ends too."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + values[i : len(values) - n + 1 + i]
    return mixed(out)


class _Running:
    """Karp-Rabin sums of a sequence; windows(n) has the hash of each of its windows and whether it is unmarked."""

    def __init__(self, values: np.ndarray):
        powers = np.full(len(values) + 1, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(len(values) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.down = np.cumprod(inverse)
        self.sums = np.r_[np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(powers)[: len(values)])]
        self.marked = np.zeros(len(values), bool)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where unmarked windows of n begin, and their hashes."""
        if len(self.marked) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        taken = np.r_[0, np.cumsum(self.marked)]
        at = np.flatnonzero(taken[n:] == taken[:-n])
        return at, (self.sums[at + n] - self.sums[at]) * self.down[at]


def tiling(item: np.ndarray, doc: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles of two token sequences: begin in the item, begin in the document, length."""
    a, b = _Running(item), _Running(doc)
    tiles = []
    most = min(len(item), len(doc))

    def common(n: int) -> tuple[int, int] | None:
        at_a, in_a = a.windows(n)
        at_b, in_b = b.windows(n)
        shared = np.flatnonzero(np.isin(in_a, in_b))
        if not len(shared):
            return None
        first = shared[0]
        return int(at_a[first]), int(at_b[np.flatnonzero(in_b == in_a[first])[0]])

    while most >= least and (found := common(least)):
        low, high = least, most
        while low < high:
            mid = (low + high + 1) // 2
            if hit := common(mid):
                low, found = mid, hit
            else:
                high = mid - 1
        i, j = found
        tiles.append((i, j, low))
        a.marked[i : i + low] = True
        b.marked[j : j + low] = True
        most = low
    return tiles


class Block:
    """Benchmark items ready to be looked for."""

    def __init__(self, ids: list, sequences: list[np.ndarray], least: int):
        self.ids, self.sequences, self.least = ids, sequences, least
        self.lengths = sorted({min(least, len(s)) for s in sequences if len(s)})
        self.seeds = {}
        self.bits = np.zeros(1 << _BITS, bool)
        for n in self.lengths:
            mine = [i for i, s in enumerate(sequences) if len(s) and min(least, len(s)) == n]
            hashes = [run_hashes(sequences[i], n) for i in mine]
            keys = np.concatenate(hashes)
            items = np.repeat(np.array(mine), [len(h) for h in hashes])
            order = np.lexsort((items, keys))
            keys, items = keys[order], items[order]
            new = np.r_[True, (keys[1:] != keys[:-1]) | (items[1:] != items[:-1])]
            self.seeds[n] = (keys[new], items[new])
            self.bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, values: np.ndarray, rows: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
        """For each row and item, the seed length and where seeds begin."""
        found = defaultdict(list)
        for n in self.lengths:
            keys, items = self.seeds[n]
            hashes = run_hashes(values, n)
            at = np.flatnonzero(self.bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
            row = np.searchsorted(rows, at, "right") - 1
            inside = at + n <= rows[row + 1]
            at, row = at[inside], row[inside]
            first, last = np.searchsorted(keys, hashes[at]), np.searchsorted(keys, hashes[at], "right")
            for p in np.flatnonzero(last > first).tolist():
                for item in items[first[p] : last[p]].tolist():
                    found[int(row[p]), item, n].append(int(at[p]))
        return found

    def pairs(self, texts: pa.Array) -> Iterator[tuple[int, int, float, int]]:
        """Row, number of the item, coverage and tiles of each pair with a seed."""
        values, rows = tokens(texts)
        for (row, item, n), at in self.hits(values, rows).items():
            sequence = self.sequences[item]
            covered = np.zeros(int(rows[row + 1] - rows[row]), bool)
            for i in np.array(at) - rows[row]:
                covered[i : i + n] = True
            # All tiles lie where seeds are; other tokens are left out, with one between that matches nothing.
            kept = covered.copy()
            kept[1:] |= covered[:-1]
            own = values[rows[row] : rows[row + 1]][kept].copy()
            gaps = np.flatnonzero(~covered[kept])
            own[gaps] = mixed(gaps.astype(np.uint64) + np.uint64(1 << 40))
            tiles = tiling(sequence, own, n)
            yield row, item, sum(t[2] for t in tiles) / len(sequence), len(tiles)


def blocks(benchmark: DataFrame, least: int = MIN_TILE, block_tokens: int = BLOCK_TOKENS) -> Iterator[Block]:
    """Items in blocks; the driver holds one block at a time and one partition of the benchmark's rows."""
    ids, sequences, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        values, _ = tokens(pa.array([row["text"]], pa.string()))
        ids.append(row["item_id"])
        sequences.append(values)
        size += len(values)
        if size >= block_tokens:
            yield Block(ids, sequences, least)
            ids, sequences, size = [], [], 0
    if ids:
        yield Block(ids, sequences, least)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage and tiles of each pair whose item is covered to `coverage` or more."""
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type.simpleString()}, coverage double, tiles int"
    out = None
    for block in blocks(benchmark, least):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [x for x in held.value.pairs(batch.column("text")) if x[2] >= coverage]
                doc_ids = batch.column("doc_id").take(pa.array([x[0] for x in found], pa.int64()))
                columns = [
                    doc_ids,
                    pa.array([held.value.ids[x[1]] for x in found], _arrow(item_type)),
                    pa.array([x[2] for x in found], pa.float64()),
                    pa.array([x[3] for x in found], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "coverage", "tiles"])

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def _arrow(kind) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]


def clean(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = MIN_COVERAGE) -> DataFrame:
    """The documents that cover no item to `coverage` or more, all columns unchanged; narrow."""
    columns = docs.columns
    out = docs.select("text", F.struct(*columns).alias("kept"))
    schema = f"text string, kept {out.schema['kept'].dataType.simpleString()}"
    for block in blocks(benchmark, least):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                stays = np.ones(batch.num_rows, bool)
                for row, _, part, _ in held.value.pairs(batch.column("text")):
                    stays[row] &= part < coverage
                yield batch.filter(pa.array(stays))

        out = out.mapInArrow(run, schema)
    return out.select(*(F.col("kept").getField(c).alias(c) for c in columns))
