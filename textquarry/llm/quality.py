"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are its words and pairs of neighbours, as they are written; the shapes of words (which kinds of signs follow
each other in them), alone and in pairs; and how often each pair of words occurs in the text, by powers of two, and whether
its words are the same, so that repetition shows whatever the words are. Each kind is hashed to a range of its own, and a feature's value is the part of
the text's occurrences it has. A score is a sparse dot product, summed over occurrences.

Training reads a bounded sample of labelled rows: `bound` documents are expected, chosen by a hash of doc_id, whole texts.
They are dealt over `shards` tasks; each goes through its part `epochs` times, one update per document. The weights are averaged
by the gradient sums that stand behind them, so a feature that one task alone has seen keeps its weight.

Defined cases: null counts as empty; a text without words scores as the bias alone, as any text does if nothing could be learned
(0.5 then); a document with several labels has the smallest; labels without a document, and rows with null doc_id or null label, teach
nothing; rows with one doc_id are each scored; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import SPACES, hashed, mixed, noise, per_row, row_of, slices, spans, utf8
from textquarry.llm.language_id import held_out

BOUND = 12_000
SHARDS = 4
EPOCHS = 3
BITS = 18
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
KINDS = 5
_SIZE = KINDS << BITS
_CLASS = np.array(
    [
        1 if 97 <= x <= 122 or x >= 128 else 2 if 65 <= x <= 90 else 3 if 48 <= x <= 57 else 4 + x % 64
        for x in range(256)
    ]
)


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the changes between kinds of signs in each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    kind = _CLASS[data]
    values = noise(128 * 128, 4)
    step = np.zeros(len(data) + 1, np.uint64)
    changed = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    step[changed + 1] = values[kind[changed - 1] * 128 + kind[changed]]
    sums = np.cumsum(step)
    return mixed(sums[ends] - sums[starts + 1] + values[kind[starts]])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all occurrences, (KINDS, n), and the offsets of rows; kinds that a word lacks have -1."""
    data, rows = utf8(texts)
    starts, ends = spans(data, rows, SPACES)
    offsets = np.searchsorted(starts, rows)
    word = hashed(data, starts, ends, noise(256, 3))
    shape = _shapes(data, starts, ends)
    row = row_of(offsets)
    n = len(word)
    pair = np.zeros(n, np.uint64)
    shapes = np.zeros(n, np.uint64)
    has_next = np.zeros(n, bool)
    if n:
        has_next[:-1] = row[1:] == row[:-1]
        pair[:-1] = np.where(has_next[:-1], mixed(word[:-1] * np.uint64(3) + word[1:]), np.uint64(0))
        shapes[:-1] = mixed(shape[:-1] * np.uint64(5) + shape[1:])
    same = np.zeros(n, bool)
    same[:-1] = has_next[:-1] & (word[1:] == word[:-1])
    _, back, times = np.unique(mixed(pair + row.astype(np.uint64)), return_inverse=True, return_counts=True)
    often = mixed(np.minimum(np.log2(times[back]), 12).astype(np.uint64) + np.uint64(77) + np.uint64(50) * same) if n else pair
    out = np.empty((KINDS, n), np.int64)
    for i, (values, every) in enumerate(((word, True), (shape, True), (pair, False), (shapes, False), (often, False))):
        number = (values >> np.uint64(64 - BITS)).astype(np.int64) + (i << BITS)
        out[i] = number if every else np.where(has_next, number, -1)
    return out, offsets


class _Ftrl:
    """Per-coordinate follow-the-regularised-leader; the last coordinate is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros(_SIZE + 1), np.zeros(_SIZE + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * weight * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _sparse(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different features and values of each row, with the bias."""
    found, offsets = features(texts)
    for s, e in zip(offsets[:-1], offsets[1:], strict=True):
        mine = found[:, s:e].ravel()
        at, times = np.unique(mine[mine >= 0], return_counts=True)
        yield np.r_[at, _SIZE], np.r_[times / max(1, e - s), 1.0]


def _shard_weights(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["order", "doc_id", "text"])  # rows alike in all teach the same
    labels = pdf["quality"].to_numpy()
    share = min(max(labels.mean(), 0.05), 0.95)
    examples = []
    texts = pdf["text"].tolist()
    for i in range(0, len(texts), 256):
        examples += _sparse(pa.array(texts[i : i + 256], pa.string()))
    model = _Ftrl()
    for _ in range(EPOCHS):
        for (at, value), label in zip(examples, labels, strict=True):
            model.learn(at, value, label, 0.5 / share if label else 0.5 / (1 - share))
    w, n = model.weights(), model.n
    seen = np.flatnonzero(n)
    return pd.DataFrame(
        {"at": [seen.astype("<i4").tobytes()], "w": [w[seen].astype("<f4").tobytes()], "n": [n[seen].astype("<f4").tobytes()], "share": [share * len(pdf)], "rows": [len(pdf)]}
    )


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND, shards: int = SHARDS) -> np.ndarray:
    """Weights from the labelled rows of docs. The driver holds one table of weights per shard, whose size is fixed."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.select("doc_id").join(known, "doc_id")
    number = ids.count()
    if not number:
        return np.zeros(_SIZE + 1, np.float32)
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = int(min(1.0, bound / number) * (1 << 40))
    chosen = known.filter(order < share)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    dealt = sample.withColumn("order", order).withColumn("shard", F.col("order") % shards)
    schema = "at binary, w binary, n binary, share double, rows long"
    found = dealt.groupBy("shard").applyInPandas(_shard_weights, schema).collect()  # one row per shard
    top, total = np.zeros(_SIZE + 1), np.zeros(_SIZE + 1)
    for row in found:
        at, w, n = (np.frombuffer(row[c], k) for c, k in (("at", "<i4"), ("w", "<f4"), ("n", "<f4")))
        top[at] += w * n
        total[at] += n
    weights = top / np.maximum(total, 1e-30)
    # Shards weigh both labels alike; the bias takes the true share again.
    share = sum(r["share"] for r in found) / sum(r["rows"] for r in found)
    weights[_SIZE] += np.log(share / (1 - share))
    return weights.astype(np.float32)


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    found, offsets = features(texts)
    held = np.r_[weights[:_SIZE], np.float32(0)]  # number -1 weighs nothing
    sums = per_row(held[found].sum(axis=0, dtype=np.float64), offsets)
    return 1 / (1 + np.exp(-np.clip(sums / np.maximum(np.diff(offsets), 1) + weights[_SIZE], -35, 35)))


def quality_scores(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> DataFrame:
    """doc_id, held_out, score and predicted (score of THRESHOLD or more), learned from rows not held out."""
    weights = train(docs.filter(~held_out()), labels, bound)
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = scores(batch.column("text"), held.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, schema)
