"""Language-model scores: a hashed maximum-entropy model with class-factored softmax beside its unigram base.

Counts of all training words make the base: a word has the probability (c + 1) / (N + V + 1). Words fall into CLASSES
classes: the most frequent have one each, other frequent ones share bands of equal mass, and all others with the
unseen are the last. A word's probability is that of its class in context times its base probability within the class. The class
is a softmax of the weights of hashed features: the word before, the one before that (a skip), both, and the second
before with the third (a skip pair). So a text's score is its base score plus, for each token, the log of the class's
probability in context over its mass.

Training: each task goes over its part of the training texts in gradient steps over batches of tokens, and
the weights are averaged by the gradient sums behind them, in a shuffle by blocks of rows. All training texts count.

Exact counts for whole vocabularies: words with at least one in FREQUENT of all tokens are at most FREQUENT, so their table
is broadcast; all others, each with less than that part of the tokens, meet their counts in a shuffle join, which no word can
make uneven. Both are found by 64-bit hash.

Defined cases: null counts as empty and has the end token alone; without training texts all classes are one and every token has
probability one; rows with one doc_id are each scored; tables may be empty; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import mixed, per_row, row_of, slices, words
from textquarry.llm.language_id import held_out
from textquarry.sources.staging import written_once

FREQUENT = 1 << 20
CLASSES = 64
SINGLES = 48
#: Words that are features by themselves; others are features by their class.
NAMED = 8192
ROWS = 1 << 14
FEATURES = 4
BATCH = 1 << 14
STEP = 0.3
#: Tokens whose logits are held at once; they stay in a core's cache.
_AT_ONCE = 1 << 11
#: Groups of more gradients than this are summed one by one.
_MANY = 48
_BLOCK_ROWS = 1 << 10
_MERGE = 1 << 21
#: The end token's place among the hashes of words.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_FRONT = 1 << 21


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, an end token after each row, and the offsets of rows."""
    found = words(texts)
    ends = found.offsets[1:] + np.arange(len(texts))
    out = np.full(len(found.hashes) + len(texts), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = found.hashes
    return out, np.r_[0, ends + 1]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    sorted_keys = all_keys[order]
    first = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return sorted_keys[first], np.add.reduceat(all_counts[order], first)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word and n; a word has few rows in a partition, one if the partition has not very many different words."""
    keys, counts, held = [], [], 0

    def out() -> pa.RecordBatch:
        k, n = _merged(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in slices(batches):
        k, n = np.unique(tokens(batch.column("text"))[0], return_counts=True)
        keys.append(k)
        counts.append(n)
        held += len(k)
        if held >= _MERGE:
            k, n = _merged(keys, counts)
            keys, counts, held = [k], [n], len(k)
            if held >= _MERGE // 2:
                yield out()
                keys, counts, held = [], [], 0
    if keys:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (its hash as a signed long) and n over all rows of docs, end tokens too."""
    partial = docs.select("text").mapInArrow(_count_batches, "word bigint, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1)
def _feature_rows() -> tuple[np.ndarray, np.ndarray]:
    """The hashed rows of weights of all values of the features: by symbol for two, by a pair of classes for the others."""

    def row(values: np.ndarray, feature: int) -> np.ndarray:
        key = mixed(values.astype(np.uint64) * np.uint64(FEATURES) + np.uint64(feature + 1))
        return (key >> np.uint64(64 - 14)).astype(np.uint16)

    symbols = np.arange(NAMED + CLASSES + 1)
    kinds = np.r_[np.arange(CLASSES), NAMED + CLASSES]  # the last is that there is no token
    pairs = kinds[:, None] * 16384 + kinds
    return np.stack([row(symbols, i) for i in range(2)]), np.stack([row(pairs, i) for i in range(2, 4)])


class Vocabulary:
    """Frequent words by falling count: their counts and classes, and the masses of classes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int, different: int):
        """keys and counts: of the frequent words, in any order."""
        order = np.lexsort((keys, -counts))
        keys, counts = keys[order], counts[order]
        self.total, self.different = total, different
        self.all = float(total + different + 1)
        mass = counts + 1.0
        kind = np.full(len(keys) + 1, CLASSES - 1, np.int64)
        singles = min(SINGLES, len(keys))
        kind[:singles] = np.arange(singles)
        rest = np.cumsum(mass[singles:])
        bands = CLASSES - 1 - SINGLES
        if len(rest):
            kind[singles:-1] = SINGLES + np.minimum((rest / rest[-1] * bands).astype(np.int64), bands - 1)
        self.masses = np.bincount(kind[:-1], mass, CLASSES)
        self.masses[CLASSES - 1] = self.all - mass.sum()
        #: By rank, and last for all other words.
        self.kinds = kind
        self.logs = np.r_[np.log10(mass), 0.0]
        named = np.minimum(np.arange(len(keys) + 1), NAMED)
        self.symbols = np.where((named < NAMED) & (np.arange(len(keys) + 1) < len(keys)), named, NAMED + kind)
        by_key = np.argsort(keys)
        self.keys, self.ranks = keys[by_key], by_key.astype(np.int32)
        self.front: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"front": None}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each word, the number of frequent words for others."""
        if self.front is None:
            slot = (self.keys & np.uint64(_FRONT - 1)).astype(np.int64)
            front_keys, front_ranks = np.zeros(_FRONT, np.uint64), np.full(_FRONT, -1, np.int32)
            order = np.argsort(-self.ranks, kind="stable")  # the more frequent word keeps a contested slot
            front_keys[slot[order]], front_ranks[slot[order]] = self.keys[order], self.ranks[order]
            self.front = front_keys, front_ranks
        front_keys, front_ranks = self.front
        slot = (hashes & np.uint64(_FRONT - 1)).astype(np.int64)
        rank = np.where(front_keys[slot] == hashes, front_ranks[slot], -1)
        left = np.flatnonzero(rank < 0)
        if len(left):
            at = np.searchsorted(self.keys, hashes[left])
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == hashes[left] if len(self.keys) else np.zeros(len(left), bool)
            rank[left] = np.where(hit, self.ranks[at] if len(self.keys) else 0, len(self.keys))
        return rank

    def contexts(self, ranks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(FEATURES, n): rows of weights for each token; a text begins with a symbol of its own."""
        symbol, kind = self.symbols[ranks], self.kinds[ranks]
        place = np.arange(len(ranks)) - offsets[:-1][row_of(offsets)]

        def back(values: np.ndarray, n: int, nothing: int) -> np.ndarray:
            out = np.full(len(values), nothing, np.int64)
            out[n:] = values[: len(values) - n]
            out[place < n] = nothing
            return out

        by_symbol, by_pair = _feature_rows()
        two = back(kind, 2, CLASSES)
        out = np.empty((FEATURES, len(ranks)), np.uint16)
        for i in range(2):
            out[i] = by_symbol[i][back(symbol, i + 1, NAMED + CLASSES)]
        out[2] = by_pair[0][back(kind, 1, CLASSES), two]
        out[3] = by_pair[1][back(kind, 3, CLASSES), two]
        return out

    def start(self) -> np.ndarray:
        """Logits of the classes without context."""
        return np.log(np.maximum(self.masses / self.all, 1e-12)).astype(np.float32)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The frequent words of a table of counts: FREQUENT of them at most, whatever its size."""
    total, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[batch.column(c).to_numpy().astype("<i8").tobytes()] for c in ("word", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["word", "n"])

    often = counts.filter(F.col("n") * FREQUENT >= total).select("word", "n")
    rows = often.mapInArrow(pack, "word binary, n binary").collect()
    keys, n = (np.frombuffer(b"".join(r[c] for r in rows), "<i8") for c in ("word", "n"))
    return Vocabulary(keys.view(np.uint64), n, total, different)


def _logits(weights: np.ndarray, start: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        out += weights.take(r, axis=0)
    out += start
    out -= out.max(axis=1, keepdims=True)
    return out


def _gradients(weights: np.ndarray, start: np.ndarray, rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The gradient of the logits of each token: probabilities, less one for the class it has."""
    out = np.empty((len(kind), CLASSES), np.float32)
    for i in range(0, len(kind), _AT_ONCE):
        p = np.exp(_logits(weights, start, rows[:, i : i + _AT_ONCE]), out=out[i : i + _AT_ONCE])
        p /= p.sum(axis=1, keepdims=True)
    out[np.arange(len(kind)), kind] -= 1
    return out


def _summed(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and for each the sum of its rows of values. In the order of falling group sizes, the k-th rows of
    all groups that have as many are added at once."""
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    first = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]][: len(keys)])
    sizes = np.diff(np.r_[first, len(keys)])
    falling = np.argsort(-sizes, kind="stable")
    first, sizes = first[falling], sizes[falling]
    out = values.take(order[first], axis=0)
    many = int(np.searchsorted(-sizes, -_MANY))
    for g in range(many):
        out[g] = values.take(order[first[g] : first[g] + sizes[g]], axis=0).sum(axis=0)
    for k in range(1, _MANY + 1):
        end = int(np.searchsorted(-sizes, -k))  # groups of more than k
        if end <= many:
            break
        out[many:end] += values.take(order[first[many:end] + k], axis=0)
    return in_order[first], out


def train(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """Weights, (ROWS, CLASSES), from all rows of docs."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_ = held.value
        start = vocabulary_.start()
        weights, sums = np.zeros((ROWS, CLASSES), np.float32), np.zeros(ROWS, np.float32)
        for batch in slices(batches):
            hashes, offsets = tokens(batch.column("text"))
            ranks = vocabulary_.find(hashes)
            kinds, contexts = vocabulary_.kinds[ranks], vocabulary_.contexts(ranks, offsets)
            for i in range(0, len(ranks), BATCH):
                rows, kind = contexts[:, i : i + BATCH], kinds[i : i + BATCH]
                gradients = _gradients(weights, start, rows, kind)
                for r in rows:
                    at, gradient = _summed(gradients, r)
                    sums[at] += np.einsum("ij,ij->i", gradient, gradient)
                    weights[at] -= STEP * gradient / np.sqrt(sums[at] + 1)[:, None]
        for i in range(0, ROWS, _BLOCK_ROWS):
            part, behind = weights[i : i + _BLOCK_ROWS], sums[i : i + _BLOCK_ROWS]
            if behind.any():
                columns = [
                    pa.array([i]),
                    pa.array([(part * behind[:, None]).astype("<f4").tobytes()], pa.binary()),
                    pa.array([behind.astype("<f4").tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "weighed", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighed, sums = {}, {}
        for batch in batches:
            for row in batch.to_pylist():
                b = row["block"]
                weighed[b] = weighed.get(b, 0) + np.frombuffer(row["weighed"], "<f4").astype(np.float64)
                sums[b] = sums.get(b, 0) + np.frombuffer(row["sums"], "<f4").astype(np.float64)
        for b, value in weighed.items():
            mean = value.reshape(-1, CLASSES) / np.maximum(sums[b], 1e-30)[:, None]
            columns = [pa.array([b]), pa.array([mean.astype("<f4").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "mean"])

    parts = docs.select("text").mapInArrow(learn, "block bigint, weighed binary, sums binary")
    blocks = parts.repartition(ROWS // _BLOCK_ROWS, "block").mapInArrow(add, "block bigint, mean binary").collect()
    out = np.zeros((ROWS, CLASSES), np.float32)
    for row in blocks:  # ROWS / _BLOCK_ROWS at most
        out[row["block"] : row["block"] + _BLOCK_ROWS] = np.frombuffer(row["mean"], "<f4").reshape(-1, CLASSES)
    return out


def context_gains(known: Vocabulary, weights: np.ndarray, ranks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each token log10 of its class's probability in context over the class's mass."""
    start, contexts = known.start(), known.contexts(ranks, offsets)
    kinds = known.kinds[ranks]
    prior = np.log10(np.maximum(known.masses / known.all, 1e-300))
    out = np.empty(len(ranks))
    for i in range(0, len(ranks), _AT_ONCE):
        logits = _logits(weights, start, contexts[:, i : i + _AT_ONCE])
        kind = kinds[i : i + _AT_ONCE]
        own = logits[np.arange(len(kind)), kind].astype(np.float64)
        np.exp(logits, out=logits)
        out[i : i + _AT_ONCE] = (own - np.log(logits.sum(axis=1, dtype=np.float64))) / np.log(10) - prior[kind]
    return out


def _parts(docs: DataFrame, known: Vocabulary, weights: np.ndarray) -> DataFrame:
    """Rows with what the frequent words give, and the other words with how often each occurs."""
    held = docs.sparkSession.sparkContext.broadcast((known, weights))
    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_frequent bigint, logs double, gain double, "
        "words array<bigint>, times array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_, weights_ = held.value
        for batch in slices(batches):
            hashes, offsets = tokens(batch.column("text"))
            ranks = vocabulary_.find(hashes)
            other = ranks == len(vocabulary_.keys)
            gains = context_gains(vocabulary_, weights_, ranks, offsets)
            row = row_of(offsets)
            order = np.lexsort((hashes[other], row[other]))
            key, of = hashes[other][order], row[other][order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (of[1:] != of[:-1])]) if len(key) else order
            times = np.diff(np.r_[first, len(key)])
            cuts = pa.array(np.searchsorted(of[first], np.arange(batch.num_rows + 1)).astype(np.int32))
            columns = [
                batch.column("row"),
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(np.diff(offsets)),
                pa.array(per_row((~other).astype(np.int64), offsets)),
                pa.array(per_row(vocabulary_.logs[ranks], offsets)),
                pa.array(per_row(gains, offsets)),
                pa.ListArray.from_arrays(cuts, pa.array(key[first].view(np.int64))),
                pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64))),
            ]
            names = ["row", "doc_id", "held_out", "n_tokens", "n_frequent", "logs", "gain", "words", "times"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out(7).alias("held_out"), "text"
    )
    return rows.mapInArrow(run, schema)


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of all rows."""
    training = docs.filter(~held_out(7))
    counts = written_once(word_counts(training), "word-counts")
    known = vocabulary(counts)
    weights = train(training, known)
    parts = written_once(_parts(docs, known, weights), "lm-parts")
    rare = counts.filter(F.col("n") * FREQUENT < known.total)
    each = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    sums = (
        each.join(rare, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("n_rare"))
    )
    log_all = float(np.log10(known.all))
    base = F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_all)
    return parts.drop("words", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )
