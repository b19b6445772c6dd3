"""SimHash near-duplicates: fingerprints, a binary trie self-join, components.

Fingerprint: the words `[^\\x20\\x09-\\x0D]+` of the text, A to Z in lower case, joined by single spaces in threes,
repeats included (fewer words: all of them); bit i is set if it is in over half of the XXH64 values, seed 42.

Self-join: two fingerprints at three bits or fewer have a half that differs in one bit at most, and that half has a
quarter in which they agree. So there are four tries, each with another quarter first, then the other quarter of its half, then
the other half. In a trie, pairs of nodes of equal depth are followed together; a pair is dropped as soon as it
differs in the first quarter, in more than one bit of the second, or in more than three in all. The first quarter
is the shuffle key. What one key holds is cut further where it is over `split_above` fingerprints: by node pairs at
the depth of two quarters, equal ones and those apart in one bit.

Copies share one fingerprint and are one class before any join. A task reports, for each connected set of
fingerprints it has found, a star with one link less than members and no more, so links are at most as many as
fingerprints in the tries, however large a group.

Defined cases: no word (null, empty, white space) gives fingerprint zero, linked like any other; rows with one doc_id
are each a row; a null doc_id is passed on and counts in a component only if all are null; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import slices
from textquarry.llm.components import components
from textquarry.sources.staging import written_once

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SPLIT_ABOVE = 50_000
_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
#: Shingles whose bits are counted at once, and node pairs followed at once.
_AT_ONCE = 1 << 18
_FRONTIER = 1 << 20
#: Segments of a sorted partition that are joined at once hold about so many fingerprints.
_SEGMENT = 1 << 17
#: Node pairs with so few leaf pairs are compared leaf by leaf.
_LEAVES = 16


def shingle_hashes(text: bytes) -> list[int]:
    words = text.translate(_LOWER).split()
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0, *(x + 1 for x in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :], strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """Each bit by the majority of the hashes; ties and no hashes give 0."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = np.array(hashes[i : i + _AT_ONCE], ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def text_fingerprints(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text as a signed long."""
    found = [fingerprint(shingle_hashes(x.encode()) if x else []) for x in texts.to_pylist()]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        signed = text_fingerprints(batch.column("text"))
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), signed], names=[*rest, "fp"])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """The key columns (doc_id if none are named) and fp, the fingerprint as a signed long."""
    keys = keys or ("doc_id",)
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(_fingerprint_batches, f"{schema}, fp bigint")


def _turned(fp: Column, by: int) -> Column:
    """Bits in the order in which trie `by` reads them."""
    low, high = F.lit(0x0000FFFF0000FFFF), F.lit(0xFFFF0000FFFF0000 - (1 << 64))
    if by & 2:
        fp = F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))
    if by & 1:
        fp = F.shiftleft(fp.bitwiseAND(low), 16).bitwiseOR(F.shiftrightunsigned(fp.bitwiseAND(high), 16))
    return fp


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Forest:
    """Connected sets over positions of an array, grown by batches of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
        self.root = root


def _children(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the second child of each node begins; depth: bits that its values share at least."""
    shift = (63 - depth).astype(np.uint64)
    target = ((values[lo] >> shift) | np.uint64(1)) << shift
    left, right = lo.copy(), hi.copy()
    while True:  # a binary search in each range
        open_ = left < right
        if not open_.any():
            return left
        mid = (left + right) >> 1
        below = open_ & (values[np.minimum(mid, len(values) - 1)] < target)
        left = np.where(below, mid + 1, left)
        right = np.where(open_ & ~below, mid, right)


def trie_links(
    values: np.ndarray, first: list[np.ndarray], depth: int, max_bits: int = MAX_BITS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions that differ in one bit of the second quarter at most and in max_bits in all.

    values: unsigned, each node's values sorted. first: begin and end of both nodes of each pair and the bits
    they differ in (a node with itself: found pairs count once). Depth first over parts of the frontier, which thus stays small.
    """
    stack = [(depth, *first)]
    while stack:
        d, alo, ahi, blo, bhi, used = stack.pop()
        if not len(alo):
            continue
        if len(alo) > _FRONTIER:
            half = len(alo) // 2
            stack += [(d, *(x[half:] for x in (alo, ahi, blo, bhi, used))), (d, *(x[:half] for x in (alo, ahi, blo, bhi, used)))]
            continue
        own = alo == blo
        na, nb = ahi - alo, bhi - blo
        few = (na * nb <= _LEAVES) | (d == 64)
        if few.any():
            yield from _leaf_pairs(values, *(x[few] for x in (alo, ahi, blo, bhi)), max_bits)
            alo, ahi, blo, bhi, used, own = (x[~few] for x in (alo, ahi, blo, bhi, used, own))
            if not len(alo):
                continue
        at = np.full(len(alo), d)
        am, bm = _children(values, alo, ahi, at), _children(values, blo, bhi, at)
        most = 0 if d < 16 else min(1, max_bits) if d < 32 else max_bits
        other = ~own
        parts = (
            (alo, am, blo, bm, used, used >= 0),
            (am, ahi, bm, bhi, used, used >= 0),
            (alo, am, bm, bhi, used + 1, used < most),
            (am, ahi, blo, bm, used + 1, other & (used < most)),
        )
        keep = [(p[5] & (p[0] < p[1]) & (p[2] < p[3]) & ~((p[0] == p[2]) & (p[1] - p[0] < 2))) for p in parts]
        stack.append((d + 1, *(np.concatenate([p[i][k] for p, k in zip(parts, keep, strict=True)]) for i in range(5))))


def _leaf_pairs(values, alo, ahi, blo, bhi, max_bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Compare all leaves under node pairs, a bounded number at once."""
    na, nb = ahi - alo, bhi - blo
    number = na * nb
    ends = np.cumsum(number)
    i = 0
    while i < len(number):
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + _FRONTIER, "right")))
        pair = np.repeat(np.arange(i, j), number[i:j])
        k = np.arange(len(pair)) - np.repeat(ends[i:j] - number[i:j] - before, number[i:j])
        a, b = alo[pair] + k // nb[pair], blo[pair] + k % nb[pair]
        apart = values[a] ^ values[b]
        near = (
            (a != b)
            & (popcount(apart) <= max_bits)
            & (popcount((apart >> np.uint64(32)) & np.uint64(0xFFFF)) <= 1)
            & (apart >> np.uint64(48) == 0)
        )
        yield a[near], b[near]
        i = j


def _joined_batches(max_bits: int):
    def segment(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch | None:
        """keys: (n, 3) of trie and quarter, base of the node pair or -1, kind; sorted, as values are under a key."""
        cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        ends = np.r_[cuts[1:], len(keys)]
        kind = keys[cuts, 2]
        forest = _Forest(len(values))
        for which, depth in ((-1, 16), (0, 32), (1, 32)):
            chosen = kind >= 1 if which == 1 else kind == which
            lo, hi = cuts[chosen], ends[chosen]
            if not len(lo):
                continue
            if which < 1:
                several = hi - lo > 1
                lo, hi = lo[several], hi[several]
                nodes = [lo, hi, lo, hi, np.zeros(len(lo), np.int64)]
            else:  # two nodes that differ in one bit of the second quarter
                mid = _children(values, lo, hi, 16 + (16 - kind[chosen]))
                both = (lo < mid) & (mid < hi)
                nodes = [lo[both], mid[both], mid[both], hi[both], np.ones(int(both.sum()), np.int64)]
            for a, b in trie_links(values, nodes, depth, max_bits):
                forest.link(a, b)
        linked = np.flatnonzero(forest.root != np.arange(len(values)))
        if not len(linked):
            return None
        trie = keys[linked, 0] >> 16
        return pa.RecordBatch.from_arrays(
            [
                pa.array(trie),
                pa.array(values[linked].view(np.int64)),
                pa.array(values[forest.root[linked]].view(np.int64)),
            ],
            names=["trie", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_values, held = [], [], 0

        def flush(all_of_it: bool) -> pa.RecordBatch | None:
            nonlocal held_keys, held_values, held
            keys, values = np.concatenate(held_keys), np.concatenate(held_values)
            cut = len(keys)
            if not all_of_it:  # the last key may go on
                cut = int(np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])[-1])
            held_keys, held_values, held = [keys[cut:]], [values[cut:]], len(keys) - cut
            return segment(keys[:cut], values[:cut]) if cut else None

        for batch in batches:
            if not batch.num_rows:
                continue
            held_keys.append(np.stack([batch.column(c).to_numpy() for c in ("key", "base", "kind")], axis=1).astype(np.int64))
            held_values.append(batch.column("turned").to_numpy().view(np.uint64))
            held += batch.num_rows
            if held >= _SEGMENT and (found := flush(False)) is not None:
                yield found
        if held and (found := flush(True)) is not None:
            yield found

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """a and b: links that connect just what pairs of fingerprints at max_bits or fewer connect.

    fps: distinct column fp. max_bits: 3 at most.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")
    tries = F.explode(F.array(*(F.struct(F.lit(t).alias("trie"), _turned(F.col("fp"), t).alias("turned")) for t in range(4))))
    spread = fps.select(tries.alias("t")).select(
        F.shiftleft(F.col("t.trie"), 16).bitwiseOR(F.shiftrightunsigned("t.turned", 48).cast("int")).alias("key"),
        F.col("t.turned").alias("turned"),
    )
    hot = spread.groupBy("key").count().filter(F.col("count") > split_above).select("key", F.lit(True).alias("hot"))
    second = F.shiftrightunsigned("turned", 32).bitwiseAND(F.lit(0xFFFF)).cast("int")
    node_pairs = F.transform(
        F.sequence(F.lit(0), F.lit(16)),
        lambda k: F.struct(
            F.when(k == 0, second)
            .otherwise(second.bitwiseAND(F.bitwise_not(F.pow(F.lit(2), k - 1).cast("int"))))
            .alias("base"),
            k.alias("kind"),
        ),
    )
    whole = F.array(F.struct(F.lit(-1).alias("base"), F.lit(-1).alias("kind")))
    parts = spread.join(hot, "key", "left").select(
        "key", "turned", F.explode(F.when(F.col("hot"), node_pairs).otherwise(whole)).alias("p")
    )
    dealt = (
        parts.select("key", F.col("p.base").alias("base"), F.col("p.kind").alias("kind"), "turned")
        .repartition("key", "base", "kind")
        .withColumn("_order", F.col("turned").bitwiseXOR(F.lit(-(1 << 63))))
        .sortWithinPartitions("key", "base", "kind", "_order")
        .drop("_order")
    )
    found = dealt.mapInArrow(_joined_batches(max_bits), "trie bigint, a bigint, b bigint")

    def back(c: str) -> Column:
        value = _turned(F.col(c), 0)
        for t in (1, 2, 3):
            undone = _turned(_turned(F.col(c), t & 1), t & 2)
            value = F.when(F.col("trie") == t, undone).otherwise(value)
        return value

    return found.select(back("a").alias("a"), back("b").alias("b"))


def classes(fps: DataFrame, key: Column | str = "doc_id", max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """fp, root (the smallest fingerprint reached) and least, the smallest key of the component."""
    own = written_once(fps.groupBy("fp").agg(F.min(key).alias("least")), "classes")
    linked = components(near_links(own.select("fp"), max_bits, split_above))
    rooted = own.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.drop("least").join(least, "root").select("fp", "root", "least")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links reach."""
    fps = written_once(fingerprints(docs), "fingerprints")
    found = classes(fps, "doc_id", max_bits, split_above)
    return fps.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id")
    )


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id stays.

    A null doc_id comes after all others; among rows with one doc_id the one with the smallest hash of all its columns stays, and
    rows alike in all columns count once.
    """
    columns = docs.columns
    keyed = docs.select(
        "doc_id", "text", F.struct(*columns).alias("_doc"), F.xxhash64(*columns).alias("_row")
    )
    fps = written_once(fingerprints(keyed, "doc_id", "_row"), "fingerprints")
    key = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    kept = classes(fps, key, max_bits, split_above).select("root", "least").distinct()
    rows = kept.select(F.col("least.doc_id").alias("_kept"), F.col("least._row").alias("_kept_row")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_row") == F.col("_kept_row"))
    stay = keyed.join(rows, same, "left_semi")
    if fps.groupBy("doc_id", "_row").count().filter("count > 1").limit(1).count():
        stay = stay.dropDuplicates(["doc_id", "_row"])
    return stay.select(*(F.col("_doc").getField(c).alias(c) for c in columns))
