"""Repeated passages by a logarithmic family of suffix arrays.

A byte goes if it is covered by LONG bytes that also start in a document with a smaller id. Every string of LONG bytes holds one sampled
suffix (the least hash among its first SPREAD positions, the leftmost of equals), at the same place wherever the string occurs; the strings
in a row that share a suffix are one entry. So a document has an entry for some 15 bytes instead of a suffix for each.

The index holds levels: arrays of entries, sorted by the hash of the suffix's first HEAD bytes (its head), with the hash of all that the
entry's strings cover and the least document that has it. Levels are dealt over buckets of heads. A new batch gets an array of its own and
is merged with all levels in one pass over each bucket: an entry found there, or with a smaller document of the batch, goes whole. Where one
head goes on in different ways, its strings are compared one by one, in a second pass of the same kind over their hashes. The array of the
batch is merged with the newest level, and the result with the next one, as long as they are of one size, as a binary counter carries.

Documents lie in packs of some PACK bytes. A pack sends each entry once, and a head with more than WAYS continuations once in all, so
a passage that a third of all documents share costs a row of a bucket for each pack, not for each document.

Entries are equal if the hashes of their heads agree in 44 bits and those of all their bytes in 40 more, strings if they agree in 44 bits and
their heads in 32.

Defined cases: null is the empty text; a null doc_id is larger than all others; rows with one doc_id, or without, take nothing from one another,
and each has its row in the result; texts below LONG bytes stay whole; an empty table gives an empty result; further columns are left out.
What is kept is given in bytes, since a cut may go through a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import mixed, utf8
from textquarry.llm.cleanup import shuffles_freed
from textquarry.sources.staging import delete_path, staging_path, written_once

LONG = 50
HEAD = 22
SPREAD = LONG - HEAD + 1
PACK = 1 << 21
#: Continuations of one head that a pack sends one by one.
WAYS = 4
#: Entries that a bucket of the index is made for, and the bytes of text that have one.
BUCKET_ENTRIES, ENTRY_BYTES = 1 << 18, 15
#: Batches in which one table is added.
BATCHES = 3

_LAST = np.iinfo(np.int64).max
#: Bits of a hash that buckets are made of, and bits that tell continuations apart.
KEY_BITS, REST_BITS = 44, 40
_TOKEN = np.uint64((1 << REST_BITS) - 1)  # stands for all continuations of a head
PACKS = "g bigint, batch int, ids binary, none binary, ends binary, bytes binary"
BLOBS = "bucket int, level int, g bigint, entries binary"
_FOUND = "kind string, g bigint, bucket int, entries binary"


# Arrays of whole numbers as bytes: how many, and for each array its least value and the bytes that the others need beyond it.


def packed(*arrays: np.ndarray) -> bytes:
    out = [len(arrays[0]).to_bytes(8, "little")]
    for x in arrays:
        x = x.astype(np.int64, copy=False)
        base = int(x.min()) if len(x) else 0
        more = (x - base).view(np.uint64)
        width = (int(more.max()).bit_length() + 7) // 8 if len(x) else 0
        out.append(base.to_bytes(8, "little", signed=True) + bytes([width]))
        out.append(np.ascontiguousarray(more).view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
    return b"".join(out)


def unpacked(blob: bytes) -> list[np.ndarray]:
    n, at, out = int.from_bytes(blob[:8], "little"), 8, []
    while at < len(blob):
        base, width = int.from_bytes(blob[at : at + 8], "little", signed=True), blob[at + 8]
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(blob, np.uint8, n * width, at + 9).reshape(n, width)
        out.append(wide.reshape(-1).view(np.int64) + base)
        at += 9 + n * width
    return out


def sorted_blob(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """keys, one at least, ascend, so the first and the steps are stored."""
    keys = keys.astype(np.int64)
    return int(keys[0]).to_bytes(8, "little") + packed(np.diff(keys, prepend=keys[0]), *others)


def from_sorted(blob: bytes) -> list[np.ndarray]:
    steps, *others = unpacked(blob[8:])
    return [int.from_bytes(blob[:8], "little") + np.cumsum(steps), *others]


# Packs of documents.


def pack_batches(call: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return text_packs(batches, (call << 44) + (TaskContext.get().partitionId() << 20), size)

    return run


def text_packs(batches: Iterator[pa.RecordBatch], g: int, size: int) -> Iterator[pa.RecordBatch]:
    """g: the first number of a pack."""
    for batch in batches:
        numbers = batch.column("batch").to_numpy()
        for b in np.unique(numbers):
            own = batch.filter(pa.array(numbers == b))
            ends = np.cumsum(pc.binary_length(own.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            i = 0
            while i < own.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
                data, at = utf8(own.column("text").slice(i, j - i))
                ids = own.column("doc_id").slice(i, j - i)
                row = [g, b, packed(ids.fill_null(_LAST).to_numpy()), packed(ids.is_null().to_numpy(zero_copy_only=False)), packed(at[1:]), data.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["g", "batch", "ids", "none", "ends", "bytes"])
                g += 1
                i = j


# Entries.


def _least_offsets(data: np.ndarray) -> np.ndarray:
    """For each position with HEAD bytes at least, how far on the sampled suffix of the string that starts here begins."""
    steps = [1, 2, 4, 8, SPREAD - 16]
    out = []
    many = len(data) - LONG + 1
    for i in range(0, many, 1 << 14):  # what a processor holds at once
        j = min(many, i + (1 << 14))
        here = data[i : j + SPREAD + 6]
        x = np.ndarray((len(here) - 7,), "<u8", here, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x &= np.uint64(0xFFFFFFFF00000000)
        x |= np.arange(len(x), dtype=np.uint64)  # so of equals the leftmost is the least
        for step in steps:
            x = np.minimum(x[:-step], x[step:])
        offset = (x.astype(np.uint32) - np.arange(len(x), dtype=np.uint32)).astype(np.uint8)
        out.append(offset[: j - i])
    return np.concatenate(out)


def _hashed(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` bytes (8 or more) from each place."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    out = np.full(len(at), size, np.uint64)
    for k in [*range(0, size - 8, 8), size - 8]:
        out ^= eights[at + k]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return mixed(out)


class Entries:
    """The entries of a pack: doc, where their first string starts, how many strings they have, heads and continuations as hashes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = data
        if len(data) < LONG:
            self.doc = self.first = self.many = np.zeros(0, np.int64)
            self.head = self.rest = np.zeros(0, np.uint64)
            return
        sizes = np.diff(ends, prepend=0)
        many = np.maximum(sizes - LONG + 1, 0)
        whole = np.repeat(np.tile([True, False], len(ends)), np.stack([many, sizes - many], 1).reshape(-1))[: len(data) - LONG + 1]
        offset = _least_offsets(data)
        new = np.ones(len(offset), bool)
        new[1:] = (offset[1:] != offset[:-1] - np.uint8(1)) | ~whole[:-1]
        first = np.flatnonzero(whole & new)
        goes_on = np.zeros(len(offset), bool)
        goes_on[:-1] = whole[1:] & ~new[1:]
        last = np.flatnonzero(whole & ~goes_on)
        before = offset[first].astype(np.int64)
        self.first, self.many = first, last - first + 1
        self.doc = np.searchsorted(ends, first, "right")
        self.head = _hashed(data, first + before, HEAD) >> np.uint64(64 - KEY_BITS)
        # Its bytes are at most twice LONG, so those at both ends are all.
        place = mixed((before.astype(np.uint64) << np.uint64(8)) + self.many.astype(np.uint64))
        rest = mixed(_hashed(data, first, LONG) + place) * np.uint64(3) + _hashed(data, last, LONG)
        self.rest = np.minimum(mixed(rest) >> np.uint64(64 - REST_BITS), _TOKEN - np.uint64(1))

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The strings of the chosen entries: the entry, where they start, and their hashes."""
        many = self.many[chosen]
        entry = np.repeat(chosen, many)
        at = self.first[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
        return entry, at, _hashed(self.data, at, LONG) >> np.uint64(64 - KEY_BITS)


def _order(most: np.ndarray, *less: np.ndarray) -> np.ndarray:
    """An order by `most`, then by the others as they come; few rows have one value of `most`."""
    order = np.argsort(most)
    same = most[order][1:] == most[order][:-1]
    rows = np.flatnonzero(np.r_[False, same] | np.r_[same, False]) if len(most) else order
    few = order[rows]
    order[rows] = few[np.lexsort((*[x[few] for x in reversed(less)], most[few]))]
    return order


def _new(*keys: np.ndarray) -> np.ndarray:
    """A mark at each first row of equal ones, in sorted rows."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    return new


class _Pack:
    """A pack and what is known of its entries from itself alone.

    least: of each entry, the least document of the pack that has the same. bare: its head has too many continuations here.
    """

    def __init__(self, batch: pa.RecordBatch, i: int):
        row = {n: batch.column(n)[i].as_py() for n in ("g", "ids", "none", "ends", "bytes")}
        self.g = row["g"]
        self.ids, self.none, self.ends = (unpacked(row[n])[0] for n in ("ids", "none", "ends"))
        self.data = np.frombuffer(row["bytes"], np.uint8)
        e = self.entries = Entries(self.data, self.ends)
        self.doc_id = self.ids[e.doc]
        order = _order(e.head, e.rest)
        new = _new(e.head[order], e.rest[order])
        number = np.cumsum(new) - 1
        least = np.full(number[-1] + 1 if len(new) else 0, _LAST)
        np.minimum.at(least, number, self.doc_id[order])
        self.order, self.first = order, order[new]  # one entry of each kind, in the order of the array
        self.number = np.empty(len(order), np.int64)
        self.number[order] = number
        self.kind_least = least
        head = e.head[self.first]
        head_new = np.r_[True, head[1:] != head[:-1]][: len(head)]
        self.kind_head = np.cumsum(head_new) - 1
        self.kind_bare = (np.bincount(self.kind_head) > WAYS)[self.kind_head] if len(head) else np.zeros(0, bool)

    def array(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Heads, continuations and least documents of the kinds, sorted; bare heads once, with the token."""
        head, rest, least = self.entries.head[self.first], self.entries.rest[self.first], self.kind_least
        bare, once = self.kind_bare, np.r_[True, self.kind_head[1:] != self.kind_head[:-1]][: len(head)]
        keep = ~bare | once
        return head[keep], np.where(bare, _TOKEN, rest)[keep], np.where(bare, _LAST, least)[keep]

    def told(self, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each kind: the least document at all, and whether its strings must be compared."""
        least, split = self.kind_least.copy(), self.kind_bare.copy()
        head, rest = (x[self.first].astype(np.int64) for x in (self.entries.head, self.entries.rest))
        key = _joint(head, rest)
        for blob in marks:
            h, r, m, s = from_sorted(blob)
            at = np.searchsorted(key, _joint(h, r))
            at = np.minimum(at, max(len(key) - 1, 0))
            hit = key[at] == _joint(h, r) if len(key) else np.zeros(len(h), bool)
            np.minimum.at(least, at[hit], m[hit])
            split[at[hit]] |= s[hit] > 0
        return least, split

    def compared(self, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries that go whole, and the entry, start, hash and head's check of all strings that must be compared."""
        least, split = self.told(marks)
        number = self.number
        gone = self.doc_id > least[number]
        chosen = np.flatnonzero(~gone & split[number])
        entry, at, hashes = self.entries.strings(chosen)
        check = self.entries.head[entry] & np.uint64(0xFFFFFFFF)
        return gone, entry, at, hashes.astype(np.int64), check.astype(np.int64)


_JOINT = np.dtype([("a", ">u8"), ("b", ">u8")])


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs as values that sort by a, then b."""
    out = np.empty(len(a), _JOINT)
    out["a"], out["b"] = a, b
    return out.view("S16").reshape(-1) if len(a) else np.zeros(0, "S16")


def dealt(g: int, buckets: int, keys: np.ndarray, *others: np.ndarray) -> pa.RecordBatch:
    """An array cut into the buckets of its keys."""
    keys = keys.astype(np.int64)
    bucket = ((keys >> 16) * buckets) >> (KEY_BITS - 16)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    used = bucket[cuts[:-1]]
    blobs = [sorted_blob(*(x[s:t] for x in (keys, *others))) for s, t in zip(cuts[:-1], cuts[1:], strict=True)]
    columns = [pa.array(used, pa.int32()), pa.array([-1] * len(used), pa.int32()), pa.array([g] * len(used), pa.int64()), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "level", "g", "entries"])


def _array_batches(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = _Pack(batch, i)
                if len(pack.first):
                    yield dealt(pack.g, buckets, *pack.array())

    return run


def _string_batches(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = _Pack(batch, i)
                _, entry, _, hashes, check = pack.compared(batch.column("marks")[i].as_py() or [])
                if not len(entry):
                    continue
                ids = pack.doc_id[entry]
                order = _order(hashes, check, ids)
                h, c = hashes[order], check[order]
                once = _new(h, c)
                yield dealt(pack.g, buckets, h[once], c[once], ids[order][once])

    return run


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for i in range(batch.num_rows):
            pack = _Pack(batch, i)
            gone, entry, at, hashes, check = pack.compared(batch.column("marks")[i].as_py() or [])
            e = pack.entries
            starts, stops = [e.first[gone]], [e.first[gone] + e.many[gone] + LONG - 1]
            if len(entry):
                ids = pack.doc_id[entry]
                order = _order(hashes, check)
                new = _new(hashes[order], check[order])
                least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
                key = _joint(hashes[order][new], check[order][new])
                for blob in batch.column("strings")[i].as_py() or []:
                    h, c, m = from_sorted(blob)
                    np.minimum.at(least, np.searchsorted(key, _joint(h, c)), m)
                away = at[order][ids[order] > least[np.cumsum(new) - 1]]
                starts.append(away)
                stops.append(away + LONG)
            a, b, doc = _runs(np.concatenate(starts), np.concatenate(stops), pack.ends)
            origin = np.r_[0, pack.ends[:-1]]
            spans = pa.StructArray.from_arrays([pa.array(a - origin[doc]), pa.array(b - origin[doc])], names=["start", "end"])
            cuts = np.searchsorted(doc, np.arange(len(origin) + 1))
            kept = []
            for k, (s, t) in enumerate(zip(origin, pack.ends, strict=True)):
                own = slice(cuts[k], cuts[k + 1])
                kept.append(b"".join(pack.data[x:y].tobytes() for x, y in zip(np.r_[s, b[own]], np.r_[a[own], t], strict=True)))
            columns = [
                pa.array(pack.ids, mask=pack.none > 0),
                pa.array(pack.ends - origin),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans).cast(span),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])


def _runs(starts: np.ndarray, stops: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching ranges, and the documents that they are in; no run goes over a document's end."""
    order = np.argsort(starts)
    starts, far = starts[order], np.maximum.accumulate(stops[order])
    doc = np.searchsorted(ends, starts, "right")
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > far[:-1]) | (doc[1:] != doc[:-1])
    return starts[new], far[np.r_[new[1:], True][: len(new)]], doc[new]


# One bucket.


def answers(g: np.ndarray, arrays: list[np.ndarray], chosen: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """What each pack is told: the chosen rows, sorted by their keys already, by pack."""
    rows = np.flatnonzero(chosen)
    rows = rows[np.argsort(g[rows], kind="stable")]
    cuts = np.flatnonzero(np.r_[True, g[rows][1:] != g[rows][:-1], True]) if len(rows) else [0]
    for s, t in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(g[rows[s]]), sorted_blob(*(x[rows[s:t]] for x in arrays))


def _table(kinds: list[str], gs: list[int], bucket: int, blobs: list[bytes]) -> pa.Table:
    columns = [pa.array(kinds, pa.string()), pa.array(gs, pa.int64()), pa.array([bucket] * len(gs), pa.int32()), pa.array(blobs, pa.binary())]
    return pa.Table.from_arrays(columns, names=["kind", "g", "bucket", "entries"])


def _merged(merge: list[int]):
    """Merge a bucket of a batch with the levels; give what packs are told and the array of the batch and the levels in `merge`."""

    def run(rows: pa.Table) -> pa.Table:
        parts = []
        for level, g, blob in zip(*(rows.column(n).to_pylist() for n in ("level", "g", "entries")), strict=True):
            if level < 0:
                head, rest, least = from_sorted(blob)
                own, asked = np.full(len(head), g), np.zeros(len(head), np.int64)
            else:
                size = int.from_bytes(blob[:8], "little")
                (names,) = unpacked(blob[8 : 8 + size])
                head, rest, least, held = from_sorted(blob[8 + size :])
                own, asked = names[held >> 1], held & 1
            parts.append((head, rest, least, own, asked, np.full(len(head), level)))
        head, rest, least, g, asked, level = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = _order(head, rest, least)
        head, rest, least, g, asked, level = (x[order] for x in (head, rest, least, g, asked, level))
        new_head, new = _new(head), _new(head, rest)
        by_head, kind = np.cumsum(new_head) - 1, np.cumsum(new) - 1
        token = int(_TOKEN)
        split = np.bincount(by_head[new]) > 1
        split |= np.bincount(by_head, rest == token) > 0
        before = np.bincount(by_head, asked) > 0
        shared = np.bincount(kind) > 1
        first = least[new][kind]
        splits, fresh = split[by_head], (split & ~before)[by_head]
        # Rows of a level are told only that their strings are asked for now, and only once.
        told = np.where(level < 0, shared[kind] | splits, fresh) & (rest != token)
        gs, blobs = [], []
        for pack, blob in answers(g, [head, rest, first, splits.astype(np.int64)], told):
            gs.append(pack)
            blobs.append(blob)
        kinds = ["mark"] * len(gs)
        keep = np.isin(level, [-1, *merge])
        head, rest, least, g, asked = (x[keep] for x in (head, rest, least, g, np.maximum(asked, splits)))
        if len(head):
            head, rest, least, g, asked = (x[_new(head, rest)] for x in (head, rest, least, g, asked))
            names, number = np.unique(g, return_inverse=True)
            kinds.append("level")
            gs.append(0)
            listed = packed(names)
            blobs.append(len(listed).to_bytes(8, "little") + listed + sorted_blob(head, rest, least, number * 2 + asked))
        return _table(kinds, gs, int(rows.column("bucket")[0].as_py()), blobs)

    return run


def _merged_strings(store: bool):
    """The same for single strings: packs are told the least document of each string that others have too. store: keep all strings."""

    def run(rows: pa.Table) -> pa.Table:
        return _strings_of_bucket(rows, store)

    return run


def _strings_of_bucket(rows: pa.Table, store: bool) -> pa.Table:
    parts = []
    for level, g, blob in zip(*(rows.column(n).to_pylist() for n in ("level", "g", "entries")), strict=True):
        h, c, m = from_sorted(blob)
        parts.append((h, c, m, np.full(len(h), g), np.full(len(h), level)))
    h, c, m, g, level = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = _order(h, c, m)
    h, c, m, g, level = (x[order] for x in (h, c, m, g, level))
    new = _new(h, c)
    kind = np.cumsum(new) - 1
    gs, blobs = [], []
    for pack, blob in answers(g, [h, c, m[new][kind]], (np.bincount(kind) > 1)[kind] & (level < 0)):
        gs.append(pack)
        blobs.append(blob)
    kinds = ["mark"] * len(gs)
    if store:
        kinds.append("level")
        gs.append(0)
        blobs.append(sorted_blob(h[new], c[new], m[new]))
    return _table(kinds, gs, int(rows.column("bucket")[0].as_py()), blobs)


class SuffixIndex:
    """An index in a folder of its own: packs of documents, levels of entries, and the strings compared so far.

    `scan` adds a batch to the levels; `settle` gives what stays of all documents that were added since it was last called. Documents
    added later are held against all earlier ones with smaller ids.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.path = staging_path(spark, "suffixes")
        self.levels: list[tuple[int, str]] = []  # batches in it, newest level last
        self.packs: list[tuple[str, bool]] = []  # and whether settled
        self.marks: list[str] = []
        self.strings: list[str] = []
        self.scans = 0

    def _name(self, kind: str) -> str:
        self.scans += 1
        return f"{self.path}/{kind}-{self.scans}"

    def _read(self, path: str, kind: str) -> DataFrame:
        whole = self.spark.read.schema(_FOUND).parquet(path)
        return whole.filter(F.col("kind") == kind).select("g", "bucket", "entries")

    def pack(self, docs: DataFrame) -> DataFrame:
        """Store documents (batch, doc_id, text) in packs."""
        path = self._name("packs")
        docs.select(F.col("batch").cast("int"), F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
            pack_batches(self.scans, PACK), PACKS
        ).write.option("compression", "zstd").partitionBy("batch").parquet(path)
        self.packs.append((path, False))
        return self.spark.read.schema(PACKS).parquet(path)

    def scan(self, packs: DataFrame) -> None:
        """Add the packs of one batch to the levels."""
        size, merge = 1, []
        for i in range(len(self.levels) - 1, -1, -1):
            if self.levels[i][0] != size:
                break
            merge.append(i)
            size *= 2
        rows = packs.mapInArrow(_array_batches(self.buckets), BLOBS)
        for i, (_, path) in enumerate(self.levels):
            rows = rows.union(self._read(path, "level").select("bucket", F.lit(i).alias("level"), "g", "entries"))
        path = self._name("level")
        with shuffles_freed(self.spark):
            rows.groupBy("bucket").applyInArrow(_merged(merge), _FOUND).write.partitionBy("kind").parquet(path)
        for i in merge:
            # What packs are told stays until it is settled.
            delete_path(self.spark, f"{self.levels[i][1]}/kind=level")
        self.levels = [x for i, x in enumerate(self.levels) if i not in merge] + [(size, path)]
        self.marks.append(path)

    def _told(self, paths: list[str], name: str, column: str) -> DataFrame:
        every = [self._read(p, "mark").select("g", "entries") for p in paths]
        return reduce(DataFrame.union, every).groupBy("g").agg(F.collect_list("entries").alias(column))

    def settle(self, last: bool = False) -> DataFrame:
        """doc_id, n_bytes, spans (start and end of what goes, in bytes) and kept, a row for each document not settled yet.

        last: nothing will be added any more, so the levels go.
        """
        if last:
            for _, path in self.levels:
                delete_path(self.spark, f"{path}/kind=level")
            self.levels = []
        path = self._name("marks")
        with shuffles_freed(self.spark):
            self._told(self.marks, "marks", "marks").write.parquet(path)
        marks = self.spark.read.schema("g bigint, marks array<binary>").parquet(path)
        # Of settled packs only those that are asked for strings are read again.
        asked = [self.spark.read.schema(PACKS).parquet(p).join(marks, "g", "inner" if done else "left") for p, done in self.packs]
        rows = reduce(DataFrame.union, asked).mapInArrow(_string_batches(self.buckets), BLOBS)
        for i, old in enumerate(self.strings):
            rows = rows.union(self._read(old, "level").select("bucket", F.lit(i).alias("level"), "g", "entries"))
        found = self._name("strings")
        with shuffles_freed(self.spark):
            rows.groupBy("bucket").applyInArrow(_merged_strings(not last), _FOUND).write.partitionBy("kind").parquet(found)
        for old in self.strings:
            delete_path(self.spark, old)
        self.strings = [found]
        own = reduce(DataFrame.union, [self.spark.read.schema(PACKS).parquet(p) for p, done in self.packs if not done])
        self.packs, self.marks = [(p, True) for p, _ in self.packs], []
        joined = own.join(marks, "g", "left").join(self._told([found], "strings", "strings"), "g", "left")
        kind = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
        return joined.mapInArrow(_kept_batches, kind)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def _batched(docs: DataFrame, batches: int) -> DataFrame:
    """Batches of ascending doc_id, of about as many documents; rows of one doc_id are in one batch, null is in the last."""
    cuts = docs.agg(F.percentile_approx("doc_id", [(i + 1) / batches for i in range(batches - 1)]).alias("cuts")).first()["cuts"] or []
    number = reduce(lambda x, cut: x + F.when(F.col("doc_id") <= cut, 0).otherwise(1), sorted(set(cuts)), F.lit(0))
    return docs.withColumn("batch", number)


def unrepeated(docs: DataFrame, batches: int = BATCHES) -> tuple[SuffixIndex, DataFrame]:
    """The index of one table, added in batches, and what stays of each document (see `settle`). The index holds what the result reads."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    index = SuffixIndex(spark, max(8, size // ENTRY_BYTES // BUCKET_ENTRIES))
    packs = index.pack(_batched(docs, batches))
    for b in range(batches):
        index.scan(packs.filter(F.col("batch") == b))
    return index, index.settle(last=True)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    index, rows = unrepeated(docs)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    try:
        return written_once(
            rows.select(
                "doc_id",
                "n_bytes",
                removed.alias("n_removed"),
                F.size("spans").cast("bigint").alias("n_spans"),
                F.sha2("kept", 256).alias("kept_sha256"),
            ),
            "unrepeated",
        )
    finally:
        index.drop()
