"""Near-copies by exact Jaccard similarity of word shingles and by op2's fingerprints: prefix filter, links, components.

The words are op2's (`simhash`), joined in fives; a text is the set of the 64-bit hashes of its shingles (fewer words: one shingle of all of
them). Two texts are linked at a similarity of 0.8 or more, and also where op2 links them, by fingerprints at three bits or fewer: neither
finds all that the other does, as fingerprints count a shingle as often as it occurs. Of what links of both kinds connect one text stays.

Candidates: shingles are ordered by the number of sets they are in, then by hash. Two sets of that similarity share one of the
first n - ceil(0.8 n) + 1 shingles of each (n: its size), so all links are found, and nothing is left out. What is in one set only comes
first and is shared by none: a text with enough of such shingles is out at once, and only shared ones go on.

Copies, texts with one set, are one class before any join. Classes lie in packs (see `suffix_index`). A pack sends each of its shingles once, as
44 bits of its hash and the number of its sets that have it, dealt over buckets, and is told which are in other sets too, and in how many.
(Equal bits make a shingle look more frequent; that changes the order, for all texts alike, and no result.) With this the order and the cut
are made within the pack, and what is left of a text, if anything, is one row.

Under a shared shingle, classes are first compared with one of them, in STARS rounds; what these links leave apart is compared pair by
pair, so a large group of near-copies costs no pairs. The join itself drops pairs whose sizes, places of the shingle in the order, or maps
exclude the similarity: a map has a bit for each remainder that a shared shingle's hash leaves by MAP_BITS, and sets differ in as many shingles
as their maps do in bits, at least. So texts that have passages in common, but not enough, seldom meet.

Defined cases: texts without words (null, empty, white space) are one class; a null doc_id comes after all others; among rows with
one doc_id the one with the smallest hash of all its columns stays, and rows alike in all columns count once; an empty table gives an
empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import mixed, per_row, row_of, slices, words
from textquarry.llm.cleanup import shuffles_freed
from textquarry.llm.components import components
from textquarry.llm.simhash import classes, text_fingerprints
from textquarry.llm.suffix_index import BLOBS, BUCKET_ENTRIES, KEY_BITS, PACK, PACKS, answers, dealt, from_sorted, pack_batches, unpacked
from textquarry.sources.staging import Staged, staged, written_once

SHINGLE = 5
#: The similarity, 4 / 5, as whole numbers.
OVER, UNDER = 4, 5
STARS = 2
#: Bytes of text that have a shingle.
WORD_BYTES = 6
MAP_BITS = 1024


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of each text, ascending, and the offsets of rows in them."""
    found = words(texts)
    sizes = np.diff(found.offsets)
    number = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    offsets = np.r_[0, np.cumsum(number)]
    row = row_of(offsets)
    first = found.offsets[:-1][row] + np.arange(len(row)) - offsets[:-1][row]
    hashes = np.zeros(len(row), np.uint64)
    for k in range(SHINGLE):
        here = k < sizes[row]
        hashes[here] = mixed(hashes[here] * np.uint64(0x9E3779B97F4A7C15) + found.hashes[first[here] + k])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])][: len(row)]
    return hashes[new], np.searchsorted(row[new], np.arange(len(texts) + 1))


def _class_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        hashes, at = shingles(batch.column("text"))
        found = np.array([_class_of(hashes[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)], np.uint64)
        columns = [batch.column("doc_id"), batch.column("_row"), pa.array(found.view(np.int64)), text_fingerprints(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_row", "class", "fp"])


_LEFT = "class bigint, size int, held int, prefix int, shared array<bigint>, map array<bigint>"


def _shingles_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a pack, their shingle hashes, and the offsets of classes in these."""
    ids, ends = (unpacked(batch.column(n)[i].as_py())[0] for n in ("ids", "ends"))
    held = pa.py_buffer(batch.column("bytes")[i].as_py())
    texts = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(np.r_[0, ends].astype(np.int64)), held)
    return ids, *shingles(texts)


def _key(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def _count_batches(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, sets = np.unique(_key(_shingles_of(batch, i)[1]), return_counts=True)
                if len(keys):
                    yield dealt(batch.column("g")[i].as_py(), buckets, keys, sets)

    return run


def _counted(rows: pa.Table) -> pa.Table:
    """A bucket of shingles: each pack is told those of its own that are in two sets or more, and in how many."""
    parts = [(*from_sorted(blob), g) for g, blob in zip(rows.column("g").to_pylist(), rows.column("entries").to_pylist(), strict=True)]
    key, sets = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    g = np.repeat([p[2] for p in parts], [len(p[0]) for p in parts])
    order = np.argsort(key, kind="stable")
    key, sets, g = key[order], sets[order], g[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.repeat(np.add.reduceat(sets, first), np.diff(first, append=len(key)))
    found = list(answers(g, [key, total], total > 1))
    return pa.table([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], names=["g", "entries"])


def _maps(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each set its MAP_BITS bits as whole numbers, one set after another."""
    out = np.zeros((len(cuts) - 1) * (MAP_BITS // 8), np.uint8)
    bit = (hashes % np.uint64(MAP_BITS)).astype(np.int64)
    np.bitwise_or.at(out, row_of(cuts) * (MAP_BITS // 8) + (bit >> 3), (128 >> (bit & 7)).astype(np.uint8))
    return out.view(np.int64)


def _left_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text that can have a partner: its size, how many shingles it has alone, and the shared ones, in order; prefix: how many count."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, hashes, at = _shingles_of(batch, i)
            blobs = [from_sorted(x) for x in batch.column("told")[i].as_py() or []]
            if not blobs:
                continue
            key, total = (np.concatenate([b[k] for b in blobs]) for k in (0, 1))
            order = np.argsort(key)
            key, total = key[order], total[order]
            own = _key(hashes)
            place = np.minimum(np.searchsorted(key, own), len(key) - 1)
            sets = np.where(key[place] == own, total[place], 1)
            row, sizes = row_of(at), np.diff(at)
            order = np.lexsort((hashes, sets, row))
            hashes, sets = hashes[order], sets[order]
            alone = per_row((sets == 1).astype(np.int64), at)
            prefix = sizes - (sizes * OVER + UNDER - 1) // UNDER + 1 - alone
            stays = (prefix > 0) & (alone < sizes)
            some = np.repeat(stays, sizes) & (sets > 1)
            cuts = np.r_[0, np.cumsum((sizes - alone)[stays])]
            columns = [ids[stays], sizes[stays].astype(np.int32), alone[stays].astype(np.int32), np.minimum(prefix, sizes - alone)[stays].astype(np.int32)]
            shared = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes[some].view(np.int64)))
            words64 = _maps(hashes[some], cuts)
            maps = pa.ListArray.from_arrays(pa.array(np.arange(len(cuts)) * (MAP_BITS // 64), pa.int32()), pa.array(words64))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), shared, maps], names=["class", "size", "held", "prefix", "shared", "map"])


def _left(texts: DataFrame, copies: Staged) -> DataFrame:
    """What the prefix filter leaves of the classes."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = texts.select(F.lit(0).alias("batch"), F.col("class").alias("doc_id"), "text")
    packs = copies.written_once(docs.mapInArrow(pack_batches(0, PACK), PACKS).drop("batch"), "near-packs")
    counts = packs.mapInArrow(_count_batches(max(8, size // WORD_BYTES // BUCKET_ENTRIES)), BLOBS)
    told = counts.groupBy("bucket").applyInArrow(_counted, "g bigint, entries binary")
    told = copies.written_once(told.groupBy("g").agg(F.collect_list("entries").alias("told")), "near-counts")
    return copies.written_once(packs.join(told, "g", "left").mapInArrow(_left_batches, _LEFT), "near-sets")


def _possible(one: Column, other: Column) -> Column:
    """Whether two sets may be alike enough that share the shingle at these places, and none before. Both have size, held, place and map."""
    sizes = one["size"] + other["size"]
    common = F.least(one["size"] - one["place"], other["size"] - other["place"])
    apart = sum((F.bit_count(one["map"][k].bitwiseXOR(other["map"][k])) for k in range(MAP_BITS // 64)), one["held"] + other["held"])
    return (common * (OVER + UNDER) >= sizes * OVER) & (apart * (OVER + UNDER) <= sizes * (UNDER - OVER))


def near_links(texts: DataFrame) -> DataFrame:
    """a and b: links that connect just what pairs of classes at the similarity or above connect. texts: class and text, a row a class."""
    spark = texts.sparkSession
    with staged(spark) as copies, shuffles_freed(spark):
        left = _left(texts, copies)
        copies.delete(keep=1)
        places = left.select("class", "size", "held", "map", F.posexplode(F.slice("shared", F.lit(1), F.col("prefix"))).alias("place", "shingle"))
        known = F.struct("size", "held", (F.col("held") + F.col("place")).alias("place"), "map").alias("known")
        prefix = places.select("class", "shingle", known)

        def linked(pairs: DataFrame) -> DataFrame:
            one, other = (left.select(F.col("class").alias(x), F.col("size").alias(f"n{x}"), F.col("shared").alias(f"s{x}")) for x in "ab")
            both = pairs.select("a", "b").distinct().join(other, "b").join(one, "a")
            common = F.size(F.array_intersect("sa", "sb"))
            return both.filter(common * (OVER + UNDER) >= OVER * (F.col("na") + F.col("nb"))).select("a", "b")

        links = spark.createDataFrame([], "a bigint, b bigint")
        here = prefix.withColumn("root", F.col("class"))
        for k in range(STARS + 1):
            if k:
                roots = components(links).withColumnRenamed("node", "class")
                here = prefix.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
            centre = F.min_by(F.struct("class", "root", "known"), F.xxhash64("class", F.lit(k))).alias("c")
            several = here.groupBy("shingle").agg(centre, F.min("root").alias("_lo"), F.max("root").alias("_hi"))
            several = several.filter("_lo < _hi").select("shingle", "c")
            if k < STARS:
                joined = here.join(several, "shingle").filter("root <> c.root").filter(_possible(F.col("known"), F.col("c.known")))
                pairs = joined.select(F.col("class").alias("a"), F.col("c.class").alias("b"))
            else:
                mine = here.join(several.select("shingle"), "shingle", "left_semi")
                other = mine.select("shingle", F.col("class").alias("b"), F.col("root").alias("rb"), F.col("known").alias("kb"))
                apart = (F.col("root") != F.col("rb")) & (F.col("class") < F.col("b"))
                pairs = mine.join(other, "shingle").filter(apart & _possible(F.col("known"), F.col("kb"))).select(F.col("class").alias("a"), "b")
            links = copies.written_once(links.union(linked(pairs)), "near-linked")
        return written_once(links, "near-links")


def fingerprint_links(kinds: DataFrame) -> DataFrame:
    """a and b: links that connect just what op2 does. kinds: class and fp, a row for each fingerprint that texts of a class have."""
    return kinds.join(classes(kinds, "class"), "fp").select(F.col("class").alias("a"), F.col("least").alias("b")).filter("a <> b")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near-copies: of each component the row with the smallest doc_id stays."""
    columns = docs.columns
    keyed = docs.select("doc_id", "text", F.struct(*columns).alias("_doc"), F.xxhash64(*columns).alias("_row"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    classed = keyed.select("doc_id", "_row", "text").mapInArrow(_class_batches, f"doc_id {kind}, _row bigint, class bigint, fp bigint")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("_row").alias("_row"))
    with staged(docs.sparkSession) as copies:
        kinds = copies.written_once(classed.groupBy("class", "fp").agg(F.min(key).alias("least")), "shingle-kinds")
        own = written_once(kinds.groupBy("class").agg(F.min("least").alias("least")), "shingle-classes")
        alike = written_once(fingerprint_links(kinds.select("class", "fp")), "fingerprint-links")
    firsts = own.select(F.col("least.doc_id").alias("_kept"), F.col("least._row").alias("_kept_row"), "class", "least")

    def rows(chosen: DataFrame) -> DataFrame:
        """A row for each class chosen; rows alike in all columns count once."""
        same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_row") == F.col("_kept_row"))
        met = keyed.join(chosen, same)
        twice = keyed.join(chosen, same, "left_semi").groupBy("doc_id", "_row").count().filter("count > 1")
        return met.dropDuplicates(["class"]) if twice.limit(1).count() else met

    links = near_links(rows(firsts).select("class", "text")).union(alike)
    linked = components(links).withColumnRenamed("node", "class")
    rooted = firsts.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("_kept"), F.col("k._row").alias("_kept_row"), F.col("root").alias("class"))
    return rows(kept).select(*(F.col("_doc").getField(c).alias(c) for c in columns))
