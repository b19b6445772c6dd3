"""Token-ID files: frequency-ranked ids in byte-aligned variable-length codes with separate control bytes.

First pass: how often each id occurs; the vocabulary bounds this table, whatever the corpus. Ids are ranked by
frequency, ties by id. Second pass: documents in ascending doc_id order, dealt by ranges, are encoded as ranks of
one to four bytes each; two bits per id, four ids to a control byte, say how many. Control bytes and data
bytes lie apart, so numpy decodes whole blocks by table lookup: a control byte gives four lengths.

The file format is a folder of Parquet files with a row per block: part (range), block (its place in the part), doc_ids,
lengths (ids of each document), control and data; and beside it a table of ranks. Blocks hold whole documents of
BLOCK_IDS ids or more in all, but for the last. Spark's writer commits them, so a lost executor costs its task alone.

Both passes tokenize, which by a table of units costs less than keeping all ids.

Defined cases: a null text is empty and has the end id alone; rows with one doc_id follow each other, ordered by
text; null doc_ids come first; an empty table gives empty files; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import slices
from textquarry.llm.pieces import unit_tokens
from textquarry.sources.staging import staging_path

END_ID = 1
BLOCK_IDS = 1 << 16
#: Of ids that were not counted.
_NO_RANK = 0xFFFFFFFF
BLOCKS = "part int, block int, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary"


def encoded_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks below 2**32."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


@lru_cache(maxsize=1)
def _lengths() -> np.ndarray:
    """For each control byte the lengths of its four codes."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def decoded_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _lengths()[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def id_counts(docs: DataFrame, tokenizer_file: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """id and n over the whole corpus, the end ids too; a partition gives each id once at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = unit_tokens(tokenizer_file)
        counts = np.zeros(max(tokens.size, (end_id or 0) + 1), np.int64)
        for batch in slices(batches):
            counts[: tokens.size] += tokens.count(batch.column("text"))
            if end_id is not None:
                counts[end_id] += batch.num_rows
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names=["id", "n"])

    partial = docs.select("text").mapInArrow(count, "id bigint, n bigint")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def frequency_ranks(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = END_ID) -> np.ndarray:
    """Ids by falling frequency: the id of each rank. It holds the vocabulary at most."""
    table = id_counts(docs, tokenizer_file, end_id).toPandas()
    return table.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def _blocks(docs: DataFrame, ids: np.ndarray, tokenizer_file: str | None, end_id: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(ids.astype(np.uint32))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, by_rank = unit_tokens(tokenizer_file), held.value
        rank_of = np.full(max(tokens.size, end_id + 1), _NO_RANK, np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        part, number = 0, 0
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        held_ranks: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            control, data = encoded_ranks(np.concatenate(held_ranks))
            columns = [[part], [number], [doc_ids], [sizes], [control], [data]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["part", "block", "doc_ids", "lengths", "control", "data"]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            number += 1
            doc_ids.clear(), sizes.clear(), held_ranks.clear()
            return out

        for batch in slices(batches):
            part = batch.column("part")[0].as_py()
            ids, rows = tokens.encode(batch.column("text"))
            ends = rows[1:] + np.arange(1, len(rows))  # with the end ids
            ranks = np.full(len(ids) + batch.num_rows, rank_of[end_id], np.uint32)
            inside = np.ones(len(ranks), bool)
            inside[ends - 1] = False
            ranks[inside] = rank_of[ids]
            if (ranks == _NO_RANK).any():
                raise ValueError("an id was encoded that the counting pass did not count")
            names = batch.column("doc_id").to_pylist()
            i, before = 0, 0
            while i < len(names):
                wanted = before + BLOCK_IDS - sum(sizes)
                j = min(len(names), int(np.searchsorted(ends, wanted)) + 1)
                doc_ids += names[i:j]
                sizes += np.diff(ends[i:j], prepend=before).tolist()
                held_ranks.append(ranks[before : ends[j - 1]])
                i, before = j, int(ends[j - 1])
                if sum(sizes) >= BLOCK_IDS:
                    yield block()
        if doc_ids:
            yield block()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(encode, BLOCKS)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_file: str | None = None, end_id: int = END_ID
) -> None:
    """Write all documents below `folder`, which must not exist: blocks and ranks."""
    spark = docs.sparkSession
    ids = frequency_ranks(docs, tokenizer_file, end_id)
    ranks = spark.createDataFrame([(r, int(i)) for r, i in enumerate(ids)], "rank int, id bigint")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")
    _blocks(docs, ids, tokenizer_file, end_id).write.parquet(f"{folder}/blocks")


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def read_ranks(spark: SparkSession, folder: str) -> np.ndarray:
    table = spark.read.schema("rank int, id bigint").parquet(f"{folder}/ranks").toPandas()
    return table.sort_values("rank")["id"].to_numpy(np.uint32)


def _first_ids(blocks: DataFrame) -> DataFrame:
    """part and first, the ids of all parts before it: a row per part."""
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    each = blocks.select("part", size.alias("ids")).groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, and with_ids the array ids, read from the files.

    start: ids of all documents before. The starts of blocks are prefix sums over the blocks of their part and over parts.
    """
    blocks = read_blocks(spark, folder)
    held = spark.sparkContext.broadcast(read_ranks(spark, folder))
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", size.alias("ids")).withColumn(
        "offset", F.coalesce(F.sum("ids").over(inside), F.lit(0))
    )
    placed = (
        starts.join(_first_ids(blocks), "part")
        .select("part", "block", (F.col("first") + F.col("offset")).alias("at"))
        .join(blocks, ["part", "block"])
        .select("at", "doc_ids", "lengths", "control", "data")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = held.value
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = by_rank[decoded_ranks(row["control"], row["data"], int(ends[-1]))].astype("<u4")
                raw = memoryview(ids.tobytes())
                crcs = [crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - lengths + row["at"]),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.r_[0, ends].astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.mapInArrow(decode, schema + (", ids array<bigint>" if with_ids else ""))


def token_files(docs: DataFrame, tokenizer_file: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the files, to the shared folder unless told otherwise, and read them back."""
    spark = docs.sparkSession
    folder = folder or staging_path(spark, "token-files")
    write_token_files(docs, folder, tokenizer_file)
    return read_documents(spark, folder)
