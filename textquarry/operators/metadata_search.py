"""Rows whose JSON metadata contain a pattern, by an inverted index in files.

A pattern is contained in a value if it is an object whose members are contained in the value's members of the same names, an array
whose elements are each contained in some element, or an equal scalar; numbers are equal by value. Every node of a value makes an entry:
its path without array positions, with the scalar or the kind of container. Per entry and BLOCK row numbers there is one list of row
numbers, as differences in bytes of seven bits, so the list of a frequent value is many rows. Of a pattern's scalars and empty containers
a search reads the lists of the one that the fewest rows have. Only in blocks where these are many it reads those of the others, and intersects
them, the shortest first; so a pattern with a rare value costs no more for its frequent ones. What is left is compared with the pattern itself.

Metadata that are null, no JSON or nested deeper than DEPTH levels are not found, nor do such patterns find anything. Repeated patterns
count once, of rows with one id each.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEPTH = 200
BLOCK_BITS = 16  # BLOCK = 2^16 row numbers
#: So few rows of a block are compared with the pattern without a look at its other lists.
DIRECT = 256
_ROWS = "number bigint, id string, metadata string"
_LISTS = "entry bigint, block bigint, n int, numbers binary"


def _no_number(text: str) -> None:
    raise ValueError(text)


def parsed(text: str | None) -> tuple[bool, object]:
    """Whether a text is JSON of at most DEPTH levels, and its value."""
    try:
        value = json.loads(text, parse_float=Decimal, parse_int=Decimal, parse_constant=_no_number)
    except (TypeError, ValueError, ArithmeticError, RecursionError):
        return False, None
    level, inner = 0, [value]
    while inner and level <= DEPTH:
        level += 1
        inner = [x for v in inner if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
    return (False, None) if inner else (True, value)


def _scalar(value: object) -> str:
    if not isinstance(value, Decimal):
        return json.dumps(value)
    sign, digits, exponent = value.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    kept = text.rstrip("0")
    return f"{'-' * sign}{kept}e{exponent + len(text) - len(kept)}" if kept else "0"


def _nodes(value: object, path: str = "") -> Iterator[tuple[str, bool]]:
    """Entries of a value as text, and whether nothing lies below the node."""
    if isinstance(value, dict):
        yield path + "{", not value
        for name, member in value.items():
            yield from _nodes(member, f"{path}.{json.dumps(name)}")
    elif isinstance(value, list):
        yield path + "[", not value
        for element in value:
            yield from _nodes(element, path + "[]")
    else:
        yield f"{path}={_scalar(value)}", True


def entries(value: object, ends_only: bool = False) -> list[int]:
    texts = {text for text, end in _nodes(value) if end or not ends_only}
    hashed = (hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest() for t in texts)
    return sorted({int.from_bytes(h, "little", signed=True) for h in hashed})


def contains(value: object, pattern: object) -> bool:
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and contains(value[k], p) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(contains(v, p) for v in value) for p in pattern)
    return not isinstance(value, (dict, list)) and _scalar(value) == _scalar(pattern)


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, seven bits a byte, the lowest first; the high bit says that more follow."""
    rest = np.diff(numbers, prepend=0).astype(np.uint64)
    sizes = 1 + sum((rest >> np.uint64(7 * i) > 0).astype(np.int64) for i in range(1, 10))
    out, starts = np.zeros(sizes.sum(), np.uint8), np.cumsum(sizes) - sizes
    for i in range(int(sizes.max(initial=0))):
        has = sizes > i
        part = (rest[has] >> np.uint64(7 * i)) & np.uint64(127)
        out[starts[has] + i] = part.astype(np.uint8) | ((sizes[has] > i + 1) * np.uint8(128)).astype(np.uint8)
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    parts = (raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.cumsum(np.add.reduceat(parts, starts) if len(starts) else parts).astype(np.int64)


def _row_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(n, e) for n, text in zip(batch["number"].to_pylist(), batch["metadata"].to_pylist()) for ok, v in [parsed(text)] if ok for e in entries(v)]
        numbers, hashed = (pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([numbers, hashed], names=["number", "entry"])


def _packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = pa.array([packed(x.values.to_numpy(zero_copy_only=False)) for x in batch["numbers"]], pa.binary())
        sizes = batch["numbers"].value_lengths()
        yield pa.RecordBatch.from_arrays([batch["entry"], batch["block"], sizes, lists], names=["entry", "block", "n", "numbers"])


def _pattern_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for pattern in batch["pattern"].to_pylist():
            ok, value = parsed(pattern)
            own = entries(value, ends_only=True) if ok else []
            out += [{"pattern": pattern, "entry": e, "needed": len(own)} for e in own]
        kinds = pa.schema([("pattern", pa.string()), ("entry", pa.int64()), ("needed", pa.int32())])
        yield pa.RecordBatch.from_pylist(out, kinds)


def _intersected(lists: pd.DataFrame) -> pd.DataFrame:
    """Row numbers that all lists of a pattern have in a block."""
    numbers = np.zeros(0, np.int64)
    if len(lists) == lists["needed"].iloc[0]:
        ordered = lists.sort_values("n")["numbers"]
        numbers = reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True) if len(a) else a, map(unpacked, ordered))
    return pd.DataFrame({"pattern": lists["pattern"].iloc[0], "number": numbers})


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pattern with the row numbers of its list."""
    for batch in batches:
        for pattern, data in zip(batch["pattern"], batch["numbers"]):
            numbers = unpacked(data.as_py())
            columns = [pa.repeat(pattern, len(numbers)), pa.array(numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "number"])


def _truly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = {p: parsed(p)[1] for p in batch["pattern"].unique().to_pylist()}
        pairs = zip(batch["metadata"].to_pylist(), batch["pattern"].to_pylist())
        yield batch.filter(pa.array([contains(parsed(m)[1], values[p]) for m, p in pairs], pa.bool_())).select(["pattern", "id"])


class MetadataIndex:
    """An index in two tables below a folder that the cluster shares; it is written whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, rows: DataFrame, id_column: str = "chunk_id", metadata: str = "metadata") -> MetadataIndex:
        named = rows.select(F.col(id_column).cast("string").alias("id"), F.col(metadata).cast("string").alias("metadata"))
        named.select(F.monotonically_increasing_id().alias("number"), "*").write.mode("overwrite").parquet(f"{self.path}/rows")
        found = self._table("rows", _ROWS).select("number", "metadata").mapInArrow(_row_entries, "number bigint, entry bigint")
        blocks = found.groupBy("entry", F.shiftright("number", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list("number")).alias("numbers"))
        lists = blocks.mapInArrow(_packed_lists, _LISTS)
        lists.repartitionByRange("entry", "block").sortWithinPartitions("entry", "block").write.mode("overwrite").parquet(f"{self.path}/lists")
        return self

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def search(self, patterns: DataFrame) -> DataFrame:
        """pattern and id of every row that contains it. patterns: a column `pattern` of JSON text."""
        asked = patterns.select(F.col("pattern").cast("string").alias("pattern")).distinct()
        needed = asked.mapInArrow(_pattern_entries, "pattern string, entry bigint, needed int")
        lists = self._table("lists", _LISTS)
        totals = lists.join(needed.select("entry").distinct(), "entry", "left_semi").groupBy("entry").agg(F.sum("n").alias("total"))
        own = F.sort_array(F.collect_list(F.struct("total", "entry"))).alias("own")
        ranked = needed.join(totals, "entry").groupBy("pattern", "needed").agg(own).where(F.size("own") == F.col("needed"))
        others = F.transform(F.slice("own", F.lit(2), F.size("own")), lambda x: x["entry"]).alias("others")
        rarest = ranked.select("pattern", "needed", F.col("own")[0]["entry"].alias("entry"), others).join(lists, "entry").drop("entry")
        alone = (F.col("n") <= DIRECT) | (F.col("needed") == 1)
        few = rarest.where(alone).select("pattern", "numbers").mapInArrow(_listed, "pattern string, number bigint")
        many = rarest.where(~alone)
        more = many.select("pattern", "needed", "block", F.explode("others").alias("entry")).join(lists, ["entry", "block"])
        every = many.drop("others").unionByName(more.drop("entry"))
        numbers = few.union(every.groupBy("pattern", "block").applyInPandas(_intersected, "pattern string, number bigint"))
        rows = numbers.join(self._table("rows", _ROWS), "number").select("pattern", "id", "metadata")
        return rows.mapInArrow(_truly, "pattern string, id string")
