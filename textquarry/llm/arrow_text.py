"""Words of Arrow text columns as flat numpy arrays, without a Python object per word.

Hashes have 64 bits and depend on the bytes of a word alone, so they agree between tasks and runs. Equal hashes are
taken for equal words; among a billion different words one such mix-up is expected with a chance of 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; longer only for a single longer word.
BLOCK = 1 << 20
#: Texts taken from an Arrow batch at once hold about so many bytes.
SLICE_BYTES = 1 << 20


def separators(more: bytes = b"") -> np.ndarray:
    """A table over bytes: white space of ASCII, and `more`."""
    table = np.zeros(256, bool)
    table[list(b"\t\n\v\f\r " + more)] = True
    return table


#: White space alone separates words.
SPACES = separators()
#: Punctuation and symbols of ASCII do too.
PUNCTUATION = separators(bytes(x for x in range(33, 127) if not chr(x).isalnum()))
_UPPER_TO_LOWER = np.array([x + 32 if 65 <= x <= 90 else x for x in range(256)])


class Words(NamedTuple):
    """hashes: one for each word; row i of the column has those from offsets[i] to offsets[i + 1].

    data, starts, ends: the bytes of the column and where its words lie in them.
    """

    hashes: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def noise(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values that look random."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(step + mixed(np.full(1, seed, np.uint64)))


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, _INVERSE):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        both.append(np.cumprod(x))
    return both[0], both[1]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows in them; null counts as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, rows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; a word never goes on in the next row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = rows[:-1][rows[:-1] < len(data)]
    first[begins] = inside[begins]
    finishes = rows[1:][rows[1:] > 0] - 1
    last[finishes] = inside[finishes]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word by prefix sums; letters: the value of each byte."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        high = int(ends[j - 1])
        up, down = _powers(max(BLOCK, 1 << (high - low).bit_length()))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(letters[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mixed(out)


def words(texts: pa.Array, table: np.ndarray = SPACES, lower: bool = True) -> Words:
    """The words of a string column. lower: A to Z count as a to z."""
    data, rows = utf8(texts)
    starts, ends = spans(data, rows, table)
    letters = noise(256, 1)
    found = hashed(data, starts, ends, letters[_UPPER_TO_LOWER] if lower else letters)
    return Words(found, np.searchsorted(starts, rows), data, starts, ends)


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values (or of their rows) between offsets; empty ranges give zero."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each value, the row it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has about `size` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        i = 0
        while i < batch.num_rows:
            before = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(i, j - i)
            i = j
