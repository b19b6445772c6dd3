"""Token ids of whole texts by a public word tokenizer, asked once for each different unit.

The tokenizer drops white space and never joins across it; between white space it splits runs of letters, single
digits and runs of other signs. Units are those parts of a word that has just ASCII and the letters of Latin-1; any
other word, and one with an apostrophe, a `<` or a control character, is a unit as a whole and encoded by the library's full
pipeline. Units go to the library's model, so all ids are its own. They are found and looked up by 64-bit hash in
numpy arrays, A to Z as a to z in units for the model alone and as they are in whole ones; the table of units is emptied at MAX_UNITS, which bounds its memory.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from textquarry.llm.arrow_text import _UPPER_TO_LOWER, SPACES, hashed, noise, utf8

MAX_UNITS = 1_500_000
DEFAULT_FILE = "word_bpe_49k.json"
_FRONT = 1 << 21
_LETTER, _DIGIT, _OTHER = 1, 2, 3
_KIND = np.array(
    [
        0 if SPACES[x] else _DIGIT if 48 <= x <= 57 else _LETTER if x >= 128 or chr(x).isalpha() else _OTHER
        for x in range(256)
    ],
    np.uint8,
)
#: Bytes that keep a word whole, but for the second byte of a letter of Latin-1.
_WHOLE = np.array([not SPACES[x] and (x < 32 or x >= 127 or chr(x) in "'<") for x in range(256)])
#: Bytes of UTF-8 as the characters that the model knows them by: printable ones as they are, others from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [x for x in range(256) if x not in _PRINTABLE]
_AS_CHARACTER = {x: x if x in _PRINTABLE else 256 + _OTHERS.index(x) for x in range(256)}


def units(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each unit, and whether it is a whole word for the full pipeline."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    kind = _KIND[data]
    new_row = np.zeros(n + 1, bool)
    new_row[rows] = True
    begins_word = (kind > 0) & (np.r_[True, kind[:-1] == 0] | new_row[:-1])
    whole = _WHOLE[data]
    if (data >= 128).any():
        first = data == 0xC3
        second = np.r_[False, first[:-1]] & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
        whole[second] = False
        whole[:-1][first[:-1] & second[1:]] = False
    word = np.cumsum(begins_word)
    bad = np.zeros(word[-1] + 1, bool)
    bad[word[whole]] = True
    cut = np.r_[True, kind[1:] != kind[:-1]] | (kind == _DIGIT)
    starts = np.flatnonzero((kind > 0) & (begins_word | (cut & ~bad[word])))
    follows = np.r_[starts[1:], n]
    blanks = np.flatnonzero((kind == 0) | new_row[:-1])  # a unit ends at the next one, a blank or its row's end
    at = np.searchsorted(blanks, starts, "right")
    stop = np.r_[blanks, n][at]
    return starts, np.minimum(follows, stop), bad[word[starts]]


class UnitTokens:
    """Ids of units, kept by hash: keys are sorted, and unit i has ids[starts[i]:starts[i] + lengths[i]]."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.ids, self.used, self.number = np.zeros(4096, np.uint32), 0, 0
        self.front_key, self.front_at = np.zeros(_FRONT, np.uint64), np.full(_FRONT, -1, np.int32)

    def _ids_of(self, unit: bytes, whole: bool) -> list[int]:
        text = unit.decode()
        if whole:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        low = text.lower()
        known = low if low.isascii() else low.encode().decode("latin-1").translate(_AS_CHARACTER)
        return [t.id for t in self.model.tokenize(known)]

    def _learn(self, keys: np.ndarray, found: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        while self.number + len(found) > len(self.starts):
            self.starts, self.lengths = (np.r_[x, np.zeros_like(x)] for x in (self.starts, self.lengths))
        here = slice(self.number, self.number + len(found))
        self.ids[self.used : self.used + len(flat)] = flat
        self.lengths[here] = lengths
        self.starts[here] = self.used + np.cumsum(lengths) - lengths
        place = np.searchsorted(self.keys, keys)
        new = np.arange(here.start, here.stop, dtype=np.int32)
        self.keys, self.at = np.insert(self.keys, place, keys), np.insert(self.at, place, new)
        self.used, self.number = self.used + len(flat), here.stop

    def _find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """For each unit its number in the table."""
        letters = noise(256, 2)
        keys = hashed(data, starts, ends, letters[_UPPER_TO_LOWER])
        if whole.any():  # added tokens are matched by case
            keys[whole] = hashed(data, starts[whole], ends[whole], letters) ^ np.uint64(1)
        slot = (keys & np.uint64(_FRONT - 1)).astype(np.int64)
        at = np.where(self.front_key[slot] == keys, self.front_at[slot], -1)
        missed = np.flatnonzero(at < 0)
        if len(missed):
            distinct, where, back = np.unique(keys[missed], return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, distinct)
            known = np.zeros(len(distinct), bool)
            inside = place < len(self.keys)
            known[inside] = self.keys[place[inside]] == distinct[inside]
            unknown = np.flatnonzero(~known)
            if len(unknown):
                raw = data.tobytes()
                of = missed[where[unknown]]
                spans = zip(starts[of].tolist(), ends[of].tolist(), whole[of].tolist(), strict=True)
                self._learn(distinct[unknown], [self._ids_of(raw[s:e], w) for s, e, w in spans])
                place = np.searchsorted(self.keys, distinct)
            found = self.at[place]
            at[missed] = found[back]
            slots = (distinct & np.uint64(_FRONT - 1)).astype(np.int64)
            self.front_key[slots], self.front_at[slots] = distinct, found
        return at

    def _numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.number > MAX_UNITS:
            self._clear()
        data, rows = utf8(texts)
        starts, ends, whole = units(data, rows)
        return self._find(data, starts, ends, whole), np.searchsorted(starts, rows)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of a column, and the offsets of the rows in them; null counts as empty."""
        at, rows = self._numbers(texts)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        first = np.repeat(self.starts[at] - (ends - lengths), lengths)
        ids = self.ids[first + np.arange(len(first))]
        return ids, np.r_[0, ends][rows]

    def count(self, texts: pa.Array) -> np.ndarray:
        """How often each id occurs in a column."""
        at, _ = self._numbers(texts)
        times = np.bincount(at, minlength=self.number)
        out = np.zeros(self.size, np.int64)
        seen = np.flatnonzero(times)
        lengths = self.lengths[seen]
        ends = np.cumsum(lengths)
        of = np.repeat(self.starts[seen] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        np.add.at(out, self.ids[of], np.repeat(times[seen], lengths))
        return out

    def sizes(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each row."""
        at, rows = self._numbers(texts)
        return np.diff(np.r_[0, np.cumsum(self.lengths[at])][rows])


@lru_cache(maxsize=2)
def unit_tokens(file: str | None = None) -> UnitTokens:
    """One table per file and worker process; file: by default the public word tokenizer's."""
    if file is None:
        import public_tokenizers

        file = public_tokenizers.path(DEFAULT_FILE)
    return UnitTokens(file)
