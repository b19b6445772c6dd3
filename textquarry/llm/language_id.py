"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of signs. The vector of a letter trigram is its letters' vectors, each
permuted (rotated) by its place, bound by multiplication; a text is the bundle, the sum, of its trigrams' vectors,
and a language the bundle of its training texts, trigrams weighed by the part of the text they are. Texts go to
the prototype with the largest cosine.

The dot product of a bundle with a prototype is the sum of its trigrams' dot products, which are a table of
trigrams by languages; the norm of the text is the same for all languages. So texts are compared in all DIMENSIONS
without their vectors being written down, and the score, a language's part of all positive cosines, does not need that norm.

Letters are a to z and 21 classes that other letters fall into by code point, in lower case; all else is a boundary. Trigrams have
a letter in the middle. Whole texts count. Statistics cover all training rows: partial sums by language and trigram, of which
there are at most 48 ** 3 for a language.

`with_language` rejects by the cosine with the best prototype, the text's norm included (as the norm of its trigrams' counts, which the
vectors keep in expectation). A short text has a small cosine, so texts are compared with training texts of as many trigrams, by
powers of two: what is below half the cosine that 99 of 100 of them reach is in no language that was learned (texts of a few repeated
words have small ones too, and stay). A power with fewer than JUDGED training texts takes the bound of the next smaller one that has as
many; without any the text stays.

Defined cases: `und`, score 0, if the text is null or has no letters, or if nothing was learned; ties go to the first
language by code point; empty tables give empty results; rows with one doc_id are each a row; further columns are kept by `identified`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrow_text import noise, per_row, row_of, slices

UNDETERMINED = "und"
DIMENSIONS = 4096
SYMBOLS = 48
GRAMS = SYMBOLS**3
#: Training texts that a bound needs, the part of them that may lie below their quantile, and the bound's part of that.
JUDGED = 32
BELOW, PART = 0.01, 0.5
#: Bytes of text whose trigrams are counted at once; sorting them takes many times that.
COSINE_BYTES = 1 << 17


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """For each code point its symbol; 0 for all but letters."""
    out = np.zeros(0x110000, np.uint8)
    for x in range(0x110000):
        c = chr(x)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[x] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return out


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of a column's texts and the offsets of its rows in them; null counts as empty."""
    listed = [x or "" for x in texts.to_pylist()]
    joined = "\0" + "".join(x + "\0" for x in listed)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _symbols()[points].astype(np.int32)
    kept = symbols > 0
    kept[1:] |= symbols[:-1] > 0
    kept[0] = True
    ends = np.cumsum([len(x) + 1 for x in listed])  # where each row's last boundary is
    at = np.cumsum(kept) - 1
    s = symbols[kept]
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(len(listed) + 1, np.int64)
    whole = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    middle = s[1:-1] > 0
    before = np.r_[0, np.cumsum(middle)]
    last = np.minimum(at[ends], len(middle))
    return whole[middle].astype(np.int64), np.r_[0, before[last]]


def trigram_vectors(numbers: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bound vectors of trigrams, of signs."""
    letters = (noise(SYMBOLS * dimensions, 8) >> np.uint64(63)).astype(np.int8).reshape(SYMBOLS, dimensions) * 2 - 1
    a, b, c = numbers // SYMBOLS**2, numbers // SYMBOLS % SYMBOLS, numbers % SYMBOLS
    return np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]


def held_out(modulus: int = 4, remainder: int = 2) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, trigram and weight, a row for each at most in a partition (beyond 64 languages, in each run of rows)."""
    sums: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, weights in sums.items():
            seen = np.flatnonzero(weights)
            columns = [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(weights[seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "trigram", "weight"])
        sums.clear()

    for batch in slices(batches):
        numbers, rows = trigrams(batch.column("text"))
        sizes = np.diff(rows)
        weight = np.repeat(1 / np.maximum(np.sqrt(sizes), 1), sizes)
        langs = batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            chosen = np.repeat(np.array([x == lang for x in langs]), sizes)
            sums.setdefault(lang, np.zeros(GRAMS))
            sums[lang] += np.bincount(numbers[chosen], weight[chosen], GRAMS)
        if len(sums) > 64:
            yield from out()
    yield from out()


class Profiles:
    """Languages and, for each trigram, the dot products with their normed prototypes."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages = languages
        self.table = table


def profiles(training: DataFrame, dimensions: int = DIMENSIONS) -> Profiles:
    """Learn from text and lang of all rows; rows without a language teach nothing.

    The driver holds sums of at most 48 ** 3 trigrams for a language and one vector for each.
    """
    labelled = training.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sums = labelled.mapInArrow(_sums, "lang string, trigram bigint, weight double")
    totals = sums.groupBy("lang", "trigram").agg(F.sum("weight").alias("weight"))

    def bundle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("trigram")
        vector = np.zeros(dimensions)
        for i in range(0, len(pdf), 4096):
            part = pdf.iloc[i : i + 4096]
            vector += part["weight"].to_numpy() @ trigram_vectors(part["trigram"].to_numpy(), dimensions).astype(float)
        return pd.DataFrame({"lang": [key[0]], "vector": [vector.round(6).tolist()]})

    rows = totals.groupBy("lang").applyInPandas(bundle, "lang string, vector array<double>").collect()
    found = sorted((r["lang"], np.array(r["vector"])) for r in rows)
    if not found:
        return Profiles([], np.zeros((GRAMS, 0), np.float32))
    prototypes = np.stack([v / max(np.linalg.norm(v), 1e-12) for _, v in found], axis=1).astype(np.float32)
    table = np.empty((GRAMS, len(found)), np.float32)
    for i in range(0, GRAMS, 4096):
        table[i : i + 4096] = trigram_vectors(np.arange(i, min(i + 4096, GRAMS)), dimensions).astype(np.float32) @ prototypes
    return Profiles([lang for lang, _ in found], table)


def predictions(texts: pa.Array, known: Profiles) -> tuple[list[str], np.ndarray]:
    """A language and a score for each text."""
    numbers, rows = trigrams(texts)
    none = np.diff(rows) == 0
    if not known.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    dots = per_row(known.table[numbers], rows).astype(np.float64)
    best = dots.argmax(axis=1)
    positive = np.maximum(dots, 0)
    total = positive.sum(axis=1)
    score = np.where(total > 0, positive.max(axis=1) / np.where(total > 0, total, 1), 1 / len(known.languages))
    languages = [UNDETERMINED if n else known.languages[b] for n, b in zip(none, best, strict=True)]
    return languages, np.where(none, 0.0, score)


def identified(docs: DataFrame, known: Profiles, columns: list[str] | None = None) -> DataFrame:
    """The columns named (all if none are) with lang_pred and score; narrow."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    columns = docs.columns if columns is None else columns
    kept = F.struct(*columns).alias("kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            languages, score = predictions(batch.column("text"), held.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(languages, pa.string()), pa.array(score)],
                names=["kept", "lang_pred", "score"],
            )

    chosen = docs.select("text", kept)
    schema = f"kept {chosen.schema['kept'].dataType.simpleString()}, lang_pred string, score double"
    return chosen.mapInArrow(run, schema)


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the rows that are not held out."""
    known = profiles(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    found = identified(rows, known, ["doc_id", "held_out"])
    return found.select("kept.doc_id", "kept.held_out", "lang_pred", "score")


def cosines(texts: pa.Array, known: Profiles, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """The number of trigrams of each text and its cosine with the best prototype, 0 without letters."""
    numbers, rows = trigrams(texts)
    different, times = np.unique(row_of(rows) * GRAMS + numbers, return_counts=True)
    squares = np.bincount(different // GRAMS, times.astype(float) ** 2, len(texts))
    best = per_row(known.table[numbers], rows).max(axis=1).astype(np.float64)
    norm = np.sqrt(dimensions * squares)
    return np.diff(rows), np.where(norm > 0, best / np.where(norm > 0, norm, 1), 0.0)


def _measured(docs: DataFrame, known: Profiles) -> DataFrame:
    """kept, the columns of docs, with grams, cosine and power, the power of two of grams."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    # The text is taken out of kept, so that it is sent and held once.
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept")
            yield pa.RecordBatch.from_arrays([kept, kept.field("text")], names=["kept", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(texts(batches), size=COSINE_BYTES):
            grams, cosine = cosines(batch.column("text"), held.value)
            columns = [batch.column("kept"), pa.array(grams.astype(np.int64)), pa.array(cosine)]
            yield pa.RecordBatch.from_arrays(columns, names=["kept", "grams", "cosine"])

    chosen = docs.select(F.struct(*docs.columns).alias("kept"))
    schema = f"kept {chosen.schema['kept'].dataType.simpleString()}, grams bigint, cosine double"
    power = F.length(F.bin("grams")) - 1
    return chosen.mapInArrow(run, schema).withColumn("power", power)


def bounds(training: DataFrame, known: Profiles) -> dict[int, float]:
    """For each power of two of trigrams the least cosine of a language, learned from text and lang of all rows."""
    labelled = training.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    low = F.percentile_approx("cosine", BELOW).alias("low")
    found = _measured(labelled, known).filter("grams > 0").groupBy("power").agg(low, F.count(F.lit(1)).alias("n"))
    return {r["power"]: PART * r["low"] for r in found.collect() if r["n"] >= JUDGED}  # 31 rows at most


def with_language(docs: DataFrame) -> DataFrame:
    """The documents in a language that was learned, all columns unchanged; those with letters if nothing was learned."""
    known = profiles(docs)
    least = F.lit(None).cast("double")
    if known.languages:
        for power, bound in sorted(bounds(docs, known).items()):
            least = F.when(F.col("power") >= power, bound).otherwise(least)
        found = _measured(docs, known)
        found = found.filter((F.col("grams") > 0) & (F.col("cosine") >= F.coalesce(least, F.lit(-1.0))))
    else:
        found = identified(docs, Profiles(["?"], np.zeros((GRAMS, 1), np.float32))).filter(F.col("lang_pred") != UNDETERMINED)
    return found.select(*(F.col("kept").getField(c).alias(c) for c in docs.columns))
