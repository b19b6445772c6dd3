"""Column helpers with Python string semantics, evaluated in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python counts as whitespace, and those at which
# `str.splitlines` breaks a line (a subset of the former).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
LINE_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85  "
BOM = "﻿"


def _members(chars: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in chars)


# Bodies of Java character classes, to be placed between brackets.
WS = _members(WHITESPACE)
LB = _members(LINE_BREAKS)
INLINE_WS = _members("".join(c for c in WHITESPACE if c not in LINE_BREAKS))


@cache
def code_point_class(test: Callable[[str], bool]) -> str:
    """Body of a Java class holding exactly the code points that pass `test`."""
    ranges: list[list[int]] = []
    for cp in range(sys.maxunicode + 1):
        if test(chr(cp)):
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1][1] = cp
            else:
                ranges.append([cp, cp])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def strip_words(c: Column) -> Column:
    """`strip` for a column of short texts of which most have nothing to strip.

    Trimming makes lists of a text's characters; ends that are visible ASCII signs are told by comparing bytes.
    """

    def visible(end: Column) -> Column:
        return (end >= F.lit("!")) & (end < F.lit("\x7f"))

    return F.when(visible(c) & visible(F.right(c, F.lit(1))), c).otherwise(strip(c))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed before anything that follows.

    For columns of long expressions: a filter on them is else pushed below them, with all they are made of written out at each
    use, and methods made of that are too large for the JVM to compile.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def first_line(c: Column) -> Column:
    return F.regexp_extract(c, rf"\A[^{LB}]*", 0)


def rejoin_lines(c: Column) -> Column:
    """`"\\n".join(s.splitlines())`: every break becomes `\\n`, one final break goes."""
    return F.regexp_replace(F.regexp_replace(c, rf"\r\n|[{LB}]", "\n"), r"\n\z", "")


def universal_newlines(c: Column) -> Column:
    """What reading a file in text mode does to `\\r\\n` and `\\r`."""
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def _composed(c: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))


@F.arrow_udf(T.StringType())
def _composed_in_python(texts: pa.Array) -> pa.Array:
    done = [None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()]
    return pa.array(done, type=pa.string())


@cache
def _icu_within_reach() -> bool:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return True
    try:
        return bool(spark.range(0).select(_composed(F.lit("a"))).columns)
    except AnalysisException:
        return False


def nfkc(c: Column) -> Column:
    """Unicode compatibility composition.

    The ICU library that comes with Spark does the work through the SQL function
    `reflect`, so rows never leave the JVM; a Spark built without it falls back to
    Python. Pure ASCII text, which cannot change, skips either.
    """
    changeable = F.octet_length(c) > F.length(c)
    if _icu_within_reach():
        return F.when(changeable, _composed(c)).otherwise(c)
    return F.coalesce(_composed_in_python(F.when(changeable, c)), c)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `use`, also inside array lambdas."""
    return F.transform(F.array(value), use)[0]


def tenths(c: Column) -> Column:
    """A double in whole tenths, rounded as Python rounds: by its exact binary value, ties to even.

    Ten times the value is kept as an unevaluated sum `head + tail` of two doubles
    (8x and 2x are exact), so the comparison with the half-way point has no rounding error.
    """
    a, b = c * F.lit(8.0), c * F.lit(2.0)
    head = a + b
    back = head - a
    tail = (a - (head - back)) + (b - back)
    low = F.floor(head).cast("double")
    side = (head - low - F.lit(0.5)) + tail
    up = (side > 0) | ((side == 0) & (low % 2 != 0))
    return F.when(up, low + 1).otherwise(low).cast("bigint")
