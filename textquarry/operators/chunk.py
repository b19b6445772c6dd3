"""Heading-aware and fixed-size splitting of clean text into chunk rows.

Everything here is a column expression over one document's text: a document
becomes an array of chunks and one `posexplode` turns it into rows, so the
running chunk number needs neither a shuffle nor a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import INLINE_WS, LB, WS, let, lstrip, rejoin_lines, strip

CHUNK_SIZE = 300
OVERLAP = 50
BATCH_SIZE = 16
TITLE_CHARS = 10

_NUL = "\u0000"
# A heading line: its blank run may cross line ends, `.` may not.
_HEADING = rf"(?md)^#{{1,6}}[{WS}]+.*$"
_HEADING_IN_LINE = rf"[{INLINE_WS}]*#{{1,6}}[{INLINE_WS}]+"


def check_levels(lowest: int, deepest: int) -> None:
    if not 1 <= lowest <= deepest <= 6:
        raise ValueError("heading levels must satisfy 1 <= lowest <= deepest <= 6")


def check_window(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than the chunk size")


def semantic_blocks(text: Column, lowest: int = 2, deepest: int = 6) -> Column:
    """Split at Markdown headings of the given levels.

    Text before the first such heading is dropped; text without any is one block.
    Heading starts are marked with NUL, and levels outside the range unmarked
    again. A NUL of the text itself gets a `_` behind it, so that only marks are
    followed by `#`.
    """
    check_levels(lowest, deepest)
    marked = F.regexp_replace(F.replace(text, F.lit(_NUL), F.lit(_NUL + "_")), _HEADING, _NUL + "$0")
    if lowest > 1:
        marked = F.regexp_replace(marked, rf"\x00(?=#{{1,{lowest - 1}}}[^#])", "")
    if deepest < 6:
        marked = F.regexp_replace(marked, rf"\x00(?=#{{{deepest + 1},6}}[^#])", "")
    parts = F.split(marked, r"\x00(?=#)")
    restored = F.transform(parts, lambda p: strip(F.replace(p, F.lit(_NUL + "_"), F.lit(_NUL))))
    sections = let(
        restored,
        lambda p: F.when(F.size(p) == 1, F.array(text)).otherwise(
            F.filter(F.slice(p, 2, F.size(p)), lambda b: b != "")
        ),
    )
    return (
        F.when(text.isNull() | (strip(text) == ""), F.array().cast("array<string>"))
        .when(F.contains(text, F.lit("#")), sections)
        .otherwise(F.array(text))
    )


def fixed_windows(text: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    """Overlapping windows of `size` characters, `size - overlap` apart.

    One regex pass: the look-ahead captures a window, the body consumes a stride.
    A further window starts only while more than the overlap remains, so the cost
    is linear in the text however long it is.
    """
    check_window(size, overlap)
    window = rf"(?s)(?=(.{{{overlap + 1},{size}}})).{{1,{size - overlap}}}"
    return (
        F.when(text.isNull() | (text == ""), F.array().cast("array<string>"))
        .when(F.length(text) <= size, F.array(text))
        .otherwise(F.regexp_extract_all(text, F.lit(window), F.lit(1)))
    )


def section_heading(block: Column) -> Column:
    """Text of the first heading line of any level, indented or not; else empty."""
    found = F.regexp_extract(
        block, rf"(?:\A|[{LB}]){_HEADING_IN_LINE}([^{WS}][^{LB}]*)", 1
    )
    return F.when(F.contains(block, F.lit("#")), strip(found)).otherwise("")


def without_heading_line(block: Column) -> Column:
    """Drop the first line if it is a heading; otherwise leave the block alone."""
    is_heading = F.rlike(block, F.lit(rf"\A{_HEADING_IN_LINE}[^{WS}]"))
    rest = F.regexp_replace(block, rf"\A[^{LB}]*(?:\r\n|[{LB}])?", "")
    return F.when(is_heading, lstrip(rejoin_lines(rest))).otherwise(block)


def fallback_title(segment: Column, base: Column | None = None) -> Column:
    """First line of a stripped segment without leading `#` and blanks, else `base`.

    At most ten characters. The pattern reads no further than needed: ten
    characters that are followed by more text, or fewer up to the last non-blank.
    """
    head = (
        rf"\A[{INLINE_WS}]*((?:[^{LB}]{{{TITLE_CHARS}}}(?=[^{LB}]*?[^{WS}]))"
        rf"|(?:[^{LB}]{{0,{TITLE_CHARS - 1}}}[^{WS}])?)"
    )
    otherwise = F.lit("") if base is None else F.substring(base, 1, TITLE_CHARS)
    return let(
        F.regexp_extract(F.ltrim(segment, F.lit("# ")), head, 1),
        lambda line: F.when(line != "", line).otherwise(otherwise),
    )


def _block_segments(block: Column, heading: Column, size: int, overlap: int) -> Column:
    """Segments of one block as `struct<content, inherited, fallback>`."""
    body = F.when(heading != "", without_heading_line(block)).otherwise(block)
    windows = let(body, lambda b: fixed_windows(b, size, overlap))
    pieces = F.filter(
        F.transform(windows, lambda w, i: F.struct(strip(w).alias("w"), i.alias("i"))),
        lambda p: p.w != "",
    )
    headed = F.transform(
        pieces,
        lambda p: F.when(
            (p.i == 0) & (heading != ""), F.concat(F.lit("## "), heading, F.lit("\n"), p.w)
        ).otherwise(p.w),
    )
    # A block is measured with its heading but split without it.
    contents = F.when(F.length(block) <= size, F.array(strip(block))).otherwise(
        let(headed, lambda h: F.when(F.size(h) == 0, F.array(strip(block))).otherwise(h))
    )
    return F.transform(
        contents,
        lambda c, i: F.struct(
            c.alias("content"),
            F.when((i == 0) & (heading != ""), heading).alias("inherited"),
            fallback_title(c, heading).alias("fallback"),
        ),
    )


def chunk_array(text: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    """All chunks of a text, in order, as `array<struct<content, inherited, fallback>>`."""
    check_window(size, overlap)
    blocks = F.transform(
        semantic_blocks(text),
        lambda b: F.struct(b.alias("block"), section_heading(b).alias("heading")),
    )
    return F.flatten(F.transform(blocks, lambda s: _block_segments(s.block, s.heading, size, overlap)))


def chunk_candidates(
    documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = OVERLAP
) -> DataFrame:
    """`(document_id, title, clean_text)` to one row per chunk, section not yet chosen."""
    return documents.select(
        "document_id", "title", F.posexplode(chunk_array(F.col("clean_text"), size, overlap)).alias("n", "c")
    ).select(
        "document_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("n").alias("chunk_index"),
        "c.content",
        "c.inherited",
        "c.fallback",
    )


def merged_small(chunks: DataFrame, smallest: int, largest: int, between: str = "\n") -> DataFrame:
    """Chunk rows of which short ones are joined with what follows them.

    Read from the first chunk of a document: one below `smallest` characters takes in the next, `between` standing between them, unless that would
    make more than `largest`; then it is left as it is. Title and section are those of the first part. Numbers and ids are made anew.
    Nothing is dropped; chunks without a number come first, ties by chunk_id. A document's chunks are one array, as its text was one cell.
    """
    order = F.struct(F.coalesce("metadata.chunk_index", F.lit(-1)).alias("i"), "chunk_id", "content", "metadata.title", "metadata.section")
    listed = chunks.groupBy("document_id").agg(F.array_sort(F.collect_list(order)).alias("parts"))
    parts = F.transform(
        "parts", lambda p: F.struct(F.coalesce(p["content"], F.lit("")).alias("content"), p["title"].alias("title"), p["section"].alias("section"))
    )
    kind = "struct<done:array<struct<content:string,title:string,section:string>>,now:struct<content:string,title:string,section:string>>"

    def step(state: Column, part: Column) -> Column:
        now = state["now"]
        joined = F.concat(now["content"], F.lit(between), part["content"])
        fits = (F.length(now["content"]) < smallest) & (F.length(joined) <= largest)
        grown = F.struct(joined.alias("content"), now["title"].alias("title"), now["section"].alias("section"))
        return (
            F.when(now.isNull(), F.struct(state["done"].alias("done"), part.alias("now")))
            .when(fits, F.struct(state["done"].alias("done"), grown.alias("now")))
            .otherwise(F.struct(F.concat(state["done"], F.array(now)).alias("done"), part.alias("now")))
            .cast(kind)
        )

    start = F.struct(F.array().alias("done"), F.lit(None).alias("now")).cast(kind)
    whole = F.aggregate(parts, start, step, lambda s: F.concat(s["done"], F.array(s["now"])))
    return listed.select("document_id", F.posexplode(whole).alias("chunk_index", "c")).select(
        "document_id",
        F.concat_ws("-", "document_id", "chunk_index").alias("chunk_id"),
        F.col("c.content").alias("content"),
        F.struct(F.col("c.title").alias("title"), F.col("c.section").alias("section"), "chunk_index").alias("metadata"),
    )


def chunk_record(section: Column) -> list[Column]:
    """Columns of a chunk row from those of `chunk_candidates` and the chosen section."""
    return [
        F.col("document_id"),
        F.concat_ws("-", "document_id", "chunk_index").alias("chunk_id"),
        F.col("content"),
        F.struct("title", section.alias("section"), "chunk_index").alias("metadata"),
    ]


def chunk_documents(
    documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = OVERLAP
) -> DataFrame:
    """Chunk rows with inherited or fallback sections (no title service)."""
    return chunk_candidates(documents, size, overlap).select(
        *chunk_record(F.coalesce("inherited", "fallback"))
    )
