"""Reading order and paragraphs of PDF pages, from rows of positioned words.

Input rows: `doc_id, page_no, word_idx, page_width, page_height, text, x0, x1,
top, bottom, size, fontname`. All windows and groupings up to the page text use
keys that start with `(doc_id, page_no)`, so Spark shuffles the words once and
reuses that partitioning; a long document is spread over its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import WS, code_point_class, let, nfkc, strip, strip_words, tenths

# Fixed values.
HEADER_RATIO = 0.1
FOOTER_RATIO = 0.9
HEADING_SIZE_FACTOR = 1.2
SEGMENT_SIZE_FACTOR, SEGMENT_MIN_GAP = 4.0, 40.0
SEGMENT_WIDTH_RATIO, SEGMENT_MAX_GAP = 0.12, 110.0
COLUMN_WIDTH_RATIO, COLUMN_MIN_GAP = 0.18, 120.0
DEFAULT_LINE_GAP, LINE_GAP_FACTOR = 12.0, 2.0
TERMINATORS = "。！?？!；;：:.…"
BULLETS = "-*•●·"
ROMAN_DIGITS = "ivxlcdmIVXLCDMİı"  # with the two letters that case folding adds to `i`

PAGE = ["doc_id", "page_no"]
LINE = [*PAGE, "line_key"]  # the top of a line in tenths: an integer groups exactly
SEGMENT = [*LINE, "segment_no"]
_GEOMETRY = ["page_width", "body_size", "line_gap"]

NOISE_PATTERN = rf"\A(?:[0-9{WS}]+|[A-Z]\.?)\z"


def filtered_words(words: DataFrame) -> DataFrame:
    """Words with text that lie between the header and the footer band."""
    number = {c: F.coalesce(c, F.lit(0.0)) for c in ("x0", "top", "bottom", "size")}
    return (
        words.withColumns({"text": strip_words(F.col("text")), "x1": F.coalesce("x1", "x0", F.lit(0.0)), **number})
        .withColumn("fontname", F.coalesce("fontname", F.lit("")))
        .where(
            (F.col("text") != "")
            & (F.col("top") >= F.col("page_height") * HEADER_RATIO)
            & (F.col("bottom") <= F.col("page_height") * FOOTER_RATIO)
        )
    )


def arranged(words: DataFrame) -> DataFrame:
    """Bring the words of a page together, in lines from left to right.

    This one shuffle and sort serve the windows over pages as well as those over lines.
    Font name, top and bottom are reduced to what is asked of them before they are moved.
    """
    height = F.when(F.col("bottom") >= F.col("top"), F.col("bottom") - F.col("top"))
    needed = words.select(
        *PAGE,
        tenths(F.col("top")).alias("line_key"),
        "word_idx",
        "page_width",
        "text",
        "x0",
        "x1",
        "size",
        height.alias("height"),
        F.rlike("fontname", F.lit("(?i)bold")).alias("bold"),
    )
    return needed.repartition(*PAGE).sortWithinPartitions(*LINE, "x0", "word_idx")


def page_measures(words: DataFrame) -> DataFrame:
    """Add the median font size and the paragraph gap of each word's page."""
    page = W.partitionBy(*PAGE)
    size = F.median(F.when(F.col("size") > 0, F.col("size"))).over(page)
    height = F.median("height").over(page)
    return words.withColumns(
        {
            "body_size": F.coalesce(size, F.lit(0.0)),
            "line_gap": F.coalesce(height * LINE_GAP_FACTOR, F.lit(DEFAULT_LINE_GAP)),
        }
    ).drop("height")


def line_segments(words: DataFrame) -> DataFrame:
    """Number the segments of each line: a wide gap to the previous word starts one."""
    in_line = W.partitionBy(*LINE).orderBy("x0", "word_idx")
    widest = F.greatest(
        F.col("body_size") * SEGMENT_SIZE_FACTOR,
        F.lit(SEGMENT_MIN_GAP),
        F.least(F.col("page_width") * SEGMENT_WIDTH_RATIO, F.lit(SEGMENT_MAX_GAP)),
    )
    starts = F.col("x0") - F.lag("x1").over(in_line) > widest
    return (
        words.withColumn("starts", F.coalesce(starts.cast("int"), F.lit(0)))
        .withColumn("segment_no", F.sum("starts").over(in_line).cast("int"))
        .drop("starts")
    )


def line_top() -> Column:
    return F.col("line_key") / F.lit(10.0)


def is_heading_word() -> Column:
    larger = (F.col("body_size") > 0) & (F.col("size") >= F.col("body_size") * HEADING_SIZE_FACTOR)
    return larger | F.col("bold")


def assembled_segments(words: DataFrame) -> DataFrame:
    """One row per segment: its text, marked `## ` if a heading, and its centre."""
    word = F.struct("x0", "word_idx", "text", ((F.col("x0") + F.col("x1")) / 2).alias("middle"))
    grouped = words.groupBy(*SEGMENT).agg(
        *[F.first(c).alias(c) for c in _GEOMETRY],
        F.min("x0").alias("first_x0"),
        F.bool_or(is_heading_word()).alias("marked"),
        F.sort_array(F.collect_list(word)).alias("words"),
    )
    text = F.array_join(F.transform("words", lambda w: w["text"]), " ")
    middles = F.sort_array(F.transform("words", lambda w: w["middle"]))
    median = let(
        middles,
        lambda m: (
            F.get(m, F.floor((F.size(m) - 1) / 2).cast("int")) + F.get(m, F.floor(F.size(m) / 2).cast("int"))
        )
        / 2,
    )
    heading = let(text, lambda t: strip(F.concat(F.lit("## "), F.ltrim(t, F.lit("# ")))))
    return grouped.select(
        *SEGMENT,
        line_top().alias("line_top"),
        *_GEOMETRY,
        "first_x0",
        median.alias("centre"),
        F.when(F.col("marked"), heading).otherwise(text).alias("text"),
    )


def page_columns(segments: DataFrame) -> DataFrame:
    """Assign segments to at most two columns, parted at the widest gap of centres."""
    page = W.partitionBy(*PAGE)
    following = F.lead("centre").over(page.orderBy("centre"))
    # Among equal gaps the leftmost wins.
    gap = F.struct((following - F.col("centre")).alias("gap"), (-F.col("centre")).alias("minus_left"), following.alias("right"))
    needed = F.greatest(F.lit(COLUMN_MIN_GAP), F.col("page_width") * COLUMN_WIDTH_RATIO)
    return (
        segments.withColumn("_gap", F.when(following.isNotNull(), gap))
        .withColumn("_widest", F.max("_gap").over(page))
        .withColumn(
            "boundary",
            F.when(
                F.col("_widest.gap") >= needed,
                (F.col("_widest.right") - F.col("_widest.minus_left")) / 2,
            ),
        )
        .withColumn("column_no", F.when(F.col("centre") > F.col("boundary"), 1).otherwise(0))
        .drop("_gap", "_widest")
    )


def starts_with_bullet(text: Column) -> Column:
    digits = code_point_class(str.isdecimal)
    return F.rlike(text, F.lit(rf"\A(?:[{BULLETS.replace('-', chr(92) + '-')}]|[{digits}]+[).]|[{ROMAN_DIGITS}]+\.)"))


def ends_paragraph(text: Column) -> Column:
    return F.rlike(F.right(text, F.lit(1)), F.lit(f"[{TERMINATORS}{code_point_class(str.isdigit)}]"))


def _joint(first: Column, after_heading: Column, gap: Column, continues: Column) -> Column:
    """What stands between a line and the kept one before it in its column."""
    return (
        F.when(first, "\n\n").when(after_heading, "\n").when(gap, "\n\n").when(continues, " ").otherwise("\n")
    )


def joined_lines(segments: DataFrame) -> DataFrame:
    """Add `kept` and `joint`: what stands between a line and the kept one before it.

    That is a space where it continues the sentence, else a line end, and a blank
    line after a paragraph gap or between columns. Whether a line continues another
    depends only on the two of them, so looking back one kept line is enough. A gap
    seen at a dropped line still counts for the next kept one.
    """
    column = W.partitionBy(*PAGE, "column_no").orderBy("line_top", "first_x0", "segment_no")
    before = column.rowsBetween(W.unboundedPreceding, -1)
    so_far = column.rowsBetween(W.unboundedPreceding, 0)
    return (
        segments.withColumn("kept", ~F.rlike("text", F.lit(NOISE_PATTERN)))
        .withColumns(
            {
                "last": F.last(F.when(F.col("kept"), F.col("text")), ignorenulls=True).over(before),
                "step": F.col("line_top") - F.lag("line_top").over(column),
            }
        )
        .withColumn("gaps", F.count_if(F.col("step") > F.col("line_gap")).over(so_far))
        .withColumn(
            "last_gaps", F.last(F.when(F.col("kept"), F.col("gaps")), ignorenulls=True).over(before)
        )
        .withColumns(
            {
                "first": F.col("last").isNull(),
                "gap": F.coalesce(F.col("gaps") > F.col("last_gaps"), F.lit(False)),
                "continues": ~(
                    F.startswith("text", F.lit("## "))
                    | F.coalesce(ends_paragraph(F.col("last")), F.lit(False))
                    | starts_with_bullet(F.col("text"))
                ),
            }
        )
        .withColumn(
            "joint",
            _joint(
                F.col("first"),
                F.coalesce(F.startswith("last", F.lit("## ")), F.lit(False)),
                F.col("gap"),
                F.col("continues"),
            ),
        )
        .drop("last", "step", "gaps", "last_gaps")
    )


def _join_after_bare_marks(lines: Column) -> Column:
    """Join the lines of a page on which one is a bare `##`.

    Such a line turns into a heading when the next one continues it, so here, and
    only here, a joint depends on how the lines before were joined.
    """
    start = F.struct(F.lit("plain").alias("last"), F.lit("").alias("text"))

    def add(so_far: Column, line: Column) -> Column:
        joint = _joint(line["first"], so_far["last"] == "heading", line["gap"], line["continues"])
        last = (
            F.when(F.startswith(line["text"], F.lit("## ")), "heading")
            .when(joint == " ", F.when(so_far["last"] == "bare", "heading").otherwise("plain"))
            .when(line["text"] == "##", "bare")
            .otherwise("plain")
        )
        return F.struct(last.alias("last"), F.concat(so_far["text"], joint, line["text"]).alias("text"))

    return F.aggregate(lines, start, add, lambda end: end["text"])


def page_texts(lines: DataFrame) -> DataFrame:
    """Concatenate the kept lines of each page, column by column."""
    order = ["column_no", "line_top", "first_x0", "segment_no"]
    line = F.struct(*order, "text", "joint", "first", "gap", "continues")
    collected = lines.groupBy(*PAGE).agg(
        F.sort_array(F.collect_list(F.when(F.col("kept"), line))).alias("lines")
    )
    plain = F.array_join(F.transform("lines", lambda n: F.concat(n["joint"], n["text"])), "")
    text = F.when(
        F.exists("lines", lambda n: n["text"] == "##"), _join_after_bare_marks(F.col("lines"))
    ).otherwise(plain)
    return collected.select(*PAGE, strip(text).alias("page_text"))


def measured_words(words: DataFrame) -> DataFrame:
    return page_measures(arranged(filtered_words(words)))


def laid_out_lines(words: DataFrame) -> DataFrame:
    """Words to lines with column and joint; the words are shuffled once, by page."""
    return joined_lines(page_columns(assembled_segments(line_segments(measured_words(words)))))


def with_page_fallback(page_text: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages without any word left take their plain text, `pages.fallback_text`.

    Page texts lie by page already; estimates of their size are too low to broadcast them on.
    """
    return pages.join(page_text.hint("merge"), PAGE, "left").select(
        *PAGE, F.coalesce("page_text", strip(F.col("fallback_text")), F.lit("")).alias("page_text")
    )


def document_texts(page_text: DataFrame) -> DataFrame:
    """Join the non-empty pages of each document and normalise."""
    pages = F.sort_array(
        F.collect_list(F.when(F.col("page_text") != "", F.struct("page_no", "page_text")))
    )
    joined = page_text.groupBy("doc_id").agg(
        F.array_join(F.transform(pages, lambda p: p["page_text"]), "\n\n").alias("clean_text")
    )
    return joined.select("doc_id", strip(nfkc(F.col("clean_text"))).alias("clean_text"))


def clean_pdf_words(words: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Clean text per document from its words, and from `pages` where none are left."""
    texts = page_texts(laid_out_lines(words))
    return document_texts(texts if pages is None else with_page_fallback(texts, pages))
