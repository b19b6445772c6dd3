"""HTML to Markdown-like text.

Work is split in two. A small Arrow function walks the tags of one page and
lists its blocks (headings, paragraphs, list items, tables, ...) with their inline
text. Layout then happens in column expressions: Markdown marks, list
indentation, table padding, blank lines, the leading heading and Unicode
normalisation. Both halves are narrow, so cleaning a corpus never shuffles.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import BOM, LB, let, nfkc, strip

# Fixed values.
NOISE_TAGS = {"script", "style", "nav", "footer", "header", "noscript", "aside"}
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
}
CONTAINER_TAGS = {"div", "section", "article", "main", "body"}
HEADING_TAGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SLICE_CHARS = 1 << 20
NOT_INLINE_TAGS = {"ul", "ol", "table"}
BLOCK_TAGS = {"p", "pre", "blockquote", "a"} | NOT_INLINE_TAGS | HEADING_TAGS

_ROW = T.StructType(
    [T.StructField("head", T.BooleanType()), T.StructField("cells", T.ArrayType(T.StringType()))]
)
_BLOCK = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("list_no", T.IntegerType()),
        T.StructField("mark", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("rows", T.ArrayType(_ROW)),
    ]
)
PAGE_BLOCKS = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(_BLOCK)),
        T.StructField("heading", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _squeeze(text: str) -> str:
    text = text.replace("\r", "").replace(BOM, "")
    if "  " in text or "\t" in text or "\f" in text or "\v" in text:
        text = re.sub(r"[ \t\f\v]+", " ", text)
    return text


def _inline(parts: list[str]) -> str:
    # squeezed text has at most one space on either side of a line end
    text = _squeeze("".join(parts)).replace(" \n", "\n").replace("\n ", "\n")
    if "\n\n\n" in text:
        text = re.sub(r"\n{3,}", "\n\n", text)
    return text.strip()


def _link(label: str, href: str) -> str:
    if not href:
        return label
    label = (label or href).replace(BOM, "")
    return f"<{href}>" if label in ("", href) else f"[{label}]({href})"


class _Open:
    """An element that is still open, and what its content counts towards."""

    def __init__(self, tag: str, role: str = "", up: _Open | None = None) -> None:
        self.tag, self.role, self.up = tag, role, up
        self.parts: list[str] = []
        self.block: dict | None = None  # filled with the inline text on closing
        self.href = ""
        self.items = 0  # list items so far
        self.row: dict | None = None  # the table row a `tr` stands for
        self.cell: tuple[list, int] | None = None  # where the text of a cell goes
        self.title: list[str] | None = None  # where the text of an h1 or title goes
        # inherited from the parent:
        self.wanted = bool(up and up.wanted)  # somebody needs the text
        self.muted = bool(up and up.muted)  # inside noise
        self.hidden = bool(up and up.hidden)  # inside noise, even if under a body there
        self.headline = bool(up and up.headline)  # inside an h1 or title
        self.rows = up.rows if up else None  # rows of the table around
        self.depth = up.depth if up else 0  # of the list


class BlockLister(HTMLParser):
    """Lists the blocks of a page in document order.

    An end tag closes up to the nearest open element of its name and is ignored
    without one; nothing is closed implicitly. The last `<body>` is the root.
    """

    def __init__(self) -> None:
        super().__init__()
        self.stack = [_Open("", "container")]
        self.open_tags: dict[str, int] = {}
        self.blocks: list[dict] = []
        self.titles: dict[str, list[list[str]]] = {"h1": [], "title": []}
        self.error: str | None = None
        self.lists = 0

    def _new_block(self, kind: str, **fields: object) -> dict:
        block = {"kind": kind, "level": 0, "list_no": 0, "mark": "", "text": "", "rows": None, **fields}
        self.blocks.append(block)
        return block

    def _role(self, tag: str, parent: _Open) -> str:
        if tag == "body":
            return "container"
        if parent.muted:
            return ""
        if parent.role == "container":
            if tag in CONTAINER_TAGS or tag.startswith("sr-"):
                return "container"
            return tag if tag in BLOCK_TAGS else "other"
        if parent.role in ("ul", "ol") and tag == "li":
            return "li"
        if (parent.role == "li" and tag in ("ul", "ol")) or (parent.role == "other" and tag in NOT_INLINE_TAGS):
            return tag
        return ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        parent = self.stack[-1]
        if tag in VOID_TAGS:
            if tag == "br" and parent.wanted and not parent.muted:
                parent.parts.append("\n")
            return
        attr = {name: value or "" for name, value in attrs}
        node = _Open(tag, self._role(tag, parent), parent)
        if tag in NOISE_TAGS:
            node.role, node.muted, node.hidden = "", True, True
        if tag == "body":  # a new root: what is around it no longer counts
            self.blocks, self.error = [], None
            for around in self.stack:
                around.role = ""
            node.muted, node.rows, node.depth, node.wanted = False, None, 0, node.headline
        if tag == "a":
            node.href = attr.get("href", "").strip()
        if tag in self.titles and not node.hidden:
            node.wanted = node.headline = True
            node.title = [""]
            self.titles[tag].append(node.title)
        if node.role:
            self._enter(node, parent, attr)
        elif node.rows is not None and not node.muted:
            self._enter_table_part(node, parent)
        self.stack.append(node)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def _enter(self, node: _Open, parent: _Open, attr: dict[str, str]) -> None:
        role = node.role
        if role in ("ul", "ol"):
            node.depth = parent.depth + 1 if parent.role == "li" else 0
            self.lists += 1
            node.block = {"list_no": self.lists, "start": attr.get("start", "1")}
        elif role == "li":
            mark = "- "
            if parent.role == "ol":
                try:
                    mark = f"{int(parent.block['start']) + parent.items}. "
                except ValueError as exc:
                    self.error = self.error or str(exc)
            parent.items += 1
            node.depth, node.wanted = parent.depth, True
            node.block = self._new_block("item", level=parent.depth, list_no=parent.block["list_no"], mark=mark)
        elif role == "table":
            node.rows = []
            self._new_block("table", rows=node.rows)
        elif role in HEADING_TAGS:
            node.wanted = True
            node.block = self._new_block("heading", level=int(role[1]))
        elif role != "container":
            node.wanted = True
            node.block = self._new_block(role)

    def _enter_table_part(self, node: _Open, parent: _Open) -> None:
        if node.tag == "tr":
            node.row = {"head": False, "cells": []}
            node.rows.append(node.row)
        elif node.tag in ("td", "th") and parent.row is not None:
            cells = parent.row["cells"]
            parent.row["head"] = parent.row["head"] or node.tag == "th"
            node.cell = (cells, len(cells))
            cells.append("")
            node.wanted = True

    def handle_endtag(self, tag: str) -> None:
        if self.open_tags.get(tag):
            while self._leave() != tag:
                pass

    def _leave(self) -> str:
        node = self.stack.pop()
        self.open_tags[node.tag] -= 1
        text = _inline(node.parts) if node.wanted and node.parts else ""
        if node.block is not None and node.role not in ("ul", "ol"):
            node.block["text"] = _link(text, node.href) if node.role == "a" else text
        if node.cell:
            node.cell[0][node.cell[1]] = text
        if node.title:
            node.title[0] = text
        if node.up.wanted and not node.muted and node.tag not in NOT_INLINE_TAGS:
            shown = _link(text, node.href) if node.tag == "a" else text
            if shown:
                node.up.parts.append(shown)
        return node.tag

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if node.wanted and not node.muted:
            node.parts.append(_squeeze(data))

    def result(self, html: str) -> dict:
        self.feed(html)
        self.close()
        while len(self.stack) > 1:
            self._leave()
        blocks = []
        for b in self.blocks:
            if b["rows"] is not None:
                b["rows"] = [r for r in b["rows"] if r["cells"]]
            if b["text"] or b["rows"] or b["kind"] == "item":
                blocks.append(b)
        first = [next((t[0] for t in self.titles[tag] if t[0]), "") for tag in ("h1", "title")]
        return {"blocks": blocks, "heading": first[0] or first[1], "error": self.error}


def _list_blocks(pages: pa.Array) -> pa.Array:
    """Blocks as Python objects take many times the bytes of their pages, so they are made for about SLICE_CHARS at once."""
    parts, found, chars = [], [], 0
    for page in pages:
        html = page.as_py()
        found.append(None if html is None else BlockLister().result(html))
        chars += len(html or "")
        if chars >= SLICE_CHARS:
            parts.append(pa.array(found, type=_ARROW_PAGE))
            found, chars = [], 0
    return pa.concat_arrays([*parts, pa.array(found, type=_ARROW_PAGE)])


_ARROW_ROW = pa.struct([("head", pa.bool_()), ("cells", pa.list_(pa.string()))])
_ARROW_BLOCK = pa.struct(
    [
        ("kind", pa.string()),
        ("level", pa.int32()),
        ("list_no", pa.int32()),
        ("mark", pa.string()),
        ("text", pa.string()),
        ("rows", pa.list_(_ARROW_ROW)),
    ]
)
_ARROW_PAGE = pa.struct(
    [("blocks", pa.list_(_ARROW_BLOCK)), ("heading", pa.string()), ("error", pa.string())]
)


def page_blocks(html: Column) -> Column:
    """`struct<blocks, heading, error>` of a page."""
    return F.arrow_udf(_list_blocks, PAGE_BLOCKS)(html)


def table_markdown(rows: Column) -> Column:
    """Padded Markdown table. The first row with a `th` is the header and further
    such rows are left out; without one the first row is promoted."""
    heads = F.filter(rows, lambda r: r["head"])
    lines = F.when(
        F.size(heads) > 0,
        F.concat(F.slice(heads, 1, 1), F.filter(rows, lambda r: ~r["head"])),
    ).otherwise(rows)

    def cell(row: Column, i: Column) -> Column:
        return F.coalesce(F.get(row["cells"], i), F.lit(""))

    def render(all_rows: Column) -> Column:
        columns = F.array_max(F.transform(all_rows, lambda r: F.size(r["cells"])))
        widths = F.transform(
            F.sequence(F.lit(0), columns - 1),
            lambda i: F.array_max(F.transform(all_rows, lambda r: F.length(cell(r, i)))),
        )

        def with_widths(w: Column) -> Column:
            def line(cells: Column) -> Column:
                return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

            padded = F.transform(
                all_rows,
                lambda r: line(F.transform(w, lambda n, i: F.rpad(cell(r, i), n, F.lit(" ")))),
            )
            rule = line(F.transform(w, lambda n: F.repeat(F.lit("-"), F.greatest(n, F.lit(3)))))
            return F.array_join(
                F.concat(F.slice(padded, 1, 1), F.array(rule), F.slice(padded, 2, F.size(padded))), "\n"
            )

        return let(widths, with_widths)

    return let(lines, render)


def _item_markdown(b: Column) -> Column:
    indent = F.repeat(F.lit("  "), b["level"])
    lines = F.filter(
        F.transform(F.split(b["text"], "\n"), lambda s: strip(s)), lambda s: s != ""
    )
    shown = F.transform(
        lines,
        lambda s, i: F.concat(indent, F.when(i == 0, b["mark"]).otherwise(F.lit("  ")), s),
    )
    return F.when(b["text"] == "", F.rtrim(F.concat(indent, b["mark"]))).otherwise(
        F.array_join(shown, "\n")
    )


def _quote_markdown(text: Column) -> Column:
    lines = F.filter(F.split(text, rf"\r\n|[{LB}]"), lambda s: strip(s) != "")
    return F.array_join(F.transform(lines, lambda s: F.concat(F.lit("> "), s)), "\n")


def block_markdown(b: Column) -> Column:
    return (
        F.when(b["kind"] == "heading", F.concat(F.repeat(F.lit("#"), b["level"]), F.lit(" "), b["text"]))
        .when(b["kind"] == "pre", F.concat(F.lit("```\n"), b["text"], F.lit("\n```")))
        .when(b["kind"] == "blockquote", _quote_markdown(b["text"]))
        .when(b["kind"] == "item", _item_markdown(b))
        .when(b["kind"] == "table", table_markdown(b["rows"]))
        .otherwise(b["text"])
    )


def title_part(heading: Column) -> Column:
    """Of a title with separators, the last non-blank part."""
    for delimiter, pattern in (("|", r"\|"), ("｜", "｜")):
        parts = F.filter(F.split(heading, pattern), lambda s: strip(s) != "")
        heading = F.when(
            F.contains(heading, F.lit(delimiter)) & (F.size(parts) > 0),
            F.btrim(F.element_at(parts, -1), F.lit(" -—")),
        ).otherwise(heading)
    return heading


def blocks_to_text(page: Column) -> Column:
    """Join the blocks of a page; put a heading first if there is none."""
    blocks = page["blocks"]

    def pieces(lo: int) -> Column:
        # Blocks are set apart by one blank line, items of one list are not.
        return F.array_join(
            F.transform(
                blocks,
                lambda b, i: F.when(i < lo, F.lit(""))
                .when(
                    (i > 0)
                    & (b["kind"] == "item")
                    & (F.get(blocks, i - 1)["list_no"] == b["list_no"]),
                    F.concat(F.lit("\n"), block_markdown(b)),
                )
                .otherwise(F.concat(F.when(i == 0, "").otherwise(F.lit("\n\n")), block_markdown(b))),
            ),
            "",
        )

    heading = title_part(page["heading"])
    opening = block_markdown(blocks[0])

    def assemble(v: Column) -> Column:
        marked = F.concat(F.lit("# "), v["heading"])
        rest = F.regexp_replace(v["rest"], r"\A\n+", "")
        return (
            F.when(F.startswith(v["opening"], F.lit("#")) | (v["heading"] == ""), F.concat(v["opening"], v["rest"]))
            .when(v["heading"] == v["opening"], F.concat_ws("\n\n", marked, F.nullif(rest, F.lit(""))))
            .otherwise(F.concat(marked, F.lit("\n\n"), v["opening"], v["rest"]))
        )

    joined = let(
        F.struct(heading.alias("heading"), opening.alias("opening"), pieces(1).alias("rest")), assemble
    )
    return F.when(F.size(blocks) == 0, F.lit("")).otherwise(joined)


def clean_html(pages: DataFrame, html: str = "html", into: str = "clean_text") -> DataFrame:
    """Add the clean text of a page and an `error` that is null where cleaning worked."""
    listed = pages.withColumn("_page", page_blocks(F.col(html)))
    text = listed.withColumn(into, F.when(F.col("_page.error").isNull(), blocks_to_text(F.col("_page"))))
    return (
        text.withColumn("error", F.col("_page.error"))
        .drop("_page")
        .withColumn(into, strip(nfkc(F.col(into))))
    )
