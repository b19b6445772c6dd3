"""Words and pages of PDF files, through an optional reader library."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PDF_PAGE

READ_RESULT = T.StructType(
    [T.StructField("pages", T.ArrayType(PDF_PAGE)), T.StructField("error", T.StringType())]
)
_NUMBERS = ("x0", "x1", "top", "bottom", "size")


def open_pdf(content: bytes):  # noqa: ANN201 - whatever the optional library returns
    import pdfplumber

    return pdfplumber.open(io.BytesIO(content))


def _word(raw: dict) -> dict:
    word = {n: float(raw[n]) if raw.get(n) is not None else None for n in _NUMBERS}
    return {**word, "text": str(raw.get("text", "")), "fontname": str(raw.get("fontname", ""))}


def read_pages(content: bytes, opener: Callable = open_pdf) -> dict:
    try:
        with opener(content) as pdf:
            pages = [
                {
                    "page_no": number,
                    "page_width": float(page.width),
                    "page_height": float(page.height),
                    "fallback_text": page.extract_text() or "",
                    "words": [
                        _word(w)
                        for w in page.extract_words(
                            keep_blank_chars=False, use_text_flow=True, extra_attrs=["fontname", "size"]
                        )
                    ],
                }
                for number, page in enumerate(pdf.pages, start=1)
            ]
        return {"pages": pages, "error": None}
    except ImportError:
        return {"pages": None, "error": "no PDF reader is installed on the executors"}
    except Exception as exc:  # a file that cannot be read must not stop the others
        return {"pages": None, "error": f"Failed to parse PDF file: {exc}"}


def read_pdf_pages(files: DataFrame, opener: Callable = open_pdf) -> DataFrame:
    """`(path, document_id, content)` to one row per page, or a single row with `error`."""
    fields = "path string, document_id string, error string"
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, *PDF_PAGE.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for file in batch.to_pylist():
                found = read_pages(file["content"], opener)
                own = {"path": file["path"], "document_id": file["document_id"], "error": found["error"]}
                nothing = dict.fromkeys(PDF_PAGE.names)
                for page in found["pages"] or ([nothing] if found["error"] else []):
                    yield pa.RecordBatch.from_pylist([{**own, **page}], schema=target)

    return files.select("path", "document_id", "content").mapInArrow(read, schema)


def words_of(pages: DataFrame) -> DataFrame:
    """Pages to word rows for the layout operators, under the path: two files may have one document id."""
    return pages.where(F.col("page_no").isNotNull()).select(
        F.col("path").alias("doc_id"),
        "page_no",
        "page_width",
        "page_height",
        F.posexplode("words").alias("word_idx", "w"),
    ).select("doc_id", "page_no", "word_idx", "page_width", "page_height", "w.*")


def page_rows(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page_no").isNotNull()).select(
        F.col("path").alias("doc_id"), "page_no", "fallback_text"
    )
