import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textquarry.functions.providers import ProviderError
from textquarry.operators import chunk as C
from textquarry.operators import embed as E

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def column(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", make(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


PIECES = [
    "#", "##", "### ", "####### ", "\n", "\n\n", "\r\n", "\r", " ", "\t", "　", "\xa0", " ", "\x1c",
    "\x85", "\x0b", "a", "bc", "雨の日", "𝒳", "\u0000", "## H\n", "# T\n", "  ## in\n", "word word word ", "_", "$1", "\\",
]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize(("size", "overlap"), [(1, 0), (7, 0), (7, 3), (10, 8), (5, 4)])
def test_windows_cover_texts(spark, size, overlap):
    texts = [*random_texts(200, size), None, "", "0123456"]
    for text, windows in zip(texts, column(spark, texts, lambda t: C.fixed_windows(t, size, overlap)), strict=True):
        step = size - overlap
        assert all(len(w) == size for w in windows[:-1])
        assert "".join(w[:step] for w in windows[:-1]) + "".join(windows[-1:]) == (text or "")
        assert len(windows) < 2 or len(windows[-1]) > overlap


@pytest.mark.parametrize(("size", "overlap"), [(0, 0), (5, 5), (5, -1)])
def test_window_arguments(size, overlap):
    with pytest.raises(ValueError):
        C.check_window(size, overlap)


@pytest.mark.parametrize(("lo", "hi"), [(0, 3), (4, 3), (2, 7)])
def test_level_arguments(lo, hi):
    with pytest.raises(ValueError):
        C.check_levels(lo, hi)


def test_semantic_blocks(spark):
    recipe = "intro\n## Flour\nSift it.\n### Rye\nHalf a cup.\n# Top\n## Water\nWarm."
    got = column(spark, [recipe, "no marks here", "# Only a title\nrest", " \n\t", None], C.semantic_blocks)
    assert got == [
        ["## Flour\nSift it.", "### Rye\nHalf a cup.\n# Top", "## Water\nWarm."],
        ["no marks here"],
        ["# Only a title\nrest"],
        [],
        [],
    ]


@pytest.mark.parametrize(("lo", "hi"), [(2, 6), (1, 6), (3, 4), (1, 2)])
def test_blocks_are_parts_that_begin_with_marks(spark, lo, hi):
    texts = random_texts(300, lo * 10 + hi)
    for text, blocks in zip(texts, column(spark, texts, lambda t: C.semantic_blocks(t, lo, hi)), strict=True):
        at = 0
        for block in blocks:
            at = text.index(block, at) + len(block)
        if len(blocks) > 1:
            assert all(lo <= len(b) - len(b.lstrip("#")) <= hi for b in blocks)


@pytest.mark.parametrize(("size", "overlap"), [(300, 50), (20, 5), (8, 7)])
def test_chunks_hold_their_blocks(spark, size, overlap):
    texts = random_texts(300, size)
    blocks = column(spark, texts, C.semantic_blocks)
    for text, parts, found in zip(texts, blocks, column(spark, texts, lambda t: C.chunk_array(t, size, overlap)), strict=True):
        assert bool(found) == bool(parts), text
        assert len(found) >= len(parts)
        assert {b.strip() for b in parts if len(b) <= size} <= {c.content for c in found}


class Fixed:
    def __init__(self, title):
        self.name = title

    def title(self, text):
        return self.name


class Failing:
    def title(self, text):
        raise ProviderError("network error")


def chunks(spark, text, provider=None, size=300, overlap=50, doc="DOC", title="T"):
    docs = spark.createDataFrame([(doc, title, text)], "document_id string, title string, clean_text string")
    batches = E.with_sections(E.document_batches(docs, size, overlap), provider)
    return sorted(E.batches_to_chunks(batches).collect(), key=lambda r: r.metadata.chunk_index)


def test_chunk_rows_with_titles(spark):
    text = "## Tides\nThe sea comes and goes.\n## Currents\n" + "Water moves. " * 20
    got = chunks(spark, text, Fixed("made up"), 120, 20, "sea", "Oceans")
    assert [c.metadata.section for c in got] == ["Tides", "Currents", "made up", "made up"]
    assert [c.chunk_id for c in got] == [f"sea-{i}" for i in range(4)]
    assert {c.metadata.title for c in got} == {"Oceans"}
    assert got[1].content.startswith("## Currents\nWater moves.")


def test_title_provider_used_and_failing(spark):
    one = chunks(spark, "wind and rain", Fixed("weather"), 200, 30)
    assert [c.metadata.asDict() for c in one] == [{"title": "T", "section": "weather", "chunk_index": 0}]
    assert chunks(spark, "snow", Failing(), 200, 30)[0].metadata.section == "snow"


def test_row_and_batch_forms_agree(spark):
    texts = random_texts(60, 3)
    docs = spark.createDataFrame(
        [(f"d{i}", "t", t) for i, t in enumerate(texts)], "document_id string, title string, clean_text string"
    )
    rows = C.chunk_documents(docs, 20, 5)
    batched = E.batches_to_chunks(E.with_sections(E.document_batches(docs, 20, 5, 3)))
    assert rows.exceptAll(batched).isEmpty() and batched.exceptAll(rows).isEmpty()
    read_back = E.batches_to_chunks(E.stored_batches(rows, 3))
    assert read_back.exceptAll(rows).isEmpty() and rows.exceptAll(read_back).isEmpty()
