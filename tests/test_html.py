import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textquarry.functions import text as functions
from textquarry.operators.html import BlockLister, _list_blocks, clean_html

CASES = {
    "order": ("<body><h3>Boats</h3><p>Oars and <b>sails</b></p><h2>Harbour</h2><p>Ropes</p></body>", "### Boats\n\nOars and sails\n\n## Harbour\n\nRopes"),
    "scripts": ("<body><script>x()</script><style>p{}</style><p>seen</p></body>", "seen"),
    "empty": ("", ""),
}


def test_cases(spark):
    df = spark.createDataFrame([(k, h) for k, (h, _) in CASES.items()], "k string, html string")
    got = {r.k: r.clean_text for r in clean_html(df).collect()}
    assert got == {k: want for k, (_, want) in CASES.items()}


def test_cleaning_drops_noise_and_keeps_order(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(100):
        names = [f"n{i}x{k}" for k in range(rnd.randint(1, 6))]
        tags = [rnd.choice(["p", "h2", "h4", "blockquote"]) for _ in names]
        body = "".join(f"<{t}>{n}</{t}><script>hidden{n}</script>" for t, n in zip(tags, names, strict=True))
        rows.append((str(i), f"<html><body>{body}</body></html>", names))
    got = clean_html(spark.createDataFrame(rows, "k string, html string, names array<string>")).collect()
    for r in got:
        at = [r.clean_text.index(n) for n in r.names]
        assert at == sorted(at) and "hidden" not in r.clean_text


def test_bad_list_start_is_an_error(spark):
    df = spark.createDataFrame([("<body><ol start='x'><li>q</li></ol></body>",), (None,)], "html string")
    bad, null = clean_html(df).collect()
    assert bad.clean_text is None and "invalid literal" in bad.error
    assert null.clean_text is None and null.error is None


def test_depth_is_not_limited():
    page = BlockLister().result("<body><p>" + "<b>" * 5000 + "x")
    assert [b["text"] for b in page["blocks"]] == ["x"]


@pytest.mark.parametrize("text", ["ascii", "Ａ，ﬁ²", "é", "ｶﾞ", "Å", "각", "𝒳", ""])
@pytest.mark.parametrize("in_jvm", [True, False])
def test_nfkc(spark, monkeypatch, text, in_jvm):
    assert functions._icu_within_reach()
    monkeypatch.setattr(functions, "_icu_within_reach", lambda: in_jvm)
    got = spark.createDataFrame([(text,)], "t string").select(functions.nfkc(F.col("t"))).first()[0]
    assert got == unicodedata.normalize("NFKC", text)


def test_blocks_of_a_batch_are_not_all_python_objects_at_once(monkeypatch):
    monkeypatch.setattr("textquarry.operators.html.SLICE_CHARS", 10_000)
    page = "<body>" + "<p>word</p>" * 500 + "</body>"
    pages = [page, None, "", *[page] * 100]
    batch = pa.array(pages)
    tracemalloc.start()
    listed = _list_blocks(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 << 20
    assert len(listed) == len(pages) and listed[1].as_py() is None and listed[2].as_py()["blocks"] == []
    assert all(listed[i].as_py() == BlockLister().result(page) for i in (0, 3, 102))
    assert len(_list_blocks(pa.array([], pa.string()))) == 0
