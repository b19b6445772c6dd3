import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textquarry.functions.providers import (
    DigestEmbedder,
    HttpEmbedder,
    HttpTitles,
    ProviderError,
    with_retries,
)
from textquarry.functions.vectors import format_vector, parse_vector
from textquarry.operators import embed as E
from textquarry.plans import ingest
from textquarry.schemas import FREE_CHUNK
from textquarry.sources import jsonl
from textquarry.sources.chunk_table import ChunkTable, TableError

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOADER_CHUNK = "chunk_id string, document_id string, content string, metadata map<string,string>"


def loader_chunks(spark, doc, contents):
    return spark.createDataFrame([(f"{doc}-{i}", doc, c, {}) for i, c in enumerate(contents)], LOADER_CHUNK)


def table(spark, tmp_path, dim=4):
    return ChunkTable(spark, str(tmp_path / "table"), dim)


def embedded(spark, rows):
    schema = "document_id string, chunk_id string, content string, metadata map<string,int>, embedding array<float>"
    return spark.createDataFrame(rows, schema)


def rows_for(doc, n, dim=4, mark=""):
    return [(doc, f"{doc}-{i}", f"text {i}{mark}", {"index": i}, [0.1 + i * 0.01] * dim) for i in range(n)]


def test_load_happy_path(spark, tmp_path):
    store = table(spark, tmp_path)
    batches = E.stored_batches(loader_chunks(spark, "doc", ["first leaf", "second leaf"]), 4)
    report = ingest.load_batches(batches, DigestEmbedder(4), store, str(tmp_path / "dead"))
    assert (report.total, report.succeeded, report.failed) == (2, 2, 0)
    assert sorted(r.chunk_id for r in store.read().collect()) == ["doc-0", "doc-1"]
    assert not (tmp_path / "dead").exists()


def test_lost_batch_goes_to_dead_letters(spark, tmp_path):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("doc2", 5)))
    batches = E.stored_batches(loader_chunks(spark, "doc2", ["broken", "oak", "elm"]), 1)
    log = str(tmp_path / "log")
    report = ingest.load_batches(batches, DigestEmbedder(4, "broken"), store, str(tmp_path / "dead"), log)
    assert (report.total, report.succeeded, report.failed) == (3, 2, 1)
    letters = spark.read.text(str(tmp_path / "dead"), wholetext=True).collect()
    assert [r.value for r in letters] == ["# Failure: refused text with 'broken'\n[doc2-0] broken\n\n"]
    assert letters[0].document_id == "doc2"
    # the old version is gone although one batch was lost
    assert sorted(r.content for r in store.read().collect()) == ["elm", "oak"]
    kinds = spark.read.json(log).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in kinds} == {"request": 3, "response": 2, "error": 1}


def test_all_batches_lost_leaves_table_alone(spark, tmp_path):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("doc", 2)))
    batches = E.stored_batches(loader_chunks(spark, "doc", ["broken"]), 1)
    assert ingest.load_batches(batches, DigestEmbedder(4, "broken"), store).succeeded == 0
    assert store.read().count() == 2


def test_batches_follow_ids_and_size(spark):
    chunks = loader_chunks(spark, "d", [str(i) for i in range(35)])
    got = E.stored_batches(chunks, 16).orderBy("batch_id").collect()
    assert [[c.content for c in r.chunks] for r in got] == [
        [str(i) for i in range(a, min(a + 16, 35))] for a in (0, 16, 32)
    ]


def test_upsert_replaces_whole_documents(spark, tmp_path):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("a", 3) + rows_for("b", 2) + rows_for("c", 1)))
    store.sanity_check(store.upsert(embedded(spark, rows_for("b", 1, mark="!") + rows_for("d", 2))))
    got = sorted((r.chunk_id, r.content) for r in store.read().collect())
    assert got == [("a-0", "text 0"), ("a-1", "text 1"), ("a-2", "text 2"), ("b-0", "text 0!"), ("c-0", "text 0"), ("d-0", "text 0"), ("d-1", "text 1")]
    row = store.read().where("chunk_id = 'a-1'").first()
    assert json.loads(row.metadata) == {"index": 1} and row.last_modified is not None
    assert row.embedding == pytest.approx([0.11] * 4)
    assert {r.document_id: r.rows for r in store.counts().collect()} == {"a": 3, "b": 1, "c": 1, "d": 2}
    assert store.sample("a").count() == 3 and store.sample("zz").count() == 0


@pytest.mark.parametrize(
    "bad",
    [
        rows_for("x", 1) + [("x", "x-1", "t", {}, [0.1, 0.2])],
        [("", "x-1", "t", {}, [0.1] * 4)],
        [("x", "x-1", "t", {}, None)],
        rows_for("x", 1) * 2,
        [],
    ],
)
def test_refused_rows_change_nothing(spark, tmp_path, bad):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("x", 2)))
    with pytest.raises(TableError):
        store.upsert(embedded(spark, bad))
    assert store.read().count() == 2


def test_a_load_that_breaks_anywhere_leaves_all_documents(spark, tmp_path, monkeypatch):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("a", 2) + rows_for("b", 1)))
    before = sorted(map(tuple, store.read().select("chunk_id", "content").collect()))
    monkeypatch.setattr(ChunkTable, "_commit", lambda self, version: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.upsert(embedded(spark, rows_for("a", 1, mark="?")))
    assert sorted(map(tuple, store.read().select("chunk_id", "content").collect())) == before
    monkeypatch.undo()
    (tmp_path / "table" / "commits" / "000000000009-half").mkdir()
    store.upsert(embedded(spark, rows_for("a", 1, mark="?")))
    want = [("a-0", "text 0?"), ("b-0", "text 0")]
    for _ in range(2):
        assert sorted(map(tuple, store.read().select("chunk_id", "content").collect())) == want
        store.compact()
    assert len(store.versions()) == 1 and len(list((tmp_path / "table" / "rows").iterdir())) == 1


def test_a_reader_outlives_a_compaction(spark, tmp_path):
    store = table(spark, tmp_path)
    store.upsert(embedded(spark, rows_for("a", 2) + rows_for("b", 1)))
    store.upsert(embedded(spark, rows_for("a", 1, mark="!")))
    begun = store.read().select("chunk_id", "content")
    want = [("a-0", "text 0!"), ("b-0", "text 0")]
    store.compact()
    store.upsert(embedded(spark, rows_for("b", 1, mark="?")))
    assert sorted(map(tuple, begun.collect())) == want
    assert sorted(map(tuple, store.read().select("chunk_id", "content").collect())) == [want[0], ("b-0", "text 0?")]
    assert len(store.versions()) == 2
    store.compact()
    assert len(store.versions()) == 1 and len(list((tmp_path / "table" / "rows").iterdir())) == 3
    store.compact()
    assert len(list((tmp_path / "table" / "rows").iterdir())) == 1 and store.read().count() == 2


def test_sanity_check_finds_damage(spark, tmp_path):
    store = table(spark, tmp_path)
    sent = store.upsert(embedded(spark, rows_for("x", 2)))
    more = sent.unionByName(sent.limit(1))
    with pytest.raises(TableError):
        store.sanity_check(more)
    store.dimension = 3
    with pytest.raises(TableError):
        store.sanity_check(sent)


def test_vector_text(spark):
    values = [0.1, -0.25, 1e-9, -1e-9, 0.123456785, 2.5e-9, 7.0, -123.456, 0.0, -0.0, 1.0 / 3]
    df = spark.createDataFrame([(values,), ([],)], "e array<float>")
    out = df.select("e", format_vector(F.col("e")).alias("t")).withColumn("back", parse_vector(F.col("t"))).collect()
    assert out[0].t == "[" + ",".join(f"{v:.8f}" for v in out[0].e) + "]"
    assert out[0].back == pytest.approx(out[0].e, abs=1e-8)
    assert (out[1].t, out[1].back) == ("[]", [])


def test_vector_text_of_doubles(spark):
    rng = random.Random(5)
    values = [0.987654321, 0.7654321049, 0.123456785, 1e-9, -5e-9, 5e-9, 1.5e-8, 0.999999995, 0.9999999999, -0.0, 2.0**-9, 3 * 2.0**-9]
    values += [rng.uniform(-2, 2) for _ in range(3000)] + [rng.randrange(10**6) / 2**9 * rng.choice([1, -1]) for _ in range(500)]
    values += [round(rng.uniform(0, 10), 8) + 5e-9 for _ in range(3000)] + [123456789.123456789, -98765432109.87654321, 4e15 + 0.5]
    df = spark.createDataFrame([(values,)], "e array<double>")
    assert df.select(format_vector(F.col("e")).alias("t")).first().t == "[" + ",".join(f"{v:.8f}" for v in values) + "]"


def test_free_metadata_and_calls_made(spark, tmp_path):
    rows = [{"document_id": "d", "chunk_id": f"d-{i}", "content": f"text {i}", "metadata": {"lang": "de", "tags": [i]}} for i in range(20)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "rows.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    store = ChunkTable(spark, str(tmp_path / "table"), 8)
    assert ingest.load_chunk_files(spark, str(tmp_path / "in"), DigestEmbedder(8), store).succeeded == 20
    kept = {r.chunk_id: json.loads(r.metadata) for r in store.read().collect()}
    assert kept["d-7"] == {"lang": "de", "tags": [7]} and len(kept) == 20

    read = jsonl.read_chunks(spark, str(tmp_path / "in"), FREE_CHUNK)
    for fails_on, kinds in (("text 9", ["response", "error", "response"]), ("text 3", ["error", "response"])):
        answered = E.embed_batches(E.stored_batches(read), DigestEmbedder(8, fails_on, call_size=8))
        log = E.call_log(answered, "m", 8, 8).collect()
        found = sorted((r.call_id, r.kind) for r in log)
        assert [k for _, k in found if k != "request"] == kinds
        assert sum(k == "request" for _, k in found) == len(kinds)
        lost = E.embedded_chunks(answered).where("error is not null")
        assert lost.count() == 16 and lost.where("embedding is not null").count() == 0


def test_jsonl_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("d", "题", "## 标题\n这是第一段。")], "document_id string, title string, clean_text string")
    from textquarry.operators.chunk import chunk_documents

    chunks = chunk_documents(docs)
    path = str(tmp_path / "chunks")
    jsonl.write_chunks(chunks, path)
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "chunks").glob("*.json"))
    assert "标题" in text and list(json.loads(text)) == ["document_id", "chunk_id", "content", "metadata"]
    assert jsonl.read_chunks(spark, path).collect() == chunks.collect()
    lines = spark.createDataFrame([(text.strip(),), ("",), ("  ",)], "value string")
    assert jsonl.parse_lines(lines).collect() == chunks.collect()


def test_retries():
    waits, tries = [], []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("500")
        return "done"

    assert with_retries(call, waits.append) == "done" and waits == [2.0, 2.0]
    with pytest.raises(ProviderError):
        with_retries(lambda: 1 / 0, waits.append)


def test_http_providers():
    asked = []

    def post(url, key, timeout, payload):
        asked.append(payload)
        if "messages" in payload:
            return {"choices": [{"message": {"content": " name "}}]}
        return {"data": [{"embedding": [len(t), 1]} for t in payload["input"]]}

    client = HttpEmbedder("u", "m", dimension=2, call_size=2, post=post)
    assert client.embed(["foo", "ba", "x"]) == [[3.0, 1.0], [2.0, 1.0], [1.0, 1.0]]
    assert [a["input"] for a in asked] == [["foo", "ba"], ["x"]]
    assert HttpTitles("u", "m", post=post).title("t") == "name"
    short = HttpEmbedder("u", "m", post=lambda *_: {"data": []}, sleep=lambda s: None)
    with pytest.raises(ProviderError):
        short.embed(["a"])
    with pytest.raises(ValueError):
        HttpEmbedder("u", "m", call_size=0)


def test_response_parsing(spark):
    df = spark.createDataFrame(
        [
            ('{"data":[{"embedding":[1,2.5],"index":0},{"embedding":[3],"index":1}]}',),
            ('{"data":[{"index":0}]}',),
            ('{"choices":[{"message":{"content":" 标题 "}}]}',),
            ('{"choices":[]}',),
        ],
        "b string",
    )
    got = df.select(E.parse_embedding_response(F.col("b")), E.parse_title_response(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [([[1.0, 2.5], [3.0]], None), (None, None), (None, "标题"), (None, None)]


def test_title_log(spark):
    docs = spark.createDataFrame(
        [("d", "t", "## H\nown heading"), ("e", "t", "good"), ("f", "t", "bad")],
        "document_id string, title string, clean_text string",
    )

    class Titles:
        def title(self, text):
            if text == "bad":
                raise ProviderError("no")
            return "name"

    batches = E.titled(E.document_batches(docs), Titles())
    log = {(r.call_id, r.kind): json.loads(r.body) for r in E.title_log(batches, "m").collect()}
    assert log == {
        ("section-e-0", "request"): {"payload": {"model": "m", "input": "good"}},
        ("section-e-0", "response"): {"title": "name"},
        ("section-f-0", "request"): {"payload": {"model": "m", "input": "bad"}},
        ("section-f-0", "error"): {"title": "no title"},
    }
    sections = {r.document_id: r.metadata.section for r in E.batches_to_chunks(E.with_sections(batches)).collect()}
    assert sections == {"d": "H", "e": "name", "f": "bad"}


def test_chunks_without_numbers_do_not_share_a_batch(spark):
    rows = [(f"x{i}", "d", str(i), {}) for i in range(40)]
    batches = E.stored_batches(spark.createDataFrame(rows, LOADER_CHUNK))
    assert batches.agg(F.max(F.size("chunks"))).first()[0] == 1


class Connection:
    def __init__(self, fails=False):
        self.log, self.fails = [], fails

    def cursor(self):
        return self

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def execute(self, statement):
        self.log.append(statement.split()[0])
        if self.fails and statement.startswith("INSERT"):
            raise OSError("lost")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_database_swap_is_one_transaction():
    from textquarry.sources.postgres import swap_in

    good, bad = Connection(), Connection(fails=True)
    swap_in(good, "rag", "rag_incoming")
    assert good.log == ["DELETE", "INSERT", "DROP", "commit", "close"]
    with pytest.raises(OSError):
        swap_in(bad, "rag", "rag_incoming")
    assert bad.log == ["DELETE", "INSERT", "rollback", "close"]


def test_database_settings(tmp_path):
    from textquarry.sources.postgres import settings

    config = tmp_path / "c.json"
    config.write_text('{"dsn": "a", "table": "t", "vector_dimension": 8}')
    assert settings(str(config), {}) == ("a", "t", 8)
    assert settings(str(config), {"POSTGRES_DSN": "b", "POSTGRES_VECTOR_DIMENSION": "4"}) == ("b", "t", 4)
    assert settings(None, {"POSTGRES_DSN": "b", "POSTGRES_TABLE": "u"}) == ("b", "u", 1536)
    for env in ({}, {"POSTGRES_DSN": "b"}, {"POSTGRES_DSN": "b", "POSTGRES_TABLE": "u", "POSTGRES_VECTOR_DIMENSION": "x"}):
        with pytest.raises(TableError):
            settings(None, env)


def test_one_long_document_spreads_over_tasks(spark):
    text = " ".join(f"word{i}" for i in range(60_000))
    docs = spark.createDataFrame([("d", "t", text)], "document_id string, title string, clean_text string")
    dealt = E.dealt_out(E.with_sections(E.document_batches(docs)), 8)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.size("chunks"))).select("sum(size(chunks))").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    answered = E.embed_batches(E.with_sections(E.document_batches(docs)), DigestEmbedder(2), 8)
    rows = E.succeeded(E.embedded_chunks(answered)).collect()
    numbers = sorted(r.metadata.chunk_index for r in rows)
    assert numbers == list(range(len(rows))) and len(rows) == sum(sizes)


def test_title_request_parameters():
    sent = []

    def post(url, key, timeout, payload):
        sent.append(payload)
        return {"choices": [{"message": {"content": " Lakes\n"}}]}

    titles = HttpTitles("http://titles", "m", parameters={"temperature": 0.2, "max_tokens": 16}, post=post)
    assert titles.title("Deep and cold.") == "Lakes"
    assert (sent[0]["temperature"], sent[0]["max_tokens"], sent[0]["model"]) == (0.2, 16, "m")
    HttpTitles("http://titles", "m", post=post).title("x")
    assert "temperature" not in sent[1]
