import os
from collections import defaultdict
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from textquarry.functions.providers import DigestEmbedder
from textquarry.plans import cli, ingest
from textquarry.sources import files, folders, jsonl, staging
from textquarry.sources.chunk_table import ChunkTable, TableError
from textquarry.streaming import inbox
from textquarry.streaming.inbox import watch_inbox

HTML = "<html><body><h2>Lakes</h2><p>Deep and cold.</p><p>Some are salty.</p></body></html>"


def test_names(spark):
    names = [".html", "a.html", "a.", "..html", "a.b.HTM", "a", "x/..b.md", "a..", "/q/.tar.gz", "/d.x/plain", "s/n.pdf", "u/é.Markdown"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = df.select("p", files.suffix(F.col("p")), files.stem(F.col("p")), files.file_kind(F.col("p"))).collect()
    assert [(r[1], r[2]) for r in got] == [(PurePosixPath(n).suffix, PurePosixPath(n).stem) for n in names]
    assert [r[3] for r in got] == [None, "html", None, "html", "html", None, "markdown", None, None, None, "pdf", "markdown"]


def test_decoding(spark):
    raw = [b"ok \xe4\xb8\xad\r\nx\ry", b"bad \xff\xfe\xe4\xb8 end", b"", b"\xef\xbf\xbd kept"]
    df = spark.createDataFrame([(bytearray(b),) for b in raw], "c binary")
    got = [r[0] for r in df.select(files.decode_text(F.col("c"))).collect()]
    assert got == [b.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n") for b in raw]
    with pytest.raises(Exception, match="INVALID_UTF8"):
        df.select(files.decode_strict(F.col("c"))).collect()


def test_titles(spark):
    cases = [("t", "m", "t"), ("", "m", "d"), (None, "m", "m"), (None, "", "d"), (None, None, "d")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string")
    got = df.select(files.effective_title(F.col("a"), F.col("b"), F.lit("d"))).collect()
    assert [r[0] for r in got] == [w for _, _, w in cases]


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "one.HTML").write_text(HTML, encoding="utf-8")
    (place / "two.md").write_text("## A\r\nbody", encoding="utf-8")
    (place / "list.htm").write_text("<ol start='x'><li>a</li></ol>", encoding="utf-8")
    (place / "fake.pdf").write_text("plain text", encoding="utf-8")
    (place / "sheet.csv").write_text("a,b", encoding="utf-8")
    return place


def test_clean_files(spark, folder):
    cleaned = ingest.clean_files(spark, str(folder))
    texts = {r.document_id: r.clean_text for r in cleaned.documents.collect()}
    assert texts == {"one": "## Lakes\n\nDeep and cold.\n\nSome are salty.", "two": "## A\nbody"}
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in cleaned.rejects.collect()}
    assert set(errors) == {"list.htm", "fake.pdf", "sheet.csv"}
    assert errors["sheet.csv"] == "Unsupported file extension: .csv"


def test_ingest_folder(spark, folder, tmp_path):
    table = ChunkTable(spark, str(tmp_path / "table"), 8)
    meta_dir = tmp_path / "meta"
    meta_dir.mkdir()
    (meta_dir / "two.json").write_text('{"title": "Second"}', encoding="utf-8")
    report, rejects = ingest.ingest_files(
        spark,
        str(folder),
        DigestEmbedder(8),
        table,
        meta=files.read_meta(spark, str(meta_dir)),
        clean_path=str(tmp_path / "clean"),
        chunks_path=str(tmp_path / "chunks"),
    )
    assert (report.total, report.failed, rejects.count()) == (2, 0, 3)
    chunks = {c.document_id: c for c in jsonl.read_chunks(spark, str(tmp_path / "chunks")).collect()}
    assert chunks["two"].metadata.title == "Second" and chunks["one"].metadata.title == "one"
    clean = jsonl.read_written_texts(spark, str(tmp_path / "clean")).collect()
    assert {r.document_id: r.clean_text for r in clean}["two"] == "## A\nbody"
    again = ingest.load_chunk_files(spark, str(tmp_path / "chunks"), DigestEmbedder(8), table)
    assert again.succeeded == 2 and table.read().count() == 2


def test_nothing_staged_is_left(spark, folder, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(shared))
    table = ChunkTable(spark, str(tmp_path / "table"), 8)
    _, rejects = ingest.ingest_files(spark, str(folder), DigestEmbedder(8), table, chunks_path=str(tmp_path / "chunks"))
    assert [p.name.split("-")[1] for p in shared.iterdir()] == ["rejects"] and rejects.count() == 3
    with pytest.raises(TableError):
        ingest.ingest_files(spark, str(folder), DigestEmbedder(4), table)
    assert {p.name.split("-")[1] for p in shared.iterdir()} == {"rejects"}
    assert table.read().count() == 2


def test_inbox(spark, folder, tmp_path):
    table = ChunkTable(spark, str(tmp_path / "table"), 8)
    for _ in range(2):
        watch_inbox(spark, str(folder), table, DigestEmbedder(8), str(tmp_path / "ckpt")).awaitTermination()
    assert {r.document_id for r in table.read().collect()} == {"one", "two"}
    (folder / "two.markdown").write_text("## B\nnew", encoding="utf-8")
    watch_inbox(spark, str(folder), table, DigestEmbedder(8), str(tmp_path / "ckpt")).awaitTermination()
    assert {r.content for r in table.read().where("document_id = 'two'").collect()} == {"## B\nnew"}


def test_every_file_of_an_inbox_ends_somewhere(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(inbox, "COMPACT_AT", 1)
    table = ChunkTable(spark, str(tmp_path / "table"), 8)
    for at, place in ((1_700_000_000, "a"), (1_700_000_900, "b")):
        (folder / place).mkdir()
        (folder / place / "two.md").write_text(f"## {place}\ntext", encoding="utf-8")
        os.utime(folder / place / "two.md", (at, at))
    os.utime(folder / "two.md", (1_600_000_000, 1_600_000_000))
    lost = str(tmp_path / "lost")
    watch_inbox(spark, str(folder), table, DigestEmbedder(8), str(tmp_path / "ckpt"), left_out=lost).awaitTermination()
    rejects = {"/".join(r.path.split("/")[-2:]): r.error for r in spark.read.json(f"{lost}/rejects/*").collect()}
    assert set(rejects) == {"in/sheet.csv", "in/fake.pdf", "in/list.htm", "in/two.md", "a/two.md"}
    assert "newer" in rejects["a/two.md"] and {r.content for r in table.read().collect() if r.document_id == "two"} == {"## b\ntext"}
    (folder / "three.md").write_text("## C\ntext", encoding="utf-8")
    watch_inbox(spark, str(folder), table, DigestEmbedder(8), str(tmp_path / "ckpt"), left_out=lost).awaitTermination()
    assert len(table.versions()) == 1 and table.read().select("document_id").distinct().count() == 3


def test_command_line(spark, folder, tmp_path):
    def run(*args):
        return cli.main(list(args), spark)

    out = str(tmp_path / "clean")
    assert run("clean", "--input-file", str(folder / "one.HTML"), "--output-dir", out) == 0
    assert run("clean", "--input-file", str(folder / "missing.md"), "--output-dir", out) == 1
    assert run("clean", "--input-file", str(folder / "sheet.csv"), "--output-dir", out) == 2
    assert run("clean", "--input-file", str(folder / "fake.pdf"), "--output-dir", out) == 2
    assert run("clean", "--input-file", str(folder), "--output-dir", out, "--rejects-dir", str(tmp_path / "left")) == 0
    assert {r.path.rsplit("/", 1)[1] for r in spark.read.json(str(tmp_path / "left")).collect()} == {"list.htm", "fake.pdf", "sheet.csv"}
    text = tmp_path / "sample.txt"
    text.write_text("## Rivers\nThey run.\n\nThey bend.", encoding="utf-8")
    chunked = str(tmp_path / "chunks")
    args = ["--document-id", "R-7", "--title", "河流说明", "--output-dir", chunked, "--disable-llm"]
    assert run("chunk", "--input-file", str(text), *args) == 0
    got = jsonl.read_chunks(spark, chunked).collect()
    assert [(c.document_id, c.metadata.title) for c in got] == [("R-7", "河流说明")]
    assert run("chunk", "--input-file", str(tmp_path / "no.txt")) == 1
    base = ["--table", str(tmp_path / "t"), "--dimension", "8", "--clean-output-dir", out,
            "--chunks-output-dir", str(tmp_path / "c2"), "--dead-letter-dir", str(tmp_path / "dead")]
    one = ["ingest", "--input-file", str(folder / "one.HTML"), "--document-id", "DOC-I", "--title", "河流说明"]
    assert run(*one, *base) == 0
    stored = ChunkTable(spark, str(tmp_path / "t"), 8).read().collect()
    assert [r.chunk_id for r in stored] == ["DOC-I-0"]
    assert run("ingest", "--input-file", str(folder / "sheet.csv"), *base) == 2
    assert run("ingest", "--input-file", str(folder / "two.md"), "--meta-file", "/no/meta.json", *base) == 1


def test_names_with_other_characters(spark, tmp_path):
    place, metas = tmp_path / "in", tmp_path / "meta"
    place.mkdir()
    metas.mkdir()
    (place / "产品 a+b.md").write_text("text", encoding="utf-8")
    (metas / "产品 a+b.json").write_text('{"title": "Rivers"}', encoding="utf-8")
    (metas / "broken.json").write_text("{", encoding="utf-8")
    meta = files.read_meta(spark, str(metas))
    assert {r.document_id: r.valid for r in meta.collect()} == {"产品 a+b": True, "broken": False}
    docs = files.with_titles(files.read_markdown(spark, str(place)), meta.unionByName(meta))
    assert [(r.document_id, r.title) for r in docs.collect()] == [("产品 a+b", "Rivers")]


def test_clean_texts_are_written_by_all_cores(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.range(40 * cores).selectExpr(f"CAST(id % {20 * cores} AS STRING) AS document_id", "'a' AS clean_text").coalesce(1)
    jsonl.write_clean_texts(docs, str(tmp_path / "texts"))
    written = list((tmp_path / "texts").glob("document_id=*/part-*.txt"))
    # rows of one document lie in one file, as before
    assert len(written) == 20 * cores and all(f.read_text() == "a\na\n" for f in written)
    assert len({f.name.split("-")[1] for f in written}) == cores
    assert files.read_clean_texts(spark, str(tmp_path / "texts")).count() == 20 * cores


def test_clean_texts_lie_as_spark_lays_them(spark, tmp_path):
    ids = [*(f"a{chr(c)}b" for c in range(1, 256)), "产品 a+b", "", None, "..", "x" * 200]
    rows = [(x, f"text\n {i}") for i, x in enumerate(ids)] + [("twice", "one"), ("none", None), ("empty", ""), ("twice", "two")]
    docs = spark.createDataFrame(rows, "document_id string, clean_text string").coalesce(1)

    def held(folder):
        found = defaultdict(list)
        for p in folder.glob("document_id=*/part-*"):
            found[p.parent.name].append((p.name.split("-")[1], p.read_bytes()))
        return {name: sorted(parts) for name, parts in found.items()}

    earlier = spark.createDataFrame([("twice", "old"), ("kept", "old")], docs.schema)
    (tmp_path / "spark").mkdir()
    writer = docs.repartition(spark.sparkContext.defaultParallelism, "document_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n")
    writer.partitionBy("document_id").text(str(tmp_path / "spark"))
    jsonl.write_clean_texts(earlier, str(tmp_path / "own"))
    jsonl.write_clean_texts(docs, str(tmp_path / "own"))
    expected, own = held(tmp_path / "spark"), held(tmp_path / "own")
    assert [x for _, x in own.pop("document_id=kept")] == [b"old\n"]
    assert len(expected) == 255 + 4 + 3 and own == expected
    assert {p.name for p in (tmp_path / "own").iterdir()} == {*own, "document_id=kept", "_SUCCESS"}
    (tmp_path / "own" / "deeper" / "x").mkdir(parents=True)
    (tmp_path / "own" / "deeper" / "x" / "y.txt").write_bytes(b"below")
    (tmp_path / "own" / "_left").mkdir()
    (tmp_path / "own" / "_left" / "z.txt").write_bytes(b"out")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "own"))
    got = {r.path: r.clean_text for r in files.read_clean_texts(spark, str(tmp_path / "own")).collect()}
    assert got == {r.path: r.content.decode() for r in listed.collect()} and len(got) > 263


def test_many_clean_texts_take_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.range(100 * cores).selectExpr("CAST(id AS STRING) AS document_id", "'a' AS clean_text")
    context = spark.sparkContext
    context.setJobGroup("clean-texts", "")
    jsonl.write_clean_texts(docs, str(tmp_path / "texts"))
    assert files.read_clean_texts(spark, str(tmp_path / "texts")).count() == 100 * cores
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("clean-texts")]
    stages = {s for j in jobs for s in j.stageIds}
    context.setLocalProperty("spark.jobGroup.id", None)
    assert sum(context.statusTracker().getStageInfo(s).numTasks for s in stages) < 50 * cores
    # each of Hadoop's check files would cost a process
    assert not list((tmp_path / "texts").glob("document_id=*/.*"))


def test_files_of_other_tasks_stay_when_a_folder_is_replaced(tmp_path):
    to = tmp_path / "to"
    for place, name in (("to/v=a", "part-00000-old.txt"), ("one/v=a", "part-00000-new.txt"), ("two/v=a", "part-00001-new.txt"), ("two/v=b", "part-00001-new.txt")):
        (tmp_path / place).mkdir(parents=True, exist_ok=True)
        (tmp_path / place / name).write_text(place)
    for own in ("one", "two", "one", "two"):  # a task may come again
        folders._moved(str(tmp_path / own), str(to), "new")
    assert {f"{p.parent.name}/{p.name}": p.read_text() for p in to.glob("*/*")} == {
        "v=a/part-00000-new.txt": "one/v=a",
        "v=a/part-00001-new.txt": "two/v=a",
        "v=b/part-00001-new.txt": "two/v=b",
    }
