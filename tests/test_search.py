import random

import numpy as np
import pytest

from textquarry.operators import vector_search
from textquarry.operators.chunk import merged_small
from textquarry.schemas import CHUNK
from textquarry.sources import chunk_table, jsonl


def slow_nearest(rows, asked, k):
    out = []
    for q, v in asked:
        near = []
        for i, w in rows:
            if i is not None and i != q and w and len(w) == len(v) and all(x is not None and np.isfinite(x) for x in w) and any(w):
                near.append((-round(float(np.dot(v, w) / np.sqrt(np.dot(v, v)) / np.sqrt(np.dot(w, w))), 9), i))
        out += [(q, n + 1, i) for n, (_, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("block", "tile"), [(2048, 2048), (3, 5)])
def test_nearest_vectors(spark, monkeypatch, block, tile):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "TILE", tile)
    rng = random.Random(1)
    rows = [(i, [float(rng.choice([-1, 0, 1, 2])) for _ in range(3)]) for i in range(120)]
    odd = [(None, [1.0, 1.0, 1.0]), (200, None), (201, []), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 0.0]), (204, [0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (206, [1.0, 2.0])]
    kind = "chunk_id long, embedding array<double>"
    stored = spark.createDataFrame(rows + odd, kind).selectExpr("*", "1 AS cosine", "2 AS query").repartition(4)
    asked = [r for r in rows if r[0] % 10 == 0 and any(r[1])] + [(205, [1.0, 2.0])]
    got = vector_search.nearest(spark.createDataFrame(asked + odd[:6], kind), stored, 4)
    assert sorted((r["query"], r["rank"], r["id"]) for r in got.collect()) == slow_nearest(rows + odd, asked, 4)
    assert vector_search.nearest(stored.limit(0), stored, 4).count() == 0
    assert vector_search.nearest(stored, stored.limit(0), 4).count() == 0


def slow_merge(contents, smallest, largest):
    out, now = [], None
    for c in contents:
        if now is not None and len(now) < smallest and len(now) + 1 + len(c) <= largest:
            now += "\n" + c
        else:
            out += [] if now is None else [now]
            now = c
    return out + ([] if now is None else [now])


def test_short_chunks_take_in_the_next(spark):
    rng = random.Random(3)
    docs = {f"d{d}": ["x" * rng.choice([1, 5, 30, 90, 120]) for _ in range(rng.randrange(1, 30))] for d in range(12)}
    rows = [(d, f"{d}-{i}", c, (f"t{d}", f"s{i}", i)) for d, cs in docs.items() for i, c in enumerate(cs)]
    rng.shuffle(rows)
    got = merged_small(spark.createDataFrame(rows, CHUNK), 50, 100).collect()
    assert got and got[0].asDict().keys() == {f.name for f in CHUNK.fields}
    for d, contents in docs.items():
        own = sorted((r for r in got if r.document_id == d), key=lambda r: r.metadata.chunk_index)
        assert [r.content for r in own] == slow_merge(contents, 50, 100)
        assert [r.chunk_id for r in own] == [f"{d}-{i}" for i in range(len(own))]
        assert own[0].metadata.section == "s0" and "\n".join(r.content for r in own) == "\n".join(contents)
    one = [("a", "a-0", None, None), (None, "b", "x", ("t", None, None))]
    assert {(r.document_id, r.chunk_id, r.content) for r in merged_small(spark.createDataFrame(one, CHUNK), 50, 100).collect()} == {("a", "a-0", ""), (None, "0", "x")}
    assert merged_small(spark.createDataFrame([], CHUNK), 50, 100).count() == 0


def test_samples_do_not_depend_on_partitions(spark):
    rows = [(f"d{i % 3}", f"c{i}", "x", ("t", "s", i)) for i in range(200)] + [("few", "few-0", "y", ("t", "s", 0))]
    df = spark.createDataFrame(rows, CHUNK)
    one, other = (sorted(r.chunk_id for r in chunk_table.sample_each(x, 5, 1).collect()) for x in (df.repartition(1), df.repartition(7)))
    assert one == other and len(one) == 16
    assert one != sorted(r.chunk_id for r in chunk_table.sample_each(df, 5, 2).collect())


def test_a_second_run_replaces_its_documents(spark, tmp_path):
    path = str(tmp_path / "chunks")
    row = lambda d, i, c: (d, f"{d}-{i}", c, ("t", "s", i))
    write = lambda *rows: jsonl.write_chunks(spark.createDataFrame(rows, CHUNK), path)
    write(row("a", 0, "old"), row("a", 1, "old"), row("b", 0, "stays"))
    write(row("a", 0, "new"))
    (tmp_path / "chunks" / "own.jsonl").write_text('{"document_id":"b","chunk_id":"b-9","content":"older"}\n{"document_id":"c","chunk_id":"c-0","content":"own"}\n')
    got = {(r.chunk_id, r.content) for r in jsonl.read_chunks(spark, path).collect()}
    assert got == {("a-0", "new"), ("b-0", "stays"), ("c-0", "own")}


def test_only_files_of_which_a_part_counts_are_joined(spark, tmp_path):
    path = str(tmp_path / "some chunks")
    write = lambda *ids: jsonl.write_chunks(spark.createDataFrame([(d, f"{d}-0", str(ids), ("t", "s", 0)) for d in ids], CHUNK).coalesce(1), path)
    shuffles = lambda df: "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    write("a", "b")
    write("a", "b", None)
    read = jsonl.read_chunks(spark, path)
    assert not shuffles(read)
    assert sorted((str(r.document_id), r.content) for r in read.collect()) == [(d, "('a', 'b', None)") for d in ("None", "a", "b")]
    write("b", "c")
    read = jsonl.read_chunks(spark, path)
    got = {(r.document_id, r.content) for r in read.collect()}
    assert shuffles(read) and read.count() == 4
    assert got == {("a", "('a', 'b', None)"), (None, "('a', 'b', None)"), ("b", "('b', 'c')"), ("c", "('b', 'c')")}
