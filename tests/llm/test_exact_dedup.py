import hashlib
import uuid

from textquarry.llm.exact_dedup import DigestIndex, exact_duplicates


def test_odd_documents(documents, clashing, no_documents, rows):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    got = rows(exact_duplicates(documents), *columns)
    groups = {}
    for r in documents.collect():
        groups.setdefault(hashlib.sha256((r["text"] or "").encode()).hexdigest(), []).append(r["doc_id"])
    want = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert got == sorted(want, key=repr)
    assert rows(exact_duplicates(clashing), *columns) == got
    assert exact_duplicates(no_documents).count() == 0


def test_index_is_dropped(spark, documents):
    exact_duplicates(documents).count()
    assert not [t.name for t in spark.catalog.listTables() if "textquarry_digests" in t.name]


def test_later_batches_meet_the_index(spark):
    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=3)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(8, "a"), (9, "c"), (10, "c")], "doc_id long, text string")
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(first, "x").collect()} == {1: (2, False), 2: (2, True), 3: (3, True)}
    assert index.rows().count() == 2
    want = {8: (2, False), 9: (10, False), 10: (10, True)}
    for _ in range(2):
        assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(second, "y").collect()} == want
        assert index.rows().count() == 3
    held = sorted(map(tuple, index.rows().collect()))
    index.compact()
    files = [f.rsplit("_", 1)[1] for f in index.rows().inputFiles()]
    assert len(files) == len(set(files)) and sorted(map(tuple, index.rows().collect())) == held
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(second, "y").collect()} == want
    spark.sql(f"ALTER TABLE {index.table} RENAME TO {index.table}_next")  # as if the last step were missing
    again = DigestIndex(spark, index.table, buckets=3)
    assert sorted(map(tuple, again.rows().collect())) == held
    again.drop()
    assert not spark.catalog.tableExists(index.table)
