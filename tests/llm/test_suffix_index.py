import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textquarry.llm import suffix_index
from textquarry.llm.suffix_index import LONG, SuffixIndex, repeated_passages, unrepeated


def slow(rows):
    """rows: doc_id and text. By sets of all strings of 50 bytes."""
    least, last = {}, 1 << 63
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - LONG + 1):
            s = b[p : p + LONG]
            least[s] = min(i, least.get(s, last))
    out = []
    for (i, b), (doc, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - LONG + 1):
            if least[b[p : p + LONG]] < i:
                gone[p : p + LONG] = b"\1" * LONG
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def passages(seed, n):
    """Texts of shared passages, cut and joined anywhere, with runs of one sign and a passage that all have."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts.append(rng.choice([s, s[a:], s[:a], " ".join(word() for _ in range(20)), "a" * rng.randrange(120), "xyz" * 30]))
        rows.append((rng.randrange(n), rng.choice(["", " "]).join([*parts, shared[0]])))
    return rows


def test_odd_documents(spark, documents, clashing, no_documents):
    assert got(repeated_passages(documents)) == slow(pairs(documents))
    assert got(repeated_passages(clashing)) == slow(pairs(clashing))
    assert got(repeated_passages(no_documents)) == []


@pytest.mark.parametrize(("seed", "pack"), [(1, 3000), (2, 30_000)])
def test_all_strings_are_found(spark, seed, pack, monkeypatch):
    monkeypatch.setattr(suffix_index, "PACK", pack)
    rows = passages(seed, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = slow(rows)
    assert any(r[3] > 1 for r in want)
    for batches in (1, 4):
        index, kept = unrepeated(docs, batches)
        removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
        kept = kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
        assert got(kept) == want
        index.drop()


def test_batches_that_come_one_by_one(spark):
    rows = sorted(passages(7, 50))
    index = SuffixIndex(spark, 8)
    found, sizes = [], []
    for i in range(5):
        lot = [r for r in rows if r[0] * 5 // 50 == i]
        docs = spark.createDataFrame(lot, "doc_id long, text string").withColumn("batch", F.lit(0))
        index.scan(index.pack(docs))
        sizes.append([n for n, _ in index.levels])
        found += [(r["doc_id"], bytes(r["kept"])) for r in index.settle().collect()]
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    want = sorted(((r[0], r[4]) for r in slow(rows)), key=repr)
    assert sorted(((i, hashlib.sha256(k).hexdigest()) for i, k in found), key=repr) == want
    index.drop()


def test_spans_are_cut_out_and_a_long_text_is_whole(spark):
    words = " ".join(str(i * 7919 % 100_003) for i in range(60_000))
    rows = [(1, words), (2, "before " + words[1000:9000] + " after"), (3, words[:49])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index, kept = unrepeated(docs)
    found = {r["doc_id"]: r for r in kept.collect()}
    assert found[1]["spans"] == [] and bytes(found[1]["kept"]).decode() == words
    (span,) = found[2]["spans"]
    assert span.end - span.start >= 8000 and 12 <= len(found[2]["kept"]) <= 14
    assert found[3]["spans"] == []
    index.drop()
