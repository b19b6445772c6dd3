import random
import tracemalloc

import numpy as np
import pyarrow as pa
from conftest_llm import union_find
from test_simhash import LOWER, WORD

import corpus_pipeline
from textquarry.llm import near_copies, simhash
from textquarry.llm.suffix_index import text_packs


def slow_shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def check(docs, got):
    sets = [(r["doc_id"], slow_shingles(r["text"])) for r in docs.collect()]
    group = union_find({s for _, s in sets}, near)
    best = {}
    for i, s in sets:
        best[group[s]] = min(best.get(group[s], (True, 0)), (i is None, i or 0))
    rows = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted(best.values())
    assert {group[slow_shingles(r["text"])] for r in rows} == set(group.values())
    return sets, group


def test_odd_documents(documents, clashing, no_documents):
    got = near_copies.one_of_each(documents)
    assert got.columns == documents.columns
    check(documents, got)
    assert near_copies.one_of_each(clashing).columns == clashing.columns
    assert near_copies.one_of_each(no_documents).count() == 0


def test_all_pairs_of_the_similarity_are_found(spark):
    rng = random.Random(3)
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 6, 30, 80]))]
        for _ in range(rng.choice([1, 4, 25])):
            now = list(words)
            for _ in range(rng.randrange(4)):
                now[rng.randrange(len(now))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(now)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, group = check(docs, corpus_pipeline.without_near_copies(spark, docs, ""))
    assert len(set(group.values())) < len({s for _, s in sets})


def test_a_passage_in_every_document(spark, monkeypatch):
    """One line in all texts, texts of a few common lines only, and several packs."""
    monkeypatch.setattr(near_copies, "PACK", 2000)
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(40))
    lines = [" ".join(f"l{k}x{i}" for i in range(12)) for k in range(6)]
    rows = []
    for i in range(60):
        own = " ".join(f"o{i}y{k}" for k in range(rng.choice([0, 3, 30])))
        rows.append((i, f"{common} {own} {rng.choice(lines)} {rng.choice(lines)}"))
    check(docs := spark.createDataFrame(rows, "doc_id long, text string").repartition(3), near_copies.one_of_each(docs))


def test_a_pack_of_short_texts_takes_little_memory():
    texts = pa.RecordBatch.from_pydict({"batch": [0] * 40_000, "doc_id": list(range(40_000)), "text": [f"word{i // 2}" for i in range(40_000)]})
    (pack,) = text_packs(iter([texts]), 0, 1 << 21)
    (counts,) = near_copies._count_batches(1)(iter([pack]))
    told = near_copies._counted(pa.Table.from_batches([counts]))
    told = pa.array([told.column("entries").to_pylist()])
    met = pa.RecordBatch.from_arrays([*pack.columns, told], names=[*pack.schema.names, "told"])
    list(near_copies._left_batches(iter([met])))  # loads what is loaded once
    tracemalloc.start()
    (left,) = near_copies._left_batches(iter([met]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert left.num_rows == 40_000 and peak < 30_000_000
    shared = left.column("shared").flatten().to_numpy().view(np.uint64)
    bits = np.zeros((40_000, near_copies.MAP_BITS), np.uint8)
    bits[np.arange(40_000), shared % np.uint64(near_copies.MAP_BITS)] = 1
    assert (np.packbits(bits, axis=1).reshape(-1).view(np.int64) == left.column("map").flatten().to_numpy()).all()


def test_what_fingerprints_link_is_one_too(spark):
    """Texts of one line over and over with other ends: few shingles in common, yet op2 links them; and through the second, a copy by shingles of the third."""
    line = " ".join(f"c{i}" for i in range(11))  # odd, so that no bit is a tie

    def text(own, last):
        return " ".join([line] * 40 + [f"{own}{k}" for k in range(60)] + [last])

    rows = [(4, text("a", "z")), (2, text("b", "z")), (3, text("b", "y")), (1, "some other text of a few words"), (None, line)]
    sets = [slow_shingles(t) for _, t in rows]
    assert not near(sets[0], sets[1]) and not near(sets[0], sets[2]) and near(sets[1], sets[2]) and not near(sets[0], sets[4])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert same[2] == same[4] != same[1]
    kept = {r["doc_id"] for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()}
    assert kept == {1, 2} | ({None} if same[None] is None else set())
