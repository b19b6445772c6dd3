import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textquarry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Targets by sharing again and again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def check(docs, block_words=mixing.BLOCK_WORDS):
    got = mixing.mixed_words(docs, block_words=block_words).collect()
    texts = docs.collect()
    assert sorted((repr(r["doc_id"]), repr(r["source"]), r["size"]) for r in got) == sorted(
        (repr(r["doc_id"]), repr(r["source"]), len(WORD.findall(r["text"] or ""))) for r in texts
    )
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = fill(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 0.5
    return sorted(map(repr, got))


def test_odd_documents(documents, clashing, no_documents):
    assert check(documents) == check(clashing)
    assert check(no_documents) == []


@pytest.mark.parametrize("seed", range(2))
def test_random_sources(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 3, 40, 400]))), "en", rng.choice(["a", "b", "c", "d", None, "hot", "hot"]), 0)
        for i in range(120)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert check(docs, 16) == check(docs, 16)


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 3, 7, 100, 101, 5000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k"), 1).alias("p"))
        got = [r[0] for r in df.collect()]
        assert sorted(got) == list(range(n))
        assert n < 100 or got != list(range(n))


def drawn_slots(documents, shard_slots, seed=1):
    plan = mixing.targets(mixing.placed(mixing.sized(documents)), block_words=16).cache()
    counts = mixing.shard_counts(plan, shard_slots, seed).cache()
    return plan, counts, mixing.slots(plan, counts, 16, seed)


def test_shards_divide_all_slots(documents):
    plan, counts, drawn = drawn_slots(documents, 64)
    assert counts.agg(F.countDistinct("shard")).first()[0] > 1
    got = defaultdict(list)
    for r in drawn.collect():
        got[r["source_key"]].append(r)
    want = {r["source_key"]: r for r in plan.collect() if r["slots"]}
    assert got.keys() == want.keys()
    for key, rows in got.items():
        rows.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(want[key]["slots"]))
        assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
        # An epoch takes each block once.
        blocks = [(r["epoch"], r["block"]) for r in rows]
        assert len(set(blocks)) == len(blocks)
    held = {(r["shard"], r["source_key"]): r["slots"] for r in counts.collect()}
    assert held == {(r["shard"], r["source_key"]): r["count"] for r in drawn.groupBy("shard", "source_key").count().collect()}


def test_counts_are_a_multinomial_draw(spark):
    """Chi-square of the counts of each source over the shards, for several seeds, and of shards over the sources."""
    plan = spark.createDataFrame([("a", 40_000), ("b", 16_000), ("c", 8_000)], "source_key string, slots long")
    total, seen = 64_000, set()
    for seed in range(1, 5):
        counts = {(r["shard"], r["source_key"]): r["slots"] for r in mixing.shard_counts(plan, 1000, seed).collect()}
        assert counts == {(r["shard"], r["source_key"]): r["slots"] for r in mixing.shard_counts(plan, 1000, seed).collect()}
        seen.add(tuple(sorted(counts.items())))
        shards = range(64)
        for key, slots in (("a", 40_000), ("b", 16_000), ("c", 8_000)):
            assert sum(counts.get((s, key), 0) for s in shards) == slots
            chi = sum((counts.get((s, key), 0) - slots / 64) ** 2 / (slots / 64) for s in shards)
            # 63 degrees of freedom: the middle 99.99 of 100.
            assert 29 < chi < 116
        size = {s: sum(counts.get((s, k), 0) for k in "abc") for s in shards}
        chi = sum(
            (counts.get((s, k), 0) - size[s] * n / total) ** 2 / (size[s] * n / total)
            for s in shards
            for k, n in (("a", 40_000), ("b", 16_000), ("c", 8_000))
        )
        # 126 degrees of freedom.
        assert 75 < chi < 200
    assert len(seen) == 4


def test_shards_hold_the_words_of_their_blocks(documents):
    """Which words are taken, against words laid end to end and cut by hand."""
    places = mixing.placed(mixing.sized(documents)).cache()
    plan, counts, drawn = drawn_slots(documents, 64)
    lines = defaultdict(list)
    for r in sorted(places.collect(), key=lambda r: r["start"]):
        lines[r["source_key"]] += [(r["start"], i) for i in range(r["size"])]
    length = {(r["source_key"], r["slot"]): r["taken_words"] for r in drawn.collect()}
    rows = mixing.packed(mixing.segments(places, 16), drawn).collect()
    assert len(rows) == len(length)
    for r in rows:
        words = [(p["start"], p["offset"] + i) for p in r["pieces"] for i in range(p["words"])]
        begin = r["block"] * 16
        assert words == lines[r["source_key"]][begin : begin + length[r["source_key"], r["slot"]]]


def test_nothing_but_the_mix_is_left(spark, documents):
    from pathlib import Path

    from textquarry.sources.staging import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("textquarry-*"))
    mixing.mixed_words(documents, block_words=16, shard_slots=64).collect()
    assert [p.name.split("-")[1] for p in set(folder.glob("textquarry-*")) - before] == ["mix"]


def test_texts_hold_the_words_taken(documents):
    got = defaultdict(int)
    texts = mixing.mixed_texts(documents, block_words=16)
    assert texts.columns == documents.columns
    for r in texts.collect():
        got[r["doc_id"], r["source"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    want = defaultdict(int)
    for r in mixing.mixed_words(documents, block_words=16).collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    assert dict(got) == {k: v for k, v in want.items() if v}


def test_clashing_columns_in_texts(clashing, no_documents):
    assert mixing.mixed_texts(clashing).columns == clashing.columns
    assert mixing.mixed_texts(no_documents).count() == 0
