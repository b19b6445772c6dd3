import random

import numpy as np
import pyarrow as pa
import pytest

from textquarry.llm import decontaminate as dc


def slow_tiling(a, b, least):
    """Greedy string tiling by comparing all positions."""
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < least:
            return tiles
        tiles.append(best)
        i, j, n = best
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


@pytest.mark.parametrize("seed", range(30))
def test_tiles_are_those_of_all_comparisons(seed):
    rng = random.Random(seed)
    a = [rng.randint(0, rng.choice([1, 3, 20])) for _ in range(rng.randint(0, 25))]
    b = a[10:] + [rng.randint(0, 3) for _ in range(rng.randint(0, 20))] + a[:8]
    values = np.random.default_rng(1).integers(1, 1 << 62, 32, dtype=np.uint64)
    got = dc.tiling(values[np.array(a, int)], values[np.array(b, int)], 3)
    assert got == slow_tiling(a, b, 3)


ITEM = "The quick brown fox jumps over the lazy dog. Then it rests under an old oak tree until the evening comes at last."


def test_planted_passages(spark):
    first, second = ITEM.split(". ")
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("abcde") for _ in range(6)) for _ in range(300))
    docs = [
        (1, noise[:900] + " " + ITEM + " " + noise[900:]),
        (2, noise + " " + second.upper() + "!! " + noise[:40] + "\n\n" + first.replace(" ", "\t")),
        (3, noise),
        (4, "Then it rests under an old oak " + noise),
        (5, None),
        (6, "tiny item"),
    ]
    bench = [(1, ITEM), (2, "tiny item"), (3, ""), (4, None), (5, "a b c d e f g h i j")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["coverage"], r["tiles"]) for r in dc.contaminated(df, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 2)}
    assert got[1, 1] == (1.0, 1) and got[2, 1] == (1.0, 2)
    assert sorted(r["doc_id"] for r in dc.clean(df, items).collect()) == [3, 4, 5]
    small = list(dc.blocks(items, block_tokens=1))
    assert len(small) == 3 and sum(len(b.ids) for b in small) == 5


def test_pairs_by_brute_force(spark):
    rng = random.Random(3)
    items = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(12)]
    docs = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    block = dc.Block(list(range(12)), [dc.tokens(pa.array([x]))[0] for x in items], 5)
    got = {(r, i): (c, n) for r, i, c, n in block.pairs(pa.array(docs))}
    for r, d in enumerate(docs):
        for i, x in enumerate(items):
            a, b = x.split(), d.split()
            tiles = slow_tiling(a, b, min(5, len(a)))
            want = (sum(t[2] for t in tiles) / len(a), len(tiles)) if tiles else None
            assert got.get((r, i)) == want


def test_odd_documents(spark, documents, clashing, no_documents, rows):
    bench = spark.createDataFrame([(7, "the dog sat on the log and then the cat left"), (None, "again and again again and")], "item_id long, text string")
    columns = ("doc_id", "item_id", "coverage", "tiles")
    got = rows(dc.contaminated(documents, bench), *columns)
    assert {r[0] for r in got} == {1, 2, 3, 12} and len(got) == 5
    assert rows(dc.contaminated(clashing, bench), *columns) == got
    assert dc.contaminated(no_documents, bench).count() == 0
    assert dc.contaminated(documents, bench.limit(0)).count() == 0
    assert dc.clean(documents, bench.limit(0)).count() == documents.count()
    assert dc.clean(clashing, bench).columns == clashing.columns
    assert dc.clean(documents, bench).count() == documents.count() - 5
