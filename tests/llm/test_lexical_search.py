import math
import random
import re
from collections import Counter

import pytest

from textquarry.llm import lexical_search
from textquarry.llm.lexical_search import best_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow(docs, items):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    within = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // length
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * within[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(found, key=lambda r: r[:3])[:20])]
    return sorted(out, key=repr)


def check(docs, items):
    got = best_documents(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    of = lambda df, k: [(r[k], r["text"]) for r in df.select(k, "text").collect()]
    assert rows == slow(of(docs, "doc_id"), of(items, "item_id"))
    return rows


def test_odd_documents(spark, documents, clashing, no_documents):
    items = [(1, "the cat and the dog"), (2, ""), (3, None), (4, "die Katze; der HUND: Straße ß"), (None, "cat cat"), (5, "漢字 x"), (5, "again"), (6, "nowhere seen")]
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS score", "3 AS doc_id")
    assert check(documents, items)
    check(clashing, items)
    assert best_documents(no_documents, items).count() == 0
    assert best_documents(documents, items.filter("false")).count() == 0


@pytest.mark.parametrize("blocks", [1000, 3])
def test_ranks_are_exact(spark, blocks, monkeypatch):
    """Many equal scores, more documents than ranks, and bounds that all are too high in long documents."""
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", blocks)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(300)], k=n))
    docs = [(i, text(rng.choice([3, 40, 400]))) for i in range(300)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(90)] + [(5000, " ".join(f"x{i}" for i in range(20_000)) + " w1 w2")]
    rng.shuffle(docs)
    items = [(i, text(12)) for i in range(10)] + [(99, docs[0][1])]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = check(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert len(rows) == 20 * 11
