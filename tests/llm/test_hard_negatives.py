import math
import random

import pytest

from textquarry.llm import hard_negatives as hn

KIND = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def slow(rows):
    """rows: vec_id, vector and label."""
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        held[i] = min(held.get(i, r), r)
    out = []
    for a, (label, v) in held.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in held.items()}
        order = sorted(held, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][0] == label and i != a][:5]:
            near = [i for i in order if held[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(near)]
    return sorted(out)


def check(spark, rows, parts=3):
    got = hn.hard_negatives(spark.createDataFrame(rows, KIND).repartition(parts).selectExpr("*", "1 AS score", "2 AS anchor"))
    assert got.columns == NAMES
    found = sorted(tuple(r) for r in got.collect())
    assert found == slow([(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows])
    return found


@pytest.mark.parametrize(("anchors", "tile"), [(2048, 1024), (2, 7)])
def test_equal_to_all_pairs(spark, monkeypatch, anchors, tile):
    """Few different scores, so that ties decide; rows with one id; ids below zero."""
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    monkeypatch.setattr(hn, "TILE", tile)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.choice([0, 0, 1, 2, 9])) for i in range(-300, 500)]
    rows += [(200, [0.5, 0.5, 0.5, 0.5], 0), (200, [0.5, 0.25, 0.5, 0.5], 0), (100, [0.0] * 4, 1)]
    assert len({r[0] for r in check(spark, rows)}) >= 6


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 2), (2, [0.5, 0.5], 1), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1)]
    rows += [(6, [inf, 1.0], 2), (8, [0.5], 1), (9, [], 1), (10, [1.0, 0.1, 7.0], 1), (None, [1.0, 1.0], 1), (11, [1.0, 1.0], None)]
    rows += [(100, [0.0, 0.0], 1), (200, [-1.0, -1.0], 1), (12, [0.2, 0.2], 2), (13, [0.3, 0.2], 2), (7, [0.1, 0.1], 3)]
    assert check(spark, rows, 1)
    assert hn.hard_negatives(spark.createDataFrame([], KIND)).count() == 0


def test_positives_at_and_below_zero(spark):
    """At zero negatives with smaller ids come before the positive in the stream."""
    rows = [(100, [1.0, 0.0], 1)] + [(i, [0.0, 1.0], 1 if i in (40, 80) else 2) for i in range(30, 95) if i % 7]
    found = check(spark, rows)
    assert {r[1] for r in found} == {40, 80} and len(found) == 20
    assert check(spark, [(100, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []


def test_too_large_scores_are_an_error():
    import numpy as np

    big = np.full((1, 4), 1 << 40)
    with pytest.raises(ValueError):
        hn.scores(big, big)
    whole = np.full((1, 2), (1 << 25) + 1)
    assert hn.scores(whole, whole)[0, 0] == 2 * ((1 << 25) + 1) ** 2
