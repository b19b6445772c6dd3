import random

import pytest

from textquarry.operators import ordered_joins

LEFT = "k string, t double, id long"
RIGHT = "k string, t double, id long, v string"


def newest(row, right):
    if row[0] is None or row[1] is None:
        return None
    before = [r for r in right if r[0] == row[0] and r[1] is not None and r[1] <= row[1]]
    return max(before, key=lambda r: (r[1], r[2] is not None, r[2] or 0), default=None)


@pytest.mark.parametrize("range_rows", [1 << 20, 40])
def test_asof_is_the_newest_before(spark, range_rows):
    rng = random.Random(range_rows)
    keys = ["hot"] * 6 + ["a", "b", None]

    def rows(n):
        return [(rng.choice(keys), rng.choice([None, *range(60)]), i) for i in range(n)]

    left = [(k, None if t is None else float(t), i) for k, t, i in rows(400)] * 2
    right = [(k, None if t is None else float(t), rng.choice([None, i]), None) for k, t, i in rows(150)]
    # a key whose only right row lies many ranges before its left rows
    left += [("late", 1000.0 + i, i) for i in range(200)]
    right += [("late", 1.0, 5, "x"), ("right only", 1.0, 6, "y")]
    out = ordered_joins.asof_join(
        spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT), "k", "t", "id", range_rows
    )
    assert out.columns == ["k", "t", "id", "match"]
    got = sorted(((tuple(r)[:3], r.match and tuple(r.match)) for r in out.collect()), key=repr)
    assert got == sorted(((r, newest(r, right)) for r in left), key=repr)


def test_asof_with_an_empty_side(spark):
    none, one = spark.createDataFrame([], RIGHT), spark.createDataFrame([("a", 1.0, 1)], LEFT)
    assert [r.match for r in ordered_joins.asof_join(one, none, "k", "t", "id").collect()] == [None]
    assert ordered_joins.asof_join(none, one, "k", "t", "id").collect() == []


@pytest.mark.parametrize("width", [0.01, 1.0, 1000.0])
def test_overlaps_are_those_of_all_pairs(spark, width):
    rng = random.Random(5)

    def rows(n):
        out = []
        for i in range(n):
            low = rng.choice([rng.uniform(-50, 50), float(rng.randint(-5, 5))])
            out.append((rng.choice("aab"), low, low + rng.choice([0, 0, 1, 2.0, 0.3, 64, 5000]), i))
        return out

    odd = [(None, 0.0, 1.0, 900), ("a", None, 1.0, 901), ("a", 1.0, None, 902), ("a", 2.0, 1.0, 903), ("a", float("nan"), 1.0, 904), ("a", 0.0, float("inf"), 905)]
    left, right = rows(90) + odd, rows(70) + odd
    left += left[:5]
    kind = "k string, low double, high double, id long"
    out = ordered_joins.overlapping(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), "k", "low", "high", width)
    got = sorted((r.a.id, r.b.id) for r in out.collect())
    assert got == sorted(
        (x[3], y[3]) for x in left for y in right if x[3] < 900 and y[3] < 900 and x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]
    )
    empty = spark.createDataFrame([], kind)
    assert ordered_joins.overlapping(empty, empty, "k", "low", "high").collect() == []


def test_overlaps_move_only_what_is_asked_for(spark):
    long = spark.range(20).selectExpr("'k' AS k", "CAST(id AS double) AS low", "id + 90.0D AS high", "id AS unasked")
    short = spark.range(20).selectExpr("'k' AS k", "CAST(id AS double) AS low", "id + 1.0D AS high", "id AS number")
    out = ordered_joins.overlapping(long, short, "k", "low", "high", 1)
    assert out.columns == ["a", "b"] and out.select("a.*").columns == ["k", "low", "high", "unasked"]
    plan = out.select("b.number")._jdf.queryExecution().executedPlan().toString()
    # long ones meet short ones at the long ones' level only, and words on a page are more than estimates say
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan
    moved = [line for line in out.select("b.number")._jdf.queryExecution().optimizedPlan().toString().splitlines() if "unasked" in line]
    assert moved == []
    assert out.count() == sum(x <= y + 1 and y <= x + 90 for x in range(20) for y in range(20))
