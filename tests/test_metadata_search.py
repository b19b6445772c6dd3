import json
import random

import numpy as np
import pytest

from textquarry.operators import metadata_search as M


def test_lists_round_trip():
    rng = np.random.default_rng(1)
    for numbers in ([], [0], [5], [0, 1, 2, 127, 128, 300], [2**33, 2**33 + 1, 2**62], sorted(set(rng.integers(0, 2**40, 500)))):
        numbers = np.array(numbers, np.int64)
        assert M.unpacked(M.packed(numbers)).tolist() == numbers.tolist()


@pytest.mark.parametrize(
    ("value", "pattern", "want"),
    [
        ('{"a": 1, "b": {"c": [1, {"d": 2}]}}', '{"b": {"c": [{"d": 2.0}]}}', True),
        ('{"a": 1}', '{"a": true}', False),
        ('{"a": "1"}', '{"a": 1}', False),
        ('{"a": 10}', '{"a": 1e1}', True),
        ('{"a": -0}', '{"a": 0.00}', True),
        ('{"a": [1, 2]}', '{"a": [2, 2]}', True),
        ('{"a": [{"x": 1}, {"y": 2}]}', '{"a": [{"x": 1, "y": 2}]}', False),
        ('{"a": {}}', '{"a": []}', False),
        ('{"a.b": 1}', '{"a": {"b": 1}}', False),
        ("[]", "{}", False),
        ("null", "null", True),
    ],
)
def test_containment(value, pattern, want):
    assert M.contains(M.parsed(value)[1], M.parsed(pattern)[1]) == want


def random_value(rng, depth=0):
    kind = rng.choice("snbol" if depth < 3 else "snb")
    if kind == "o":
        return {rng.choice("abé"): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    if kind == "l":
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {"s": "x", "n": rng.choice([0, 1, 1.5]), "b": rng.choice([True, None])}[kind]


@pytest.mark.parametrize("bits", [16, 2])
def test_search_finds_what_a_slow_one_finds(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(M, "BLOCK_BITS", bits)
    rng = random.Random(5)
    texts = [json.dumps(random_value(rng)) for _ in range(600)] + [None, "", "{", '{"a": NaN}', "{}", "[" * 20000, "[" * 150 + "]" * 150, "[" * 400 + "]" * 400, '{"a": 1, "a": 0}'] + ['{"a": {"b": 1}}'] * 40
    rows = [(f"c{i}" if i else None, t) for i, t in enumerate(texts)]
    patterns = [json.dumps(random_value(rng, 1)) for _ in range(40)] + ["{}", "{}", "", None, "nonsense", '{"a":{"b":1.0}}', '{"a":0}', "[[]]", "[" * 150 + "]" * 150, "[" * 400 + "]" * 400]
    stored = spark.createDataFrame(rows, "chunk_id string, metadata string").selectExpr("*", "1 AS number", "2 AS pattern").repartition(3)
    index = M.MetadataIndex(spark, str(tmp_path / "index")).build(stored)
    asked = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    want = [(p, i) for p in set(patterns) if M.parsed(p)[0] for i, t in rows if M.parsed(t)[0] and M.contains(M.parsed(t)[1], M.parsed(p)[1])]
    assert len(want) > 500
    assert sorted(map(repr, ((r.pattern, r.id) for r in index.search(asked).collect()))) == sorted(map(repr, want))
    assert index.search(asked.limit(0)).count() == 0
    assert M.MetadataIndex(spark, str(tmp_path / "none")).build(stored.limit(0)).search(asked).count() == 0


def test_a_rare_value_spares_the_lists_of_frequent_ones(spark, tmp_path, monkeypatch):
    rows = spark.range(600).selectExpr("CONCAT('c', id) AS chunk_id", """CONCAT('{"kind":"x","half":', id % 2, ',"id":', id, '}') AS metadata""")
    index = M.MetadataIndex(spark, str(tmp_path / "index")).build(rows)
    rare = spark.createDataFrame([('{"kind":"x","id":7}',), ('{"kind":"x","id":8,"half":1}',), ('{"kind":"x","id":-1}',)], "pattern string")
    frequent = spark.createDataFrame([('{"kind":"x","half":1}',), ('{"kind":"y","half":1}',)], "pattern string")
    with monkeypatch.context() as m:
        m.setattr(M, "DIRECT", 0)  # all lists are intersected
        assert [r.id for r in index.search(rare).collect()] == ["c7"]
        found = sorted(r.id for r in index.search(frequent).collect())
    assert found == sorted(f"c{i}" for i in range(1, 600, 2)) == sorted(r.id for r in index.search(frequent).collect())

    def never(lists):
        raise AssertionError("frequent values' lists were read")

    monkeypatch.setattr(M, "_intersected", never)
    assert [r.id for r in index.search(rare).collect()] == ["c7"]
