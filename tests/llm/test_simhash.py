import random
import re

import pytest
import xxhash
from conftest_llm import union_find
from pyspark.sql import functions as F

from textquarry.llm import simhash
from textquarry.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(a, b):
    return (a ^ b).bit_count() <= 3


def test_odd_documents(documents, clashing, no_documents):
    got = simhash.near_duplicates(documents).collect()
    fps = {(r["doc_id"], slow_fingerprint(r["text"])) for r in documents.collect()}
    assert {(r["doc_id"], int(r["fingerprint"], 16)) for r in got} == fps
    assert len(got) == documents.count()
    group = union_find({f for _, f in fps}, near)
    least = {}
    for i, f in fps:
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    assert all(r["component_id"] == least.get(group[int(r["fingerprint"], 16)]) for r in got)
    assert sorted(map(repr, got)) == sorted(map(repr, simhash.near_duplicates(clashing).collect()))
    assert simhash.near_duplicates(no_documents).count() == 0


def test_one_of_each_stays(documents, clashing, no_documents):
    got = simhash.one_of_each(documents)
    assert got.columns == documents.columns
    groups = union_find({slow_fingerprint(r["text"]) for r in documents.collect()}, near)
    assert got.count() == len(set(groups.values()))
    assert {groups[slow_fingerprint(r["text"])] for r in got.collect()} == set(groups.values())
    assert simhash.one_of_each(clashing).columns == clashing.columns
    assert simhash.one_of_each(no_documents).count() == 0


def values(seed):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(80):
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.randint(0, 5)):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    ball = rng.getrandbits(64)
    out |= {ball ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    return sorted(out)


@pytest.mark.parametrize("split", [50_000, 15])
def test_links_connect_what_all_pairs_connect(spark, split):
    all_of_them = values(split)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in all_of_them], "fp long")
    links = simhash.near_links(df, split_above=split)
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(links).collect()}
    group = union_find(all_of_them, near)
    assert {frozenset(v for v in all_of_them if group[v] == g) for g in set(group.values())} == {
        frozenset(v for v in all_of_them if got.get(v, v) == g) for g in {got.get(v, v) for v in all_of_them}
    }


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = components(spark.createDataFrame(path, "a long, b long"))
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert roots == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tries_give_bits_back(spark):
    one = spark.createDataFrame([(0x0123456789ABCDEF,)], "fp long")
    got = one.select(*(F.hex(simhash._turned(F.col("fp"), t)) for t in range(4))).first()
    assert tuple(got) == ("123456789ABCDEF", "4567012389ABCDEF".replace("89ABCDEF", "CDEF89AB"), "89ABCDEF01234567", "CDEF89AB45670123")
