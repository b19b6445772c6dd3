import math
import random
import re
import zlib
from collections import Counter

import pytest

from textquarry.llm import maxent_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def check(docs):
    got = lm.lm_scores(docs).collect()
    texts = [(r["doc_id"], WORD.findall((r["text"] or "").translate(LOWER)) + [END]) for r in docs.collect()]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    counts = Counter(w for i, words in texts if not held(i) for w in words if i is not None)
    total, different = sum(counts.values()), len(counts)
    want = sorted(
        (repr(i), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (total + different + 1)) for x in w), 6))
        for i, w in texts
    )
    assert want == sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got)
    assert {r["train_tokens"] for r in got} <= {total}
    return got


def test_odd_documents(documents, clashing, no_documents):
    got = check(documents)
    assert len(check(clashing)) == len(got)
    assert lm.lm_scores(no_documents).count() == 0


def test_rare_words_meet_their_counts(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 8)
    check(documents)


def test_context_helps_on_held_out_texts(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = ["alpha", "beta", "gamma", "delta"] if i % 2 else ["one", "two", "three", "four"]
        rows.append((i, " ".join(words[k % 4] for k in range(rng.randint(0, 3), 60)), "en", "a", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    held = [r for r in check(docs) if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] for r in held)


def test_words_in_context_add_up_to_one(spark, documents):
    training = documents.filter("doc_id IS NOT NULL")
    known = lm.vocabulary(lm.word_counts(training))
    weights = lm.train(training, known)
    import numpy as np

    ranks = np.arange(len(known.keys) + 1)
    base = np.r_[10 ** known.logs[:-1], known.masses[-1]] / known.all  # the last: all words that are not frequent
    for context in ([3, 1, 0], [0, 0, 2]):
        total = 0.0
        for r in ranks:
            seen = np.array([*context, r])
            gain = lm.context_gains(known, weights, seen, np.array([0, 4]))[-1]
            total += base[r] * 10**gain
        assert total == pytest.approx(1, abs=1e-4)


def test_sums_of_groups_small_and_large():
    import numpy as np

    rng = np.random.default_rng(5)
    sizes = [1, 2, lm._MANY - 1, lm._MANY, lm._MANY + 1, 3 * lm._MANY, 7, 1]
    keys = rng.permutation(np.repeat(np.arange(len(sizes)) * 11, sizes)).astype(np.uint16)
    values = rng.normal(size=(len(keys), 5)).astype(np.float32)
    for k, v in ((keys, values), (keys[:1], values[:1]), (keys[:0], values[:0])):
        found, sums = lm._summed(v, k)
        assert sorted(found.tolist()) == sorted(set(k.tolist()))
        for key, total in zip(found, sums, strict=True):
            assert total == pytest.approx(v[k == key].sum(axis=0), abs=1e-4)
