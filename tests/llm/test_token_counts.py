import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textquarry.llm import token_counts as tc
from textquarry.sources.staging import staging_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = (*tc.GROUPS, "documents", "tokens")


def test_odd_documents(documents, clashing, no_documents, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, tokens = Counter(), Counter()
    for r in documents.collect():
        text = r["text"] or ""
        for version, n in (("words-1", len(WORD.findall(text))), ("word-bpe-49k-1", len(tokenizer.encode(text, add_special_tokens=False).ids))):
            docs[r["source"], r["lang"], version] += 1
            tokens[r["source"], r["lang"], version] += n
    want = sorted(((*k, docs[k], tokens[k]) for k in docs), key=repr)
    assert rows(tc.token_totals(documents), *COLUMNS) == want
    assert rows(tc.token_totals(clashing), *COLUMNS) == want
    assert tc.token_totals(no_documents).count() == 0


def test_totals_after_each_batch(spark, rows):
    made = [("a" if i % 3 else None, "en" if i % 2 else "de", i % tc.PARTS, i % 7, None if i == 5 else i % 11) for i in range(60)]
    counts = spark.createDataFrame(made, "source string, lang string, part int, words long, pieces long")
    rollup = tc.TokenRollup(spark, staging_path(spark, "rollup-test"))
    held = {}
    for name, batch in tc.history(counts):
        for i, (_, _, part, n, pieces) in enumerate(made):
            if name == f"arrivals/{part}":
                held[i] = (n, n)
            elif name == "revised" or (name == "restored" and part == tc.PARTS - 1):
                held[i] = (n, pieces or 0)
            elif name == "withdrawn" and part == tc.PARTS - 1:
                del held[i]
        assert rollup.commit(name, batch) and not rollup.commit(name, batch)
        docs, tokens = Counter(), Counter()
        for i, sizes in held.items():
            for version, n in zip((tc.WORDS, tc.PIECES), sizes):
                docs[(*made[i][:2], version)] += 1
                tokens[(*made[i][:2], version)] += n
        want = sorted(((*k, docs[k], tokens[k]) for k in docs), key=repr)
        assert [r for r in rows(rollup.totals(), *COLUMNS) if r[3]] == want
        if name == "withdrawn":
            rollup.compact()
            assert [r for r in rows(rollup.totals(), *COLUMNS) if r[3]] == want


def test_asking_again_changes_nothing(spark, documents, rows):
    folder = staging_path(spark, "rollup-test")
    first = rows(tc.token_totals(documents, folder), *COLUMNS)
    assert rows(tc.token_totals(documents, folder), *COLUMNS) == first == rows(tc.token_totals(documents), *COLUMNS)
    assert len(tc.TokenRollup(spark, folder).batches()) == tc.PARTS + 3


SCHEMA = "source string, lang string, tokenizer_version string, n_tokens long"


def test_signed_batches_count_once(spark, rows):
    rollup = tc.TokenRollup(spark, staging_path(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    df = spark.createDataFrame([("a", "en", "v1", 5), ("a", "en", "v1", 7), ("b", None, "v1", None)], SCHEMA)
    assert rollup.commit("load/1", tc.changes(df, "insert"))
    assert not rollup.commit("load/1", tc.changes(df, "insert"))
    assert rollup.commit("revised", tc.changes(df.limit(1), "revise", F.lit(9), F.lit(5)))
    assert rollup.commit("gone", tc.changes(df.filter("n_tokens = 7"), "delete"))
    want = [("a", "en", "v1", 1, 9), ("b", None, "v1", 1, 0)]
    assert rows(rollup.totals(), *COLUMNS) == want
    rollup.compact()
    assert rows(rollup.totals(), *COLUMNS) == want
    assert not rollup.commit("gone", tc.changes(df, "delete"))
    assert rollup.commit("empty", tc.changes(df.limit(0), "insert"))
    rollup.compact()
    assert rows(rollup.totals(), *COLUMNS) == want
    assert len(rollup.batches()) == 4


def test_interrupted_batches_do_not_count(spark, rows):
    rollup = tc.TokenRollup(spark, staging_path(spark, "rollup-test"))
    df = spark.createDataFrame([("a", "en", "v1", 5)], SCHEMA)
    with pytest.raises(Exception, match="unknown operation"):
        rollup.commit("bad", tc.changes(df, "inserted"))
    assert rollup.totals().count() == 0
    assert rollup.commit("bad", tc.changes(df, "insert"))
    assert rows(rollup.totals(), *COLUMNS) == [("a", "en", "v1", 1, 5)]
