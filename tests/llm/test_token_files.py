import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textquarry.llm import token_files as tf
from textquarry.llm.pieces import UnitTokens, unit_tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(docs, tokenizer):
    got = tf.token_files(docs).collect()
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, (r["text"] or "").encode()))
    start, want = 0, []
    for r in order:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_odd_documents(documents, clashing, no_documents, tokenizer):
    check(documents, tokenizer)
    check(clashing, tokenizer)
    assert tf.token_files(no_documents).count() == 0


def test_blocks_of_a_few_ids(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 40)
    check(documents, tokenizer)


def test_ranks_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 2 ** rng.integers(1, 33, n), dtype=np.uint64).astype(np.uint32) if n else np.zeros(0, np.uint32)
        control, data = tf.encoded_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert tf.decoded_ranks(control, data, n).tolist() == ranks.tolist()
    assert tf.encoded_ranks(np.array([1, 255, 256, 65536]))[1] == b"\x01\xff\x00\x01\x00\x00\x01"


def test_units_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(7)
    signs = "abÉZ1.,'<|>\n \t é×÷ßń“”日  \x1f\u0085ſKİΣ#\x00\x7f"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", "x<|endoftext|>y <|STARTOFTEXT|>", "don't we'll I'VE 's", "ab" * 5000, "a.b,c!d"]
    ids, rows = unit_tokens().encode(pa.array(texts, pa.string()))
    counts = unit_tokens().count(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[rows[i] : rows[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    assert counts.tolist() == np.bincount(ids, minlength=len(counts)).tolist()


def test_frequent_ids_have_low_ranks(documents):
    ids = tf.frequency_ranks(documents)
    counts = {r["id"]: r["n"] for r in tf.id_counts(documents).collect()}
    assert sorted(counts, key=lambda i: (-counts[i], i)) == ids.tolist()


def test_whole_units_keep_their_case(tokenizer):
    texts = ["<|EndOfText|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|> a", "<|startoftext|> a"]
    for listed in (texts, texts[::-1]):
        tokens = UnitTokens(public_tokenizers.path("word_bpe_49k.json"))
        ids, rows = tokens.encode(pa.array(listed))
        for i, text in enumerate(listed):
            assert ids[rows[i] : rows[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_an_id_that_was_not_counted_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    ids = tf.frequency_ranks(docs.withColumn("text", F.lit("a b")))
    with pytest.raises(Exception, match="did not count"):
        tf._blocks(docs, ids, None, tf.END_ID).collect()
