import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest_llm import union_find
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_decontaminate import slow_tiling
from test_near_copies import near, slow_shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")



def written(spark, docs, benchmark, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_do_what_slow_versions_do(spark, documents, tmp_path):
    leak = "then the quick brown fox jumps over the lazy dog again"
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    docs = written(spark, documents.union(spark.createDataFrame([(50, "So " + leak + " today", "en", "z", 0)], documents.schema)), bench, str(tmp_path))
    now = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before.collect(), now.collect())
        if name != "token_ids":
            assert now.columns == docs.columns

    before, after = seen["language_id"]
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if any(c.isalpha() for c in r["text"] or ""))

    before, after = seen["near_dedup"]
    group = union_find({slow_shingles(r["text"]) for r in before}, near)
    best = {}
    for r in before:
        g = group[slow_shingles(r["text"])]
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        best[g] = min(best.get(g, key), key)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == sorted(best.values())

    before, after = seen["decontamination"]
    item = leak.split()

    def covered(text):
        tokens = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower())[:2000]
        return sum(t[2] for t in slow_tiling(item, tokens, 5)) / len(item) >= 0.5

    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if not covered(r["text"]))

    before, after = seen["mixing"]
    words = sum(len(WORD.findall(r["text"])) for r in before)
    assert abs(sum(len(WORD.findall(r["text"])) for r in after) - 1.5 * words) <= 0.5 * 6
    whole = {r["text"] for r in before}
    assert all(r["text"] in whole or any(r["text"].strip() in t for t in whole) or r["doc_id"] is not None for r in after)

    before, after = seen["token_ids"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = Counter((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in before)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after) == sizes
    rows = sorted(after, key=lambda r: r["start"])
    assert [r["start"] for r in rows] == np.r_[0, np.cumsum([r["n_tokens"] for r in rows])][:-1].tolist()


def test_run_gives_the_last_stage(spark, documents, no_documents, tmp_path):
    bench = spark.createDataFrame([(1, "nothing of this kind")], "item_id long, text string")
    written(spark, documents, bench, f"{tmp_path}/a")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 5
    written(spark, no_documents, bench, f"{tmp_path}/b")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_python_gets_few_bytes_at_once(spark, no_documents, tmp_path):
    bench = spark.createDataFrame([(1, "nothing of this kind")], "item_id long, text string")
    docs = written(spark, no_documents, bench, str(tmp_path))
    long = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("some text "), 1000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        after = stage(spark, docs, str(tmp_path))
        seen = [r["size"] for r in long.mapInArrow(sizes, "size bigint").collect()]
        assert max(seen) <= 5_000_000 and sum(seen) >= 20_000_000, name
        assert after.count() == 0
