import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textquarry.llm import language_id as li

SYLLABLES = {"en": ["the", "and", "ing", "tion", "her"], "de": ["sch", "ung", "über", "ein", "keit"], "fr": ["eau", "que", "ment", "é", "oir"]}


def corpus(spark, n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40)))
        rows.append((i, " ".join(words).capitalize(), lang, "a", 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = li.language_predictions(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_table_is_the_dot_product_of_written_out_vectors(spark):
    docs = corpus(spark, 40)
    known = li.profiles(docs, 256)
    texts = [r["text"] for r in docs.limit(5).collect()]
    numbers, rows = li.trigrams(pa.array(texts))
    weights = {}
    for r in docs.collect():
        n, _ = li.trigrams(pa.array([r["text"]]))
        bundle = li.trigram_vectors(n, 256).sum(axis=0) / np.sqrt(len(n))
        weights[r["lang"]] = weights.get(r["lang"], 0) + bundle
    for i in range(5):
        vector = li.trigram_vectors(numbers[rows[i] : rows[i + 1]], 256).sum(axis=0)
        dots = known.table[numbers[rows[i] : rows[i + 1]]].sum(axis=0)
        for k, lang in enumerate(known.languages):
            prototype = weights[lang] / np.linalg.norm(weights[lang])
            assert abs(vector @ prototype - dots[k]) < 1e-2 * max(1, abs(dots[k]))


def test_odd_documents(documents, clashing, no_documents, rows):
    columns = ("doc_id", "held_out", "lang_pred", "score")
    got = rows(li.language_predictions(documents), *columns)
    assert len(got) == documents.count()
    assert {r[0] for r in got if r[2] == "und"} == {6, 7, 8, 10, None}
    assert rows(li.language_predictions(clashing), *columns) == got
    assert li.language_predictions(no_documents).count() == 0
    kept = li.with_language(clashing)
    assert kept.columns == clashing.columns and kept.count() == documents.count() - 5
    nothing = li.language_predictions(documents.withColumn("lang", documents["source"].substr(9, 1).cast("string")).filter("lang = ''"))
    assert nothing.count() == documents.filter("source IS NOT NULL").count()


def test_trigrams_stay_in_their_row():
    numbers, rows = li.trigrams(pa.array(["ab", None, "", "é", "!!", "a b", "AB"]))
    assert np.diff(rows).tolist() == [2, 0, 0, 1, 0, 2, 2]
    assert numbers[:2].tolist() == numbers[-2:].tolist()


def test_letters_that_are_no_language_go(spark):
    rng = random.Random(8)
    docs = corpus(spark, 600)
    signs = ["abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"]
    noise = [(1000 + i, "".join(rng.choice(signs[i % 3]) for _ in range(400)), None, "n", 0) for i in range(30)]
    mixed = docs.union(spark.createDataFrame(noise, docs.schema))
    kept = {r["doc_id"] for r in li.with_language(mixed).collect()}
    assert not kept & {r[0] for r in noise}
    assert len(kept) >= 0.99 * 600


def test_all_stay_when_nothing_could_be_learned(spark):
    docs = corpus(spark, 20).withColumn("lang", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(99, "123 !!", None, "a", 0)], docs.schema)
    assert {r["doc_id"] for r in li.with_language(docs.union(odd)).collect()} == set(range(20))


def test_cosines_take_little_text_at_once(spark, monkeypatch):
    measured = li.cosines

    def checked(texts, known, dimensions=li.DIMENSIONS):
        if sum(len(x or "") for x in texts.to_pylist()) > 1 << 17:
            raise AssertionError("more text at once than an executor's memory is planned for")
        return measured(texts, known, dimensions)

    docs = spark.createDataFrame([(i, "some words of a text " * 500, "en", "s", 0) for i in range(200)], "doc_id long, text string, lang string, source string, n int").coalesce(1)
    monkeypatch.setattr(li, "cosines", checked)
    assert li.with_language(docs).count() == 200
