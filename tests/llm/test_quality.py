import random
import zlib

from pyspark.sql import functions as F

from textquarry.llm import quality


def corpus(spark, n=600):
    rng = random.Random(5)
    words = ["river", "stone", "over", "the", "under", "light", "and", "carry", "of", "green"]
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 60)))
        rows.append((i, text if good else " ".join(w + "###" for w in text.split()), "en", "a", 0))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality long")


def test_held_out_accuracy_and_rule(spark):
    docs, labels = corpus(spark)
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 600
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert sum(r["predicted"] == r["quality"] for r in held) > 0.97 * len(held)


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(spark, 200)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.quality_scores(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_odd_documents(spark, documents, clashing, no_documents, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 14)] + [(1, 0), (None, 1), (2, None)], "doc_id long, quality long")
    columns = ("doc_id", "held_out", "score", "predicted")
    got = rows(quality.quality_scores(documents, labels), *columns)
    assert len(got) == documents.count()
    assert rows(quality.quality_scores(clashing, labels), *columns) == got
    assert quality.quality_scores(no_documents, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(documents, labels.limit(0)).collect()} == {0.5}


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    docs, labels = corpus(spark, 200)
    twice = docs.union(docs.withColumn("text", F.reverse("text"))).union(docs.withColumn("text", F.lit("one for all")))
    dealt = (twice.repartition(1), twice.orderBy(F.desc("text")).repartition(7))
    one, other = (sorted(map(tuple, quality.quality_scores(x, labels).collect())) for x in dealt)
    assert one == other
