import random

from textquarry.streaming.newest import current, newest_versions

KIND = "id string, version long, text string"


def test_any_order_of_arrival_gives_the_newest(spark, tmp_path):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.4 else rng.choice("abcde"), rng.randrange(25), rng.choice(["x", "y", "ä", "", None])) for _ in range(120)]
    rows += rows[:10] + [(None, 1, "no id"), ("a", None, "no version"), ("late", 9, "new")]
    rng.shuffle(rows)
    rows += [("late", 3, "old")]
    inbox = str(tmp_path / "inbox")
    answers = []
    for n, order in enumerate((rows, rows[::-1])):
        inbox, target, state = (str(tmp_path / f"{name}-{n}") for name in ("inbox", "target", "state"))
        for at in range(0, len(order), 45):
            spark.createDataFrame(order[at : at + 45], KIND).coalesce(2).write.mode("append").parquet(inbox)
            newest_versions(spark, inbox, KIND, target, state, "id", "version", 1)
        newest_versions(spark, inbox, KIND, target, state, "id", "version")
        written = [tuple(r) for r in spark.read.schema(KIND).parquet(target).collect()]
        assert len(set(written)) == len(written)
        answers.append(sorted((tuple(r) for r in current(spark, target, KIND, "id", "version").collect()), key=repr))
    assert answers[0] == answers[1]
    want = {}
    for key, version, _ in rows:
        if key is not None and version is not None:
            want[key] = max(want.get(key, -1), version)
    assert {r[0]: r[1] for r in answers[0]} == want
    assert all(r in rows for r in answers[0])
