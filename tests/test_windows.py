import datetime as dt
import random

from pyspark.sql import functions as F

from textquarry.streaming import windows

KIND = "k string, ts timestamp_ntz, id long"
BEGIN = dt.datetime(2024, 1, 1)


def slow_sessions(rows, pause):
    out, last = {}, {}
    for key, minute, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        if key not in last or minute - last[key][1] > pause:
            last[key] = [minute, minute]
        last[key][1] = minute
        out[key, last[key][0]] = (minute, out.get((key, last[key][0]), (0, 0))[1] + 1)
    return sorted((k, first, end, n) for (k, first), (end, n) in out.items())


def test_a_stream_of_late_files_gives_the_sessions_of_the_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), rng.randrange(0, 1200), i) for i in range(160)]
    # By time, but each up to 50 minutes late.
    arrive = sorted(rows, key=lambda r: r[1] + rng.randrange(0, 50))
    inbox, target, state = (str(tmp_path / n) for n in ("inbox", "sessions", "state"))

    def put(part):
        frame = spark.createDataFrame([(k, BEGIN + dt.timedelta(minutes=m), i) for k, m, i in part], KIND)
        frame.coalesce(1).write.mode("append").parquet(inbox)

    def run():
        windows.write_sessions(spark, inbox, KIND, target, state, "k", "ts", "20 minutes", "2 hours", F.count(F.lit(1)).alias("n"))

    for at in range(0, 160, 40):
        put(arrive[at : at + 40])
        run()
    open_ones = spark.read.parquet(target).count()
    windows.close_sessions(spark, inbox, KIND, "ts", "2030-01-01 00:00:00")
    run()
    run()  # nothing new, nothing twice
    minute = lambda t: int((t - BEGIN).total_seconds() // 60)
    got = sorted((r.k, minute(r.session_start), minute(r.session_end) - 20, r.n) for r in spark.read.parquet(target).collect())
    # Minutes apart by the pause itself touch, and go on.
    assert got == slow_sessions(rows, 20)
    assert open_ones < len(got)
    table = spark.createDataFrame([(k, BEGIN + dt.timedelta(minutes=m), i) for k, m, i in rows], KIND)
    batch = windows.sessions(table, "k", "ts", "20 minutes", F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.k, minute(r.session_start), minute(r.session_end) - 20, r.n) for r in batch) == got


def test_odd_rows_in_windows(spark):
    rows = [(None, BEGIN, 1), (None, BEGIN, 1), ("a", None, 2)]
    table = spark.createDataFrame(rows, KIND)
    n = F.count(F.lit(1)).alias("n")
    assert [(r.k, r.n) for r in windows.sliding(table, "k", "ts", "2 hours", "1 hour", n).collect()] == [(None, 2)] * 2
    assert [(r.k, r.n) for r in windows.sessions(table, "k", "ts", "1 hour", n).collect()] == [(None, 2)]
