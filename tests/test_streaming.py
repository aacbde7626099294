"""Check-in streams driven to completion over files."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ratemill.sources import commits
from ratemill.sources import files as S
from ratemill.streaming import checkins as T
from ratemill.streaming.sinks import UpsertTable


def write(spark, path, rows):
    spark.createDataFrame(rows, T.CHECKIN).write.mode("append").parquet(path)


def run(df, folder, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def events(n=200):
    t = datetime(2024, 1, 1)
    return [(i, i % 7, t + timedelta(minutes=7 * i), "Gym Visit" if i % 5 else "Nap", "Y" if i % 11 else "N") for i in range(n)]


def good():
    return [e for e in events() if e[3] == "Gym Visit" and e[4] == "Y" and e[1] != 6]


def test_validate_dedupe_count(spark, folder):
    write(spark, f"{folder}/in", events())
    write(spark, f"{folder}/in", events())
    enrolled = spark.createDataFrame([(i,) for i in range(6)], "enrollment_id long")
    valid = T.valid_checkins(T.read_checkins(spark, f"{folder}/in", files_per_trigger=2), enrolled)
    once = run(T.dedupe(valid, "30 days"), folder, "once")
    assert once.count() == len(good())
    counts = run(T.running_counts(valid, "1 day"), folder, "counts", "complete")
    assert counts.agg(F.sum("qualifying_activity_count")).first()[0] == 2 * len(good())


def test_alarm(spark, folder):
    write(spark, f"{folder}/in", events())
    hot = run(T.threshold_alarm(T.read_checkins(spark, f"{folder}/in"), 9, "1 hour"), folder, "alarm", "complete")
    per_hour = {}
    for e in events():
        per_hour[e[2].replace(minute=0)] = per_hour.get(e[2].replace(minute=0), 0) + 1
    assert hot.count() == sum(n >= 9 for n in per_hour.values()) > 0


def test_source_watch(spark, folder):
    import os
    os.makedirs(f"{folder}/src")
    for name, text in (("a.csv", "one"), ("b.csv", "two")):
        with open(f"{folder}/src/{name}", "w") as f:
            f.write(text)
    known = S.source_state(spark, f"{folder}/src/a.csv").withColumn("source_state_id", F.lit(1)).select("source_path", "content_hash", "source_state_id")
    seen = []
    T.source_watch(spark, f"{folder}/src", lambda: known, lambda df, i: seen.extend(r["source_path"] for r in df.collect()), f"{folder}/cp").awaitTermination()
    assert [os.path.basename(s) for s in seen] == ["b.csv"]


COUNTS = "window_start timestamp, enrollment_id bigint, qualifying_activity_count bigint"


def test_windows_end_and_leave_the_state(spark, folder):
    """Forty days of check-ins, a day a file; the state never holds more than the windows of the delay."""
    day = datetime(2024, 1, 1)
    for d in range(40):
        write(spark, f"{folder}/in", [(100 * d + i, i, day + timedelta(days=d, hours=i), "Gym Visit", "Y") for i in range(10)])
    late = [(-1, 3, day, "Gym Visit", "Y"), (-2, 3, day + timedelta(days=39), "Gym Visit", "Y")]
    write(spark, f"{folder}/in", late)
    table = UpsertTable(spark, f"{folder}/out", ["window_start", "enrollment_id"], COUNTS, fold_after=7)
    q = T.upserted(T.running_counts(T.read_checkins(spark, f"{folder}/in", files_per_trigger=10), delay="2 days"), table, f"{folder}/cp")
    q.awaitTermination()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert state and state[-1] <= 4 * 10 and max(state) < 40 * 10
    got = {(r["window_start"], r["enrollment_id"]): r["qualifying_activity_count"] for r in table.read().collect()}
    assert len(got) == 400 and got[(day, 3)] == 1 and got[(day + timedelta(days=39), 3)] == 2     # the late one is out, the one in time is in


def test_a_batch_that_comes_again_changes_nothing(spark, folder):
    table = UpsertTable(spark, folder, ["k"], "k bigint, v bigint", fold_after=3)
    rows = lambda *r: spark.createDataFrame(list(r), "k bigint, v bigint")
    assert table.read().count() == 0
    assert table.upsert(rows((1, 1), (2, 1)), 0) and table.upsert(rows((2, 2), (None, 5)), 1)
    at = commits.position(spark, folder)
    assert not table.upsert(rows((1, 9)), 1) and not table.upsert(rows((1, 9)), 0)
    want = {(1, 1), (2, 2), (None, 5)}
    assert {tuple(r) for r in table.read().collect()} == want and commits.position(spark, folder) == at
    for i in range(2, 9):
        assert UpsertTable(spark, folder, ["k"], "k bigint, v bigint", fold_after=3).upsert(rows((i, i), (1, i)), i)
    assert {tuple(r) for r in table.read().collect()} == {(1, 8), (2, 2), (None, 5)} | {(i, i) for i in range(3, 9)}
    assert len(commits.entry(spark, folder, commits.position(spark, folder))["folders"]) <= 3
    assert {tuple(r) for r in table.read(at).collect()} == want
