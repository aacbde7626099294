"""The commit log, rollups that follow their source, publications of several writers."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_pricing import small_book

from ratemill.operators.aggregates import period_rollup
from ratemill.plans import publish, rollups
from ratemill.sources import commits

ACT = "enrollment_id long, activity_date date, verified_flag string"


def test_one_writer_gets_a_number(spark, folder):
    assert commits.position(spark, folder) == 0 and commits.entry(spark, folder, 0) is None
    commits.commit(spark, folder, 1, {"a": 1})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, folder, 1, {"a": 2})
    assert commits.entry(spark, folder, 1) == {"number": 1, "a": 1}
    seen = []

    def attempt(at, last):
        seen.append(at)
        if len(seen) == 1:
            commits.commit(spark, folder, at + 1, {"a": "other"})      # someone else is quicker
        return {"a": "mine"}

    assert commits.committed(spark, folder, attempt) == 3 and seen == [1, 2]
    assert [r["a"] for r in commits.entries(spark, folder, "a string").orderBy("number").collect()] == ["1", "other", "mine"]
    assert commits.entries(spark, folder, "a string", 2).count() == 2
    assert not [f for f in os.listdir(f"{folder}/log") if f.endswith(".tmp")]


def activity(spark, rows):
    return spark.createDataFrame(rows, ACT)


BASE = [(1, date(2020, 3, 1), "Y"), (1, date(2020, 4, 1), "Y"), (2, date(2020, 5, 1), "N"), (2, date(2021, 1, 1), "Y"), (3, date(2022, 12, 31), "Y"), (None, date(2022, 1, 1), "Y"), (4, None, "Y")]


def content(df):
    return sorted(map(str, (tuple(r) for r in df.select("enrollment_id", "activity_period", "qualifying_activity_count").collect())))


def files(folder):
    last = json.load(open(max(f"{folder}/log/{f}" for f in os.listdir(f"{folder}/log") if f.endswith(".json"))))
    return {p: sorted(f for f in os.listdir(f"{folder}/data/batch={b}/activity_period={p}") if f.endswith(".parquet")) for p, (b, *_) in last["periods"].items()}


@pytest.mark.parametrize("grain", ["year", "month", "day"])
def test_refresh_follows_the_source(spark, folder, grain):
    changed = [*BASE[1:3], (2, date(2021, 1, 1), "Y"), (2, date(2021, 1, 1), "Y"), *BASE[4:], (9, date(2023, 6, 6), "Y")]
    was, now = activity(spark, BASE), activity(spark, changed)
    assert len(rollups.refresh(was, folder, grain)) == {"year": 3, "month": 5, "day": 5}[grain]
    assert rollups.refresh(was.repartition(3), folder, grain) == [] and commits.position(spark, folder) == 1
    before = files(folder)
    touched = rollups.refresh(now, folder, grain)
    after = files(folder)
    assert content(rollups.read(spark, folder, now, grain)) == content(period_rollup(now.where("activity_date is not null"), grain))
    assert content(rollups.read(spark, folder, now, grain, 1)) == content(period_rollup(was.where("activity_date is not null"), grain))
    assert touched and all(before[p] == after[p] for p in after if p not in touched) and all(after.get(p) != before.get(p) for p in touched)


def test_changes_alone_give_the_same(spark, folder):
    was = activity(spark, BASE)
    rollups.refresh(was, folder)
    before = files(folder)
    added = activity(spark, [(5, date(2021, 2, 2), "Y"), (3, date(2030, 1, 1), "Y"), (6, date(2020, 1, 1), "N"), (None, None, "Y")])
    removed = activity(spark, [(2, date(2021, 1, 1), "Y"), (3, date(2022, 12, 31), "Y")])
    assert rollups.apply_changes(folder, added, removed) == ["2021", "2022", "2030"]
    now = activity(spark, [r for r in BASE if r[:2] not in ((2, date(2021, 1, 1)), (3, date(2022, 12, 31)))]).unionByName(added)
    assert content(rollups.read(spark, folder, now, "year")) == content(period_rollup(now.where("activity_date is not null"), "year"))
    assert files(folder)["2020"] == before["2020"]
    assert rollups.refresh(now, folder) == []           # the fingerprints followed too
    with pytest.raises(Exception, match="never there"):
        rollups.apply_changes(folder, activity(spark, []), activity(spark, [(77, date(2020, 1, 1), "Y")]))
    assert rollups.apply_changes(folder, activity(spark, []), activity(spark, [])) == []


def test_writers_of_one_rollup(spark, folder):
    """A second writer commits between the first one's look and its commit; both changes are there."""
    rollups.refresh(activity(spark, BASE), folder)
    real, calls = commits.commit, []

    def slow(spark_, root, number, entry):
        if not calls:
            calls.append(number)
            commits.commit = real
            rollups.apply_changes(folder, activity(spark, [(8, date(2020, 1, 1), "Y")]), activity(spark, []))
        return real(spark_, root, number, entry)

    commits.commit = slow
    try:
        rollups.apply_changes(folder, activity(spark, [(9, date(2020, 1, 1), "Y")]), activity(spark, []))
    finally:
        commits.commit = real
    got = rollups.read(spark, folder, activity(spark, BASE), "year").where("activity_period = 2020")
    assert {r["enrollment_id"] for r in got.collect()} == {1, 8, 9} and commits.position(spark, folder) == 3


def test_empty_source(spark, folder):
    assert rollups.refresh(activity(spark, []), folder) == []
    assert rollups.read(spark, folder, activity(spark, []), "year").count() == 0


def test_two_publications_from_one_state(spark, folder):
    size = dict(n_factors=4, n_rates=8)
    publish.publish(spark, folder, small_book(spark, "1.00"), date(2024, 1, 1), first=True, **size)
    a = publish.prepare(spark, folder, small_book(spark, "2.00"), date(2024, 2, 1), **size)
    b = publish.prepare(spark, folder, small_book(spark, "3.00"), date(2024, 3, 1), **size)
    at = publish.position(spark, folder)
    assert publish.commit(spark, b) == {"run_id": 2, "rate_version_id": 2}
    assert publish.commit(spark, a) == {"run_id": 3, "rate_version_id": 3}
    rates = publish.rates(spark, folder).groupBy("rate_version_id").agg(F.max("base_rate").alias("r"), F.countDistinct("risk_factor_id").alias("f")).collect()
    assert sorted((r[0], float(r[1]), r[2]) for r in rates) == [(1, 1.0, 4), (2, 3.0, 4), (3, 2.0, 4)]
    ids = publish.factors(spark, folder)
    assert ids.count() == ids.select("risk_factor_id").distinct().count() == 12
    assert publish.versions(spark, folder, at).count() == 1 and publish.rates(spark, folder, at).count() == 8
    assert publish.rates(spark, folder).join(ids, "risk_factor_id").count() == 24
