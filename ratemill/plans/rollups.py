"""A period rollup that follows its source: only periods that changed are counted and written again.

The table is a log of manifests (``sources.commits``). A manifest names, for each period, the batch folder that holds its rows and the
fingerprint of the source rows they were counted from: their number and three sums over parts of a 64-bit hash, which do not depend on order and
add up. A refresh compares these with the source, one aggregate, and rewrites the periods that differ; ``apply_changes`` does not
read the source at all, it adds and takes away counted rows and their fingerprints. A manifest has one line a period, so it is as long as
the calendar. Files are never changed: readers of an older number keep their state. Activity without a date belongs to no period.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.operators.aggregates import activity_period, period_rollup
from ratemill.sources import commits
from ratemill.sources.files import write_by_period

SUMS = ("n", "s0", "s1", "s2")


def _schema(activity: DataFrame, grain: str) -> str:
    period = "int" if grain == "year" else "date"
    return f"enrollment_id {activity.schema['enrollment_id'].dataType.simpleString()}, qualifying_activity_count bigint, batch string, activity_period {period}"


def _dated(activity: DataFrame) -> DataFrame:
    return activity.where("activity_date is not null")


def fingerprints(activity: DataFrame, grain: str) -> DataFrame:
    """(period, n, s0, s1, s2) of the verified rows of each period."""
    h = F.xxhash64("enrollment_id", F.col("activity_date").cast("timestamp"))
    parts = [F.sum(F.shiftrightunsigned(h, 21 * i).bitwiseAND(F.lit((1 << 21) - 1))).alias(f"s{i}") for i in range(3)]
    return _dated(activity).where(F.col("verified_flag") == "Y").groupBy(activity_period(grain).cast("string").alias("period")).agg(F.count(F.lit(1)).alias("n"), *parts)


def _sums(activity: DataFrame, grain: str) -> dict[str, list[int]]:
    return {r["period"]: [r[c] for c in SUMS] for r in fingerprints(activity, grain).collect()}    # a row a period


def _of_periods(df: DataFrame, period: Column, periods: list[str]) -> DataFrame:
    """Rows of these periods; the list is part of a manifest, so it is short."""
    wanted = df.sparkSession.createDataFrame([(p,) for p in periods], "_wanted string")
    return df.join(F.broadcast(wanted), period.cast("string") == F.col("_wanted"), "left_semi")


def read(spark: SparkSession, path: str, activity: DataFrame, grain: str, position: int | None = None, keep_batch: bool = False) -> DataFrame:
    """The rollup as of a log position, by default the last; period and batch are partition columns."""
    at = commits.position(spark, path) if position is None else position
    manifest = (commits.entry(spark, path, at) or {"periods": {}})["periods"]
    schema = _schema(activity, grain)
    if manifest:
        leaves = [f"{path}/data/batch={batch}/activity_period={period}" for period, (batch, *_) in sorted(manifest.items())]
        df = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*leaves)
    else:
        df = spark.createDataFrame([], schema)
    return df if keep_batch else df.drop("batch")


def refresh(activity: DataFrame, path: str, grain: str = "year", version: str = "") -> list[str]:
    """Brings the rollup up to date with its source and returns the periods that were written again or are gone.

    ``version`` is kept with the entry; a caller that knows its source's version can tell by it that nothing has to be compared.
    """
    spark, touched = activity.sparkSession, []

    def attempt(at: int, last: dict | None) -> dict | None:
        known, found = last["periods"] if last else {}, _sums(activity, grain)
        changed = sorted(p for p, sums in found.items() if p not in known or known[p][1:] != sums)
        touched[:] = sorted({*changed, *(p for p in known if p not in found)})
        if last and not touched and last["version"] == version:
            return None
        periods = {p: known[p] for p in found if p not in changed}
        if changed:
            batch = f"b{uuid.uuid4().hex}"
            rows = _of_periods(activity, activity_period(grain), changed)
            write_by_period(period_rollup(rows, grain), f"{path}/data/batch={batch}", "activity_period", ["enrollment_id"])
            periods |= {p: [batch, *found[p]] for p in changed}
        return {"version": version, "periods": periods}

    commits.committed(spark, path, attempt)
    return touched


def apply_changes(path: str, added: DataFrame, removed: DataFrame, grain: str = "year", version: str = "") -> list[str]:
    """Adds and takes away activity rows without reading the source; an edited row is taken away as it was and added as it is.

    The counts of the touched periods are merged with the changes. A count that would fall below zero raises: such a row was never there.
    """
    spark, touched = added.sparkSession, []

    def attempt(at: int, last: dict | None) -> dict | None:
        known = last["periods"] if last else {}
        plus, minus = _sums(added, grain), _sums(removed, grain)
        touched[:] = sorted({*plus, *minus})
        if not touched:
            return None
        change = period_rollup(_dated(added), grain).unionByName(period_rollup(_dated(removed), grain).withColumn("qualifying_activity_count", -F.col("qualifying_activity_count")))
        old = _of_periods(read(spark, path, added, grain, at), F.col("activity_period"), touched)
        n = F.sum("qualifying_activity_count")
        below = F.raise_error(F.lit("a removed row was never there")).cast("bigint")
        merged = old.unionByName(change).groupBy("enrollment_id", "activity_period").agg(F.when(n < 0, below).otherwise(n).alias("qualifying_activity_count"))
        batch = f"b{uuid.uuid4().hex}"
        write_by_period(merged.where("qualifying_activity_count > 0"), f"{path}/data/batch={batch}", "activity_period", ["enrollment_id"])
        periods = dict(known)
        for p in touched:
            sums = [o + a - r for o, a, r in zip(known.get(p, [None, 0, 0, 0, 0])[1:], plus.get(p, [0] * 4), minus.get(p, [0] * 4))]
            periods.pop(p, None)
            if sums[0]:
                periods[p] = [batch, *sums]
        return {"version": version, "periods": periods}

    commits.committed(spark, path, attempt)
    return touched
