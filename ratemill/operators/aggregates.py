"""Grouped facts. Every aggregate combines before its shuffle, so a hot group stays cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import recode as R
from ratemill.functions.money import exact_ratio
from ratemill.operators.cumulative import null_safe_join, numbered, quantiles
from ratemill.operators.filters import half_open
from ratemill.operators.sets import union_facts
from ratemill.session import spread


def verified_counts(activity: DataFrame, lo: date, hi: date, enrollment_id=None,
                    year_partition: str | None = None) -> DataFrame:
    """Verified activity per enrollment with lo <= date < hi, for one enrollment or all."""
    rows = half_open(activity, "activity_date", lo, hi, year_partition).where(F.col("verified_flag") == "Y")
    if enrollment_id is not None:
        rows = rows.where(F.col("enrollment_id") == enrollment_id)
    return rows.groupBy("enrollment_id").agg(F.count(F.lit(1)).alias("qualifying_activity_count"))


def _rows(weight: str | None, cond: Column | None = None) -> Column:
    """Number of rows (meeting a condition); on a table of counts the sum of its count column."""
    if weight is None:
        return F.count(F.lit(1)) if cond is None else F.count_if(cond)
    return F.sum(weight) if cond is None else F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0))


def profile_counts(df: DataFrame, cols: Sequence[str] = (*fixed.PROFILE, "diabetes_status")) -> DataFrame:
    """Rows per combination of coded columns, nulls kept: a few thousand rows whatever the input size.

    Prevalence, shares, summaries and sparsity all take this table with ``weight="n"``, so the records are
    scanned and shuffled once for all of them.
    """
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def prevalence(df: DataFrame, keys: Sequence[str], col: str = "diabetes_status", yes: str = "yes",
               in_set: Sequence[str] = tuple(fixed.OUTCOMES_IN_SET), weight: str | None = None) -> DataFrame:
    """Share of ``yes`` among the rows whose outcome is in the set; groups without such rows give null."""
    hit, base = _rows(weight, F.col(col) == yes), _rows(weight, F.col(col).isin(*in_set))
    present = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    return df.where(present).groupBy(*keys).agg(hit.alias("yes_rows"), base.alias("base_rows"),
                                                (hit / F.nullif(base, F.lit(0))).alias("prevalence"))


def conditional_prevalence(df: DataFrame, profile: Sequence[str], outcome: str = "diabetes_status",
                           weight: str | None = None) -> DataFrame:
    """P(outcome | profile) with four digits from one scan.

    Rows are counted per (profile, outcome) first; the profile total is a window over those few counts.
    """
    cells = df.dropna(subset=[*profile, outcome]).groupBy(*profile, outcome).agg(_rows(weight).alias("outcome_rows"))
    total = F.sum("outcome_rows").over(Window.partitionBy(*profile))
    rate = (F.col("outcome_rows").cast("decimal(18,8)") / total.cast("decimal(19,0)")).cast("decimal(6,4)")
    return cells.withColumns({"profile_rows": total, "prevalence_rate": rate})


def marginal_shares(df: DataFrame, col: str, vocab: Sequence[str], check: bool = True, weight: str | None = None) -> DataFrame:
    """Share of each vocabulary level; fails when the levels found are not exactly the vocabulary."""
    counts = df.where(F.col(col).isin(*vocab)).groupBy(col).agg(_rows(weight).alias("n"))
    out = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
    if check:
        found = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
        out = out.withColumn("share", F.when(found == len(vocab), F.col("share")).otherwise(
            F.raise_error(F.lit(f"{col} does not hold exactly {list(vocab)}")).cast("double")))
    return out


def weighted_means(df: DataFrame, keys: Sequence[str], weight: str, cols: Mapping[str, str]) -> DataFrame:
    """Weighted mean per group; ``cols`` maps a column to its result decimal type."""
    w = F.col(weight).cast("decimal(18,0)")
    means = [exact_ratio(F.sum(w * F.col(c)), F.sum(w), dtype).alias(c) for c, dtype in cols.items()]
    return df.groupBy(*keys).agg(F.sum(w).cast("long").alias(weight), *means)


def marginalise(df: DataFrame, keys: Sequence[str], level: str, prob: str, weights: DataFrame) -> DataFrame:
    """Probability per key after weighting out ``level``; every key must hold every level."""
    w = weights.select(level, "share")
    n = w.agg(F.count(F.lit(1)).alias("_levels"))
    joined = df.join(F.broadcast(w), level)
    summed = joined.groupBy(*keys).agg(F.sum(F.col(prob) * F.col("share")).alias(prob),
                                       F.count(F.lit(1)).alias("_found")).join(F.broadcast(n))
    fail = F.raise_error(F.lit(f"a profile lacks a level of {level}")).cast("double")
    return summed.withColumn(prob, F.when(F.col("_found") == F.col("_levels"), F.col(prob)).otherwise(fail)).drop(
        "_found", "_levels")


def mean_prevalence(summary: DataFrame, outcome: str = "yes", weighted: bool = False) -> DataFrame:
    """Mean conditional prevalence by band and gender over profiles that have an outcome row.

    ``weighted=True`` weights by profile rows and so also counts profiles without the outcome.
    """
    if weighted:
        per_profile = summary.groupBy(*fixed.PROFILE).agg(
            F.max("profile_rows").alias("n"),
            F.coalesce(F.sum(F.when(F.col("diabetes_status") == outcome, F.col("outcome_rows"))), F.lit(0)).alias("y"))
        rate = exact_ratio(F.sum("y"), F.sum("n"), "decimal(6,4)", 0)
        out = per_profile.groupBy("age_band", "gender").agg(rate.alias("mean_prevalence"))
    else:
        rows = summary.where((F.col("diabetes_status") == outcome) & F.col("prevalence_rate").isNotNull())
        out = rows.groupBy("age_band", "gender").agg(
            F.avg("prevalence_rate").cast("decimal(6,4)").alias("mean_prevalence"))
    return out.orderBy(R.ordinal("age_band", fixed.AGE_LABELS), "gender")


def participation(rollup: DataFrame, enrollments: DataFrame, period: str = "activity_period") -> DataFrame:
    """Per period: enrollments taking part, activities, and the number of all enrollments."""
    per = rollup.groupBy(period).agg(F.count_distinct("enrollment_id").alias("participating"),
                                     F.sum("qualifying_activity_count").alias("activities"))
    return with_total(per, enrollments, "total_enrollments")


def with_total(df: DataFrame, other: DataFrame, out: str) -> DataFrame:
    """Each row beside the row count of another table (one-row side)."""
    return df.join(F.broadcast(other.agg(F.count(F.lit(1)).alias(out))))


def wellness_credit(improvements: DataFrame, requests: DataFrame, cap=fixed.CREDIT_CAP, scale: int = 2,
                    enrollments: DataFrame | None = None) -> DataFrame:
    """Credit percent for every requested (enrollment_id, renewal_date).

    The mean of positive improvement percents measured strictly before the renewal date, rounded to
    ``scale`` digits and capped; 0 without any. With ``enrollments`` only measures from the enroll date on
    count. Improvements and requests shrink to one row per enrollment and day, so the running sums of an
    enrollment never hold more rows than there are days. Both are counted first and dealt to as many tasks as that takes.
    """
    good = improvements.where(F.col("improvement_pct") > 0)
    rows = good.count()
    if enrollments is not None:
        good = spread(good, rows, "enrollment_id", "measure_date").groupBy("enrollment_id", "measure_date").agg(
            F.sum("improvement_pct").alias("improvement_pct"), F.count(F.lit(1)).alias("n"))
        good = spread(good, rows, "enrollment_id").join(spread(enrollments.select("enrollment_id", "enroll_date"), rows, "enrollment_id"), "enrollment_id").where(
            F.col("measure_date") >= F.col("enroll_date"))
    else:
        good = spread(good, rows, "enrollment_id", "measure_date").withColumn("n", F.lit(1))
    zero = F.lit(0).cast("decimal(20,2)")
    daily = good.groupBy("enrollment_id", F.col("measure_date").alias("day")).agg(
        F.sum("improvement_pct").cast("decimal(20,2)").alias("total"), F.sum("n").alias("n")
    ).withColumn("asked", F.lit(False))
    marks = requests.select("enrollment_id", F.col("renewal_date").alias("day")).where(
        "enrollment_id is not null and day is not null")
    asked = marks.count()
    marks = spread(marks, asked, "enrollment_id", "day").distinct().select(
        "enrollment_id", "day", zero.alias("total"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("asked"))
    # On one day the request sorts before the measures, which makes the comparison strict.
    upto = Window.partitionBy("enrollment_id").orderBy("day", F.when(F.col("asked"), 0).otherwise(1)).rowsBetween(
        Window.unboundedPreceding, 0)
    run = spread(daily.unionByName(marks), rows + asked, "enrollment_id").select("enrollment_id", "day", "asked", F.sum("total").over(upto).alias("total"),
                                          F.sum("n").over(upto).alias("n")).where("asked")
    mean = (F.col("total") / F.nullif(F.col("n"), F.lit(0)).cast("decimal(19,0)")).cast(f"decimal(20,{scale})")
    credit = F.least(F.coalesce(mean, F.lit(0).cast(f"decimal(20,{scale})")), F.lit(cap)).cast(f"decimal({scale + 3},{scale})")
    return run.select("enrollment_id", F.col("day").alias("renewal_date"), credit.alias("credit_pct"))


def activity_period(grain: str = "year") -> Column:
    """The period of an activity: year number, or the start date of day/week/month."""
    if grain == "year":
        return F.year("activity_date")
    return F.trunc("activity_date", grain) if grain != "day" else F.col("activity_date").cast("date")


def period_rollup(activity: DataFrame, grain: str = "year") -> DataFrame:
    """Verified activity per enrollment and period."""
    return activity.where(F.col("verified_flag") == "Y").groupBy(
        "enrollment_id", activity_period(grain).alias("activity_period")).agg(
        F.count(F.lit(1)).alias("qualifying_activity_count"))


def period_total(rollup: DataFrame, enrollments: DataFrame, period) -> DataFrame:
    """Activity of one period for every enrollment, 0 when it has none."""
    rows = rollup.where(F.col("activity_period") == F.lit(period)).groupBy("enrollment_id").agg(
        F.sum("qualifying_activity_count").alias("n"))
    return enrollments.select("enrollment_id").join(rows, "enrollment_id", "left").select(
        "enrollment_id", F.coalesce("n", F.lit(0)).alias("qualifying_activity_count"))


def range_from_rollup(activity: DataFrame, rollup: DataFrame, lo: date, hi: date,
                      year_partition: str | None = None) -> DataFrame:
    """Counts per enrollment for a range: from the annual rollup when the range is whole years."""
    whole = (lo.month, lo.day, hi.month, hi.day) == (1, 1, 1, 1)
    if not whole:
        return verified_counts(activity, lo, hi, year_partition=year_partition)
    return rollup.where(F.col("activity_period").between(lo.year, hi.year - 1)).groupBy("enrollment_id").agg(
        F.sum("qualifying_activity_count").alias("qualifying_activity_count"))


def reachability(df: DataFrame, key: str, target: str) -> DataFrame:
    """How many keys reach exactly one, no, or several distinct targets."""
    n = df.groupBy(key).agg(F.count_distinct(target).alias("n"))
    return n.agg(F.count_if(F.col("n") == 1).alias("exactly_one"), F.count_if(F.col("n") == 0).alias("none"),
                 F.count_if(F.col("n") > 1).alias("several"))


def order_violation(df: DataFrame, earlier: str, later: str) -> DataFrame:
    bad, n = F.count_if(F.col(later) < F.col(earlier)), F.count(F.lit(1))
    return df.agg(n.alias("rows"), bad.alias("violations"),
                  exact_ratio(bad * 100, n, "decimal(8,4)", 0).alias("pct"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_facts(*[d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
                         for name, d in tables.items()])


def date_profile(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Min and max of each date column, long form, from one pass."""
    facts = df.agg(*[F.struct(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(f"{table}.{c}").alias("date_column"), F.col(f"{c}.lo").alias("min_date"),
                              F.col(f"{c}.hi").alias("max_date")) for c in cols])
    return facts.select(F.inline(rows))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("distinct_keys"), F.min(key).alias("min_key"),
                  F.max(key).alias("max_key"), F.count(F.lit(1)).alias("rows"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value of each column, null included, long form from one scan."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                        for c in cols])))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of values, null included."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def agreement(df: DataFrame, a: str, b: str, valid: Sequence) -> DataFrame:
    both = F.col(a).isin(*valid) & F.col(b).isin(*valid)
    return df.agg(F.count_if(both).alias("valid_rows"), F.count_if(both & (F.col(a) != F.col(b))).alias("off_diagonal"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max per column, exact. Moments of all columns take one pass."""
    base = df.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("sd"),
                             F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(f"s{i}") for i, c in enumerate(cols)])
    base = base.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))
    quarts = union_facts(*[quantiles(df, [], c, [0.25, 0.5, 0.75]).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))]
    ).select(F.lit(c).alias("column_name"), "*") for c in cols])
    return base.join(F.broadcast(quarts), "column_name")


def dist_summary(df: DataFrame, col: str) -> DataFrame:
    """min, median, p90, max, number of zeros and the median of the non-zero values."""
    base = df.agg(F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"),
                  F.count_if(F.col(col) == 0).alias("zeros"))
    q = quantiles(df, [], col, [0.5, 0.9]).agg(
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.9, F.col("quantile"))).alias("p90"))
    nz = quantiles(df.where(F.col(col) != 0), [], col, [0.5]).agg(F.max("quantile").alias("nonzero_median"))
    return base.join(F.broadcast(q)).join(F.broadcast(nz))


def sparsity(df: DataFrame, keys: Sequence[str], grid_size: int, small: int = 30, weight: str | None = None) -> DataFrame:
    """Profile of cell sizes: cells are counted per key, so the rest works on at most ``grid_size`` rows."""
    cells = df.dropna(subset=list(keys)).groupBy(*keys).agg(_rows(weight).alias("n"))
    p = F.percentile("n", F.array(*[F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    facts = cells.agg(F.count(F.lit(1)).alias("cells"), F.min("n").alias("min_n"), p.alias("p"), F.max("n").alias("max_n"),
                      F.count_if(F.col("n") < small).alias("small_cells"), F.count_if(F.col("n") == 1).alias("singletons"))
    return facts.select("cells", (F.lit(grid_size) - F.col("cells")).alias("empty_cells"), "min_n",
                        *[F.col("p")[i].alias(n) for i, n in enumerate(("p10", "p25", "median", "p75", "p90"))],
                        "max_n", "small_cells", "singletons", (F.col("small_cells") / F.col("cells")).alias("small_share"))


def group_modes(df: DataFrame, key: str, cat_cols: Sequence[str], mean_cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Most frequent value per column (smallest on ties), means, size and share of all rows per group.

    Values are counted per (group, column, value) before the mode is picked. On a table of counts ``weight``
    names the count column.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    df = df.withColumn("_w", w)
    long = df.select(key, "_w", F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                                   for c in cat_cols]))).where("v is not null")
    counts = long.groupBy(key, "c", "v").agg(F.sum("_w").alias("n"))
    best = counts.groupBy(key, "c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
    modes = best.groupBy(key).agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).alias(f"mode_{c}") for c in cat_cols])
    def mean(c: str) -> Column:
        if weight is None:
            return F.avg(c)
        return F.sum(F.col("_w") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("_w")))
    stats = df.groupBy(key).agg(F.sum("_w").cast("long").alias("size"), *[mean(c).alias(f"mean_{c}") for c in mean_cols])
    total = df.agg(F.sum("_w").alias("_all"))
    return stats.join(modes, key).join(F.broadcast(total)).withColumn(
        "size_percent", F.col("size") * 100.0 / F.col("_all")).drop("_all")


def representatives(df: DataFrame, band: str, value: str) -> DataFrame:
    return df.where(F.col(band).isNotNull() & F.col(value).isNotNull()).groupBy(band).agg(
        F.avg(F.col(value)).cast("double").alias(f"representative_{value}"))


def cohort_compare(df: DataFrame, keys: Sequence[str], cohort: str, value: str, newer, older) -> DataFrame:
    """Differences newer - older over keys present in both: mean and max size, signs, and where the max is."""
    wide = df.where(F.col(cohort).isin(newer, older)).groupBy(*keys).agg(
        F.max(F.when(F.col(cohort) == newer, F.col(value))).alias("a"),
        F.max(F.when(F.col(cohort) == older, F.col(value))).alias("b")).where("a is not null and b is not null")
    d = F.col("a") - F.col("b")
    # the largest difference, first key on ties
    top = F.min_by(F.concat_ws("|", *keys), F.struct(-F.abs(d), *[F.col(k) for k in keys]))
    return wide.agg(F.avg(F.abs(d)).alias("mean_abs_diff"), F.max(F.abs(d)).alias("max_abs_diff"),
                    F.count_if(d > 0).alias("higher"), F.count_if(d < 0).alias("lower"),
                    F.count_if(d == 0).alias("equal"), top.alias("max_at"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicated keys, rows they hold, and the most repeated key (smallest on ties)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    worst = F.min_by(F.concat_ws("|", *keys), F.struct(-F.col("n"), *[F.col(k) for k in keys]))
    return counts.agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
                      F.max("n").alias("worst_count"), worst.alias("worst_key"))


def one_more_case(cells: DataFrame, yes: str = "yes_rows", n: str = "base_rows") -> DataFrame:
    """Change of a cell's rate, in percentage points, had it one more positive row."""
    delta = (F.col(yes) + 1) / (F.col(n) + 1) - F.col(yes) / F.nullif(F.col(n), F.lit(0))
    return cells.withColumn("pp_change", delta * 100)


def next_ids(df: DataFrame, existing: DataFrame, out: str, order: str) -> DataFrame:
    """New rows numbered in order of ``order`` after the highest existing id."""
    top = existing.agg(F.coalesce(F.max(out), F.lit(0)).cast("long").alias("_top"))
    run = numbered(df, order, "_seq").join(F.broadcast(top))
    return run.withColumn(out, F.col("_top") + F.col("_seq")).drop("_top", "_seq")


def tiles(versions: DataFrame, runs: DataFrame, rollup: DataFrame) -> DataFrame:
    """Dashboard tiles: versions, successful runs, verified activities."""
    v = versions.agg(F.count(F.lit(1)).alias("versions"))
    r = runs.agg(F.count_if(R.same_text("status", F.lit("success"))).alias("successful_runs"))
    a = rollup.agg(F.coalesce(F.sum("qualifying_activity_count"), F.lit(0)).alias("verified_activities"))
    return v.join(F.broadcast(r)).join(F.broadcast(a))


def distribution_diff(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts and shares of two populations over the same categorical columns, with the share difference."""
    def side(d: DataFrame, n: str) -> DataFrame:
        counts = value_counts(d, cols).withColumnRenamed("n", n)
        totals = counts.groupBy("column_name").agg(F.sum(n).alias("_all"))  # one row per compared column
        return counts.join(F.broadcast(totals), "column_name").withColumn(f"share_{n}", F.col(n) / F.col("_all")).drop("_all")
    l, r = side(a, "a"), side(b, "b").select(F.col("column_name").alias("cb"), F.col("value").alias("vb"), "b", "share_b")
    j = l.join(r, (F.col("column_name") == F.col("cb")) & F.col("value").eqNullSafe(F.col("vb")), "full")
    zero = F.lit(0.0)
    return j.select(F.coalesce("column_name", "cb").alias("column_name"), F.coalesce("value", "vb").alias("value"),
                    F.coalesce("a", F.lit(0)).alias("rows_a"), F.coalesce("b", F.lit(0)).alias("rows_b"),
                    (F.coalesce("share_a", zero) - F.coalesce("share_b", zero)).alias("share_diff"))


def share_of(df: DataFrame, group: Sequence[str], level: str) -> DataFrame:
    """Share of each level within its group; rows are counted first and group totals joined back, so that a
    group with very many levels is not held in one window."""
    counts = df.groupBy(*group, level).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_all"))
    return null_safe_join(counts, totals, group).withColumn("share", F.col("n") / F.col("_all")).drop("_all")
