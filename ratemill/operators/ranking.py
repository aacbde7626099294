"""Latest-row, as-of, monotonicity and rank statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.functions import money
from ratemill.operators.cumulative import null_safe_join, quantiles_of, rank_ties, tie_counts, value_ranks, with_ranges
from ratemill.session import broadcast_if_small, cut_lineage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``. An aggregate with map-side combine, so no key is gathered whole."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def version_segments(versions: DataFrame) -> DataFrame:
    """(at, rate_version_id): from each time on which a version begins or ends, the version in force until the next one; null where none is.

    Where versions overlap the highest id counts. A version covers a range of these times' numbers; the range is cut into blocks of powers of
    two, at most two a power, and a time meets the blocks that hold it by equality. So overlaps cost a logarithm, not a product. The
    version list is one row per published rate book, so one window numbers its times.
    """
    v = versions.select("rate_version_id", F.col("effective_date").cast("timestamp").alias("_from"), F.col("expiry_date").cast("timestamp").alias("_to"))
    v = v.where("_from is not null and (_to is null or _from < _to)")
    times = v.select(F.explode(F.array("_from", "_to")).alias("at")).where("at is not null").distinct()
    times = cut_lineage(times.withColumn("_no", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at")) - 1).cast("long")))
    powers = max(1, times.count()).bit_length()
    end = F.coalesce(F.col("_end_no"), F.lit(1 << powers).cast("long"))
    placed = v.join(times.select(F.col("at").alias("_from"), F.col("_no").alias("_first")), "_from").join(
        times.select(F.col("at").alias("_to"), F.col("_no").alias("_end_no")), "_to", "left").withColumn("_end", end)
    level = placed.withColumn("_power", F.explode(F.sequence(F.lit(0), F.lit(powers))))
    a, b = F.expr("shiftright(_first + shiftleft(1L, _power) - 1, _power)"), F.expr("shiftright(_end, _power)")
    ends = F.when(a < b, F.array(F.when(a % 2 == 1, a), F.when(b % 2 == 1, b - 1)))
    blocks = level.select("rate_version_id", "_power", F.explode(ends).alias("_block")).where("_block is not null")
    best = blocks.groupBy("_power", "_block").agg(F.max("rate_version_id").alias("rate_version_id"))
    asked = times.select("at", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(powers)), lambda p: F.call_function("shiftright", F.col("_no"), p))).alias("_power", "_block"))
    return asked.join(best, ["_power", "_block"], "left").groupBy("at").agg(F.max("rate_version_id").alias("rate_version_id"))


def as_of_version(df: DataFrame, on: str, versions: DataFrame, how: str = "left") -> DataFrame:
    """Version in force at a date or time: effective <= time < expiry, a null expiry being open; highest id on overlap.

    The distinct times of the facts and the times on which the version changes are merged in order within ranges: each time takes the last change
    before it in its range, or else the one that the small scan over ranges carries in. Facts then meet their time's version by equality. Nothing
    depends on how many days lie between.
    """
    at = F.col(on).cast("timestamp")
    facts = df.select(at.alias("at")).where("at is not null").distinct().withColumn("_change", F.lit(None).cast(f"struct<v: {versions.schema['rate_version_id'].dataType.simpleString()}>"))
    changes = version_segments(versions).select("at", F.struct(F.col("rate_version_id").alias("v")).alias("_change"))
    merged = with_ranges(cut_lineage(changes.unionByName(facts)), ["at"])
    last = F.max_by("_change", F.when(F.col("_change").isNotNull(), F.col("at")))
    w = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    ahead = merged.groupBy("_range").agg(last.alias("_l")).select("_range", F.last("_l", ignorenulls=True).over(w).alias("_ahead"))
    inner = Window.partitionBy("_range").orderBy("at", F.col("_change").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    run = merged.withColumn("_own", F.last("_change", ignorenulls=True).over(inner)).where("_change is null").join(ahead, "_range")
    picked = run.select(F.col("at").alias("_at"), F.coalesce("_own", "_ahead")["v"].alias("rate_version_id")).where("rate_version_id is not null")
    return df.join(broadcast_if_small(cut_lineage(picked)), at == F.col("_at"), how).drop("_at")


def version_chain(versions: DataFrame) -> DataFrame:
    """Each version closes when the next takes effect; the last one stays open and active.

    The version list is one row per published rate book, so one window over it is small.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("rate_version_id")
    nxt = F.lead("effective_date").over(w)
    return versions.withColumns({"expiry_date": nxt,
                                 "status": F.when(nxt.isNull(), "active").otherwise("superseded")})


def prior_quote(quotes: DataFrame, profile: Sequence[str]) -> DataFrame:
    """For each quote the last quote of the identical profile under a different version, with the change.

    Quotes shrink to the last one per (profile, version). The best one of another version is then the
    profile's overall last, or the last of the second version when the own version holds the overall last.
    """
    per_version = quotes.where(F.col("quoted_premium").isNotNull()).groupBy(*profile, "rate_version_id").agg(
        F.max("application_id").alias("last_id"), F.max_by("quoted_premium", "application_id").alias("last_premium"))
    w = Window.partitionBy(*profile).orderBy(F.col("last_id").desc())
    ranked = per_version.withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    def pick(i: int) -> Column:
        return F.max(F.when(F.col("_n") == i, F.struct("last_id", "last_premium", "rate_version_id")))
    best = ranked.groupBy(*profile).agg(pick(1).alias("_first"), pick(2).alias("_second"))
    j = quotes.join(best, list(profile), "left")
    p = F.when(F.col("_first.rate_version_id") == F.col("rate_version_id"), F.col("_second")).otherwise(F.col("_first"))
    j = j.withColumn("_p", p)
    diff = F.col("quoted_premium") - F.col("_p.last_premium")
    pct = (diff * 100 / F.nullif(F.col("_p.last_premium"), F.lit(0))).cast("decimal(12,4)")
    return j.withColumns({"prior_application_id": F.col("_p.last_id"), "prior_premium": F.col("_p.last_premium"),
                          "prior_version_id": F.col("_p.rate_version_id"), "premium_change": diff,
                          "premium_change_pct": pct}).drop("_first", "_second", "_p")


def effective_premium(contracts: DataFrame, renewals: DataFrame) -> DataFrame:
    """Premium of the latest renewal, else the issue premium."""
    last = renewals.groupBy("contract_id").agg(
        F.max_by("final_premium", F.struct("renewal_date", "renewal_id")).alias("last_final"),
        F.max("renewal_date").alias("last_renewal_date"))
    return contracts.join(last, "contract_id", "left").withColumn(
        "effective_premium", F.coalesce("last_final", "modal_premium")).drop("last_final")


def monotonic_violations(df: DataFrame, group: Sequence[str], order: Column, value: str) -> DataFrame:
    """Number of steps down along an ordered band axis, per group; the axis is a short list of bands."""
    w = Window.partitionBy(*group).orderBy(order)
    step = df.withColumn("_prev", F.lag(value).over(w))
    return step.groupBy(*group).agg(F.count_if(F.col(value) < F.col("_prev")).alias("violations"),
                                    (F.count_if(F.col(value) < F.col("_prev")) == 0).alias("non_decreasing"))


def score_counts(df: DataFrame, group: Sequence[str], label: str, score: str, weight: str | None = None) -> DataFrame:
    """Rows (ties) and positives (pos) per group and distinct score: all any metric below needs. A row counts ``weight`` times where that is named."""
    positive = F.col(label).cast("long")
    pos = F.sum(positive * F.col(weight)).cast("long") if weight else F.sum(positive)
    return tie_counts(df.where(F.col(label).isNotNull()), group, score, {"pos": pos}, weight)


def auc(df: DataFrame, group: Sequence[str], label: str, score: str) -> DataFrame:
    """Rank-sum AUC per group, ties at average rank; null when a group holds one class only.

    Scores are reduced to distinct values, ranked in buckets, then summed: exact and spread out.
    """
    return auc_of(score_counts(df, group, label, score), group, score)


def auc_of(counts: DataFrame, group: Sequence[str], score: str) -> DataFrame:
    g = rank_ties(counts, group, score).groupBy(*group).agg(
        F.sum("ties").alias("n_rows"), F.sum("pos").alias("positive_rows"), F.sum(F.col("avg_rank") * F.col("pos")).alias("_rs"))
    p, q = F.col("positive_rows").cast("double"), (F.col("n_rows") - F.col("positive_rows")).cast("double")
    return g.withColumn("auc", F.when((p > 0) & (q > 0), (F.col("_rs") - p * (p + 1) / 2) / (p * q))).drop("_rs")


def spearman(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Spearman correlation per group: average ranks of both columns, then Pearson on the ranks.

    Rows are first counted per (group, x, y); ranks come back by joins on (group, value).
    """
    full = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = full.groupBy(*group, x, y).agg(F.count(F.lit(1)).alias("_w"))
    rx = value_ranks(full, group, x).select(*group, x, F.col("avg_rank").alias("_rx"))
    ry = value_ranks(full, group, y).select(*group, y, F.col("avg_rank").alias("_ry"))
    j = null_safe_join(null_safe_join(pairs, rx, [*group, x]), ry, [*group, y])
    w = F.col("_w").cast("double")
    # ranks average (n+1)/2, so centred sums need no second pass
    n = full.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"))
    j = null_safe_join(j, n, group) if group else j.join(F.broadcast(n))
    mid = (F.col("n_rows") + 1) / F.lit(2.0)
    dx, dy = F.col("_rx") - mid, F.col("_ry") - mid
    s = j.groupBy(*group, "n_rows").agg(F.sum(w * dx * dy).alias("xy"), F.sum(w * dx * dx).alias("xx"),
                                        F.sum(w * dy * dy).alias("yy"))
    return s.select(*group, "n_rows", (F.col("xy") / F.nullif(F.sqrt(F.col("xx") * F.col("yy")), F.lit(0.0))).alias("spearman"))


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Calibration by quantile bins of the score: edges are interpolated quantiles, a value on an edge falls
    in the lower bin (the first bin includes its lower edge); empty bins are left out."""
    cells = score_counts(df, [], label, score)
    q = quantiles_of(rank_ties(cells, [], score), [], score, [i / bins for i in range(1, bins)])
    edges = q.agg(F.array_sort(F.collect_list("quantile")).alias("_e"))
    b = cells.join(F.broadcast(edges)).withColumn(
        "bin", F.size(F.filter("_e", lambda e: e < F.col(score).cast("double"))))
    return b.groupBy("bin").agg(F.sum("ties").alias("n_rows"), (F.sum("pos") / F.sum("ties")).alias("observed"),
                                (F.sum(F.col("ties") * F.col(score).cast("double")) / F.sum("ties")).alias("predicted"))


def cumulative_hits(counts: DataFrame, score: str) -> DataFrame:
    """Per distinct score: rows (flagged) and positives (tp) at or above it, and all positives."""
    r = rank_ties(counts, [], score, ["pos"])
    return r.select(score, "ties", "pos", (F.col("total") - F.col("cum") + F.col("ties")).alias("flagged"),
                    (F.col("total_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"), F.col("total_pos").alias("positives"))


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at every distinct score used as threshold (score >= threshold is positive)."""
    r = cumulative_hits(score_counts(df, [], label, score), score)
    return r.select(F.col(score).alias("threshold"), (F.col("tp") / F.col("flagged")).alias("precision"),
                    (F.col("tp") / F.nullif(F.col("positives"), F.lit(0))).alias("recall"))


def pr_auc_of(counts: DataFrame, score: str) -> DataFrame:
    """Area under the precision-recall curve by the trapezoid rule, from (recall 0, precision 1).

    Each point is paired with the point before it: the rows and hits before a score are its running
    totals less its own counts, so no window over all scores is needed.
    """
    before_flagged, before_tp = F.col("flagged") - F.col("ties"), F.col("tp") - F.col("pos")
    p0 = F.when(before_flagged > 0, before_tp / F.nullif(before_flagged, F.lit(0))).otherwise(F.lit(1.0))
    p1 = F.col("tp") / F.col("flagged")
    width = F.col("pos") / F.nullif(F.col("positives"), F.lit(0))
    return cumulative_hits(counts, score).agg(F.sum(width * (p0 + p1) / 2).alias("pr_auc"))


def anniversaries(contracts: DataFrame, as_of) -> DataFrame:
    """Every anniversary of a contract up to ``as_of`` and before its expiry; 29 Feb stays on 28 Feb."""
    first = money.anniversary("effective_date", 1)
    end = F.least(F.lit(as_of).cast("date"), F.coalesce(F.date_sub("expiry_date", 1), F.lit(as_of).cast("date")))
    dates = F.when(first <= end, F.sequence(first, end, F.expr("interval 1 year")))
    return contracts.withColumn("renewal_date", F.explode(dates))
