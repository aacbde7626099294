"""Exact ranks, prefix sums and order statistics without one task holding a whole group.

Rows are dealt to ranges of (group, value), cut where a sample says, as many as their number takes: a large group spans many ranges, small
ones share one. Sums per range are few, so their running total is a small window; the ordered window itself runs inside
one range at a time, which is the only time rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.session import broadcast_if_small, cut_lineage

RANGE_ROWS = 200_000     # rows of a range, about
SAMPLES = 32             # sampled rows a range


def with_ranges(df: DataFrame, order: Sequence[str], out: str = "_range", range_rows: int | None = None) -> DataFrame:
    """Adds the number of the row's range in ``order``; it never decreases with the order and rows alike in it share a range.

    ``df`` is read three times, so it should be a table. The cuts are taken from sorted samples, ``SAMPLES`` a range, in one task, and kept;
    each row finds its range by halving, one projection a step.
    """
    n = df.count()
    ranges = -(-n // (range_rows or RANGE_ROWS))
    if ranges <= 1:
        return df.withColumn(out, F.lit(0))
    key = F.struct(*[F.col(c) for c in order])
    sampled = df.sample(min(1.0, 1.25 * ranges * SAMPLES / n), 17).agg(F.array_sort(F.collect_list(key)).alias("_s"))
    every = F.size("_s") / F.lit(float(ranges))
    cuts = F.filter(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("_s", F.floor(i * every).cast("int"))), lambda c: c.isNotNull())
    out_df = df.crossJoin(F.broadcast(cut_lineage(sampled.select(cuts.alias("_cuts"))))).withColumn(out, F.lit(0))      # one row
    for step in (1 << i for i in reversed(range((ranges - 1).bit_length()))):
        beyond = F.get("_cuts", F.col(out) + (step - 1)) < key
        out_df = out_df.withColumn(out, F.when(beyond, F.col(out) + step).otherwise(F.col(out)))
    return out_df.drop("_cuts")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; keeps the left key columns."""
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_running_totals(df: DataFrame, groups: Sequence[str], range_: str, order: Sequence[Column],
                        amounts: Mapping[str, Column], totals: Mapping[str, str] | None = None) -> DataFrame:
    """Inclusive running sums in order, per group; the order must be total inside a range, and ranges rise with it.

    ``amounts`` maps an output column to what it sums; ``totals`` maps such a column to the name of its group total. A group is
    compared as a struct, in which nulls are alike, so windows and the join of the ranges' sums share one partitioning.
    """
    totals = totals or {}
    group = F.struct(*[F.col(g) for g in groups]) if groups else F.lit(0)
    df = df.withColumns({"_g": group, **{f"_a_{k}": c for k, c in amounts.items()}})
    sums = df.groupBy(range_, "_g").agg(*[F.sum(f"_a_{k}").alias(f"_p_{k}") for k in amounts])
    w = Window.partitionBy("_g")
    before = w.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(range_, "_g",
                          *[F.coalesce(F.sum(f"_p_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in amounts],
                          *[F.sum(f"_p_{k}").over(w).alias(name) for k, name in totals.items()])
    inner = Window.partitionBy(range_, "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = df.withColumns({f"_i_{k}": F.sum(f"_a_{k}").over(inner) for k in amounts})
    joined = ranked.join(offsets if groups else F.broadcast(offsets), [range_, "_g"]).withColumns({k: F.col(f"_i_{k}") + F.col(f"_o_{k}") for k in amounts})
    return joined.drop("_g", *[f"_{x}_{k}" for k in amounts for x in "aio"])


def tie_counts(df: DataFrame, groups: Sequence[str], value: str, extra: Mapping[str, Column] | None = None, weight: str | None = None) -> DataFrame:
    """One row per (group, distinct value) with ``ties`` rows and extra sums; a row counts ``weight`` times where that is named.

    It is kept as a table: cuts, sums of ranges and ranks all read it, and the input is aggregated once.
    """
    return cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        (F.sum(weight).cast("long") if weight else F.count(F.lit(1))).alias("ties"), *[c.alias(name) for name, c in (extra or {}).items()]))


def rank_ties(counts: DataFrame, groups: Sequence[str], value: str, extra: Sequence[str] = ()) -> DataFrame:
    """tie_counts with cum (rows up to and with the value), total, avg_rank, and cum_/total_ of the extra sums."""
    ranged = with_ranges(counts, [*groups, value])
    amounts = {"cum": F.col("ties"), **{f"cum_{e}": F.col(e) for e in extra}}
    run = with_running_totals(ranged, groups, "_range", [F.col(value)], amounts,
                              {"cum": "total", **{f"cum_{e}": f"total_{e}" for e in extra}})
    return run.withColumn("avg_rank", F.col("cum") - (F.col("ties") - 1) / F.lit(2.0)).drop("_range")


def value_ranks(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    return rank_ties(tie_counts(df, groups, value), groups, value)


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group in long form: (groups, prob, quantile)."""
    return quantiles_of(value_ranks(df, groups, value), groups, value, probs)


def quantiles_of(ranks: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    r = ranks.select(*groups, F.col(value).cast("double").alias("_v"), "ties", "cum", "total", wanted)
    r = r.withColumn("_pos", (F.col("total") - 1) * F.col("prob"))
    lo, hi, start = F.floor("_pos"), F.ceil("_pos"), F.col("cum") - F.col("ties")
    r = r.where(((lo >= start) & (lo < F.col("cum"))) | ((hi >= start) & (hi < F.col("cum"))))
    at = r.groupBy(*groups, "prob", "_pos").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    return at.select(*groups, "prob", (F.col("_lo") + step).alias("quantile"))


def numbered(df: DataFrame, key: str, out: str, ties: Sequence[str] = (), start: int = 1) -> DataFrame:
    """1..N in order of ``key`` (then ``ties``).

    Rows are dealt to ranges of key and ties together, so the rows of one key are spread as far as its ties tell them apart, and
    numbered where they are; that is the only time they are shuffled. Kept as a table, the numbers stay as they are when tasks
    run again. Only the sizes of the ranges are summed up in order.
    """
    order = [F.col(key), *[F.col(t) for t in ties]]
    place = F.monotonically_increasing_id()          # range in the upper bits, row in the lower 33
    rows = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    rows = rows.withColumns({"_range": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    ahead = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    run = rows.join(broadcast_if_small(ahead), "_range")
    return run.withColumn(out, (F.col("_ahead") + F.col("_row") + start).cast("long")).drop("_place", "_range", "_row", "_ahead")


def hash_rank(df: DataFrame, groups: Sequence[str], key: Sequence[str], seed: int, out: str,
              total: str | None = None) -> DataFrame:
    """Rank 1..n of every row of a group in a seeded, input-order-free pseudo-random order. Ranges are leading bits of the hash, as many as
    the rows take."""
    bits = max(1, -(-df.count() // RANGE_ROWS)).bit_length() - 1
    h = df.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(k) for k in key]))
    h = h.withColumn("_hb", F.shiftright(F.col("_h"), 64 - bits) if bits else F.lit(0))
    run = with_running_totals(h, groups, "_hb", [F.col("_h"), *[F.col(k) for k in key]], {out: F.lit(1)},
                              {out: total} if total else {})
    return run.drop("_h", "_hb")
