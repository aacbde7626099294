"""Set operations, vocabularies, coverage and seeded samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.session import broadcast_if_small, cut_lineage


def union_facts(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values of several columns as (variable, value), from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).where("value is not null").distinct()


def coverage_diff(observed: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only observed ('unexpected') and keys only expected ('missing'); empty means equal sets."""
    o, e = observed.select(*keys).distinct(), expected.select(*keys).distinct()
    return o.join(e, list(keys), "left_anti").withColumn("problem", F.lit("unexpected")).unionByName(
        e.join(o, list(keys), "left_anti").withColumn("problem", F.lit("missing")))


DIGITS = 4      # hex digits a round: 65,536 counts a group


def sample_hash(key: Sequence[str], seed: int) -> Column:
    """32 hex digits, md5 of the seed and the key's columns as text, joined by ``|``; a null column is empty."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]).cast("binary"))


def hash_cuts(df: DataFrame, group: Column, h: Column, *wanted: Callable[[Column], Column]) -> DataFrame:
    """(_g, _k, _cut): the hash up to which a group has as many rows as the k-th of ``wanted`` says of its size. Where none are, the row is
    left out.

    Rows are counted by the hash's first digits; the running count says in which of these a cut lies. Its rows are counted by twice the
    digits, and the rest, one in four billion, hash by hash. Only counts are shuffled. ``df`` is read three times, whatever the number of cuts.
    """
    rows = df.select(group.alias("_g"), h.alias("_h"))
    at = None
    for digits in (DIGITS, 2 * DIGITS, 32):
        prefix = F.substring("_h", 1, digits)
        part = rows if at is None else rows.join(broadcast_if_small(at), (rows["_g"] == at["_bg"]) & F.col("_h").startswith(at["_at"]))
        keys = ["_g"] if at is None else ["_g", "_k", "_left"]
        counts = part.groupBy(*keys, prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(*keys)
        upto = F.sum("_n").over(w.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
        runs = counts.withColumns({"_upto": upto, "_size": F.sum("_n").over(w)})
        if at is None:
            left = [F.least(want(F.col("_size")), F.col("_size")).cast("bigint") for want in wanted]
            runs = runs.select("*", F.posexplode(F.array(*left)).alias("_k", "_left"))
        runs = runs.where((F.col("_upto") - F.col("_n") < F.col("_left")) & (F.col("_left") <= F.col("_upto")))
        at = cut_lineage(runs.select(F.col("_g").alias("_bg"), "_k", F.col("_p").alias("_at"), (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left")))
    return at.select(F.col("_bg").alias("_g"), "_k", F.col("_at").alias("_cut"))


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int) -> DataFrame:
    """Exactly n rows (all, when there are fewer), uniform and independent of input order: those with the smallest seeded hash of the unique
    ``key``. The table itself is only filtered, by one hash; were keys repeated, rows alike would stay or go together."""
    h = sample_hash(key, seed)
    cut = hash_cuts(df, F.lit(0), h, lambda size: F.lit(n)).first()
    return df.where(h <= F.lit(cut["_cut"])) if cut else df.where(F.lit(False))


def stratified_split(df: DataFrame, label: str, key: Sequence[str], test_fraction: float = 0.2,
                     seed: int = 7) -> DataFrame:
    """Adds ``split`` = test / train with the exact rounded test share inside each label (null is one): the smallest hashes of the unique
    ``key``. Rows are not shuffled, they meet their label's cut."""
    group, h = F.struct(F.col(label)), sample_hash(key, seed)
    cuts = hash_cuts(df, group, h, lambda size: F.round(size * F.lit(test_fraction)))
    marked = df.withColumn("_g", group).join(broadcast_if_small(cuts), "_g", "left")
    return marked.withColumn("split", F.when(h <= F.col("_cut"), "test").otherwise("train")).drop("_g", "_k", "_cut")


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], folds: int = 5, seed: int = 7) -> DataFrame:
    """Adds ``fold``, 0 to folds - 1, of sizes that differ by one at most inside each label (null is one): ranges of the unique ``key``'s
    hashes. Rows are not shuffled, they meet their label's cuts; rows alike in ``key`` share a fold."""
    group, h = F.struct(F.col(label)), sample_hash(key, seed)
    found = hash_cuts(df, group, h, *[lambda size, k=k: F.floor(size * k / folds) for k in range(1, folds)])
    cuts = found.groupBy("_g").agg(F.collect_list("_cut").alias("_cuts"))      # folds - 1 a label
    marked = df.withColumn("_g", group).join(broadcast_if_small(cuts), "_g", "left").withColumn("_h", h)
    within = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<string>")), lambda c: F.col("_h") <= c))
    return marked.withColumn("fold", F.lit(folds - 1) - within).drop("_g", "_cuts", "_h")
