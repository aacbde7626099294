"""Depth of a decision tree from class counts.

Records shrink to weighted profiles of binned features. The trees of all folds, and the one over all rows, grow side by side: one
aggregate a level counts classes by tree, node, feature and bin, so a search over eight depths takes eight jobs however many folds
there are. A tree of depth d is the deep one cut off at level d, which gives the leaves of all depths from the last level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.operators import ranking as K
from ratemill.operators.cumulative import rank_ties
from ratemill.operators.sets import stratified_folds
from ratemill.plans.models import WEIGHT, weighted
from ratemill.session import cut_lineage

BINS = 32


@dataclass
class TreeSearch:
    """``depth`` is the shallowest one of highest mean AUC (``by_depth``); ``folds`` has leaves and held-out AUC by fold and depth;
    ``tree`` has the nodes of the tree over all rows down to ``depth``; ``cuts`` are the candidate cuts of each feature."""

    depth: int
    cv_auc: float
    by_depth: dict[int, float]
    folds: DataFrame
    tree: DataFrame
    cuts: dict[str, list[float]]


def cut_points(df: DataFrame, names: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Values at which a feature may be cut (x <= cut goes left): all but the largest where it has ``bins`` values at most, else those
    that reach a multiple of 1/bins of the rows. What is collected depends on ``names`` and ``bins`` alone."""
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(names)])
    values = cut_lineage(weighted(df).select(WEIGHT, F.inline(pairs)).where("x is not null").groupBy("feature", "x").agg(F.sum(WEIGHT).alias("ties")))
    facts = values.groupBy("feature").agg(F.count(F.lit(1)).alias("values"), F.max("x").alias("top"))
    reach, before = (F.floor(c * bins / F.col("total")) for c in (F.col("cum"), F.col("cum") - F.col("ties")))
    kept = rank_ties(values, ["feature"], "x").join(F.broadcast(facts), "feature").where(     # one row a feature
        (F.col("x") < F.col("top")) & ((F.col("values") <= bins) | (reach > before)))
    found: dict[str, list[float]] = {c: [] for c in names}
    for r in kept.select("feature", "x").collect():
        found[names[r["feature"]]].append(r["x"])
    return {c: sorted(v) for c, v in found.items()}


def _bins(names: Sequence[str], cuts: dict[str, list[float]]) -> Column:
    """Cuts below the value, by feature; a missing value lies beyond all cuts."""
    def one(c: str) -> Column:
        below = sum(((F.col(f"`{c}`").cast("double") > v).cast("int") for v in cuts[c]), F.lit(0))
        return F.coalesce(below, F.lit(len(cuts[c])))
    return F.array(*[one(c) for c in names])


def _literal(values: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _squares(n: Column, pos: Column) -> Column:
    neg = n - pos
    return (neg * neg + pos * pos) / n


def _best_splits(counts: DataFrame) -> DataFrame:
    """The (feature, bin) that lowers the Gini impurity of each node most, first feature and bin on ties; no row where none lowers it.

    ``counts`` has a row per tree, node, feature and bin, so a window holds the bins of one feature.
    """
    w = Window.partitionBy("tree", "node", "feature")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumns({"_ln": F.sum("n").over(upto), "_lp": F.sum("pos").over(upto), "_n": F.sum("n").over(w), "_p": F.sum("pos").over(w)})
    c = c.where("_ln < _n").withColumn("_value", _squares(F.col("_ln"), F.col("_lp")) + _squares(F.col("_n") - F.col("_ln"), F.col("_p") - F.col("_lp")))
    better = c.where(F.col("_value") > _squares(F.col("_n"), F.col("_p")))
    return better.groupBy("tree", "node").agg(F.max_by(F.struct("feature", "bin"), F.struct("_value", -F.col("feature"), -F.col("bin"))).alias("split")).select(
        "tree", "node", "split.feature", "split.bin")


def _grown(rows: DataFrame, trees: int, levels: int) -> tuple[DataFrame, dict[tuple[int, int], tuple[int, int]]]:
    """Rows with ``nodes``, their last node in each tree, and the splits. Nodes are numbered from 1, children 2n and 2n + 1.

    At most ``trees`` times 2^levels splits reach the driver.
    """
    rows = rows.withColumn("nodes", F.array_repeat(F.lit(1), trees))
    splits: dict[tuple[int, int], tuple[int, int]] = {}
    for level in range(levels):
        first = 1 << level
        at = rows.select("fold", "label", WEIGHT, "bins", F.posexplode("nodes").alias("tree", "node")).where(
            (F.col("tree") != F.col("fold")) & (F.col("node") >= first))
        counts = at.select("tree", "node", "label", WEIGHT, F.posexplode("bins").alias("feature", "bin")).groupBy("tree", "node", "feature", "bin").agg(
            F.sum(WEIGHT).alias("n"), F.sum(F.col(WEIGHT) * F.col("label")).alias("pos"))
        found = {(r["tree"], r["node"]): (r["feature"], r["bin"]) for r in _best_splits(counts).collect()}
        if not found:
            break
        splits |= found
        slots = [(t, first + i) for t in range(trees) for i in range(first)]
        feature, last = (_literal([found.get(s, (-1, -1))[part] for s in slots]) for part in (0, 1))

        rows = rows.withColumn("nodes", F.transform("nodes", _step(first, feature, last)))
    return cut_lineage(rows), splits


def _step(first: int, feature: Column, last: Column):
    """From a node to its child; ``feature`` and ``last`` bin of its split by tree and node, -1 where it is not split."""
    def moved(node: Column, tree: Column) -> Column:
        slot = tree * first + node - first
        beyond = F.get("bins", F.get(feature, slot)) > F.get(last, slot)
        return F.when((node >= first) & (F.get(feature, slot) >= 0), node * 2 + beyond.cast("int")).otherwise(node)
    return moved


def _leaves(rows: DataFrame, depths: Sequence[int]) -> DataFrame:
    """Training and held-out counts of the leaves of each tree and depth."""
    held = F.col("tree") == F.col("fold")
    w, pos = F.col(WEIGHT), F.col(WEIGHT) * F.col("label")
    ends = rows.select("fold", "label", WEIGHT, F.posexplode("nodes").alias("tree", "node")).groupBy("tree", "node").agg(
        *[F.coalesce(F.sum(F.when(cond, v)), F.lit(0.0)).alias(name)
          for name, cond, v in (("n", ~held, w), ("pos", ~held, pos), ("held_n", held, w), ("held_pos", held, pos))])
    leaf = F.expr("shiftright(node, greatest(length(bin(node)) - 1 - depth, 0))")
    return ends.withColumn("depth", F.explode(_literal(depths))).withColumn("leaf", leaf).groupBy("tree", "depth", "leaf").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "held_n", "held_pos")])


def tree_search(df: DataFrame, label: str, names: Sequence[str], key: Sequence[str], depths: Sequence[int] = tuple(range(1, 9)), folds: int = 5,
                seed: int = 7, bins: int = BINS) -> TreeSearch:
    """Gini tree over ``names`` whose depth has the highest mean AUC over stratified folds of the unique ``key``.

    Rows without a label are left out, rows count ``weight`` times where that column exists, and a missing value is larger than any other.
    A fold whose held-out rows are of one class has no AUC and does not count; without any such value the search fails.
    """
    rows = weighted(df.where(F.col(label).isNotNull()))
    cuts = cut_points(rows, names, bins)
    dealt = stratified_folds(rows, label, key, folds, seed)
    profiles = cut_lineage(dealt.select("fold", F.col(label).cast("double").alias("label"), F.col(WEIGHT).cast("double").alias(WEIGHT), _bins(names, cuts).alias("bins"))
                           .groupBy("fold", "label", "bins").agg(F.sum(WEIGHT).alias(WEIGHT)))
    ends, splits = _grown(profiles, folds + 1, max(depths))
    leaves = cut_lineage(_leaves(ends, depths).withColumn("probability", F.col("pos") / F.nullif(F.col("n"), F.lit(0.0))))
    scored = leaves.where((F.col("tree") < folds) & (F.col("held_n") > 0)).groupBy("tree", "depth", "probability").agg(
        F.sum("held_n").alias("ties"), F.sum("held_pos").alias("pos"))
    sizes = leaves.where(F.col("tree") < folds).groupBy("tree", "depth").agg(F.count(F.lit(1)).alias("leaves"))
    aucs = K.auc_of(cut_lineage(scored), ["tree", "depth"], "probability")
    by_fold = cut_lineage(sizes.join(aucs, ["tree", "depth"]).select(F.col("tree").alias("fold"), "depth", "leaves", "n_rows", "positive_rows", "auc"))
    by_depth = {r["depth"]: r["auc"] for r in by_fold.groupBy("depth").agg(F.avg("auc").alias("auc")).where("auc is not null").collect()}
    if not by_depth:
        raise ValueError("no fold holds rows of both classes")
    best = min(by_depth, key=lambda d: (-round(by_depth[d], 12), d))
    every = leaves.where((F.col("tree") == folds) & (F.col("depth") == best)).select(F.col("leaf").alias("node"), "n", "pos")
    return TreeSearch(best, by_depth[best], dict(sorted(by_depth.items())), by_fold, _nodes(every, splits, folds, names, cuts, best), cuts)


def _nodes(leaves: DataFrame, splits: dict, tree: int, names: Sequence[str], cuts: dict, depth: int) -> DataFrame:
    """Inner nodes with feature and cut, and leaves, each with its rows, positives and share."""
    up = F.expr("transform(sequence(0, length(bin(node)) - 1), i -> shiftright(node, i))")
    sums = leaves.select(F.explode(up).alias("node"), "n", "pos").groupBy("node").agg(F.sum("n").alias("n_rows"), F.sum("pos").alias("positive_rows"))
    inner = [(node, names[f], cuts[names[f]][b]) for (t, node), (f, b) in splits.items() if t == tree and node < 1 << depth]
    named = leaves.sparkSession.createDataFrame(inner, "node int, feature string, cut double")
    return sums.join(F.broadcast(named), "node", "left").withColumn("probability", F.col("positive_rows") / F.col("n_rows"))     # 2^depth rows


def score_tree(search: TreeSearch, df: DataFrame, names: Sequence[str], out: str = "probability") -> DataFrame:
    """Adds the share of positives of the leaf that each row ends in; a missing value is larger than any cut."""
    nodes = {r["node"]: r for r in search.tree.collect()}       # 2^(depth + 1) rows

    def value(node: int) -> Column:
        r = nodes[node]
        if r["feature"] is None:
            return F.lit(r["probability"])
        left = F.coalesce(F.col(f"`{r['feature']}`") <= r["cut"], F.lit(False))
        return F.when(left, value(2 * node)).otherwise(value(2 * node + 1))

    return df.withColumn(out, value(1))
