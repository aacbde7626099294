"""Risk-model fitting with Spark ML, and metrics as plain aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.operators.filters import dummy_matrix, dummy_names
from ratemill.session import cut_lineage

WEIGHT = "weight"


def compress(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Equal rows as one row with its count as ``weight``.

    Profiles are coded, so the result has at most one row per distinct profile, bmi and label however many
    records there are. Fits weigh rows by it, which gives the same estimates as the records. It is kept as a
    table because iterative fits read their input many times.
    """
    return cut_lineage(df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)))


def weighted(df: DataFrame) -> DataFrame:
    return df if WEIGHT in df.columns else df.withColumn(WEIGHT, F.lit(1.0))


def vectors(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="error").transform(df)


def _labelled(df: DataFrame, label: str, names: Sequence[str], *keep) -> DataFrame:
    return vectors(weighted(df), names).select("features", F.col(label).cast("double").alias("label"), WEIGHT, *keep)


def fit_logit(df: DataFrame, label: str, names: Sequence[str]):
    """Unregularised logistic regression; rows count ``weight`` times where that column exists."""
    return LogisticRegression(regParam=0.0, maxIter=200, tol=1e-9, standardization=True, weightCol=WEIGHT).fit(_labelled(df, label, names))


def score(model, df: DataFrame, names: Sequence[str], out: str = "probability") -> DataFrame:
    scored = model.transform(vectors(df, names, model.getFeaturesCol()))
    p = vector_to_array(model.getProbabilityCol())[1]
    return scored.withColumn("_p", p).drop(model.getFeaturesCol(), model.getProbabilityCol(), "rawPrediction",
                                           "prediction").withColumnRenamed("_p", out)


def coefficients(model, names: Sequence[str], spark) -> DataFrame:
    rows = [("Intercept", float(model.intercept))] + [(n, float(c)) for n, c in zip(names, model.coefficients)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def inference_table(df: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """Wald table of a binomial fit: coefficient, standard error, z, p, odds ratio and 95% limits."""
    fit = GeneralizedLinearRegression(family="binomial", link="logit", regParam=0.0, maxIter=50, weightCol=WEIGHT).fit(
        _labelled(df, label, names))
    s = fit.summary
    # the summary lists the intercept last
    coefs = [*[float(c) for c in fit.coefficients], float(fit.intercept)]
    rows = list(zip([*names, "Intercept"], coefs, s.coefficientStandardErrors, s.tValues, s.pValues))
    t = df.sparkSession.createDataFrame([(n, float(c), float(e), float(z), float(p)) for n, c, e, z, p in rows],
                                        "feature string, coefficient double, std_error double, z_value double, p_value double")
    lo, hi = F.col("coefficient") - 1.96 * F.col("std_error"), F.col("coefficient") + 1.96 * F.col("std_error")
    return t.withColumns({"significant_0_05": F.col("p_value") < 0.05, "odds_ratio": F.exp("coefficient"),
                          "ci_lower": lo, "ci_upper": hi, "odds_ratio_lower": F.exp(lo), "odds_ratio_upper": F.exp(hi)})


def threshold_metrics_of(counts: DataFrame, prob: str, cut: float = 0.5) -> DataFrame:
    """Brier score and precision, recall and F1 at a cut from score counts; an undefined ratio counts as 0."""
    neg, p = F.col("ties") - F.col("pos"), F.col(prob)
    flagged = p >= cut
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))
    d = counts.agg(
        F.sum("ties").alias("n_rows"), (F.sum(F.col("pos") * (1 - p) * (1 - p) + neg * p * p) / F.sum("ties")).alias("brier"),
        total(F.when(flagged, F.col("pos"))).alias("tp"), total(F.when(flagged, neg)).alias("fp"), total(F.when(~flagged, F.col("pos"))).alias("fn"))
    def ratio(a, b):
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return d.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                          "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
                          "f1": ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def classification_metrics(df: DataFrame, label: str, prob: str, weight: str | None = None) -> DataFrame:
    """AUC, Brier, precision/recall/F1 at one half, and PR-AUC, as one row. The scored rows are read once; one counts ``weight`` times
    where that is named."""
    counts = K.score_counts(df, [], label, prob, weight)
    return K.auc_of(counts, [], prob).select("auc").join(F.broadcast(threshold_metrics_of(counts, prob))).join(
        F.broadcast(K.pr_auc_of(counts, prob)))


@dataclass
class ClusterSweep:
    k: int
    inertia: dict[int, float]
    silhouette: dict[int, float]
    centres: dict[int, np.ndarray]
    clustered: DataFrame


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0.0)


def _each(points: DataFrame, work, schema: str) -> DataFrame:
    """``work(x, weights, ids)`` on every batch of points."""
    def run(frames):
        for pdf in frames:
            if len(pdf):
                yield work(np.stack(pdf["x"]), pdf["w"].to_numpy(), pdf["id"].to_numpy())
    return points.mapInPandas(run, schema)


def _seeded_centres(points: DataFrame, runs: Sequence[tuple[int, int]], seed: int) -> dict[tuple[int, int], np.ndarray]:
    """First centres of all (k, start): each next one is drawn by weight times squared distance to those before.

    All starts draw side by side: a point's lot is an exponential variable, made from its id, over its share; the smallest lot is drawn.
    One aggregate a round.
    """
    centres: dict[tuple[int, int], np.ndarray] = {}
    for step in range(max(k for k, _ in runs)):
        todo = [r for r in runs if r[0] > step]

        def lots(x, w, ids, todo=todo, step=step):
            found = []
            for no, run in enumerate(todo):
                share = w * _squared(x, centres[run]).min(1) if step else w
                salt = ((seed * 1_000_003 + run[0] * 10_007 + run[1]) * 101 + step) * 0x9E3779B97F4A7C15
                z = ids.astype(np.uint64) + np.uint64(salt % 2 ** 64)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
                u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) + 1.0
                lot = np.where(share > 0, -np.log(u / (2.0 ** 53 + 1)) / np.where(share > 0, share, 1.0), np.inf)
                best = int(lot.argmin())
                found.append((no, float(lot[best]), x[best].tolist()))
            return pd.DataFrame(found, columns=["run", "lot", "x"])

        drawn = _each(points, lots, "run int, lot double, x array<double>").groupBy("run").agg(F.min_by("x", F.struct("lot", "x")).alias("x")).collect()
        for r in drawn:
            run = todo[r["run"]]
            centres[run] = np.vstack([*centres.get(run, np.empty((0, len(r["x"])))), r["x"]])
    return centres


def _moved(points: DataFrame, runs: Sequence[tuple[int, int]], centres: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], tuple[np.ndarray, float]]:
    """Centres after one step of each run, and the cost before it. A cluster without points keeps its centre."""
    def sums(x, w, ids):
        found = []
        for no, run in enumerate(runs):
            d = _squared(x, centres[run])
            own = d.argmin(1)
            cost = w * d[np.arange(len(x)), own]
            dealt = np.zeros_like(d)
            dealt[np.arange(len(x)), own] = w
            for c, (n, total) in enumerate(zip(dealt.sum(0), dealt.T @ x)):
                found.append((no, c, float(cost[own == c].sum()), [float(n), *total.tolist()]))
        return pd.DataFrame(found, columns=["run", "c", "cost", "s"])

    width = next(iter(centres.values())).shape[1] + 1
    got = _each(points, sums, "run int, c int, cost double, s array<double>").groupBy("run", "c").agg(
        F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s")).collect()
    out = {run: (centres[run].copy(), 0.0) for run in runs}
    for r in got:
        run = runs[r["run"]]
        moved, cost = out[run]
        if r["s"][0] > 0:
            moved[r["c"]] = np.array(r["s"][1:]) / r["s"][0]
        out[run] = moved, cost + r["cost"]
    return out


def _silhouettes(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, float]:
    """Mean silhouette by squared distance for each k. A cluster's size, sum and sum of squares give a point's mean distance to it."""
    ks = sorted(centres)

    def sums(x, w, ids):
        found, squares = [], (x * x).sum(1)
        for k in ks:
            own = _squared(x, centres[k]).argmin(1)
            for c in range(k):
                v = w * (own == c)
                found.append((k, c, [float(v.sum()), float((v * squares).sum()), *(v @ x).tolist()]))
        return pd.DataFrame(found, columns=["k", "c", "s"])

    width = next(iter(centres.values())).shape[1] + 2
    facts: dict[int, np.ndarray] = {k: np.zeros((k, width)) for k in ks}
    for r in _each(points, sums, "k int, c int, s array<double>").groupBy("k", "c").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s")).collect():
        facts[r["k"]][r["c"]] = r["s"]

    def scores(x, w, ids):
        found, at = [], np.arange(len(x))
        for k in ks:
            n, squares, total = facts[k][:, 0], facts[k][:, 1], facts[k][:, 2:]
            some = np.maximum(n, 1e-300)
            mean = np.where(n > 0, (x * x).sum(1)[:, None] + squares / some - 2 * x @ (total / some[:, None]).T, np.inf)
            own = _squared(x, centres[k]).argmin(1)
            alone = n[own] <= 1
            inner = np.where(alone, 0.0, mean[at, own] * n[own] / np.where(alone, 1.0, n[own] - 1))
            mean[at, own] = np.inf
            outer = mean.min(1)
            top = np.maximum(inner, outer)
            value = np.where(alone | ~np.isfinite(outer) | (top <= 0), 0.0, (outer - inner) / np.where((top > 0) & np.isfinite(top), top, 1.0))
            found.append((k, float((w * value).sum()), float(w.sum())))
        return pd.DataFrame(found, columns=["k", "total", "n"])

    rows = _each(points, scores, "k int, total double, n double").groupBy("k").agg((F.sum("total") / F.sum("n")).alias("s")).collect()
    return {r["k"]: float(r["s"]) for r in rows}


def kmeans_sweep(df: DataFrame, names: Sequence[str], ks: Sequence[int] = tuple(range(2, 9)), seed: int = 7, n_init: int = 20,
                 max_iter: int = 300, tol: float = 1e-6) -> ClusterSweep:
    """Standardised k-means over several k, the cheapest of ``n_init`` starts each; the highest silhouette wins.

    All starts of all k move in one aggregate an iteration: tasks return sums for each centre, so what reaches the driver depends on
    ``ks``, ``n_init`` and ``names`` alone. A start has settled when its centres move by ``tol`` at most. Columns are divided by their
    population deviation; the silhouette uses squared distances over all points. Rows count ``weight`` times; ``cluster`` is added to
    the rows, and a point as near to several centres belongs to the first.
    """
    w = F.col(WEIGHT)
    rows = weighted(df)
    facts = rows.agg(F.sum(w).alias("n"), *[F.sum(w * F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(names)],
                     *[F.sum(w * F.col(f"`{c}`") * F.col(f"`{c}`")).alias(f"q{i}") for i, c in enumerate(names)]).first()
    n = facts["n"]
    if not n:
        raise ValueError("k-means needs at least one row")
    means = [facts[f"s{i}"] / n for i in range(len(names))]
    sds = [math.sqrt(max(facts[f"q{i}"] / n - m * m, 0.0)) for i, m in enumerate(means)]
    zs = [((F.col(f"`{c}`") - m) / (sd or 1.0)).cast("double") for c, m, sd in zip(names, means, sds)]
    raw = rows.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.sum(w).cast("double").alias("w"))
    points = raw.select(F.array(*zs).alias("x"), "w", F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("id")).persist()
    runs = [(k, i) for k in ks for i in range(n_init)]
    centres = _seeded_centres(points, runs, seed)
    active, cost = list(runs), {}
    for _ in range(max_iter):
        step = _moved(points, active, centres)
        still = [r for r in active if np.abs(step[r][0] - centres[r]).max() > tol]
        for r in active:
            centres[r], cost[r] = step[r]
        active = still
        if not active:
            break
    cheapest = {k: min((r for r in runs if r[0] == k), key=cost.get) for k in ks}
    kept = {k: centres[r] for k, r in cheapest.items()}
    silhouette = _silhouettes(points, kept)
    points.unpersist()
    best = max(silhouette, key=silhouette.get)
    far = F.array(*[sum(((z - float(v)) * (z - float(v)) for z, v in zip(zs, centre)), F.lit(0.0)) for centre in kept[best]])
    nearest = (F.array_position("_far", F.array_min("_far")) - 1).cast("int")
    out = cut_lineage(rows.withColumn("_far", far).withColumns({"cluster": nearest, "cluster_distance": F.array_min("_far")}).drop("_far"))
    return ClusterSweep(best, {k: cost[r] for k, r in cheapest.items()}, silhouette, kept, out)


def cluster_profile(clustered: DataFrame, label: str = "label") -> DataFrame:
    """Modes, mean bmi, observed prevalence, size and a readable name per cluster."""
    cats = ["age_band", "gender", "smoking_status", "exercise_freq"]
    p = A.group_modes(weighted(clustered), "cluster", cats, ["bmi", label], WEIGHT)
    name = F.concat(F.col("mode_age_band"), F.lit(" "), F.col("mode_gender"), F.lit(", "), F.col("mode_smoking_status"),
                    F.lit(" smoking, "), F.col("mode_exercise_freq"), F.lit(" exercise"))
    return p.withColumn("cluster_name", name)


def sensitivity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Coefficients of two fits side by side with the change and whether the sign flips."""
    j = a.select("feature", F.col("coefficient").alias("primary")).join(
        b.select("feature", F.col("coefficient").alias("sensitivity")), "feature")
    return j.withColumns({"change": F.col("sensitivity") - F.col("primary"),
                          "sign_changed": F.signum("sensitivity") != F.signum("primary")})


def score_grid(model, grid: DataFrame, representatives: DataFrame) -> DataFrame:
    """Probability for every grid profile, with the mean bmi observed in its band."""
    value = [c for c in representatives.columns if c != "bmi_band"][0]
    g = grid.join(F.broadcast(representatives.select("bmi_band", F.col(value).alias("bmi"))), "bmi_band")
    return score(model, dummy_matrix(g), dummy_names()).select(*fixed.PROFILE, "probability")


def sparse_vs_predicted(observed: DataFrame, predicted: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """The n smallest observed cells beside their prediction, and the first profile without any record.

    observed: profile columns, records, empirical; predicted: profile columns, probability.
    """
    order = fixed.PROFILE
    sparse = J.join_one_to_one(observed, predicted, order).orderBy("records", *order).limit(n)
    zero = J.zero_cells(predicted, observed, order).orderBy(*order).limit(1)
    return sparse, zero


def observed_profiles(df: DataFrame) -> DataFrame:
    full = df.dropna(subset=[*fixed.PROFILE, "diabetes_status"])
    return full.groupBy(*fixed.PROFILE).agg(F.count(F.lit(1)).alias("records"),
                                            F.avg((F.col("diabetes_status") == "yes").cast("double")).alias("empirical"))


def external_validation(scored: DataFrame, ratio: DataFrame, baseline: DataFrame, prob: str = "probability", weight: str | None = None) -> dict[str, DataFrame]:
    """Mean prediction against two mortality references: rank correlation and monotonicity by gender.

    scored: age_band, gender and the probability; ratio: coarse_group, gender, f; baseline: age_band, gender,
    mortality_rate.
    """
    s = scored.withColumn("coarse_group", R.coarse_group("age_band"))
    coarse = J.external_reference(s, ratio, ["coarse_group", "gender"], prob, weight)
    fine = J.external_reference(s, baseline, ["age_band", "gender"], prob, weight)
    order = R.ordinal("age_band", fixed.AGE_LABELS)
    return {"coarse": coarse, "fine": fine,
            "spearman": K.spearman(coarse, ["gender"], f"mean_{prob}", "f"),
            "model_monotonic": K.monotonic_violations(fine, ["gender"], order, f"mean_{prob}"),
            "baseline_monotonic": K.monotonic_violations(fine, ["gender"], order, "mortality_rate")}


def subgroup_auc(df: DataFrame, group: str, label: str, prob: str) -> DataFrame:
    return K.auc(df, [group], label, prob)


def split_summary(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


def constant_brier(df: DataFrame, label: str) -> DataFrame:
    """Brier score of always predicting the base rate; for 0/1 labels that is rate * (1 - rate)."""
    p = F.avg(F.col(label).cast("double"))
    return df.where(F.col(label).isNotNull()).agg(p.alias("base_rate"), (p * (1 - p)).alias("constant_brier"))


def metrics_bundle(metrics: DataFrame, validation: dict[str, DataFrame], split: DataFrame, **extra) -> DataFrame:
    """One nested row of all metrics, ready for a JSON document. Every part is a handful of rows."""
    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
    out = metrics.select(F.struct(*metrics.columns).alias("logistic_regression"))
    for name in ("spearman", "model_monotonic", "baseline_monotonic"):
        out = out.join(F.broadcast(packed(validation[name], name)))
    out = out.join(F.broadcast(packed(split, "split")))
    return out.withColumns({k: F.lit(v) for k, v in extra.items()})


def gate_input(metrics: DataFrame, validation: dict[str, DataFrame]) -> DataFrame:
    """auc, min_spearman and violations for the publication gate."""
    odd = F.count_if(F.col("spearman").isNull() | F.isnan("spearman"))       # a group without a defined value fails the gate
    s = validation["spearman"].agg(F.when(odd == 0, F.min("spearman")).alias("min_spearman"))
    v = validation["model_monotonic"].agg(F.count_if(~F.col("non_decreasing")).alias("violations"))
    return metrics.select("auc").join(F.broadcast(s)).join(F.broadcast(v))
