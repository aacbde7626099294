"""Fits on synthetic truth and metrics against brute force."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.operators.sets import stratified_split
from ratemill.plans import models as M
from ratemill.sources import files as S


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(11)
    n = 8000
    pdf = pd.DataFrame({"id": np.arange(n), "age_band": rng.choice(fixed.AGE_LABELS, n), "gender": rng.choice(fixed.GENDERS, n),
                        "smoking_status": rng.choice(fixed.SMOKING_LEVELS, n), "exercise_freq": rng.choice(fixed.EXERCISE_LEVELS, n), "bmi": rng.normal(28, 5, n)})
    eta = -1.5 + 0.8 * (pdf.gender == "M") + 0.5 * (pdf.smoking_status == "current") + 0.08 * (pdf.bmi - 28) + 0.15 * (pdf.age_band.map(fixed.AGE_LABELS.index) - 4)
    pdf["label"] = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    return P.full_matrix(spark.createDataFrame(pdf)).cache()


def test_logit_and_inference(spark, people):
    names = P.dummy_names()
    assert len(names) == 12 + 1 + 2 + 1 + 1 and "age_band_40-44" not in names and "smoking_status_never" not in names
    fit = M.fit_logit(people, "label", names)
    co = {r["feature"]: r["coefficient"] for r in M.coefficients(fit, names, spark).collect()}
    t = {r["feature"]: r for r in M.inference_table(people, "label", names).collect()}
    assert co["gender_M"] == pytest.approx(0.8, abs=0.15) and co["bmi_num"] == pytest.approx(0.08, abs=0.02)
    for f, c in co.items():
        assert t[f]["coefficient"] == pytest.approx(c, abs=1e-3)
    x = np.column_stack([np.ones(people.count()), people.orderBy("id").select(*names).toPandas().to_numpy()])
    beta = np.array([co["Intercept"], *[co[n] for n in names]])
    p = 1 / (1 + np.exp(-x @ beta))
    se = np.sqrt(np.diag(np.linalg.pinv(x.T @ ((p * (1 - p))[:, None] * x))))
    assert [t[f]["std_error"] for f in ["Intercept", *names]] == pytest.approx(se, rel=1e-2)
    r = t["gender_M"]
    assert r["significant_0_05"] and r["odds_ratio"] == pytest.approx(np.exp(r["coefficient"])) and r["ci_lower"] < r["coefficient"] < r["ci_upper"]


def test_metrics_brute_force(spark, people):
    names = P.dummy_names()
    split = stratified_split(people, "label", ["id"])
    sizes = {r["split"]: r["n_rows"] for r in M.split_summary(split).collect()}
    assert abs(sizes["test"] - 1600) <= 1
    fit = M.fit_logit(split.where("split = 'train'"), "label", names)
    scored = M.score(fit, split.where("split = 'test'"), names).withColumn("probability", F.round("probability", 2))
    m = M.classification_metrics(scored, "label", "probability").first()
    y, p = scored.select("label", "probability").toPandas().to_numpy().T
    assert m["brier"] == pytest.approx(((y - p) ** 2).mean())
    pos, neg = p[y == 1], p[y == 0]
    assert m["auc"] == pytest.approx(((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()))
    hit = p >= 0.5
    assert m["precision"] == pytest.approx(y[hit].mean()) and m["recall"] == pytest.approx(hit[y == 1].mean())
    cuts = np.unique(p)[::-1]
    prec, rec = [1.0] + [y[p >= c].mean() for c in cuts], [0.0] + [(p[y == 1] >= c).mean() for c in cuts]
    assert m["pr_auc"] == pytest.approx(np.trapezoid(prec, rec))
    pts = {r["threshold"]: (r["precision"], r["recall"]) for r in K.pr_points(scored, "label", "probability").collect()}
    assert pts[cuts[5]] == (pytest.approx(prec[6]), pytest.approx(rec[6]))
    cal = K.calibration(scored, "label", "probability").collect()
    assert sum(r["n_rows"] for r in cal) == len(y) and all(abs(r["observed"] - r["predicted"]) < 0.15 for r in cal)
    base = M.constant_brier(scored, "label").first()
    assert base["constant_brier"] == pytest.approx(((y - y.mean()) ** 2).mean())


def test_weighted_rows_give_the_same_fit(spark, people):
    names = P.dummy_names()
    coarse = people.withColumn("bmi_num", F.round("bmi")).withColumn("bmi", F.round("bmi"))
    small = M.compress(coarse, ["label", "bmi", *P.full_names(), "age_band", "gender", "smoking_status", "exercise_freq"])
    assert small.count() < 8000 and small.agg(F.sum("weight")).first()[0] == 8000
    a = {r["feature"]: r for r in M.inference_table(coarse, "label", names).collect()}
    b = {r["feature"]: r for r in M.inference_table(small, "label", names).collect()}
    for f in a:
        assert b[f]["coefficient"] == pytest.approx(a[f]["coefficient"], abs=1e-6) and b[f]["std_error"] == pytest.approx(a[f]["std_error"], rel=1e-6)
    co = {r["feature"]: r["coefficient"] for r in M.coefficients(M.fit_logit(small, "label", names), names, spark).collect()}
    assert all(co[f] == pytest.approx(a[f]["coefficient"], abs=1e-3) for f in a)


def test_clusters(people):
    names = P.full_names()
    sweep = M.kmeans_sweep(people, names, (2, 3), n_init=3)
    assert sweep.k in (2, 3) and sweep.inertia[3] < sweep.inertia[2]
    prof = M.cluster_profile(sweep.clustered).collect()
    assert sum(r["size"] for r in prof) == 8000 and sum(r["size_percent"] for r in prof) == pytest.approx(100)
    assert all(r["cluster_name"].endswith("exercise") for r in prof)


def test_clusters_by_plain_steps(spark):
    rng = np.random.default_rng(5)
    at = np.array([[0, 0], [8, 1], [1, 9]])
    x = np.round(at[rng.integers(0, 3, 400)] + rng.normal(0, 1, (400, 2)), 1)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"])).repartition(5)
    sweep = M.kmeans_sweep(df, ["a", "b"], (2, 3, 4), n_init=6)
    z = (x - x.mean(0)) / x.std(0)
    assert sweep.k == 3
    for k, centres in sweep.centres.items():
        far = ((z[:, None] - centres[None]) ** 2).sum(2)
        own = far.argmin(1)
        assert sweep.inertia[k] == pytest.approx(far.min(1).sum(), rel=1e-6)
        assert np.allclose([z[own == c].mean(0) for c in range(k)], centres, atol=1e-5)
        pair = ((z[:, None] - z[None]) ** 2).sum(2)
        inner = np.array([pair[i][(own == own[i])].sum() / max((own == own[i]).sum() - 1, 1) for i in range(len(z))])
        outer = np.array([min(pair[i][own == c].mean() for c in range(k) if c != own[i]) for i in range(len(z))])
        assert sweep.silhouette[k] == pytest.approx(((outer - inner) / np.maximum(inner, outer)).mean(), abs=1e-9)
    again = M.kmeans_sweep(df.repartition(2), ["a", "b"], (2, 3, 4), n_init=6)
    assert again.inertia == pytest.approx(sweep.inertia)                       # starts do not hang on how rows are dealt to tasks
    doubled = M.kmeans_sweep(df.withColumn("weight", F.lit(2.0)), ["a", "b"], (3,), n_init=6)
    assert doubled.inertia[3] == pytest.approx(2 * sweep.inertia[3])
    same = M.kmeans_sweep(spark.createDataFrame([(1.0, 2.0)] * 4, "a double, b double"), ["a", "b"], (2,), n_init=2)
    assert same.inertia[2] == 0 and same.silhouette[2] == 0 and same.clustered.count() == 4
    with pytest.raises(ValueError, match="at least one row"):
        M.kmeans_sweep(df.limit(0), ["a", "b"], (2,))


def test_sensitivity(spark):
    a = spark.createDataFrame([("x", 0.5), ("y", -0.1)], "feature string, coefficient double")
    b = spark.createDataFrame([("x", 0.7), ("y", 0.1)], "feature string, coefficient double")
    got = {r["feature"]: (round(r["change"], 3), r["sign_changed"]) for r in M.sensitivity(a, b).collect()}
    assert got == {"x": (0.2, False), "y": (0.2, True)}


def test_grid_validation_and_bundle(spark, people, folder):
    names = P.dummy_names()
    fit = M.fit_logit(people, "label", names)
    grid = J.profile_grid(spark, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                                  "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS})
    reps = spark.createDataFrame([("under", 17.0), ("normal", 22.0), ("over", 27.0), ("obese", 34.0)], "bmi_band string, representative_bmi_value double")
    scores = M.score_grid(fit, grid, reps)
    assert scores.count() == 624 and scores.where("probability between 0 and 1").count() == 624
    rec = people.withColumns({"bmi_band": F.when(F.col("bmi") < 25, "normal").otherwise("over"), "diabetes_status": F.when(F.col("label") == 1, "yes").otherwise("no")})
    sparse, zero = M.sparse_vs_predicted(M.observed_profiles(rec), scores)
    assert sparse.count() == 5 and zero.first()["bmi_band"] == "obese"
    ratio = spark.createDataFrame([(g, s, 0.01 * i) for i, g in enumerate(fixed.COARSE_LABELS, 1) for s in "FM"], "coarse_group string, gender string, f double")
    base = spark.createDataFrame([(b, s, 0.001 * i) for i, b in enumerate(fixed.AGE_LABELS, 1) for s in "FM"], "age_band string, gender string, mortality_rate double")
    scored = M.score(fit, people, names)
    checks = M.external_validation(scored, ratio, base)
    assert all(r["spearman"] > 0.9 for r in checks["spearman"].collect())
    assert all(r["non_decreasing"] for r in checks["baseline_monotonic"].collect())
    metrics = M.classification_metrics(scored, "label", "probability")
    gate = M.gate_input(metrics, checks).first()
    assert gate["auc"] > 0.6 and gate["min_spearman"] > 0.9
    bundle = M.metrics_bundle(metrics, checks, M.split_summary(people.withColumn("split", F.lit("all"))), seed=7)
    S.write_metrics(bundle, f"{folder}/metrics")
    doc = json.loads(spark.read.text(f"{folder}/metrics").first()[0])
    assert doc["seed"] == 7 and doc["logistic_regression"]["auc"] == pytest.approx(gate["auc"]) and len(doc["spearman"]) == 2


def test_subgroup_auc_is_null_for_one_class(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 0, 0.1), ("b", 1, 0.3)], "g string, y int, p double")
    assert {r["g"]: r["auc"] for r in M.subgroup_auc(df, "g", "y", "p").collect()} == {"a": 1.0, "b": None}


def test_weighted_rows_count_as_their_copies(spark):
    """Metrics and reference means of distinct rows with weights are those of the rows written out."""
    from ratemill.operators import joins
    from ratemill.plans import models
    rows = [(i % 2 if i < 6 else None, round(0.1 + 0.13 * (i % 5), 2), "a" if i % 3 else "b", 1.0 + i % 4) for i in range(8)]
    few = spark.createDataFrame(rows, "label int, p double, g string, weight double")
    many = spark.createDataFrame([r[:3] for r in rows for _ in range(int(r[3]))], "label int, p double, g string")
    reference = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, f double")
    for x, y in ((models.classification_metrics(few, "label", "p", "weight"), models.classification_metrics(many, "label", "p")),
                 (joins.external_reference(few, reference, ["g"], "p", "weight"), joins.external_reference(many, reference, ["g"], "p"))):
        assert x.columns == y.columns
        for a, b in zip(sorted(x.collect()), sorted(y.collect())):
            assert all(u == v or abs(u - v) < 1e-12 for u, v in zip(a, b))
