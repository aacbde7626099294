"""Model fits, score metrics and the streaming path."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.operators.sets import stratified_split
from ratemill.plans import models as M
from ratemill.plans import pricing, trees
from ratemill.session import cut_lineage, run_folder, shared_dir
from ratemill.sources import files as S
from ratemill.streaming import checkins as T


def scored(spark, sf):
    """Line items with a 0/1 outcome and a score between 0 and 1 from the price; groups by ship mode columns."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_discount") <= 0.045).cast("int").alias("y"), (F.col("l_extendedprice") / 110000).alias("p"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("grp"),
        F.col("l_linestatus").alias("sex"))


_SCORED = """
scored AS (SELECT CASE WHEN l_discount <= 0.045 THEN 1 ELSE 0 END AS y, l_extendedprice/110000 AS p, l_extendedprice AS price, l_quantity AS qty,
  l_returnflag AS grp, l_linestatus AS sex FROM lineitem)"""
_RANKS = """
ranked AS (SELECT *, rank() OVER (PARTITION BY {g} ORDER BY p) + (count(*) OVER (PARTITION BY {g}, p) - 1)/2.0 AS r FROM scored)"""


@query("WITH" + _SCORED + "," + _RANKS.format(g="grp") + """
SELECT grp, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS positive_rows,
  round((sum(r) FILTER (WHERE y = 1) - sum(y)*(sum(y)+1)/2.0) / (sum(y)::DOUBLE*(count(*)-sum(y))), 6) AS auc FROM ranked GROUP BY 1""")
def auc_by_group(spark, sf):
    return M.subgroup_auc(scored(spark, sf), "grp", "y", "p")


@query("WITH" + _SCORED + """,
c AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scored GROUP BY 1),
k AS (SELECT *, sum(n) OVER w AS flagged, sum(pos) OVER w AS tp, sum(pos) OVER () AS positives FROM c WINDOW w AS (ORDER BY p DESC)),
pr AS (SELECT sum((pos::DOUBLE/positives) * (CASE WHEN flagged > n THEN (tp - pos)::DOUBLE/(flagged - n) ELSE 1.0 END + tp::DOUBLE/flagged)/2) AS pr_auc FROM k),
rk AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1)/2.0 AS r FROM scored),
a AS (SELECT (sum(r) FILTER (WHERE y = 1) - sum(y)*(sum(y)+1)/2.0) / (sum(y)::DOUBLE*(count(*)-sum(y))) AS auc FROM rk),
t AS (SELECT count(*) AS n_rows, avg((y-p)*(y-p)) AS brier, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn FROM scored)
SELECT round(auc, 6) AS auc, n_rows, round(brier, 6) AS brier, tp, fp, fn, round(tp::DOUBLE/(tp+fp), 6) AS precision, round(tp::DOUBLE/(tp+fn), 6) AS recall,
  round(2.0*tp/(2*tp+fp+fn), 6) AS f1, round(pr_auc, 6) AS pr_auc FROM t, a, pr""")
def classification_metrics(spark, sf):
    return M.classification_metrics(scored(spark, sf), "y", "p")


@query("WITH" + _SCORED + """,
c AS (SELECT qty, count(*) AS n, sum(y) AS pos FROM scored GROUP BY 1)
SELECT qty AS threshold, round(sum(pos) OVER w::DOUBLE / sum(n) OVER w, 6) AS precision, round(sum(pos) OVER w::DOUBLE / sum(pos) OVER (), 6) AS recall FROM c WINDOW w AS (ORDER BY qty DESC)""")
def pr_curve(spark, sf):
    return K.pr_points(scored(spark, sf), "y", "qty")


@query("WITH" + _SCORED + """,
x AS (SELECT grp, rank() OVER (PARTITION BY grp ORDER BY price) + (count(*) OVER (PARTITION BY grp, price) - 1)/2.0 AS rx,
  rank() OVER (PARTITION BY grp ORDER BY qty) + (count(*) OVER (PARTITION BY grp, qty) - 1)/2.0 AS ry FROM scored)
SELECT grp, count(*) AS n_rows, round(corr(rx, ry), 6) AS spearman FROM x GROUP BY 1""")
def spearman_by_group(spark, sf):
    return K.spearman(scored(spark, sf), ["grp"], "price", "qty")


@query("WITH" + _SCORED + """,
e AS (SELECT """ + ", ".join(f"quantile_cont(p, 0.{i}) AS e{i}" for i in range(1, 10)) + """ FROM scored),
b AS (SELECT y, p, """ + " + ".join(f"(p > e{i})::INT" for i in range(1, 10)) + """ AS bin FROM scored, e)
SELECT CAST(bin AS BIGINT) AS bin, count(*) AS n_rows, round(avg(y), 6) AS observed, round(avg(p), 6) AS predicted FROM b GROUP BY 1""")
def calibration_bins(spark, sf):
    return K.calibration(scored(spark, sf), "y", "p")


@query("WITH" + star.RECORDS + "," + star.PREV + """
SELECT gender, count(*) FILTER (WHERE p < q) AS violations, CAST(count(*) FILTER (WHERE p < q) = 0 AS BIGINT) AS non_decreasing
FROM (SELECT gender, p, lag(p) OVER (PARTITION BY gender ORDER BY """ + star.band_no("age_band") + """) AS q FROM prev) GROUP BY 1""")
def monotonic_violations(spark, sf):
    from ratemill.operators.aggregates import prevalence
    p = prevalence(star.counts(spark, sf), ["age_band", "gender"], weight="n")
    return K.monotonic_violations(p, ["gender"], R.ordinal("age_band", fixed.AGE_LABELS), "prevalence")


@query("WITH" + _SCORED + """
SELECT round(avg(y), 6) AS base_rate, round(avg(y)*(1-avg(y)), 6) AS constant_brier FROM scored""")
def constant_brier(spark, sf):
    return M.constant_brier(scored(spark, sf), "y")


@query("""SELECT split, count(*) AS n_rows, round(avg(quality), 6) AS positive_rate FROM (SELECT quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5('7|' || doc_id)) <= floor(count(*) OVER (PARTITION BY quality)*0.2 + 0.5)
  THEN 'test' ELSE 'train' END AS split FROM labels) GROUP BY 1""")
def split_summary(spark, sf):
    s = stratified_split(table(spark, sf, "labels"), "quality", ["doc_id"])
    return M.split_summary(s, "quality")


_EXT = star.RECORDS + "," + star.MORTALITY + "," + star.PREV + "," + star.cells_sql(2023) + f""",
s AS (SELECT gender, {star.coarse_case('age_band')} AS coarse_group, CASE WHEN bmi_value >= 30 THEN 0.25::DOUBLE ELSE 0.125::DOUBLE END * age_code AS score FROM records
  WHERE age_band IS NOT NULL AND bmi_value IS NOT NULL),
m AS (SELECT coarse_group, s.gender, avg(score) AS mean_score, any_value(f) AS f FROM s JOIN cells_ratio r ON r.age_band = coarse_group AND r.gender = s.gender GROUP BY 1, 2)"""


@query("WITH" + _EXT + " SELECT coarse_group, gender, round(mean_score, 6) AS mean_score, round(f, 6) AS f FROM m")
def external_reference(spark, sf):
    """Mean score per coarse group beside the mortality ratio."""
    return J.external_reference(ext_scores(spark, sf), pricing.condition_ratio(star.mortality(cut_lineage(star.deaths(spark, sf))), 2023),
                                ["coarse_group", "gender"], "score")


def ext_scores(spark, sf):
    rec = star.records(spark, sf).where("age_band is not null and bmi_value is not null")
    score = F.when(F.col("bmi_value") >= 30, 0.25).otherwise(0.125) * F.col("age_code")
    return rec.select("gender", "age_band", R.coarse_group("age_band").alias("coarse_group"), score.alias("score"))


@query("WITH" + _EXT + """,
r AS (SELECT gender, rank() OVER (PARTITION BY gender ORDER BY mean_score) + (count(*) OVER (PARTITION BY gender, mean_score) - 1)/2.0 AS a,
  rank() OVER (PARTITION BY gender ORDER BY f) + (count(*) OVER (PARTITION BY gender, f) - 1)/2.0 AS b FROM m)
SELECT gender, count(*) AS n_rows, round(corr(a, b), 6) AS spearman FROM r GROUP BY 1""")
def external_spearman(spark, sf):
    dead = cut_lineage(star.deaths(spark, sf))
    m = star.mortality(dead)
    checks = M.external_validation(ext_scores(spark, sf), pricing.condition_ratio(m, 2023), m.where("condition_flag = 'BASELINE'"), "score")
    return checks["spearman"]


def training(spark, sf):
    """Labelled records as weighted distinct profiles with their indicator columns."""
    rec = P.complete_cases(star.records(spark, sf), [*fixed.PROFILE, "bmi_value"]).where(F.col("diabetes_code").isin(1, 3))
    rec = P.labels(rec.withColumn("bmi", F.col("bmi_value").cast("double")), "diabetes_code")
    return P.full_matrix(M.compress(rec, ["label", "bmi", "age_band", "gender", "smoking_status", "exercise_freq"]))


_COMPLETE = """records WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL AND bmi_band IS NOT NULL
  AND exercise_freq IS NOT NULL AND bmi_value IS NOT NULL AND diabetes_code IN (1, 3)"""


@query("WITH" + star.RECORDS + ",\nt AS (SELECT * FROM " + _COMPLETE + ")\n" + " UNION ALL ".join(
    f"SELECT '{c}_{v}' AS feature, count(*) AS n_rows, count(*) FILTER (WHERE {c} = '{v}') AS with_level FROM t"
    for c, levels in P.FEATURE_LEVELS.items() for v in levels if v != P.REFERENCE_LEVELS[c]))
def dummy_sums(spark, sf):
    """Records with each level, from the reference-coded matrix of weighted profiles."""
    t = training(spark, sf).drop(*P.full_names())
    names = [n for n in P.dummy_names() if n != "bmi_num"]
    sums = P.dummy_matrix(t).agg(F.sum("weight").alias("n"), *[F.sum(F.col(f"`{n}`") * F.col("weight")).alias(f"s{i}") for i, n in enumerate(names)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col("n").cast("bigint").alias("n_rows"), F.col(f"s{i}").cast("bigint").alias("with_level"))
                                          for i, n in enumerate(names)])))


@query("WITH" + star.RECORDS + ",\nt AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE diabetes_code = 1) AS positives FROM " + _COMPLETE + ")\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, n_rows, positives, 1::BIGINT AS score_is_zero, 1::BIGINT AS odds_match, 1::BIGINT AS limits_match, 1::BIGINT AS fits_agree FROM t" for n in P.dummy_names()))
def logit_fit_checks(spark, sf):
    """What a maximum-likelihood fit must satisfy for each feature: residuals sum to zero over it, odds ratios and limits follow from the
    coefficient and its error, and both solvers agree."""
    names, t = P.dummy_names(), P.dummy_matrix(training(spark, sf).drop(*P.full_names()))
    fit = M.fit_logit(t, "label", names)
    w = F.col(M.WEIGHT)
    def mean(c):
        return F.sum(w * c) / F.sum(w)
    gaps = M.score(fit, t, names).agg(
        F.sum(w).cast("bigint").alias("n_rows"), F.sum(w * F.col("label")).cast("bigint").alias("positives"),
        *[(mean((F.col("label") - F.col("probability")) * F.col(f"`{c}`")) / F.greatest(mean(F.col(f"`{c}`")), F.lit(1e-12))).alias(f"g{i}") for i, c in enumerate(names)])
    rows = gaps.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), "n_rows", "positives", (F.abs(f"g{i}") < 1e-4).alias("score_is_zero")) for i, c in enumerate(names)])))
    wald = M.inference_table(t, "label", names)
    near = [(F.col("odds_ratio") / F.exp("coefficient") - 1), F.col("ci_upper") - F.col("coefficient") - 1.96 * F.col("std_error")]
    other = M.coefficients(fit, names, spark).withColumnRenamed("coefficient", "other")
    j = rows.join(wald, "feature").join(other, "feature")
    return j.select("feature", "n_rows", "positives", "score_is_zero", (F.abs(near[0]) < 1e-9).alias("odds_match"), (F.abs(near[1]) < 1e-9).alias("limits_match"),
                    (F.abs(F.col("coefficient") - F.col("other")) < 1e-3).alias("fits_agree"))


def residuals(fit, t, label, names):
    """Rows and positives of a fit, and whether its residuals sum to zero over each feature, as they do at the maximum."""
    w = F.col(M.WEIGHT)
    def mean(c):
        return F.sum(w * c) / F.sum(w)
    gaps = M.score(fit, t, names).agg(
        F.sum(w).alias("n_rows"), F.sum(w * F.col(label)).alias("positives"),
        *[(mean((F.col(label) - F.col("probability")) * F.col(f"`{c}`")) / F.greatest(mean(F.col(f"`{c}`")), F.lit(1e-12))).alias(f"g{i}") for i, c in enumerate(names)])
    return gaps.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col("n_rows").cast("bigint").alias("n_rows"), F.col("positives").cast("bigint").alias("positives"),
                                                   (F.abs(f"g{i}") < 1e-4).alias("at_maximum")) for i, c in enumerate(names)])))


@query("WITH" + star.RECORDS + ",\nt AS (SELECT count(*) AS n_rows FROM " + _COMPLETE + ")\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, n_rows, 1::BIGINT AS errors_match, 1::BIGINT AS z_matches, 1::BIGINT AS p_matches, 1::BIGINT AS significance_matches FROM t" for n in ["Intercept", *P.dummy_names()]))
def wald_checks(spark, sf):
    """Wald table against its definition: errors from the inverse of the information matrix, which one aggregate over the profiles adds up
    at the fitted probabilities, z and p from coefficient and error."""
    names, t = P.dummy_names(), P.dummy_matrix(training(spark, sf).drop(*P.full_names()))
    wald = M.inference_table(t, "label", names)
    table_ = {r["feature"]: r for r in wald.collect()}
    x = [F.lit(1.0), *[F.col(f"`{c}`") for c in names]]
    all_names = ["Intercept", *names]
    p = 1 / (1 + F.exp(-sum((v * table_[c]["coefficient"] for v, c in zip(x, all_names)), F.lit(0.0))))
    # a square matrix of as many sums as features
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    w = F.col("_w")
    sums = t.withColumn("_w", F.col(M.WEIGHT) * p * (1 - p)).agg(F.sum(M.WEIGHT).alias("n"), F.array(*[F.sum(w * x[i] * x[j]) for i, j in pairs]).alias("s")).first()
    information = np.zeros((len(x), len(x)))
    for (i, j), v in zip(pairs, sums["s"]):
        information[i, j] = information[j, i] = v
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    rows = []
    for name, error in zip(all_names, errors):
        r = table_[name]
        z = r["coefficient"] / r["std_error"]
        both = math.erfc(abs(z) / math.sqrt(2))          # two sides of the normal distribution
        rows.append((name, int(sums["n"]), bool(abs(r["std_error"] / error - 1) < 1e-4), bool(abs(r["z_value"] - z) < 1e-9), bool(abs(r["p_value"] - both) < 1e-9),
                     bool(r["significant_0_05"] == (both < 0.05))))
    return spark.createDataFrame(rows, "feature string, n_rows long, errors_match boolean, z_matches boolean, p_matches boolean, significance_matches boolean")


_PROFILED = _COMPLETE.replace("diabetes_code IN (1, 3)", "diabetes_code IN (1, 3, 4)")


@query("WITH" + star.RECORDS + """,
t AS (SELECT count(*) FILTER (WHERE diabetes_code <> 4) AS n_primary, count(*) FILTER (WHERE diabetes_code = 1) AS pos_primary, count(*) AS n_sensitivity,
  count(*) FILTER (WHERE diabetes_code <> 3) AS pos_sensitivity FROM """ + _PROFILED + ")\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, n_primary, pos_primary, n_sensitivity, pos_sensitivity, 1::BIGINT AS both_at_maximum, 1::BIGINT AS change_matches, 1::BIGINT AS sign_matches FROM t" for n in P.dummy_names()))
def sensitivity_refit(spark, sf):
    """The fit beside one that counts the in-between class as positive: rows and positives of both, each at its maximum, change and sign
    as the two coefficients say."""
    rec = P.complete_cases(star.records(spark, sf), [*fixed.PROFILE, "bmi_value"]).where(F.col("diabetes_code").isin(1, 3, 4))
    rec = P.labels(rec.withColumn("bmi", F.col("bmi_value").cast("double")), "diabetes_code")
    t = P.dummy_matrix(M.compress(rec, ["label", "label_sensitivity", "bmi", *P.FEATURE_LEVELS]))
    names = P.dummy_names()
    first = t.where("label is not null")
    a, b = M.fit_logit(first, "label", names), M.fit_logit(t, "label_sensitivity", names)
    plain_a, plain_b = M.coefficients(a, names, spark), M.coefficients(b, names, spark)
    both = residuals(a, first, "label", names).withColumnsRenamed({"n_rows": "n_primary", "positives": "pos_primary", "at_maximum": "_a"}).join(
        residuals(b, t, "label_sensitivity", names).withColumnsRenamed({"n_rows": "n_sensitivity", "positives": "pos_sensitivity", "at_maximum": "_b"}), "feature")
    j = both.join(M.sensitivity(plain_a, plain_b), "feature").join(plain_a.withColumnRenamed("coefficient", "ca"), "feature").join(
        plain_b.withColumnRenamed("coefficient", "cb"), "feature")
    return j.select("feature", "n_primary", "pos_primary", "n_sensitivity", "pos_sensitivity", (F.col("_a") & F.col("_b")).alias("both_at_maximum"),
                    (F.abs(F.col("ca") + F.col("change") - F.col("cb")) < 1e-9).alias("change_matches"),
                    (F.col("sign_changed") == ((F.col("ca") < 0) != (F.col("cb") < 0))).alias("sign_matches"))


def grid(spark):
    return J.profile_grid(spark, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                                  "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS})


def _values(name: str, levels) -> str:
    return f"(SELECT unnest([{', '.join(repr(v) for v in levels)}]) AS {name})"


_GRID = "(SELECT * FROM " + ", ".join(_values(c, v) for c, v in {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                                                                  "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS}.items()) + ")"


@query("WITH" + star.RECORDS + ",\nreps AS (SELECT bmi_band, avg(CAST(bmi_value AS DOUBLE)) AS bmi FROM records WHERE bmi_band IS NOT NULL AND bmi_value IS NOT NULL GROUP BY 1)\n"
       "SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, round(bmi, 4) AS bmi, 1::BIGINT AS score_matches FROM " + _GRID + " JOIN reps USING (bmi_band)")
def scored_grid(spark, sf):
    """Every profile with the mean bmi of its band, and whether its score is the logistic of intercept, level effects and bmi effect."""
    names, t = P.dummy_names(), P.dummy_matrix(training(spark, sf).drop(*P.full_names()))
    fit = M.fit_logit(t, "label", names)
    reps = A.representatives(star.records(spark, sf), "bmi_band", "bmi_value")
    scored = M.score_grid(fit, grid(spark), reps).join(F.broadcast(reps.withColumnRenamed("representative_bmi_value", "bmi")), "bmi_band")      # four bands
    effect = dict(zip(names, (float(c) for c in fit.coefficients)))
    eta = F.lit(float(fit.intercept)) + F.col("bmi") * effect["bmi_num"]
    for c in P.FEATURE_LEVELS:
        eta = eta + sum((F.when(F.col(c) == v, effect[f"{c}_{v}"]).otherwise(0.0) for v in P.FEATURE_LEVELS[c] if v != P.REFERENCE_LEVELS[c]), F.lit(0.0))
    return scored.select(*fixed.PROFILE, F.round("bmi", 4).alias("bmi"), (F.abs(F.col("probability") - 1 / (1 + F.exp(-eta))) < 1e-9).alias("score_matches"))


@query("WITH" + star.RECORDS + """,
observed AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, count(*) AS records, avg((diabetes_status = 'yes')::INT) AS empirical FROM records
  WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in fixed.PROFILE) + f""" AND diabetes_status IS NOT NULL GROUP BY ALL),
few AS (SELECT 'sparse' AS part, * FROM observed ORDER BY records, {', '.join(fixed.PROFILE)} LIMIT 5),
none AS (SELECT 'unseen' AS part, g.*, NULL::BIGINT AS records, NULL::DOUBLE AS empirical FROM {_GRID} g ANTI JOIN observed USING ({', '.join(fixed.PROFILE)}) ORDER BY {', '.join(fixed.PROFILE)} LIMIT 1)
SELECT part, {', '.join(fixed.PROFILE)}, records, round(empirical, 6) AS empirical, 1::BIGINT AS predicted FROM (SELECT * FROM few UNION ALL SELECT * FROM none)""")
def sparse_cells_scored(spark, sf):
    """The smallest observed cells and the first profile nobody has, each with a prediction of the fitted model."""
    names, t = P.dummy_names(), P.dummy_matrix(training(spark, sf).drop(*P.full_names()))
    rec = star.records(spark, sf)
    scored = cut_lineage(M.score_grid(M.fit_logit(t, "label", names), grid(spark), A.representatives(rec, "bmi_band", "bmi_value")))
    sparse, zero = M.sparse_vs_predicted(M.observed_profiles(rec), scored)
    rows = sparse.select(F.lit("sparse").alias("part"), *fixed.PROFILE, "records", "empirical", "probability").unionByName(
        zero.select(F.lit("unseen").alias("part"), *fixed.PROFILE, F.lit(None).cast("long").alias("records"), F.lit(None).cast("double").alias("empirical"), "probability"))
    return rows.withColumn("predicted", (F.col("probability") > 0) & (F.col("probability") < 1)).drop("probability")


@query("WITH" + _SCORED + "," + _RANKS.replace("PARTITION BY {g}, p", "PARTITION BY p").replace("PARTITION BY {g} ", "").replace("PARTITION BY {g}", "") + "," + _EXT + f""",
r AS (SELECT gender, rank() OVER (PARTITION BY gender ORDER BY mean_score) + (count(*) OVER (PARTITION BY gender, mean_score) - 1)/2.0 AS a,
  rank() OVER (PARTITION BY gender ORDER BY f) + (count(*) OVER (PARTITION BY gender, f) - 1)/2.0 AS b FROM m),
sp AS (SELECT gender, corr(a, b) AS spearman FROM r GROUP BY 1),
lb AS (SELECT quality, count(*) AS n, floor(count(*)*0.2 + 0.5) AS n_test FROM labels GROUP BY 1),
base AS (SELECT gender, mortality_rate, lag(mortality_rate) OVER (PARTITION BY gender ORDER BY {star.band_no("age_band")}) AS q FROM baseline
  WHERE age_band IN (SELECT age_band FROM records))
SELECT (SELECT round((sum(r) FILTER (WHERE y = 1) - sum(y)*(sum(y)+1)/2.0) / (sum(y)::DOUBLE*(count(*)-sum(y))), 6) FROM ranked) AS auc,
  (SELECT round(avg((y-p)*(y-p)), 6) FROM scored) AS brier, (SELECT round(spearman, 6) FROM sp WHERE gender = 'F') AS spearman_f,
  (SELECT round(spearman, 6) FROM sp WHERE gender = 'M') AS spearman_m, (SELECT CAST(sum(n_test) AS BIGINT) FROM lb) AS n_test, (SELECT CAST(sum(n - n_test) AS BIGINT) FROM lb) AS n_train,
  (SELECT count(*) FROM base WHERE mortality_rate < q) AS baseline_violations, 7::BIGINT AS seed""")
def metrics_document(spark, sf):
    """The bundle of metrics written as one JSON document and read back: held-out metrics, rank correlations, monotonicity, split, seed."""
    m = star.mortality(cut_lineage(star.deaths(spark, sf)))
    checks = M.external_validation(ext_scores(spark, sf), pricing.condition_ratio(m, 2023), m.where("condition_flag = 'BASELINE'"), "score")
    split = M.split_summary(stratified_split(table(spark, sf, "labels"), "quality", ["doc_id"]), "quality")
    path = run_folder(spark, "metrics")
    S.write_metrics(M.metrics_bundle(M.classification_metrics(scored(spark, sf), "y", "p"), checks, split, seed=7), path)
    doc = spark.read.json(path)
    def of(rows, key, value, field):
        return F.filter(rows, lambda r: r[key] == value)[0][field]
    violations = F.aggregate("baseline_monotonic", F.lit(0).cast("bigint"), lambda a, r: a + r["violations"])
    return doc.select(F.col("logistic_regression.auc").alias("auc"), F.col("logistic_regression.brier").alias("brier"), of("spearman", "gender", "F", "spearman").alias("spearman_f"),
                      of("spearman", "gender", "M", "spearman").alias("spearman_m"), of("split", "split", "test", "n_rows").alias("n_test"),
                      of("split", "split", "train", "n_rows").alias("n_train"), violations.alias("baseline_violations"), "seed")


@query()
def logit_inference(spark, sf):
    """Wald table of the logistic fit on every labelled record."""
    return M.inference_table(training(spark, sf), "label", P.dummy_names())


@query("WITH" + star.RECORDS + """
SELECT count(*) AS n_rows, 1::BIGINT AS sizes_add_up, 0::BIGINT AS nearer_elsewhere, 1::BIGINT AS centres_are_means, 1::BIGINT AS inertia_adds_up, 1::BIGINT AS inertia_falls,
  1::BIGINT AS silhouettes_in_range, 7::BIGINT AS ks FROM """ + _COMPLETE)
def kmeans_checks(spark, sf):
    """What clusterings of the weighted profiles must satisfy: every row is with its nearest centre, centres are the means of their rows,
    sizes and distances add up to all rows and to the inertia, and more clusters cost less."""
    names, t = P.full_names(), training(spark, sf)
    sweep = M.kmeans_sweep(t, names)
    w = F.col(M.WEIGHT)
    rows = sweep.clustered
    n, *moments = rows.agg(F.sum(w), *[F.sum(w * F.col(f"`{c}`")) for c in names],
                           *[F.sum(w * F.col(f"`{c}`") * F.col(f"`{c}`")) for c in names]).first()
    mean = [m / n for m in moments[:len(names)]]
    scale = [max(q / n - m * m, 0.0) ** 0.5 or 1.0 for q, m in zip(moments[len(names):], mean)]
    z = [(F.col(f"`{c}`") - m) / s for c, m, s in zip(names, mean, scale)]
    far = [sum(((v - float(g)) * (v - float(g)) for v, g in zip(z, centre)), F.lit(0.0)) for centre in sweep.centres[sweep.k]]
    by_cluster = rows.groupBy("cluster").agg(F.sum(w).alias("n"), *[(F.sum(w * v) / F.sum(w)).alias(f"m{i}") for i, v in enumerate(z)]).collect()
    gap = max(abs(r[f"m{i}"] - sweep.centres[sweep.k][r["cluster"]][i]) for r in by_cluster for i in range(len(names)))
    costs = [sweep.inertia[k] for k in sorted(sweep.inertia)]
    return rows.agg(
        F.sum(w).cast("bigint").alias("n_rows"), (F.lit(sum(r["n"] for r in by_cluster)) == F.sum(w)).alias("sizes_add_up"),
        F.count_if(F.least(*far) < F.col("cluster_distance") - 1e-9).alias("nearer_elsewhere"), F.lit(bool(gap < 1e-4)).alias("centres_are_means"),
        (F.abs(F.sum(w * F.col("cluster_distance")) / sweep.inertia[sweep.k] - 1) < 1e-6).alias("inertia_adds_up"),
        F.lit(all(b <= a * 1.001 for a, b in zip(costs, costs[1:]))).alias("inertia_falls"),
        F.lit(all(-1 <= v <= 1 for v in sweep.silhouette.values())).alias("silhouettes_in_range"), F.lit(len(sweep.silhouette)).alias("ks"))


@query()
def kmeans_profiles(spark, sf):
    """Profiles of the best clustering for k = 2 to 8."""
    sweep = M.kmeans_sweep(training(spark, sf), P.full_names())
    return M.cluster_profile(sweep.clustered)


def keyed_training(spark, sf):
    """Labelled records, one by one, with the columns that tell them apart."""
    rec = P.complete_cases(star.records(spark, sf), [*fixed.PROFILE, "bmi_value"]).where(F.col("diabetes_code").isin(1, 3))
    return P.full_matrix(P.labels(rec.withColumn("bmi", F.col("bmi_value").cast("double")), "diabetes_code"))


def _tree_sql(levels: int = 8, folds: int = 5, bins: int = 32) -> str:
    """Tree search level by level: t0..t4 leave a fold out, t5 has all rows; nodes are numbered from 1, children 2n and 2n + 1."""
    flags = [f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END" for c, values in P.FEATURE_LEVELS.items() for v in values] + ["bmi_value"]
    count = len(flags)
    deal = " + ".join(f"(r > (size*{k})//{folds})::INT" for k in range(1, folds))
    ctes = [f"""
d AS (SELECT row_number() OVER () AS id, CASE WHEN diabetes_code = 1 THEN 1 ELSE 0 END AS y, md5('7|' || l_orderkey || '|' || l_partkey) AS h,
  [{', '.join(f'CAST({f} AS DOUBLE)' for f in flags)}] AS x FROM {_COMPLETE})""", f"""
dealt AS MATERIALIZED (SELECT id, y, x, {deal} AS fold FROM (SELECT *, rank() OVER (PARTITION BY y ORDER BY h) AS r, count(*) OVER (PARTITION BY y) AS size FROM d))""", f"""
xs AS (SELECT f, v, count(*) AS n FROM (SELECT f, x[f + 1] AS v FROM dealt, range({count}) g(f)) GROUP BY 1, 2)""", """
xc AS (SELECT *, sum(n) OVER (PARTITION BY f ORDER BY v) AS c, sum(n) OVER (PARTITION BY f) AS t, count(*) OVER (PARTITION BY f) AS many, max(v) OVER (PARTITION BY f) AS top FROM xs)""", f"""
cuts AS MATERIALIZED (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS b FROM xc WHERE v < top AND (many <= {bins} OR (c*{bins})//t > ((c - n)*{bins})//t))""", f"""
cl AS (SELECT list(coalesce(v, []) ORDER BY f) AS l FROM range({count}) g(f) LEFT JOIN (SELECT f, list(v ORDER BY v) AS v FROM cuts GROUP BY 1) USING (f))""", f"""
p AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM (SELECT y, fold, list_transform(range({count}), lambda f: len(list_filter(l[f + 1], lambda c: c < x[f + 1]))) AS b, count(*) AS w FROM dealt, cl GROUP BY ALL))""", f"""
r0 AS (SELECT id, t, 1::BIGINT AS node FROM p, range({folds + 1}) g(t))"""]
    squares = "(({n} - {p})::DOUBLE*({n} - {p}) + {p}::DOUBLE*{p})/{n}"
    for i in range(levels):
        ctes.append(f"""
c{i} AS MATERIALIZED (SELECT t, node, f, b[f + 1] AS bin, CAST(sum(w) AS BIGINT) AS n, CAST(sum(w*y) AS BIGINT) AS pos FROM r{i} JOIN p USING (id), range({count}) g(f)
  WHERE t <> fold AND node >= {1 << i} GROUP BY 1, 2, 3, 4),
s{i} AS (SELECT *, CAST(sum(n) OVER u AS BIGINT) AS ln, CAST(sum(pos) OVER u AS BIGINT) AS lp, CAST(sum(n) OVER a AS BIGINT) AS an, CAST(sum(pos) OVER a AS BIGINT) AS ap FROM c{i}
  WINDOW u AS (PARTITION BY t, node, f ORDER BY bin), a AS (PARTITION BY t, node, f)),
v{i} AS (SELECT *, {squares.format(n='ln', p='lp')} + {squares.format(n='(an - ln)', p='(ap - lp)')} AS value, {squares.format(n='an', p='ap')} AS whole FROM s{i} WHERE ln < an),
b{i} AS MATERIALIZED (SELECT t, node, f, bin FROM v{i} WHERE value > whole QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY value DESC, f, bin) = 1),
r{i + 1} AS MATERIALIZED (SELECT id, r.t, CASE WHEN s.node IS NULL THEN r.node ELSE 2*r.node + (p.b[s.f + 1] > s.bin)::INT END AS node FROM r{i} r JOIN p USING (id) LEFT JOIN b{i} s ON s.t = r.t AND s.node = r.node)""")
    ctes.append(f"""
leaf AS MATERIALIZED (SELECT t, depth, node >> greatest(len(bin(node)) - 1 - depth, 0) AS leaf, coalesce(sum(w) FILTER (WHERE t <> fold), 0) AS n, coalesce(sum(w*y) FILTER (WHERE t <> fold), 0) AS pos,
  coalesce(sum(w) FILTER (WHERE t = fold), 0) AS hn, coalesce(sum(w*y) FILTER (WHERE t = fold), 0) AS hp FROM r{levels} JOIN p USING (id), range(1, {levels + 1}) g(depth) GROUP BY 1, 2, 3),
sc AS (SELECT t, depth, pos::DOUBLE/n AS prob, sum(hn) AS n, sum(hp) AS pos, count(*) AS leaves FROM leaf WHERE t < {folds} GROUP BY 1, 2, 3),
rk AS (SELECT *, sum(n) OVER (PARTITION BY t, depth ORDER BY prob) - (n - 1)/2.0 AS mid FROM sc),
auc AS MATERIALIZED (SELECT t AS fold, depth, CAST(sum(leaves) AS BIGINT) AS leaves, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(pos) AS BIGINT) AS positive_rows,
  (sum(mid*pos) - sum(pos)*(sum(pos) + 1)/2.0)::DOUBLE/(sum(pos)::DOUBLE*(sum(n) - sum(pos))) AS auc FROM rk GROUP BY 1, 2),
chosen AS (SELECT depth FROM (SELECT depth, avg(auc) AS a FROM auc GROUP BY 1) ORDER BY round(a, 12) DESC, depth LIMIT 1)""")
    return "WITH" + star.RECORDS + "," + ",".join(ctes)


_TREE = _tree_sql()
_TREE_NAMES = "[" + ", ".join(f"'{n}'" for n in P.full_names()) + "]"


@query(_TREE + " SELECT fold, depth, leaves, CAST(n_rows AS DOUBLE) AS n_rows, CAST(positive_rows AS DOUBLE) AS positive_rows, round(auc, 6) AS auc, CAST(depth = (SELECT depth FROM chosen) AS BIGINT) AS chosen FROM auc")
def tree_depth_search(spark, sf):
    """Leaves and held-out AUC of every fold and depth, and which depth is chosen."""
    found = trees.tree_search(keyed_training(spark, sf), "label", P.full_names(), ["l_orderkey", "l_partkey"])
    return found.folds.withColumn("chosen", F.col("depth") == found.depth)


@query(_TREE + """,
sp AS (""" + " UNION ALL ".join(f"SELECT * FROM b{i} WHERE t = 5" for i in range(8)) + f"""),
up AS (SELECT leaf >> i AS node, sum(n) AS n, sum(pos) AS pos FROM leaf, range(8) g(i) WHERE t = 5 AND depth = (SELECT depth FROM chosen) AND leaf >> i > 0 GROUP BY 1),
inn AS (SELECT node, {_TREE_NAMES}[sp.f + 1] AS feature, cuts.v AS cut FROM sp JOIN cuts ON cuts.f = sp.f AND cuts.b = sp.bin WHERE node < (1 << (SELECT depth FROM chosen)))
SELECT up.node, feature, round(cut, 6) AS cut, CAST(n AS DOUBLE) AS n_rows, CAST(pos AS DOUBLE) AS positive_rows, round(pos::DOUBLE/n, 6) AS probability FROM up LEFT JOIN inn USING (node)""")
def tree_nodes(spark, sf):
    """The tree of the chosen depth over all labelled records."""
    return trees.tree_search(keyed_training(spark, sf), "label", P.full_names(), ["l_orderkey", "l_partkey"]).tree


@query("""SELECT user_id AS enrollment_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS qualifying_activity_count FROM events
WHERE event_type IN ('view', 'click', 'purchase') AND user_id IN (SELECT o_custkey FROM orders) GROUP BY 1, 2""")
def stream_verified(spark, sf):
    """Check-ins read as a stream that delivers every event twice: validated, de-duplicated, written, counted."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    raw = star.activity(spark, sf).select("activity_id", "enrollment_id", "activity_type", "verified_flag").join(
        table(spark, sf, "events").select(F.col("event_id").alias("activity_id"), F.col("ts").cast("timestamp").alias("activity_ts")), "activity_id")
    raw.unionByName(raw).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema.simpleString()[7:-1].replace(":", " ")
    stream = T.read_checkins(spark, f"{root}/in", schema)
    clean = T.dedupe(T.valid_checkins(stream, star.enrollments(spark, sf), ("view", "click", "purchase")), "40 days")
    q = clean.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("enrollment_id", F.col("activity_ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("qualifying_activity_count"))
