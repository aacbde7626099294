"""Published pricing values, rate-book shape, publication and the refresh run."""

from datetime import date
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators.quality import ExpectationError
from ratemill.plans import pricing, publish, refresh

# Population baseline per band, male then female.
BASELINE = {
    "18-24": ("0.001287", "0.000477"), "25-29": ("0.001781", "0.000696"), "30-34": ("0.002298", "0.001017"), "35-39": ("0.002771", "0.001358"),
    "40-44": ("0.003432", "0.001851"), "45-49": ("0.004302", "0.002463"), "50-54": ("0.005968", "0.003576"), "55-59": ("0.008949", "0.005389"),
    "60-64": ("0.013236", "0.008208"), "65-69": ("0.018777", "0.011751"), "70-74": ("0.026642", "0.017873"), "75-79": ("0.041223", "0.029835"),
    "80-99": ("0.109587", "0.093825"),
}
# Condition and all-cause rates per coarse group, female then male.
COHORT = {
    "15-24": ("0.000005", "0.000410", "0.000007", "0.001062"), "25-34": ("0.000019", "0.000866", "0.000030", "0.002021"),
    "35-44": ("0.000045", "0.001616", "0.000076", "0.003075"), "45-54": ("0.000119", "0.003110", "0.000219", "0.005237"),
    "55-64": ("0.000276", "0.007045", "0.000508", "0.011386"), "65-74": ("0.000564", "0.014862", "0.000945", "0.022630"),
    "75-84": ("0.001130", "0.038490", "0.001767", "0.051639"), "85+": ("0.002417", "0.134781", "0.003499", "0.153696"),
}


def mortality(spark):
    rows = [(2023, b, g, "BASELINE", D(r), None) for b, (m, f) in BASELINE.items() for g, r in (("M", m), ("F", f))]
    for grp, (fc, fa, mc, ma) in COHORT.items():
        rows += [(2023, grp, "F", "DIABETES", D(fc), None), (2023, grp, "F", "ALLCAUSE", D(fa), None),
                 (2023, grp, "M", "DIABETES", D(mc), None), (2023, grp, "M", "ALLCAUSE", D(ma), None)]
    return spark.createDataFrame(rows, "source_year int, age_band string, gender string, condition_flag string, "
                                       "mortality_rate decimal(8,6), life_expectancy decimal(5,2)")


def book(spark, p=0.12, prob=0.1):
    m = mortality(spark)
    base = m.where("condition_flag = 'BASELINE'")
    special = {("45-49", "M"): 0.11004127, ("55-59", "M"): 0.18634583}
    prev = spark.createDataFrame([(b, g, special.get((b, g), p)) for b in fixed.AGE_LABELS for g in fixed.GENDERS], "age_band string, gender string, prevalence double")
    cells = pricing.rating_cells(base, prev, pricing.condition_ratio(m, 2023))
    grid = J.profile_grid(spark, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS, "bmi_band": fixed.BMI_LEVELS})
    factors = pricing.risk_factors(cells, grid.withColumn("probability", F.lit(prob)))
    products = pricing.product_factors(spark.createDataFrame([(i,) for i in range(1, 16)], "product_id int"))
    return cells, factors, pricing.rate_book(factors, products)


def test_published_values(spark):
    cells, factors, rates = book(spark)
    rr = {(r["age_band"], r["gender"]): r["rr"] for r in cells.collect()}
    assert rr[("45-49", "M")] == pytest.approx(1.396604722997, abs=1e-7)
    assert rr[("55-59", "M")] == pytest.approx(1.250608026670, abs=1e-7)
    assert factors.count() == 624 and rates.count() == 9360
    def cell(age, smoke, bmi, product):
        return rates.where((F.col("age_band") == age) & (F.col("gender") == "M") & (F.col("smoking_status") == smoke) & (F.col("bmi_band") == bmi)
                           & (F.col("diabetes_status") == "yes") & (F.col("product_id") == product)).first()
    a, b = cell("45-49", "never", "normal", 3), cell("55-59", "current", "obese", 3)
    assert (a["mortality_multiplier"], a["base_rate"]) == (D("1.338"), D("9.93"))
    assert (b["mortality_multiplier"], b["base_rate"]) == (D("3.710"), D("57.27"))


def test_relative_risk_inverts(spark):
    df = spark.createDataFrame([(0.004, p, f) for p in (0.02, 0.1, 0.3) for f in (0.01, 0.04, 0.2)], "m double, p double, f double")
    out = pricing.relative_risk(df).withColumn("back", pricing.prevalence_for_rr(F.col("rr"), F.col("f"))).collect()
    for r in out:
        assert r["back"] == pytest.approx(r["p"])
        assert r["p"] * r["md"] + (1 - r["p"]) * r["mn"] == pytest.approx(r["m"])
        assert r["p"] * (r["md"] - r["mn"]) == pytest.approx(r["f"] * r["m"])


def test_cohort_comparison(spark):
    rows = [("a", "F", 2024, 0.3), ("a", "F", 2023, 0.1), ("a", "M", 2024, 0.1), ("a", "M", 2023, 0.15), ("b", "F", 2024, 0.2), ("b", "F", 2023, 0.2), ("c", "F", 2023, 0.9)]
    r = A.cohort_compare(spark.createDataFrame(rows, "age_band string, gender string, y int, v double"), ["age_band", "gender"], "y", "v", 2024, 2023).first()
    assert (r["higher"], r["lower"], r["equal"], r["max_at"]) == (1, 1, 1, "a|F")
    assert r["mean_abs_diff"] == pytest.approx(0.25 / 3)


def test_out_of_range_and_unknown_product_raise(spark):
    cells = spark.createDataFrame([("18-24", "F", D("0.000001"), 900.0, 1.5)], "age_band string, gender string, m decimal(8,6), mn double, rr double")
    probs = spark.createDataFrame([("18-24", "F", "never", "normal", 0.1)], "age_band string, gender string, smoking_status string, bmi_band string, probability double")
    with pytest.raises(Exception, match="multiplier out of range"):
        pricing.risk_factors(cells, probs).collect()
    with pytest.raises(Exception, match="no factor for product"):
        pricing.product_factors(spark.createDataFrame([(16,)], "product_id int")).collect()


def test_marginal_checks(spark):
    df = spark.createDataFrame([("yes",)] * 3, "x string")
    with pytest.raises(Exception, match="does not hold exactly"):
        A.marginal_shares(df, "x", ["no", "yes"]).collect()
    w = spark.createDataFrame([("yes", 0.770203), ("no", 0.229797)], "e string, share double")
    p = spark.createDataFrame([("a", "yes", 0.1), ("a", "no", 0.2)], "k string, e string, p double")
    assert A.marginalise(p, ["k"], "e", "p", w).first()["p"] == pytest.approx(0.1229797)
    with pytest.raises(Exception, match="lacks a level"):
        A.marginalise(p.where("e = 'no'"), ["k"], "e", "p", w).collect()


def small_book(spark, base="1.00"):
    rows = [("18-24", g, "never", d, "normal", pid, D("1.100"), D(base)) for g in "FM" for d in ("yes", "no") for pid in (1, 2)]
    return spark.createDataFrame(rows, "age_band string, gender string, smoking_status string, diabetes_status string, bmi_band string, product_id int, "
                                       "mortality_multiplier decimal(6,3), base_rate decimal(12,2)")


STATE = {"source_path": "survey.csv", "content_hash": "a" * 64, "byte_size": 10}


def test_publication(spark, folder):
    size = dict(n_factors=4, n_rates=8)
    with pytest.raises(ExpectationError, match="one active"):
        publish.publish(spark, folder, small_book(spark), date(2024, 1, 1), **size)
    publish.publish(spark, folder, small_book(spark, "1.00"), date(2024, 1, 1), first=True, state=STATE, **size)
    before = sorted(map(tuple, publish.rates(spark, folder).collect()))
    # forced failure after the state row, and a count mismatch: nothing may become visible
    with pytest.raises(RuntimeError):
        publish.publish(spark, folder, small_book(spark, "2.00"), date(2024, 2, 1), state={**STATE, "content_hash": "b" * 64}, fail_after_state=True, **size)
    with pytest.raises(ExpectationError, match="rates"):
        publish.publish(spark, folder, small_book(spark, "2.00"), date(2024, 2, 1), n_factors=4, n_rates=9)
    assert sorted(map(tuple, publish.rates(spark, folder).collect())) == before
    assert publish.source_states(spark, folder).count() == 1
    assert [r["status"] for r in publish.runs(spark, folder).orderBy("run_id").collect()] == ["failed", "success", "failed", "failed"]
    done = publish.publish(spark, folder, small_book(spark, "3.00"), date(2024, 3, 1), state={**STATE, "content_hash": "c" * 64}, **size)
    v = publish.versions(spark, folder).orderBy("rate_version_id").collect()
    assert [(r["rate_version_id"], r["status"], r["expiry_date"]) for r in v] == [(1, "superseded", date(2024, 3, 1)), (2, "active", None)]
    assert done["rate_version_id"] == 2
    active = J.active_rate_book(publish.versions(spark, folder), publish.factors(spark, folder), publish.rates(spark, folder))
    assert {r["base_rate"] for r in active.collect()} == {D("3.00")} and active.count() == 8
    observed = spark.createDataFrame([("survey.csv", "c" * 64), ("survey.csv", "d" * 64), ("new.csv", "c" * 64)], "source_path string, content_hash string")
    assert sorted((r["source_path"], r["content_hash"][0], r["changed"]) for r in publish.changed(publish.source_states(spark, folder), observed).collect()) == [
        ("new.csv", "c", True), ("survey.csv", "c", False), ("survey.csv", "d", True)]


@pytest.mark.parametrize("auc,spear,viol,passed", [(0.75, 0.1, 1, True), (0.731, 0.1, 1, True), (0.729, 0.1, 1, False), (0.9, 0.0, 0, False), (0.9, 0.5, 2, False)])
def test_gate(spark, auc, spear, viol, passed):
    schema = "auc double, min_spearman double, violations long"
    new, base = spark.createDataFrame([(auc, spear, viol)], schema), spark.createDataFrame([(0.75, 0.3, 1)], schema)
    assert publish.gate(new, base).first()["passed"] is passed


@pytest.mark.parametrize("auc,spear,viol", [(None, 0.1, 0), (float("nan"), 0.1, 0), (0.9, None, 0), (0.9, float("nan"), 0), (0.9, 0.1, None)])
@pytest.mark.parametrize("with_base", [True, False])
def test_undefined_metrics_fail(spark, auc, spear, viol, with_base):
    schema = "auc double, min_spearman double, violations long"
    base = spark.createDataFrame([(0.75, 0.3, 1)], schema) if with_base else None
    assert publish.gate(spark.createDataFrame([(auc, spear, viol)], schema), base).first()["passed"] is False


def test_failure_reason_is_whole(spark, folder):
    publish.log_failure(spark, folder, date(2026, 1, 1), "x" * 2000)
    assert len(publish.runs(spark, folder).first()["notes"]) == 2000


def test_first_gate_records_a_baseline(spark):
    new = spark.createDataFrame([(0.6, 0.1, 5)], "auc double, min_spearman double, violations long")
    r = publish.gate(new, None).first()
    assert r["passed"] and r["baseline_recorded"]
    out = spark.createDataFrame([(False, False), (True, True), (True, False)], "c boolean, p boolean")
    assert [r[0] for r in out.select(publish.outcome(F.col("c"), F.col("p"))).collect()] == ["unchanged", "retrained", "gate_failed"]


def test_notes_name_every_parameter():
    text = publish.run_notes(2024, D("1.40"), D("0.10"), "grid")
    assert "loading=1.40" in text and "cohort=2024" in text and "current:2.30" in text


def survey(spark, n=6000, slope=0.25):
    rng = np.random.default_rng(4)
    age, sex = rng.integers(1, 14, n), rng.integers(1, 3, n)
    bmi = rng.integers(1500, 4500, n)
    yes = rng.random(n) < 1 / (1 + np.exp(4.0 - slope * age - 0.0004 * (bmi - 2500)))
    return spark.createDataFrame(pd.DataFrame({
        "k": np.arange(n), "diabetes_code": np.where(yes, 1.0, 3.0), "smoker_code": rng.integers(1, 5, n).astype(float), "activity_code": rng.integers(1, 3, n).astype(float),
        "bmi_implied": bmi.astype(float), "bmi_code": np.select([bmi < 1850, bmi < 2500, bmi < 3000], [1.0, 2.0, 3.0], 4.0), "age_code": age.astype(float), "sex_code": sex.astype(float)}))


def test_refresh_end_to_end(spark, folder):
    products = spark.createDataFrame([(i,) for i in range(1, 16)], "product_id int")
    args = (mortality(spark), products, date(2026, 1, 1))
    first = refresh.run_refresh(spark, folder, survey(spark), "k", *args, STATE, first=True)
    assert first.outcome == "retrained" and first.run == {"run_id": 1, "rate_version_id": 1}
    assert publish.rates(spark, folder).count() == 9360 and publish.factors(spark, folder).count() == 624
    again = refresh.run_refresh(spark, folder, survey(spark), "k", *args, STATE)
    assert again.outcome == "unchanged" and again.run == {"run_id": 2, "rate_version_id": 2}
    rates = publish.rates(spark, folder).groupBy("rate_version_id").agg(F.count(F.lit(1)).alias("n"), F.sum("base_rate").alias("total")).orderBy("rate_version_id").collect()
    assert [r["n"] for r in rates] == [9360, 9360] and rates[0]["total"] == rates[1]["total"]
    worse = refresh.run_refresh(spark, folder, survey(spark, slope=0.0), "k", *args, {**STATE, "content_hash": "f" * 64})
    assert worse.outcome == "gate_failed"
    assert publish.versions(spark, folder).count() == 2
    with pytest.raises(ValueError, match="loading"):
        refresh.run_refresh(spark, folder, survey(spark), "k", *args, STATE, loading=D("0"))
    with pytest.raises(ValueError, match="products"):
        refresh.run_refresh(spark, folder, survey(spark), "k", mortality(spark), products.limit(3), date(2026, 1, 1), STATE)
    assert publish.runs(spark, folder).where("status = 'failed'").count() == 3
