"""The rate refresh: detect a changed source, stage, train, gate, derive, compose, publish."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.operators import aggregates as A
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators.sets import stratified_split
from ratemill.plans import models, pricing, publish
from ratemill.plans.staging import survey_records
from ratemill.session import cut_lineage


@dataclass
class RefreshResult:
    outcome: str
    run: dict | None
    gate: dict | None
    metrics: DataFrame | None


def probabilities(model, records: DataFrame, exercise: DataFrame) -> DataFrame:
    """Predicted probability per rating profile with exercise weighted out."""
    grid = J.profile_grid(records.sparkSession, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS,
                                                 "smoking_status": fixed.SMOKING_LEVELS, "bmi_band": fixed.BMI_LEVELS,
                                                 "exercise_freq": fixed.EXERCISE_LEVELS})
    scored = models.score_grid(model, grid, A.representatives(records, "bmi_band", "bmi_value"))
    keys = ["age_band", "gender", "smoking_status", "bmi_band"]
    return A.marginalise(scored, keys, "exercise_freq", "probability", exercise)


def run_refresh(spark: SparkSession, root: str, raw_survey: DataFrame, key: str, mortality: DataFrame, products: DataFrame,
                effective: date, state: dict, baseline_metrics: DataFrame | None = None,
                cohort: int = fixed.DEFAULT_COHORT, loading: Decimal = fixed.LOADING,
                undiagnosed: Decimal = fixed.UNDIAGNOSED_FRACTION, first: bool = False) -> RefreshResult:
    """One refresh run.

    raw_survey: coded respondents with a row ``key``; mortality: the long staging table (source_year, age_band,
    gender, condition_flag, mortality_rate, life_expectancy); state: path, hash and size of the observed source.

    A source whose hash is already known is not retrained: the book is derived and published from the profile that
    the last passing run kept. A new model must pass the gate, by default against the metrics kept with that profile;
    on a pass its profile and metrics are kept with the published run, else the run is logged as failed. Any error is
    logged as a failed run and raised.
    """
    try:
        return _refresh(spark, root, raw_survey, key, mortality, products, effective, state, baseline_metrics, cohort, loading, undiagnosed, first)
    except _Logged as error:
        raise error.__cause__ from None
    except Exception as error:
        publish.log_failure(spark, root, effective, str(error), state.get("source_path", ""))
        raise


class _Logged(Exception):
    """Carries an error that the publication has logged itself."""


def check_parameters(products: DataFrame, loading: Decimal, undiagnosed: Decimal) -> None:
    if not loading > 0:
        raise ValueError(f"loading must be positive, not {loading}")
    if not 0 <= undiagnosed <= 1:
        raise ValueError(f"undiagnosed share must lie in 0..1, not {undiagnosed}")
    known = sorted(fixed.PRODUCT_FACTORS)
    found = products.agg(F.count(F.lit(1)), F.count_if(F.col("product_id").isin(known)), F.countDistinct("product_id")).first()
    if tuple(found) != (len(known),) * 3:
        raise ValueError(f"products must be just {known}")


def _trained(raw_survey: DataFrame, records: DataFrame, key: str, mortality: DataFrame, baseline: DataFrame, ratio: DataFrame):
    """The final model and its gate metrics.

    Respondents are reduced to their distinct profiles by split, once; fits, scores and metrics weigh these by their rows.
    """
    frame = P.labels(P.complete_cases(records, [*fixed.PROFILE, "bmi_value"]).where(
        F.col("diabetes_code").isin(1, 3, 4)).withColumn("bmi", F.col("bmi_value")), "diabetes_code")
    primary = frame.where("label is not null")
    split = stratified_split(primary, "label", [key])
    names = P.dummy_names()
    features = ["label", "bmi", "age_band", "gender", "smoking_status", "exercise_freq"]

    parts = P.dummy_matrix(models.compress(split, [*features, "split"]))
    whole = P.dummy_matrix(cut_lineage(parts.groupBy(*features).agg(F.sum(models.WEIGHT).alias(models.WEIGHT))))
    held_out = models.score(models.fit_logit(parts.where("split = 'train'"), "label", names), parts.where("split = 'test'"), names)
    metrics = models.classification_metrics(held_out, "label", "probability", models.WEIGHT)
    final = models.fit_logit(whole, "label", names)
    validation = models.external_validation(models.score(final, whole, names), ratio, baseline, weight=models.WEIGHT)
    return final, models.gate_input(metrics, validation)


def _refresh(spark, root, raw_survey, key, mortality, products, effective, state, baseline_metrics, cohort, loading, undiagnosed, first) -> RefreshResult:
    check_parameters(products, loading, undiagnosed)
    observed = spark.createDataFrame([(state["source_path"], state["content_hash"], int(state["byte_size"]))],
                                     "source_path string, content_hash string, byte_size bigint")
    is_new = publish.changed(publish.source_states(spark, root), observed).first()["changed"]
    profile = None if is_new else publish.latest_artifact(spark, root, "model_profile")
    records = survey_records(raw_survey)
    counts = cut_lineage(A.profile_counts(records))
    exercise = A.marginal_shares(counts, "exercise_freq", fixed.EXERCISE_LEVELS, weight="n")
    baseline = mortality.where((F.col("condition_flag") == "BASELINE") & (F.col("source_year") == fixed.BASELINE_YEAR))
    ratio = pricing.condition_ratio(mortality, cohort)
    outcome, verdict, bundle, artifacts = "unchanged", None, None, None
    if profile is None:
        final, bundle = _trained(raw_survey, records, key, mortality, baseline, ratio)
        bundle = cut_lineage(bundle)
        against = baseline_metrics if baseline_metrics is not None else publish.latest_artifact(spark, root, "model_metrics")
        verdict = publish.gate(bundle, against).first().asDict()
        if not verdict["passed"]:
            publish.log_failure(spark, root, effective, f"gate failed: {verdict}", state["source_path"])
            return RefreshResult("gate_failed", None, verdict, bundle)
        profile = cut_lineage(probabilities(final, records, exercise))
        outcome, artifacts = "retrained", {"model_profile": profile, "model_metrics": bundle}
    cells = pricing.rating_cells(baseline, A.prevalence(counts, ["age_band", "gender"], weight="n"), ratio)
    factors = pricing.risk_factors(cells, profile, undiagnosed)
    book = pricing.rate_book(factors, pricing.product_factors(products), loading)
    n_factors = len(fixed.AGE_LABELS) * len(fixed.GENDERS) * len(fixed.SMOKING_LEVELS) * len(fixed.BMI_LEVELS) * 2
    try:
        run = publish.publish(spark, root, book, effective, n_factors=n_factors, n_rates=n_factors * products.count(),
                              sources=state["source_path"], notes=publish.run_notes(cohort, loading, undiagnosed),
                              state=state if is_new else None, first=first, artifacts=artifacts)
    except Exception as error:
        raise _Logged from error
    return RefreshResult(outcome, run, verdict, bundle)
