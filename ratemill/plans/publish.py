"""Versioned publication on plain files, by any number of writers.

A run writes its source state, factors and rates under an attempt of its own and then makes the next entry of a numbered log, which is the
commit: of two writers who prepared from the same state one gets the number, the other takes new ids and tries the next one. Files hold no
ids that the log gives out (run, version, first factor number); readers add them from the log, so a retry writes nothing again. Readers join
through the log, so a run without a success entry does not exist for them, and a log position that a reader keeps is one state for
good. Version status and expiry are derived from the log, which is why closing the old version needs no update.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.operators.quality import ExpectationError, expect_one_active
from ratemill.operators.ranking import version_chain
from ratemill.session import broadcast_if_small
from ratemill.sources import commits
from ratemill.sources.files import path_exists

RUN_LOG = ("run_id int, run_type string, started_at date, completed_at date, status string, source_datasets string, "
           "rate_version_id int, notes string")
GIVEN = "attempt string, factors_before int, n_factors int"
STATE = "source_path string, content_hash string, byte_size bigint, observed_at timestamp, attempt string"
FACTOR = ("factor_no int, age_band string, gender string, smoking_status string, diabetes_status string, "
          "bmi_band string, mortality_multiplier decimal(6,3), attempt string")
RATE = "factor_no int, product_id int, base_rate decimal(12,2), attempt string"


def position(spark: SparkSession, root: str) -> int:
    """The last log entry; a reader that passes it on to the functions below keeps to one state."""
    return commits.position(spark, root)


def _log(spark: SparkSession, root: str, at: int | None) -> DataFrame:
    return commits.entries(spark, root, f"{RUN_LOG}, {GIVEN}", at)


def _read(spark: SparkSession, root: str, table: str, schema: str, at: int | None) -> DataFrame:
    """Rows of the committed runs, each with its run's log entry."""
    done = _log(spark, root, at).where("status = 'success'").select("attempt", "run_id", "rate_version_id", "factors_before")
    if not path_exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], schema).join(done, "attempt")
    return spark.read.schema(schema).parquet(f"{root}/{table}").join(done, "attempt")


def runs(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    return _log(spark, root, at).select(*[c.split()[0] for c in RUN_LOG.split(", ")])


def versions(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    """Rate versions with derived expiry and status."""
    done = runs(spark, root, at).where("status = 'success'")
    return version_chain(done.select("rate_version_id", F.col("started_at").alias("effective_date"),
                                     F.col("run_id").alias("created_by_run_id")))


def _factor_id():
    return (F.col("factor_no") + F.col("factors_before")).alias("risk_factor_id")


def factors(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    return _read(spark, root, "risk_factor", FACTOR, at).select(_factor_id(), *fixed.FACTOR_KEY, "mortality_multiplier", F.col("run_id").alias("derived_from_run_id"))


def rates(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    return _read(spark, root, "rate", RATE, at).select("rate_version_id", _factor_id(), "product_id", "base_rate")


def source_states(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    return _read(spark, root, "source_state", STATE, at).select(
        F.col("run_id").alias("source_state_id"), "source_path", "content_hash", "byte_size", "observed_at",
        F.col("run_id").alias("observed_by_run_id"))


def run_notes(cohort: int = fixed.DEFAULT_COHORT, loading: Decimal = fixed.LOADING,
              undiagnosed: Decimal = fixed.UNDIAGNOSED_FRACTION, model: str = "") -> str:
    """Parameters of a run as one readable line."""
    params = {"undiagnosed": undiagnosed, "loading": loading, "cohort": cohort, "baseline_year": fixed.BASELINE_YEAR,
              "smoking": ",".join(f"{k}:{v}" for k, v in fixed.SMOKING_RELATIVITY.items()),
              "bmi": ",".join(f"{k}:{v}" for k, v in fixed.BMI_RELATIVITY.items()), "model": model}
    return "; ".join(f"{k}={v}" for k, v in params.items())


def _next_ids(spark: SparkSession, root: str, at: int) -> tuple[int, int, int]:
    """The next run and version, and how many factors there are before them, as of a log position."""
    top = _log(spark, root, at).agg(F.max("run_id"), F.max("rate_version_id"), F.sum("n_factors")).first()
    return (top[0] or 0) + 1, (top[1] or 0) + 1, top[2] or 0


def _write(df: DataFrame, root: str, table: str, attempt: str) -> int:
    """Writes one attempt's part and returns the rows found on re-reading it."""
    path = f"{root}/{table}/attempt={attempt}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path).count()


@dataclass(frozen=True)
class Prepared:
    """A run whose tables are written but which no reader sees."""
    root: str
    attempt: str
    n_factors: int
    entry: dict
    first: bool


def prepare(spark: SparkSession, root: str, book: DataFrame, effective: date, *, n_factors: int, n_rates: int,
            sources: str = "", notes: str = "", state: Mapping | None = None, run_type: str = "manual",
            first: bool = False, fail_after_state: bool = False, artifacts: Mapping[str, DataFrame] | None = None) -> Prepared:
    """Writes the tables of a run (book: factor key, multiplier, product_id, base_rate). See ``publish``."""
    if not first:
        expect_one_active(versions(spark, root))
    attempt = f"a{uuid.uuid4().hex}"
    if state:
        row = (state["source_path"], state["content_hash"], int(state["byte_size"]))
        obs = spark.createDataFrame([row], "source_path string, content_hash string, byte_size bigint")
        _write(obs.withColumn("observed_at", F.current_timestamp()).coalesce(1), root, "source_state", attempt)
    if fail_after_state:
        raise RuntimeError("forced failure after the source state")
    # the factor grid is a fixed vocabulary product, so one ordered window numbers it
    grid = book.select(*fixed.FACTOR_KEY, "mortality_multiplier").distinct()
    numbered = grid.withColumn("factor_no", F.row_number().over(Window.orderBy(*fixed.FACTOR_KEY)))
    f = numbered.select("factor_no", *fixed.FACTOR_KEY, F.col("mortality_multiplier").cast("decimal(6,3)").alias("mortality_multiplier"))
    found = _write(f.coalesce(1), root, "risk_factor", attempt)
    if found != n_factors:
        raise ExpectationError(f"expected {n_factors} risk factors, wrote {found}")
    written = spark.read.parquet(f"{root}/risk_factor/attempt={attempt}")
    r = book.join(broadcast_if_small(written.select("factor_no", *fixed.FACTOR_KEY)), fixed.FACTOR_KEY).select(
        "factor_no", F.col("product_id").cast("int").alias("product_id"), F.col("base_rate").cast("decimal(12,2)").alias("base_rate"))
    found = _write(r, root, "rate", attempt)
    if found != n_rates:
        raise ExpectationError(f"expected {n_rates} rates, wrote {found}")
    for name, kept in (artifacts or {}).items():
        _write(kept, root, name, attempt)
    entry = {"run_type": run_type, "started_at": effective, "completed_at": effective, "status": "success", "source_datasets": sources, "notes": notes}
    return Prepared(root, attempt, n_factors, entry, first)


def commit(spark: SparkSession, prepared: Prepared) -> dict:
    """Makes a prepared run visible under the next free run and version; the ids follow whatever others have committed meanwhile."""
    given = {}

    def attempt(at: int, last: dict | None) -> dict:
        if not prepared.first:
            expect_one_active(versions(spark, prepared.root, at))
        run_id, version_id, before = _next_ids(spark, prepared.root, at)
        given.update(run_id=run_id, rate_version_id=version_id)
        return {**prepared.entry, **given, "attempt": prepared.attempt, "factors_before": before, "n_factors": prepared.n_factors}

    commits.committed(spark, prepared.root, attempt)
    return given


def publish(spark: SparkSession, root: str, book: DataFrame, effective: date, *, sources: str = "", run_type: str = "manual", **how) -> dict:
    """Publishes a rate book (factor key, multiplier, product_id, base_rate) as the new active version.

    ``n_factors`` and ``n_rates`` are what has to be found on re-reading. ``first`` allows the very first version; later ones need exactly
    one active version. ``artifacts`` are tables kept with the run, such as the model's profile and metrics. On any failure a failed run is
    logged and the error raised; nothing of the run becomes visible.
    """
    try:
        return commit(spark, prepare(spark, root, book, effective, sources=sources, run_type=run_type, **how))
    except Exception as error:
        log_failure(spark, root, effective, str(error), sources, run_type)
        raise


def log_failure(spark: SparkSession, root: str, started: date, reason: str, sources: str = "", run_type: str = "manual") -> int:
    """Logs a failed run, which takes a run id but no version."""
    def attempt(at: int, last: dict | None) -> dict:
        return {"run_id": _next_ids(spark, root, at)[0], "run_type": run_type, "started_at": started, "completed_at": started,
                "status": "failed", "source_datasets": sources, "notes": reason}

    at = commits.committed(spark, root, attempt)
    return commits.entry(spark, root, at)["run_id"]


def latest_artifact(spark: SparkSession, root: str, name: str, at: int | None = None) -> DataFrame | None:
    """The table of that name that the last successful run with one kept."""
    if not path_exists(spark, f"{root}/{name}"):
        return None
    kept = spark.read.parquet(f"{root}/{name}")
    done = _log(spark, root, at).where("status = 'success'").join(kept.select("attempt").distinct(), "attempt", "left_semi")
    last = done.agg(F.max_by("attempt", "run_id")).first()[0]
    return None if last is None else kept.where(F.col("attempt") == last).drop("attempt")


def changed(states: DataFrame, observed: DataFrame) -> DataFrame:
    """Whether the observed hash differs from the latest known one per path; an unknown path has changed."""
    latest = states.groupBy("source_path").agg(F.max_by("content_hash", "source_state_id").alias("known_hash"))
    return observed.join(latest, "source_path", "left").withColumn(
        "changed", ~F.col("content_hash").eqNullSafe(F.col("known_hash")))


def gate(new: DataFrame, baseline: DataFrame | None, tol: float = fixed.AUC_TOLERANCE) -> DataFrame:
    """One row: each metric with its baseline and whether it passed.

    ``new`` and ``baseline`` hold auc, min_spearman and violations. Without a baseline the new values become it
    and only the direction must be right. A new value that is null or not a number never passes.
    """
    n = new.select(F.col("auc").alias("new_auc"), F.col("min_spearman"), F.col("violations").alias("new_violations"))
    b = n.limit(0).select(F.lit(0.0).alias("base_auc"), F.lit(0).cast("long").alias("base_violations")) \
        if baseline is None else baseline.select(F.col("auc").alias("base_auc"), F.col("violations").alias("base_violations"))
    j = n.join(F.broadcast(b), F.lit(True), "left")
    def defined(name):
        return F.col(name).isNotNull() & ~F.isnan(name)

    passed = F.col("auc_passed") & F.col("direction_passed") & F.col("violations_passed")
    return j.withColumns({
        "min_auc": F.col("base_auc") - tol,
        "baseline_recorded": F.col("base_auc").isNull(),
        "auc_passed": defined("new_auc") & (F.col("base_auc").isNull() | F.coalesce(F.col("new_auc") >= F.col("base_auc") - tol, F.lit(False))),
        "direction_passed": defined("min_spearman") & F.coalesce(F.col("min_spearman") > 0, F.lit(False)),
        "violations_passed": F.col("new_violations").isNotNull() & (F.col("base_violations").isNull() | F.coalesce(F.col("new_violations") <= F.col("base_violations"), F.lit(False))),
    }).withColumn("passed", passed)


def outcome(changed_col, passed_col):
    """'unchanged', 'retrained' or 'gate_failed'."""
    return F.when(~changed_col, "unchanged").when(passed_col, "retrained").otherwise("gate_failed")
