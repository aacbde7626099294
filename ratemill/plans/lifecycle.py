"""Quote, bind, renew and wellness requests as batches: accepted rows and rejected rows with a reason."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import money
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators.ranking import anniversaries, as_of_version
from ratemill.session import spread


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The first reason whose condition holds (null counts as holding), else null."""
    out = F.when(F.coalesce(checks[0][0], F.lit(True)), checks[0][1])
    for cond, reason in checks[1:]:
        out = out.when(F.coalesce(cond, F.lit(True)), reason)
    return out


def _split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    judged = df.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def quote(requests: DataFrame, customers: DataFrame, book: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prices requests under the active book.

    requests: application_id, customer_id, product_id, applicant_age, gender, smoking_status, diabetes_status,
    bmi_value, face_amount.
    """
    known = customers.select("customer_id", F.lit(True).alias("_known"))
    r = requests.withColumns({"age_band": R.age_band("applicant_age"), "bmi_band": R.bmi_band("bmi_value")})
    r = J.active_profile_rate(r.join(known, "customer_id", "left"), book, "left")
    complete = (F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("applicant_age").isNotNull()
                & F.col("bmi_value").isNotNull() & F.col("face_amount").isin(*fixed.FACE_AMOUNTS)
                & F.col("gender").isin(*fixed.GENDERS) & F.col("smoking_status").isin(*fixed.SMOKING_LEVELS)
                & F.col("diabetes_status").isin("yes", "no"))
    reason = first_reason((~complete, "incomplete profile"), (F.col("age_band").isNull(), "age out of range"),
                          (F.col("_known").isNull(), "unknown customer"), (F.col("base_rate").isNull(), "no current rate"))
    ok, bad = _split(r, reason)
    priced = ok.drop("_known").withColumns({"quoted_premium": money.premium("base_rate", "face_amount"),
                                            "status": F.lit("quoted")})
    return priced, bad.select(*requests.columns, "reason")


def bind(quotes: DataFrame, contracts: DataFrame, on: date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New contracts pinned to the quoted version, the applications after binding, and refusals."""
    ok, bad = _split(quotes, first_reason((F.col("status") != "quoted", "not available to bind")))
    ids = A.next_ids(ok, contracts, "contract_id", "application_id")
    new = ids.select("contract_id", F.concat(F.lit("POL-"), F.col("contract_id").cast("string")).alias("contract_number"),
                     F.lit("Active").alias("activity_status"), F.col("quoted_premium").alias("modal_premium"),
                     "product_id", F.col("rate_version_id").alias("issued_rate_version_id"),
                     F.lit(on).alias("effective_date"), F.lit(None).cast("date").alias("expiry_date"), "application_id")
    after = quotes.withColumn("status", F.when(F.col("status") == "quoted", "bound").otherwise(F.col("status")))
    return new, after, bad


def renew(requests: DataFrame, contracts: DataFrame, applications: DataFrame, enrollments: DataFrame,
          improvements: DataFrame, book: DataFrame, renewals: DataFrame,
          credit_scale: int = 6) -> tuple[DataFrame, DataFrame]:
    """Reprices (contract_id, renewal_date) requests under the active book; contracts stay as issued.

    The premium uses the credit at six digits, the stored percentage has two. Credits are asked for by request and
    enrollment alone, so the long chain of lookups runs once.
    """
    c = contracts.select("contract_id", "application_id", "issued_rate_version_id")
    a = applications.select("application_id", F.lit(True).alias("_app"), *fixed.FACTOR_KEY, "product_id", "face_amount")
    e = enrollments.select("contract_id", "enrollment_id")
    requested = requests.select("contract_id", "renewal_date").distinct()
    done = renewals.select("contract_id", "renewal_date", F.lit(True).alias("_done")).distinct()
    r = requested.join(c.withColumn("_contract", F.lit(True)), "contract_id", "left")
    r = J.left_join_spreading_nulls(r, a, "application_id", "contract_id").join(e, "contract_id", "left")
    r = r.join(done, ["contract_id", "renewal_date"], "left")
    r = J.active_profile_rate(r, book, "left")
    reason = first_reason((F.col("renewal_date").isNull(), "invalid date"), (F.col("_contract").isNull(), "contract not found"),
                          (F.col("_app").isNull(), "no application"), (F.col("_done").isNotNull(), "already renewed"),
                          (F.col("base_rate").isNull(), "no rate for profile"))
    ok, bad = _split(r, reason)
    credit = A.wellness_credit(improvements, requested.join(e, "contract_id"), scale=credit_scale)
    ok = J.left_join_spreading_nulls(ok, credit, "enrollment_id", "contract_id", ["renewal_date"])
    zero = F.lit(0).cast(f"decimal({credit_scale + 3},{credit_scale})")
    ok = ok.withColumn("credit_pct", F.coalesce("credit_pct", zero)).withColumn(
        "base_premium", money.premium_3dp("base_rate", "face_amount"))
    out = ok.select("contract_id", "renewal_date", F.col("rate_version_id").alias("new_rate_version_id"), "base_premium",
                    F.col("credit_pct").cast("decimal(5,2)").alias("wellness_discount_pct"),
                    money.renewal_premium("base_premium", "credit_pct").alias("final_premium"))
    return out, bad.select("contract_id", "renewal_date", "reason")


def worklist(renewals: DataFrame, lo: date, hi: date) -> DataFrame:
    return renewals.where((F.col("renewal_date") >= F.lit(lo)) & (F.col("renewal_date") < F.lit(hi)))


def historical_renewals(contracts: DataFrame, enrollments: DataFrame, improvements: DataFrame, versions: DataFrame,
                        as_of: date) -> DataFrame:
    """Every past anniversary with its credit (measures from enrollment on), version in force and premium."""
    a = anniversaries(contracts.select("contract_id", "effective_date", "expiry_date", "modal_premium"), as_of)
    rows = a.count()
    a = spread(a, rows, "contract_id").join(enrollments.select("contract_id", "enrollment_id"), "contract_id", "left")
    credit = A.wellness_credit(improvements, a, enrollments=enrollments)
    a = J.left_join_spreading_nulls(a, credit, "enrollment_id", "contract_id", ["renewal_date"], rows).withColumn(
        "credit_pct", F.coalesce("credit_pct", F.lit(0).cast("decimal(5,2)")))
    a = as_of_version(a, "renewal_date", versions)
    return a.select("contract_id", "renewal_date", F.col("rate_version_id").alias("new_rate_version_id"),
                    F.col("credit_pct").alias("wellness_discount_pct"),
                    money.renewal_premium("modal_premium", "credit_pct").alias("final_premium"))


def pin_audit(contracts: DataFrame, version_id) -> DataFrame:
    return contracts.where(F.col("issued_rate_version_id") == version_id).select(
        "contract_id", "contract_number", "effective_date", "expiry_date", "modal_premium", "issued_rate_version_id")


def projection(contracts: DataFrame, applications: DataFrame, enrollments: DataFrame, rollup: DataFrame,
               improvements: DataFrame, book: DataFrame, renewals: DataFrame, as_of: date) -> DataFrame:
    """Per policy: this year's activity, credit, base and projected premium a year ahead, and whether that
    renewal exists already. Policies whose profile has no active rate are left out."""
    nxt = F.add_months(F.lit(as_of), 12)
    a = applications.select("application_id", *fixed.FACTOR_KEY, "product_id", "face_amount")
    p = contracts.select("contract_id", "contract_number", "application_id").join(a, "application_id")
    p = p.join(enrollments.select("contract_id", "enrollment_id"), "contract_id", "left")
    p = J.active_profile_rate(p, book).withColumn("renewal_date", nxt)
    credit = A.wellness_credit(improvements, enrollments.select("enrollment_id").withColumn("renewal_date", nxt), scale=6)
    year = rollup.where(F.col("activity_period") == as_of.year).groupBy("enrollment_id").agg(
        F.sum("qualifying_activity_count").alias("activities"))
    p = J.left_join_spreading_nulls(p, credit, "enrollment_id", "contract_id", ["renewal_date"])
    p = J.left_join_spreading_nulls(p, year, "enrollment_id", "contract_id")
    have = renewals.groupBy("contract_id", "renewal_date").agg(F.max("renewal_id").alias("existing_renewal_id"))
    p = p.join(have, ["contract_id", "renewal_date"], "left")
    credit_pct = F.coalesce("credit_pct", F.lit(0).cast("decimal(9,6)"))
    base = money.premium_3dp("base_rate", "face_amount")
    return p.select("contract_id", "contract_number", "renewal_date", "enrollment_id",
                    F.coalesce("activities", F.lit(0)).alias("activities"), credit_pct.cast("decimal(5,2)").alias("credit_pct"),
                    base.alias("base_premium"), money.renewal_premium(base, credit_pct).alias("projected_premium"),
                    "existing_renewal_id")


def enrollments(requests: DataFrame, existing: DataFrame, programs: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Enrollment requests (contract_id, program_id, enroll_date text): one per contract, known program,
    dated before the projected renewal a year ahead."""
    e = existing.select("contract_id", F.lit(True).alias("_has")).distinct()
    p = programs.select("program_id", F.lit(True).alias("_program"))
    r = requests.withColumn("_date", R.iso_date("enroll_date")).join(e, "contract_id", "left").join(p, "program_id", "left")
    reason = first_reason((F.col("contract_id").isNull() | F.col("program_id").isNull() | F.col("_date").isNull(), "invalid request"),
                          (F.col("_has").isNotNull(), "already enrolled"), (F.col("_program").isNull(), "unknown program"),
                          (F.col("_date") >= F.add_months(F.lit(as_of), 12), "after projected renewal"))
    ok, bad = _split(r, reason)
    # of several valid requests for one contract the earliest is taken
    first = ok.groupBy("contract_id").agg(F.min(F.struct("_date", "program_id")).alias("_first"))
    taken = first.select("contract_id", "_first.program_id", F.col("_first._date").alias("enroll_date"),
                         F.lit("Active").alias("status"))
    repeated = ok.join(first, "contract_id").where(F.struct("_date", "program_id") != F.col("_first")).withColumn(
        "reason", F.lit("repeated request"))
    out = ["contract_id", "program_id", "enroll_date", "reason"]
    return taken, bad.select(*out).unionByName(repeated.select(*out))


def screenings(requests: DataFrame, existing: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Screening requests: known enrollment and measure, positive baseline, enroll date <= date < projected
    renewal; accepted rows get the improvement percent."""
    e = existing.select("enrollment_id", "enroll_date")
    r = requests.join(e, "enrollment_id", "left")
    valid = (F.lower("measure_type").isin(*fixed.MEASURE_TYPES) & (F.col("baseline_value") > 0) & (F.col("measure_value") >= 0))
    inside = (F.col("measure_date") >= F.col("enroll_date")) & (F.col("measure_date") < F.add_months(F.lit(as_of), 12))
    reason = first_reason((~valid, "invalid measure"), (F.col("enroll_date").isNull(), "unknown enrollment"),
                          (~inside, "outside the credit window"))
    ok, bad = _split(r, reason)
    pct = money.improvement_pct("measure_type", "baseline_value", "measure_value")
    return ok.withColumn("improvement_pct", pct).drop("enroll_date"), bad.drop("enroll_date")


def allowed_types(df: DataFrame, col: str = "activity_type", allowed=tuple(fixed.ACTIVITY_TYPES)) -> DataFrame:
    return df.where(F.col(col).isin(*allowed))


def dashboard(versions: DataFrame, contracts: DataFrame, summary: DataFrame, baseline: DataFrame, rollup: DataFrame,
              enrolled: DataFrame, runs: DataFrame, states: DataFrame) -> dict[str, DataFrame]:
    """The five dashboard tables and the tiles."""
    return {
        "versions": J.pinned_per_version(versions, contracts).orderBy("rate_version_id"),
        "prevalence": A.mean_prevalence(summary),
        "mortality": baseline.orderBy(R.ordinal("age_band", fixed.AGE_LABELS), "gender"),
        "participation": A.participation(rollup, enrolled).orderBy("activity_period"),
        "runs": history(runs, states),
        "tiles": A.tiles(versions, runs, rollup),
    }


def history(runs: DataFrame, states: DataFrame) -> DataFrame:
    """Refresh runs, newest first, with the source state they observed."""
    return J.run_history(runs, states).orderBy(F.col("run_id").desc())
