"""Quote, bind, renew and wellness requests on small fixtures."""

import re
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from ratemill.plans import lifecycle as L

REQ = ("application_id long, customer_id long, product_id int, applicant_age int, gender string, smoking_status string, diabetes_status string, "
       "bmi_value decimal(5,2), face_amount decimal(12,2)")
BOOK = ("rate_version_id int, age_band string, gender string, smoking_status string, diabetes_status string, bmi_band string, product_id int, "
        "base_rate decimal(12,2), mortality_multiplier decimal(6,3)")


def book(spark):
    return spark.createDataFrame([(9, "45-49", "M", "never", "yes", "normal", 3, D("9.93"), D("1.338"))], BOOK)


def ask(spark, **over):
    row = dict(application_id=1, customer_id=1, product_id=3, applicant_age=45, gender="M", smoking_status="never", diabetes_status="yes",
               bmi_value=D("22.00"), face_amount=D("250000")) | over
    return tuple(row.values())


def test_quote(spark):
    reqs = [ask(spark), ask(spark, application_id=2, face_amount=D("123")), ask(spark, application_id=3, applicant_age=17), ask(spark, application_id=4, customer_id=77),
            ask(spark, application_id=5, gender="F"), ask(spark, application_id=6, diabetes_status="gest"), ask(spark, application_id=7, bmi_value=None)]
    ok, bad = L.quote(spark.createDataFrame(reqs, REQ), spark.createDataFrame([(1,)], "customer_id long"), book(spark))
    row = ok.first()
    assert ok.count() == 1 and row["quoted_premium"] == D("2482.50") and (row["age_band"], row["bmi_band"]) == ("45-49", "normal")
    assert {r["application_id"]: r["reason"] for r in bad.collect()} == {
        2: "incomplete profile", 3: "age out of range", 4: "unknown customer", 5: "no current rate", 6: "incomplete profile", 7: "incomplete profile"}


CONTRACT = ("contract_id long, contract_number string, activity_status string, modal_premium decimal(12,2), product_id int, issued_rate_version_id int, "
            "effective_date date, expiry_date date, application_id long")


def contracts(spark):
    return spark.createDataFrame([(10, "C10", "Active", D("1.00"), 3, 4, date(2023, 1, 1), None, 1), (11, "C11", "Active", D("1.00"), 3, 4, date(2023, 1, 1), None, None),
                                  (12, "C12", "Active", D("1.00"), 3, 4, date(2023, 1, 1), None, 2)], CONTRACT)


def test_bind_pins_the_quoted_version(spark):
    quotes = spark.createDataFrame([(5, 3, 7, D("9.00"), "quoted"), (8, 3, 7, D("8.00"), "quoted"), (9, 3, 7, D("7.00"), "bound")],
                                   "application_id long, product_id int, rate_version_id int, quoted_premium decimal(12,2), status string")
    new, after, bad = L.bind(quotes, contracts(spark), date(2024, 6, 1))
    got = [(r["contract_id"], r["application_id"], r["issued_rate_version_id"], r["modal_premium"]) for r in new.orderBy("contract_id").collect()]
    assert got == [(13, 5, 7, D("9.00")), (14, 8, 7, D("8.00"))]
    assert {r["status"] for r in after.collect()} == {"bound"} and [r["application_id"] for r in bad.collect()] == [9]


def test_renew(spark):
    at = date(2025, 1, 1)
    key = "age_band string, gender string, smoking_status string, diabetes_status string, bmi_band string, product_id int, face_amount decimal(12,2)"
    apps = spark.createDataFrame([(1, "45-49", "M", "never", "yes", "normal", 3, D("250000")), (2, "18-24", "M", "never", "yes", "normal", 3, D("250000"))], f"application_id long, {key}")
    enr = spark.createDataFrame([(100, 10)], "enrollment_id long, contract_id long")
    imp = spark.createDataFrame([(100, date(2024, 5, 1), D("10.00")), (100, date(2024, 6, 1), D("20.00")), (100, at, D("99.00"))],
                                "enrollment_id long, measure_date date, improvement_pct decimal(5,2)")
    done = spark.createDataFrame([(10, date(2024, 1, 1))], "contract_id long, renewal_date date")
    req = spark.createDataFrame([(10, at), (10, date(2024, 1, 1)), (11, at), (12, at), (99, at), (10, None), (10, at)], "contract_id long, renewal_date date")
    before = contracts(spark)
    ok, bad = L.renew(req, before, apps, enr, imp, book(spark), done)
    r = ok.first()
    assert ok.count() == 1
    assert (r["new_rate_version_id"], r["base_premium"], r["wellness_discount_pct"], r["final_premium"]) == (9, D("2482.500"), D("15.00"), D("2110.13"))
    assert sorted((x["contract_id"], x["reason"]) for x in bad.collect()) == [
        (10, "already renewed"), (10, "invalid date"), (11, "no application"), (12, "no rate for profile"), (99, "contract not found")]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, contracts(spark).collect()))


def test_enrollment_requests(spark):
    req = spark.createDataFrame([(1, 1, "2024-05-01"), (1, 1, "2024-04-01"), (2, 1, "2024-04-01"), (3, 9, "2024-04-01"), (4, 1, "2025-01-15"), (5, 1, "soon"), (6, 2, "2025-01-14")],
                                "contract_id long, program_id int, enroll_date string")
    ok, bad = L.enrollments(req, spark.createDataFrame([(2,)], "contract_id long"), spark.createDataFrame([(1,), (2,)], "program_id int"), date(2024, 1, 15))
    assert sorted((r["contract_id"], r["enroll_date"]) for r in ok.collect()) == [(1, date(2024, 4, 1)), (6, date(2025, 1, 14))]
    assert {(r["contract_id"], r["reason"]) for r in bad.collect()} == {
        (1, "repeated request"), (2, "already enrolled"), (3, "unknown program"), (4, "after projected renewal"), (5, "invalid request")}


def test_screenings(spark):
    req = spark.createDataFrame([(1, date(2024, 5, 1), "BMI", D("30"), D("27")), (1, date(2023, 5, 1), "BMI", D("30"), D("27")), (2, date(2024, 5, 1), "BMI", D("30"), D("27")),
                                 (1, date(2024, 5, 1), "mood", D("30"), D("27")), (1, date(2024, 5, 1), "BMI", D("0"), D("27")), (1, date(2025, 1, 15), "Exercise", D("10"), D("12"))],
                                "enrollment_id long, measure_date date, measure_type string, baseline_value decimal(8,2), measure_value decimal(8,2)")
    ok, bad = L.screenings(req, spark.createDataFrame([(1, date(2024, 1, 1))], "enrollment_id long, enroll_date date"), date(2024, 1, 15))
    assert [r["improvement_pct"] for r in ok.collect()] == [D("10.00")]
    assert sorted(r["reason"] for r in bad.collect()) == ["invalid measure", "invalid measure", "outside the credit window", "outside the credit window", "unknown enrollment"]


def test_allowed_types(spark):
    df = spark.createDataFrame([("Gym Visit",), ("Nap",)], "activity_type string")
    assert [r[0] for r in L.allowed_types(df).collect()] == ["Gym Visit"]


def test_dashboard(spark):
    from ratemill.operators import aggregates as A
    from ratemill import fixed
    v = spark.createDataFrame([(1, date(2023, 1, 1), date(2024, 1, 1), "superseded", 1), (2, date(2024, 1, 1), None, "active", 2)],
                              "rate_version_id int, effective_date date, expiry_date date, status string, created_by_run_id int")
    rec = spark.createDataFrame([("18-24", "F", "never", "normal", "yes", d) for d in ("yes", "no", "no", "no")] + [("25-29", "F", "never", "normal", "no", "yes")],
                                "age_band string, gender string, smoking_status string, bmi_band string, exercise_freq string, diabetes_status string")
    base = spark.createDataFrame([("25-29", "F", 0.2), ("18-24", "F", 0.1)], "age_band string, gender string, mortality_rate double")
    roll = spark.createDataFrame([(1, 2024, 5), (2, 2024, 7), (1, 2023, 1)], "enrollment_id long, activity_period int, qualifying_activity_count long")
    runs = spark.createDataFrame([(1, "Success"), (2, "failed")], "run_id int, status string")
    states = spark.createDataFrame([(50, "h", 3, 1)], "source_state_id int, content_hash string, byte_size long, observed_by_run_id int")
    d = L.dashboard(v, contracts(spark).withColumn("issued_rate_version_id", F.lit(2)), A.conditional_prevalence(rec, fixed.PROFILE), base, roll, roll.select("enrollment_id").distinct(), runs, states)
    assert [(r["rate_version_id"], r["pinned"]) for r in d["versions"].collect()] == [(1, 0), (2, 3)]
    assert [(r["age_band"], r["mean_prevalence"]) for r in d["prevalence"].collect()] == [("18-24", D("0.2500")), ("25-29", D("1.0000"))]
    assert [r["age_band"] for r in d["mortality"].collect()] == ["18-24", "25-29"]
    assert [tuple(r) for r in d["participation"].collect()] == [(2023, 1, 1, 2), (2024, 2, 12, 2)]
    assert [(r["run_id"], r["retrained"]) for r in d["runs"].collect()] == [(2, False), (1, True)]
    assert tuple(d["tiles"].first()) == (2, 1, 13)


def test_credit_tasks_follow_the_rows(spark, monkeypatch):
    """Sums, joins and windows of past renewals take more tasks where there are more rows, and give what they give in few."""
    from ratemill import session
    from ratemill.catalog import all_queries

    def run():
        return all_queries()["historical_renewals"](spark, "/root/testdata/sf0.001")

    few = run()
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    many = run()
    plan = many._jdf.queryExecution().executedPlan().toString()
    tasks = [int(x) for x in re.findall(r"(?:Exchange|Shuffle)[^\n]*hashpartitioning\([^)\n]*, (\d+)\)", plan) if int(x) > 8]
    assert len(tasks) >= 6 and sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
