"""Quotes, binding, renewals, wellness credits and projections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.plans import lifecycle as L
from ratemill.session import spread

_BOOK = star.RATING + "," + star.book_sql(2023) + "," + star.VERSIONS
_KEY = "age_band, gender, smoking_status, diabetes_status, bmi_band, product_id"

_QUOTE = "WITH" + _BOOK + "," + star.APPLICATIONS + f""",
asked AS (SELECT * REPLACE (CASE WHEN applicant_age = 20 THEN -customer_id ELSE customer_id END AS customer_id) FROM applications),
judged AS (SELECT a.*, base_rate, mortality_multiplier, CASE
    WHEN face_amount NOT IN (100000, 250000, 500000, 1000000) THEN 'incomplete profile' WHEN age_band IS NULL THEN 'age out of range'
    WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'unknown customer' WHEN base_rate IS NULL THEN 'no current rate' END AS reason
  FROM asked a LEFT JOIN book USING ({_KEY})),
priced AS (SELECT *, CAST(CAST(CAST(round(base_rate * CAST(face_amount AS DECIMAL(12,2)), 0) AS DECIMAL(22,0)) * 0.001 AS DECIMAL(18,3)) AS DECIMAL(12,2)) AS quoted_premium,
  (SELECT max(rate_version_id) FROM versions) AS rate_version_id FROM judged WHERE reason IS NULL)"""


def requests(spark, sf):
    """Quote requests; some name a customer that does not exist."""
    a = star.applications(spark, sf)
    return a.withColumn("customer_id", F.when(F.col("applicant_age") == 20, -F.col("customer_id")).otherwise(F.col("customer_id")))


def customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"))


@query(_QUOTE + """
SELECT application_id, customer_id, CAST(product_id AS BIGINT) AS product_id, age_band, gender, smoking_status, diabetes_status, bmi_band,
  CAST(face_amount AS DOUBLE) AS face_amount, CAST(rate_version_id AS BIGINT) AS rate_version_id, CAST(base_rate AS DOUBLE) AS base_rate,
  CAST(quoted_premium AS DOUBLE) AS quoted_premium FROM priced""")
def quote_batch(spark, sf):
    ok, _ = L.quote(requests(spark, sf), customers(spark, sf), star.active_book(spark, sf))
    return ok.select("application_id", "customer_id", "product_id", "age_band", "gender", "smoking_status", "diabetes_status", "bmi_band",
                     "face_amount", "rate_version_id", "base_rate", "quoted_premium")


@query(_QUOTE + " SELECT application_id, reason FROM judged WHERE reason IS NOT NULL")
def quote_rejects(spark, sf):
    _, bad = L.quote(requests(spark, sf), customers(spark, sf), star.active_book(spark, sf))
    return bad.select("application_id", "reason")


@query(_QUOTE + """,
q AS (SELECT *, row_number() OVER (ORDER BY application_id) AS n FROM priced WHERE diabetes_status = 'no')
SELECT (SELECT max(o_orderkey) FROM orders) + n AS contract_id, 'POL-' || ((SELECT max(o_orderkey) FROM orders) + n) AS contract_number,
  application_id, CAST(quoted_premium AS DOUBLE) AS modal_premium, CAST(rate_version_id AS BIGINT) AS issued_rate_version_id,
  '2024-06-01' AS effective_date FROM q""")
def bind_batch(spark, sf):
    """Quotes of applicants with the condition are bound already, all others are bound now."""
    ok, _ = L.quote(requests(spark, sf), customers(spark, sf), star.active_book(spark, sf))
    ok = ok.withColumn("status", F.when(F.col("diabetes_status") == "yes", "bound").otherwise(F.col("status")))
    new, _, _ = L.bind(ok, star.contracts(spark, sf), date(2024, 6, 1))
    return new.select("contract_id", "contract_number", "application_id", "modal_premium", "issued_rate_version_id", "effective_date")


@query(_QUOTE + """
SELECT application_id, CASE WHEN diabetes_status = 'no' THEN 'bound' ELSE 'withdrawn' END AS status, CASE WHEN diabetes_status = 'yes' THEN 'not available to bind' END AS reason FROM priced""")
def bind_outcomes(spark, sf):
    """Each quote's state after binding, and why it was refused."""
    ok, _ = L.quote(requests(spark, sf), customers(spark, sf), star.active_book(spark, sf))
    ok = ok.withColumn("status", F.when(F.col("diabetes_status") == "yes", "withdrawn").otherwise(F.col("status")))
    _, after, bad = L.bind(ok, star.contracts(spark, sf), date(2024, 6, 1))
    return after.select("application_id", "status").join(bad.select("application_id", "reason"), "application_id", "left")


_RENEW = "WITH" + _BOOK + "," + star.APPLICATIONS + "," + star.CONTRACTS + "," + star.WELLNESS + f""",
req AS (SELECT contract_id, CAST(effective_date + to_years(2024 - CAST(year(effective_date) AS INT)) AS DATE) AS renewal_date FROM contracts
  UNION ALL SELECT -1 - contract_id, DATE '2024-03-01' FROM enrollments),
app AS (SELECT * FROM applications WHERE face_amount <> 750000),
done AS (SELECT o_orderkey AS contract_id FROM orders WHERE o_orderpriority = '5-LOW'),
judged AS (SELECT r.contract_id, r.renewal_date, enrollment_id, base_rate, face_amount, CASE WHEN c.contract_id IS NULL THEN 'contract not found'
    WHEN a.application_id IS NULL THEN 'no application' WHEN d.contract_id IS NOT NULL THEN 'already renewed'
    WHEN base_rate IS NULL THEN 'no rate for profile' END AS reason
  FROM req r LEFT JOIN contracts c ON c.contract_id = r.contract_id LEFT JOIN app a ON a.application_id = c.application_id
  LEFT JOIN enrollments e ON e.contract_id = r.contract_id LEFT JOIN done d ON d.contract_id = r.contract_id LEFT JOIN book USING ({_KEY})),
credit AS (SELECT j.contract_id, CAST(sum(improvement_pct)*100 AS BIGINT) AS cents, count(*) AS n FROM judged j JOIN improvements i ON i.enrollment_id = j.enrollment_id
  AND measure_date < renewal_date AND improvement_pct > 0 WHERE reason IS NULL GROUP BY 1),
priced AS (SELECT contract_id, renewal_date, least(coalesce({star.half_up('cents', 'n*100', 6, 'DECIMAL(11,6)')}, 0), 15)::DECIMAL(9,6) AS credit,
    CAST(CAST(round(base_rate * CAST(face_amount AS DECIMAL(12,2)), 0) AS DECIMAL(22,0)) * 0.001 AS DECIMAL(18,3)) AS base
  FROM judged LEFT JOIN credit USING (contract_id) WHERE reason IS NULL)"""


def renewal_inputs(spark, sf):
    c = star.contracts(spark, sf)
    year = F.add_months("effective_date", (F.lit(2024) - F.year("effective_date")) * 12)
    e = star.enrollments(spark, sf)
    req = c.select("contract_id", year.alias("renewal_date")).unionByName(
        e.select((F.lit(-1) - F.col("contract_id")).alias("contract_id"), F.lit(date(2024, 3, 1)).alias("renewal_date")))
    apps = star.profiled(star.applications(spark, sf)).where("face_amount <> 750000")
    return L.renew(req, c, apps, e, star.improvements(spark, sf), star.active_book(spark, sf), star.renewals_2024(spark, sf))


@query(_RENEW + """
SELECT contract_id, CAST(renewal_date AS VARCHAR) AS renewal_date, (SELECT CAST(max(rate_version_id) AS BIGINT) FROM versions) AS new_rate_version_id,
  CAST(base AS DOUBLE) AS base_premium, CAST(CAST(credit AS DECIMAL(5,2)) AS DOUBLE) AS wellness_discount_pct,
  CAST(CAST(CAST(base AS DECIMAL(15,3)) * CAST(100 - credit AS DECIMAL(9,6)) * 0.01 AS DECIMAL(12,2)) AS DOUBLE) AS final_premium FROM priced""")
def renewal_reprice(spark, sf):
    return renewal_inputs(spark, sf)[0]


@query(_RENEW + " SELECT contract_id, CAST(renewal_date AS VARCHAR) AS renewal_date, reason FROM judged WHERE reason IS NOT NULL")
def renewal_rejects(spark, sf):
    return renewal_inputs(spark, sf)[1]


@query("WITH" + star.WELLNESS + f""",
asked AS (SELECT DISTINCT enrollment_id, measure_date AS renewal_date FROM improvements),
s AS (SELECT a.enrollment_id, a.renewal_date, CAST(coalesce(sum(i.improvement_pct), 0)*100 AS BIGINT) AS cents, count(i.improvement_id) AS n FROM asked a
  LEFT JOIN improvements i ON i.enrollment_id = a.enrollment_id AND i.measure_date < a.renewal_date AND i.improvement_pct > 0 GROUP BY 1, 2)
SELECT enrollment_id, CAST(renewal_date AS VARCHAR) AS renewal_date,
  CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE least(CAST({star.half_up('cents', 'n*100', 2, 'DECIMAL(9,2)')} AS DOUBLE), 15.0::DOUBLE) END AS credit_pct FROM s""".replace(
      "n*100)", "greatest(n, 1)*100)"))
def wellness_credit(spark, sf):
    i = star.improvements(spark, sf)
    return A.wellness_credit(i, i.select("enrollment_id", F.col("measure_date").alias("renewal_date")))


@query("WITH" + star.CONTRACTS + """
SELECT contract_id, CAST(CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) AS VARCHAR) AS renewal_date
FROM contracts, generate_series(0, 8) g(k) WHERE CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) <= DATE '2001-08-01'
AND (expiry_date IS NULL OR CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) < expiry_date)""")
def anniversaries(spark, sf):
    return K.anniversaries(star.contracts(spark, sf).select("contract_id", "effective_date", "expiry_date"), date(2001, 8, 1)).select(
        "contract_id", "renewal_date")


_SCREENS = f"""
screens AS (SELECT l_orderkey AS k, o_custkey AS enrollment_id, CAST(l_shipdate AS DATE) AS measure_date,
  CAST(CAST(round(l_tax*100) AS INT)*4 - 6 AS DECIMAL(5,2)) AS improvement_pct FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@query("WITH" + star.CONTRACTS + "," + star.WELLNESS + "," + star.VERSIONS + "," + _SCREENS + f""",
ann AS (SELECT contract_id, modal_premium, CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) AS renewal_date
  FROM contracts, generate_series(0, 8) g(k) WHERE CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) <= DATE '2001-08-01'
  AND (expiry_date IS NULL OR CAST(CAST(effective_date + to_years(1) AS DATE) + to_years(CAST(k AS INT)) AS DATE) < expiry_date)),
s AS (SELECT a.contract_id, a.renewal_date, any_value(a.modal_premium) AS modal_premium, CAST(coalesce(sum(i.improvement_pct), 0)*100 AS BIGINT) AS cents,
  count(i.k) AS n FROM ann a LEFT JOIN enrollments e ON e.contract_id = a.contract_id
  LEFT JOIN screens i ON i.enrollment_id = e.enrollment_id AND i.measure_date < a.renewal_date AND i.measure_date >= e.enroll_date AND i.improvement_pct > 0 GROUP BY 1, 2),
c AS (SELECT *, least({star.half_up('cents', 'greatest(n, 1)*100', 2, 'DECIMAL(9,2)')}, 15)::DECIMAL(5,2) AS credit FROM s)
SELECT contract_id, CAST(renewal_date AS VARCHAR) AS renewal_date, CAST(year(renewal_date) - 1994 AS BIGINT) AS new_rate_version_id,
  CAST(credit AS DOUBLE) AS wellness_discount_pct, CAST(CAST(modal_premium * CAST(100 - credit AS DECIMAL(9,6)) * 0.01 AS DECIMAL(12,2)) AS DOUBLE) AS final_premium FROM c""")
def historical_renewals(spark, sf):
    """Past anniversaries; screenings are line items of the enrolled customer."""
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("enrollment_id"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_tax")
    screens = spread(lines, lines.count(), "l_orderkey").join(owner, "l_orderkey").select(
        "enrollment_id", F.col("l_shipdate").cast("date").alias("measure_date"),
        (star.pct("l_tax") * 4 - 6).cast("decimal(5,2)").alias("improvement_pct"))
    return L.historical_renewals(star.contracts(spark, sf), star.enrollments(spark, sf), screens, star.versions(spark, sf), date(2001, 8, 1))


_PROFILE = "product_id, applicant_age, gender, smoking_status, diabetes_status, bmi_value, face_amount"


@query("WITH" + star.APPLICATIONS + f""",
q AS (SELECT application_id, {_PROFILE}, CAST(year(application_date) - 1994 AS INT) AS rate_version_id,
  CAST(face_amount/1000 + applicant_age + year(application_date) - 1990 AS DECIMAL(12,2)) AS quoted_premium FROM applications),
p AS (SELECT a.application_id, max(b.application_id) AS prior_application_id FROM q a JOIN q b USING ({_PROFILE})
  WHERE a.rate_version_id <> b.rate_version_id GROUP BY 1)
SELECT a.application_id, CAST(a.rate_version_id AS BIGINT) AS rate_version_id, prior_application_id, CAST(b.rate_version_id AS BIGINT) AS prior_version_id,
  CAST(b.quoted_premium AS DOUBLE) AS prior_premium, CAST(a.quoted_premium - b.quoted_premium AS DOUBLE) AS premium_change,
  round(CAST((CASE WHEN a.quoted_premium < b.quoted_premium THEN -1 ELSE 1 END) * {star.half_up('abs(a.quoted_premium - b.quoted_premium)*10000', 'CAST(b.quoted_premium*100 AS BIGINT)', 4, 'DECIMAL(16,4)')} AS DOUBLE), 6) AS premium_change_pct
FROM q a LEFT JOIN p USING (application_id) LEFT JOIN q b ON b.application_id = prior_application_id""")
def prior_quote_delta(spark, sf):
    a = star.applications(spark, sf)
    year = F.year("application_date")
    profile = ["product_id", "applicant_age", "gender", "smoking_status", "diabetes_status", "bmi_value", "face_amount"]
    q = a.select("application_id", *profile, (year - 1994).alias("rate_version_id"),
                 (F.col("face_amount") / 1000 + F.col("applicant_age") + year - 1990).cast("decimal(12,2)").alias("quoted_premium"))
    return K.prior_quote(q, profile).select("application_id", "rate_version_id", "prior_application_id", "prior_version_id", "prior_premium",
                                            "premium_change", "premium_change_pct")


@query("WITH" + _BOOK + "," + star.APPLICATIONS + "," + star.CONTRACTS + "," + star.WELLNESS + f""",
act AS (SELECT user_id AS enrollment_id, count(*) AS activities FROM events WHERE event_type <> 'error' AND year(ts) = 2024 GROUP BY 1),
cr AS (SELECT enrollment_id, CAST(sum(improvement_pct)*100 AS BIGINT) AS cents, count(*) AS n FROM improvements WHERE improvement_pct > 0 AND measure_date < DATE '2025-01-20' GROUP BY 1),
have AS (SELECT o_orderkey AS contract_id, o_orderkey + 7 AS existing_renewal_id FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O'),
p AS (SELECT c.contract_id, contract_number, e.enrollment_id, coalesce(activities, 0) AS activities,
    least(coalesce({star.half_up('cents', 'n*100', 6, 'DECIMAL(11,6)')}, 0), 15)::DECIMAL(9,6) AS credit,
    CAST(CAST(round(base_rate * CAST(face_amount AS DECIMAL(12,2)), 0) AS DECIMAL(22,0)) * 0.001 AS DECIMAL(18,3)) AS base
  FROM contracts c JOIN applications USING (application_id) LEFT JOIN enrollments e ON e.contract_id = c.contract_id JOIN book USING ({_KEY})
  LEFT JOIN act ON act.enrollment_id = e.enrollment_id LEFT JOIN cr ON cr.enrollment_id = e.enrollment_id)
SELECT contract_id, contract_number, '2025-01-20' AS renewal_date, enrollment_id, activities, CAST(CAST(credit AS DECIMAL(5,2)) AS DOUBLE) AS credit_pct,
  CAST(base AS DOUBLE) AS base_premium, CAST(CAST(CAST(base AS DECIMAL(15,3)) * CAST(100 - credit AS DECIMAL(9,6)) * 0.01 AS DECIMAL(12,2)) AS DOUBLE) AS projected_premium, h.existing_renewal_id
FROM p LEFT JOIN have h USING (contract_id)""")
def wellness_projection(spark, sf):
    apps = star.profiled(star.applications(spark, sf))
    ahead = table(spark, sf, "orders").where("o_orderpriority = '5-LOW' and o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("contract_id"), F.lit(date(2025, 1, 20)).alias("renewal_date"), (F.col("o_orderkey") + 7).alias("renewal_id"))
    return L.projection(star.contracts(spark, sf), apps, star.enrollments(spark, sf), A.period_rollup(star.activity(spark, sf), "year"),
                        star.improvements(spark, sf), star.active_book(spark, sf), star.renewals_2024(spark, sf).unionByName(ahead), date(2024, 1, 20))


@query("""WITH r AS (SELECT o_orderkey, o_custkey AS contract_id, CASE WHEN o_orderstatus = 'P' THEN 99 ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS program_id,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS enroll_date FROM orders),
j AS (SELECT *, CASE WHEN enroll_date = 'soon' THEN 'invalid request' WHEN contract_id IN (SELECT user_id FROM events) THEN 'already enrolled'
  WHEN program_id = 99 THEN 'unknown program' WHEN enroll_date >= '2001-01-15' THEN 'after projected renewal' END AS reason FROM r),
v AS (SELECT *, min((enroll_date, program_id)) OVER (PARTITION BY contract_id) AS best FROM j WHERE reason IS NULL)
SELECT contract_id, enroll_date, CAST(program_id AS BIGINT) AS program_id, 'accepted' AS verdict, count(DISTINCT 1) AS n FROM v WHERE (enroll_date, program_id) = best GROUP BY ALL
UNION ALL SELECT contract_id, enroll_date, CAST(program_id AS BIGINT), 'repeated request', count(*) FROM v WHERE (enroll_date, program_id) <> best GROUP BY ALL
UNION ALL SELECT contract_id, enroll_date, CAST(program_id AS BIGINT), reason, count(*) FROM j WHERE reason IS NOT NULL GROUP BY ALL""")
def enrollment_requests(spark, sf):
    o = table(spark, sf, "orders")
    req = o.select(F.col("o_custkey").alias("contract_id"),
                   F.when(F.col("o_orderstatus") == "P", 99).otherwise(F.substring("o_orderpriority", 1, 1).cast("int")).alias("program_id"),
                   F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), "soon").otherwise(
                       F.date_format("o_orderdate", "yyyy-MM-dd")).alias("enroll_date"))
    programs = o.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("program_id")).distinct()
    existing = table(spark, sf, "events").select(F.col("user_id").alias("contract_id"))
    ok, bad = L.enrollments(req, existing, programs, date(2000, 1, 15))
    cols = ["contract_id", F.col("enroll_date").cast("string").alias("enroll_date"), "program_id"]
    both = ok.select(*cols, F.lit("accepted").alias("verdict")).unionByName(bad.select(*cols, F.col("reason").alias("verdict")))
    return both.groupBy("contract_id", "enroll_date", "program_id", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query("WITH" + star.WELLNESS + """,
r AS (SELECT l_partkey AS k, l_linenumber, l_orderkey, o_custkey + CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 100000000 ELSE 0 END AS enrollment_id,
  CAST(l_shipdate AS DATE) AS measure_date, CASE WHEN l_linenumber <= 2 THEN 'BMI' WHEN l_linenumber <= 4 THEN 'Smoking' WHEN l_linenumber <= 6 THEN 'exercise' ELSE 'mood' END AS t,
  CAST(CAST(round(l_tax*100) AS INT)*5 AS DECIMAL(8,2)) AS b, CAST(CAST(l_quantity AS INT) AS DECIMAL(8,2)) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
j AS (SELECT r.*, enroll_date, CASE WHEN t = 'mood' OR b <= 0 THEN 'invalid measure' WHEN enroll_date IS NULL THEN 'unknown enrollment'
  WHEN measure_date < enroll_date OR measure_date >= DATE '2001-01-01' THEN 'outside the credit window' END AS reason FROM r LEFT JOIN enrollments USING (enrollment_id))
SELECT coalesce(reason, lower(t)) AS verdict, count(*) AS n, CAST(sum(CASE WHEN reason IS NULL THEN CASE WHEN (t = 'exercise') = (v >= b) THEN 1 ELSE -1 END * """ + star.half_up("abs(v - b)*100", "CAST(b AS BIGINT)", 2, "DECIMAL(12,2)").replace("(CAST(b AS BIGINT))", "greatest(CAST(b AS BIGINT), 1)") + """ END) AS DOUBLE) AS pct_sum FROM j GROUP BY 1""")
def screening_requests(spark, sf):
    n = F.col("l_linenumber")
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lost = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 100000000).otherwise(0)
    req = table(spark, sf, "lineitem").join(owner, "l_orderkey").select(
        (F.col("o_custkey") + lost).alias("enrollment_id"), F.col("l_shipdate").cast("date").alias("measure_date"),
        F.when(n <= 2, "BMI").when(n <= 4, "Smoking").when(n <= 6, "exercise").otherwise("mood").alias("measure_type"),
        (star.pct("l_tax") * 5).cast("decimal(8,2)").alias("baseline_value"), F.col("l_quantity").cast("decimal(8,2)").alias("measure_value"))
    ok, bad = L.screenings(req, star.enrollments(spark, sf), date(2000, 1, 1))
    zero = F.lit(None).cast("decimal(8,2)")
    both = ok.select(F.lower("measure_type").alias("verdict"), "improvement_pct").unionByName(
        bad.select(F.col("reason").alias("verdict"), zero.alias("improvement_pct")))
    return both.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("improvement_pct").alias("pct_sum"))


@query("SELECT event_type AS activity_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1")
def allowed_activity(spark, sf):
    rows = L.allowed_types(star.activity(spark, sf), allowed=("view", "click", "purchase"))
    return A.counts_by(rows, "activity_type")


@query("WITH" + star.CONTRACTS + "," + star.WELLNESS + """
SELECT count(*) AS n, count(a.o_orderkey) AS with_application, count(e.enrollment_id) AS with_enrollment FROM contracts c
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') a ON a.o_orderkey = c.application_id LEFT JOIN enrollments e ON e.contract_id = c.contract_id""")
def renewal_context(spark, sf):
    apps = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("application_id"), F.lit(1).alias("has_app"))
    ctx = J.renewal_context(star.contracts(spark, sf), apps, star.enrollments(spark, sf))
    return ctx.agg(F.count(F.lit(1)).alias("n"), F.count("has_app").alias("with_application"), F.count("enrollment_id").alias("with_enrollment"))
