"""The measured workload, joins and rollups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.operators import aggregates as A
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.operators.sets import union_facts
from ratemill.plans import lifecycle as L
from ratemill.plans import rollups
from ratemill.session import broadcast_if_small, run_folder
from ratemill.sources import commits


@query("WITH" + star.CONTRACTS + """
SELECT customer_id, contract_id, contract_number, activity_status, CAST(effective_date AS VARCHAR) AS effective_date,
  CAST(expiry_date AS VARCHAR) AS expiry_date FROM contracts JOIN customer ON c_custkey = customer_id""")
def q1_party_contracts(spark, sf):
    c = star.contracts(spark, sf)
    parties = c.select("customer_id", "contract_id").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id")), "customer_id")
    return J.party_contracts(parties, c.drop("customer_id"))


@query("WITH" + star.CONTRACTS + """
SELECT customer_id, contract_id, contract_number, activity_status, CAST(effective_date AS VARCHAR) AS effective_date,
  CAST(expiry_date AS VARCHAR) AS expiry_date FROM contracts JOIN customer ON c_custkey = customer_id WHERE customer_id = 7""")
def q1_one_customer(spark, sf):
    c = star.contracts(spark, sf)
    return J.party_contracts(c.select("customer_id", "contract_id"), c.drop("customer_id"), customer_id=7)


def billing_path(spark, sf):
    """Contract - customer - nation (account) - supplier (billing account) - line item (invoice)."""
    c = star.contracts(spark, sf)
    cust = table(spark, sf, "customer")
    supp = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation")
    line = table(spark, sf, "lineitem")
    return dict(
        contracts=c, parties=c.select("contract_id", "customer_id"), customers=cust.select(F.col("c_custkey").alias("customer_id")),
        members=cust.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("account_id")),
        accounts=nation.select(F.col("n_nationkey").alias("account_id")),
        account_billing=supp.select(F.col("s_nationkey").alias("account_id"), F.col("s_suppkey").alias("billing_account_id")),
        billing=supp.select(F.col("s_suppkey").alias("billing_account_id")),
        invoices=line.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_suppkey").alias("billing_account_id"),
                             F.col("l_shipdate").cast("date").alias("run_date"),
                             F.col("l_extendedprice").cast("decimal(12,2)").alias("premium_subtotal")))


@query("""SELECT o_orderkey AS contract_id, l_suppkey AS billing_account_id, l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS run_date, l_extendedprice AS premium_subtotal
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN supplier ON s_nationkey = n_nationkey
JOIN lineitem ON l_suppkey = s_suppkey WHERE o_orderkey = 1""")
def q2_chain_invoices(spark, sf):
    return J.invoice_chain(**billing_path(spark, sf), contract_id=1).orderBy("run_date", "l_orderkey", "l_linenumber")


@query("""WITH pairs AS (SELECT o_orderkey, CASE WHEN l_shipdate < o_orderdate THEN 1 ELSE 0 END AS early
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_nationkey = c_nationkey JOIN lineitem ON l_suppkey = s_suppkey)
SELECT count(*) AS pairs, CAST(sum(early) AS BIGINT) AS before_effective,
  round(CAST(CAST(100.0 * sum(early)::DOUBLE / count(*) AS DECIMAL(8,4)) AS DOUBLE), 6) AS pct_before,
  count(DISTINCT o_orderkey) AS contracts_with_invoice FROM pairs""")
def q2_reachable_pairs(spark, sf):
    t = billing_path(spark, sf)
    links = J.contract_accounts(t["contracts"], t["parties"], t["customers"], t["members"], t["accounts"])
    return J.reachable_pair_facts(links, t["account_billing"], t["contracts"].select("contract_id", "effective_date"), t["invoices"])


@query("""SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS run_date
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_name = 'Supplier#000000003'""")
def q2b_account_invoices(spark, sf):
    account = P.point_lookup(table(spark, sf, "supplier"), "s_name", "Supplier#000000003").select(F.col("s_suppkey").alias("l_suppkey"))
    rows = table(spark, sf, "lineitem").join(account, "l_suppkey")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("run_date")).orderBy(
        "run_date", "l_orderkey")


@query("WITH" + star.VERSIONS + """
SELECT CAST(rate_version_id AS BIGINT) AS rate_version_id, CAST(effective_date AS VARCHAR) AS effective_date,
  CAST(expiry_date AS VARCHAR) AS expiry_date, status FROM versions WHERE lower(status) = lower('Active')""")
def q3_active_version(spark, sf):
    return P.ci_equals(star.versions(spark, sf), "status", "Active").select("rate_version_id", "effective_date", "expiry_date", "status")


_Q5 = """SELECT l_suppkey AS enrollment_id, count(*) AS qualifying_activity_count FROM lineitem
WHERE l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '{hi}' AND l_returnflag <> 'R' GROUP BY 1"""


@query(_Q5.format(hi="1999-01-01").replace("GROUP BY", "AND l_suppkey = 3 GROUP BY"))
def q4_enrollment_counts(spark, sf):
    """The count of one enrollment in a date range."""
    return A.verified_counts(star.shipments(spark, sf), date(1998, 1, 1), date(1999, 1, 1), enrollment_id=3)


@query(_Q5.format(hi="1999-01-01"))
def q5_verified_counts(spark, sf):
    return A.verified_counts(star.shipments(spark, sf), date(1998, 1, 1), date(1999, 1, 1))


@query("""SELECT l_suppkey AS enrollment_id, year(l_shipdate) AS activity_period, count(*) AS qualifying_activity_count
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def q5_period_rollup(spark, sf):
    return A.period_rollup(star.shipments(spark, sf), "year")


@query(_Q5.format(hi="2001-01-01"))
def q5_from_rollup(spark, sf):
    s = star.shipments(spark, sf)
    return A.range_from_rollup(s, star.stored_rollup(spark, sf, "lineitem", s, "year"), date(1998, 1, 1), date(2001, 1, 1))


_ROLLUP_CHANGED = """SELECT l_suppkey AS enrollment_id, year(l_shipdate) AS activity_period, count(*) AS qualifying_activity_count, CAST(year(l_shipdate) IN (1997, 1998) AS BIGINT) AS written_again
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2"""


def _before_changes(spark, sf):
    """The shipments as they are and as they were: some of 1997 with the other flag, some of 1998 not there yet."""
    flag = F.when(F.col("l_returnflag") == "R", "N").otherwise("Y")
    edited = (F.year("l_shipdate") == 1997) & (F.col("l_orderkey") % 7 == 0)
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("enrollment_id"), F.col("l_shipdate").alias("activity_date"), flag.alias("verified_flag"), edited.alias("edited"),
        ((F.year("l_shipdate") == 1998) & (F.col("l_linenumber") % 3 == 0)).alias("appended"))
    was = rows.withColumn("verified_flag", F.when(F.col("edited"), F.when(F.col("verified_flag") == "Y", "N").otherwise("Y")).otherwise(F.col("verified_flag")))
    return rows, was


def _rollup_rows(spark, path, activity, before: int):
    """The rollup beside whether a period's rows were written after position ``before``."""
    old = rollups.read(spark, path, activity, "year", before, keep_batch=True).select("activity_period", F.col("batch").alias("old")).distinct()
    new = rollups.read(spark, path, activity, "year", keep_batch=True)
    return new.join(broadcast_if_small(old), "activity_period", "left").select("enrollment_id", "activity_period", "qualifying_activity_count", (~F.col("batch").eqNullSafe(F.col("old"))).alias("written_again"))


@query(_ROLLUP_CHANGED)
def rollup_refreshed(spark, sf):
    """A stored rollup whose source got new and edited rows, brought up to date by comparing periods."""
    rows, was = _before_changes(spark, sf)
    path = run_folder(spark, "rollup")
    rollups.refresh(was.where("not appended"), path)
    before = commits.position(spark, path)
    rollups.refresh(rows, path)
    return _rollup_rows(spark, path, rows, before)


@query(_ROLLUP_CHANGED)
def rollup_by_changes(spark, sf):
    """The same brought up to date by the changed rows alone: taken away as they were, added as they are."""
    rows, was = _before_changes(spark, sf)
    path = run_folder(spark, "rollup")
    rollups.refresh(was.where("not appended"), path)
    before = commits.position(spark, path)
    rollups.apply_changes(path, rows.where("edited or appended"), was.where("edited"))
    if rollups.refresh(rows, path):
        raise AssertionError("the changes left periods that differ from the source")
    return _rollup_rows(spark, path, rows, before)


@query("""SELECT user_id AS enrollment_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS activity_period,
  count(*) AS qualifying_activity_count FROM events WHERE event_type <> 'error' GROUP BY 1, 2""")
def weekly_rollup(spark, sf):
    return A.period_rollup(star.activity(spark, sf), "week")


@query("""SELECT c_custkey AS enrollment_id, count(event_id) AS qualifying_activity_count
FROM customer LEFT JOIN events ON user_id = c_custkey AND event_type <> 'error' AND CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""")
def period_total(spark, sf):
    everyone = table(spark, sf, "customer").select(F.col("c_custkey").alias("enrollment_id"))
    return A.period_total(star.stored_rollup(spark, sf, "events", star.activity(spark, sf), "day"), everyone, date(2024, 1, 15))


@query("WITH" + star.CONTRACTS + """
SELECT contract_id, contract_number, CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date,
  CAST(modal_premium AS DOUBLE) AS modal_premium, CAST(issued_rate_version_id AS BIGINT) AS issued_rate_version_id
FROM contracts WHERE issued_rate_version_id = 6""")
def q6_pin_audit(spark, sf):
    return L.pin_audit(star.contracts(spark, sf), 6)


@query("WITH" + star.VERSIONS + "," + star.CONTRACTS + """
SELECT CAST(rate_version_id AS BIGINT) AS rate_version_id, status, count(contract_id) AS pinned FROM versions
LEFT JOIN (SELECT * FROM contracts WHERE activity_status = 'Lapsed' AND issued_rate_version_id <> 3) c ON issued_rate_version_id = rate_version_id GROUP BY 1, 2""")
def pinned_per_version(spark, sf):
    c = star.contracts(spark, sf).where("activity_status = 'Lapsed' and issued_rate_version_id <> 3")
    return J.pinned_per_version(star.versions(spark, sf), c).select("rate_version_id", "status", "pinned")


@query("""SELECT l_orderkey AS contract_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS renewal_date, l_extendedprice AS final_premium
FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-04-01'""")
def renewal_worklist(spark, sf):
    r = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("contract_id"), F.col("l_shipdate").alias("renewal_date"),
                                            F.col("l_extendedprice").alias("final_premium"))
    return L.worklist(r, date(1997, 1, 1), date(1997, 4, 1)).withColumn("renewal_date", F.col("renewal_date").cast("date"))


@query("""SELECT 'Lapsed' AS status, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'Active', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def q8_status_counts(spark, sf):
    o = table(spark, sf, "orders")
    return union_facts(*[P.status_count(o, "o_orderstatus", code).select(F.lit(name).alias("status"), "n")
                         for name, code in (("Lapsed", "F"), ("Active", "O"))])


_Q8 = """SELECT o_orderkey AS contract_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS effective_date, o_totalprice AS modal_premium
FROM orders WHERE o_orderstatus = '{status}'"""


@query(_Q8.format(status="F"))
def q8_status_rows(spark, sf):
    return status_rows(spark, sf, "F")


@query(_Q8.format(status="O"))
def q8b_common_status_rows(spark, sf):
    return status_rows(spark, sf, "O")


def status_rows(spark, sf, status):
    rows = P.by_status(table(spark, sf, "orders"), "o_orderstatus", status, ["o_orderkey", "o_orderdate", "o_totalprice"])
    return rows.select(F.col("o_orderkey").alias("contract_id"), F.col("o_orderdate").cast("date").alias("effective_date"),
                       F.col("o_totalprice").alias("modal_premium"))


_SUMMARY = star.RECORDS + """,
outcome AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, diabetes_status, count(*) AS outcome_rows FROM records
  WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL AND bmi_band IS NOT NULL AND exercise_freq IS NOT NULL
  AND diabetes_status IS NOT NULL GROUP BY ALL),
profile AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, CAST(sum(outcome_rows) AS BIGINT) AS profile_rows FROM outcome GROUP BY ALL),
summary AS (SELECT *, """ + star.half_up('outcome_rows', 'profile_rows', 4, 'DECIMAL(6,4)') + """ AS prevalence_rate
  FROM outcome JOIN profile USING (age_band, gender, smoking_status, bmi_band, exercise_freq))"""


def summary(spark, sf):
    return A.conditional_prevalence(star.counts(spark, sf), fixed.PROFILE, weight="n")


@query("WITH" + _SUMMARY + """
SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, diabetes_status, outcome_rows, profile_rows,
  CAST(prevalence_rate AS DOUBLE) AS prevalence_rate FROM summary""")
def q9_conditional_prevalence(spark, sf):
    return summary(spark, sf)


@query("WITH" + _SUMMARY + """,
u AS (SELECT age_band, gender, CAST(""" + star.half_up('sum(CAST(prevalence_rate*10000 AS BIGINT))', 'count(*)*10000', 4, 'DECIMAL(6,4)') + """ AS DOUBLE) AS mean_prevalence FROM summary
  WHERE diabetes_status = 'yes' GROUP BY ALL),
p AS (SELECT age_band, gender, max(profile_rows) AS n, coalesce(sum(outcome_rows) FILTER (WHERE diabetes_status = 'yes'), 0) AS y
  FROM summary GROUP BY age_band, gender, smoking_status, bmi_band, exercise_freq),
w AS (SELECT age_band, gender, CAST(""" + star.half_up('sum(y)', 'sum(n)', 4, 'DECIMAL(6,4)') + """ AS DOUBLE) AS weighted_prevalence FROM p GROUP BY ALL)
SELECT age_band, gender, mean_prevalence, weighted_prevalence FROM u JOIN w USING (age_band, gender)""")
def prevalence_by_cell(spark, sf):
    s = summary(spark, sf)
    w = A.mean_prevalence(s, weighted=True).withColumnRenamed("mean_prevalence", "weighted_prevalence")
    return A.mean_prevalence(s).join(w, ["age_band", "gender"])


@query("WITH" + star.VERSIONS + "," + star.CONTRACTS + """
SELECT contract_id, CAST(c.effective_date + 200 AS VARCHAR) AS on_date, CAST(max(rate_version_id) AS BIGINT) AS rate_version_id
FROM contracts c LEFT JOIN versions v ON c.effective_date + 200 >= v.effective_date AND (v.expiry_date IS NULL OR c.effective_date + 200 < v.expiry_date)
GROUP BY 1, 2""")
def asof_version_join(spark, sf):
    c = star.contracts(spark, sf).select("contract_id", F.date_add("effective_date", 200).alias("on_date"))
    return K.as_of_version(c, "on_date", star.versions(spark, sf))


@query("WITH" + star.VERSIONS + """
SELECT CAST(rate_version_id AS BIGINT) AS rate_version_id, CAST(effective_date AS VARCHAR) AS effective_date,
  CAST(expiry_date AS VARCHAR) AS expiry_date, status, CAST(created_by_run_id AS BIGINT) AS created_by_run_id FROM versions""")
def version_chain(spark, sf):
    return star.versions(spark, sf)


@query(f"""SELECT {star.age_case('CAST(floor(l_extendedprice/1300) AS INT) + 18')} AS age_band, l_linestatus, count(*) AS n,
  sum(CAST(floor(l_extendedprice/1300) AS INT) + 18)::BIGINT AS age_sum FROM lineitem GROUP BY 1, 2""")
def range_band_join(spark, sf):
    people = table(spark, sf, "lineitem").select((F.floor(F.col("l_extendedprice") / 1300) + 18).cast("int").alias("age"), "l_linestatus")
    per_age = people.groupBy("age", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    banded = J.band_join(per_age, "age", J.band_table(spark))
    return banded.groupBy("age_band", "l_linestatus").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("age")).alias("age_sum"))


@query("""WITH bands AS (SELECT p_partkey, CAST(p_retailprice * 40 AS DECIMAL(12,2)) AS lower, CAST(p_retailprice * 40 + p_size / 4.0 AS DECIMAL(12,2)) AS upper FROM part),
totals AS (SELECT CAST(o_totalprice AS DECIMAL(12,2)) AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT p_partkey, CAST(sum(n) AS BIGINT) AS orders, CAST(max(total) AS DOUBLE) AS highest FROM totals JOIN bands ON total BETWEEN lower AND upper GROUP BY 1""")
def decimal_band_join(spark, sf):
    """Orders whose total lies in a part's band of decimals; bands are a few cents to some units wide."""
    start = (F.col("p_retailprice").cast("decimal(10,2)") * 40).cast("decimal(12,2)")
    bands = table(spark, sf, "part").select("p_partkey", start.alias("lower"), (start + (F.col("p_size").cast("decimal(5,0)") / 4).cast("decimal(6,2)")).cast("decimal(12,2)").alias("upper"))
    totals = table(spark, sf, "orders").groupBy(F.col("o_totalprice").cast("decimal(12,2)").alias("total")).agg(F.count(F.lit(1)).alias("n"))
    return J.band_join(totals, "total", bands).groupBy("p_partkey").agg(F.sum("n").alias("orders"), F.max("total").alias("highest"))


@query("""WITH bands AS (SELECT s_suppkey, CAST(DATE '1995-01-01' + CAST(s_suppkey * 3 AS INT) AS DATE) AS lower,
  CASE WHEN s_nationkey <> 7 THEN CAST(DATE '1995-01-01' + CAST(s_suppkey * 3 + s_nationkey * s_nationkey AS INT) AS DATE) END AS upper FROM supplier),
days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT s_suppkey, CAST(sum(n) AS BIGINT) AS orders, CAST(min(day) AS VARCHAR) AS first_day FROM days JOIN bands ON day >= lower AND (upper IS NULL OR day <= upper) GROUP BY 1""")
def overlapping_band_join(spark, sf):
    """Orders within each supplier's season: bands of dates that overlap, from one day to years, some without an end."""
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") * 3).cast("int"))
    end = F.when(F.col("s_nationkey") != 7, F.date_add(start, (F.col("s_nationkey") * F.col("s_nationkey")).cast("int")))
    bands = table(spark, sf, "supplier").select("s_suppkey", start.alias("lower"), end.alias("upper"))
    days = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return J.band_join(days, "day", bands).groupBy("s_suppkey").agg(F.sum("n").alias("orders"), F.min("day").alias("first_day"))


@query("""WITH last AS (SELECT l_orderkey, max(l_shipdate) AS d, arg_max(l_extendedprice, (l_shipdate, l_partkey, l_linenumber)) AS p FROM lineitem GROUP BY 1)
SELECT o_orderkey AS contract_id, coalesce(p, o_totalprice) AS effective_premium, CAST(CAST(d AS DATE) AS VARCHAR) AS last_renewal_date
FROM orders LEFT JOIN last ON l_orderkey = o_orderkey""")
def effective_premium(spark, sf):
    line = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_shipdate").cast("date").alias("renewal_date"),
        F.struct("l_partkey", "l_linenumber").alias("renewal_id"), F.col("l_extendedprice").cast("decimal(12,2)").alias("final_premium"))
    c = star.contracts(spark, sf).select("contract_id", "modal_premium")
    return K.effective_premium(c, line).select("contract_id", "effective_premium", "last_renewal_date")


@query("""SELECT user_id, arg_max(event_type, event_id) AS event_type, round(arg_max(value, event_id), 6) AS value, max(event_id) AS event_id FROM events GROUP BY 1""")
def latest_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return K.latest_per_key(e, ["user_id"], ["event_id"])


@query("WITH" + star.RUNS + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(started_at AS VARCHAR) AS started_at, status, CAST(source_state_id AS BIGINT) AS source_state_id,
  content_hash, byte_size, CAST(source_state_id IS NOT NULL AS BIGINT) AS retrained FROM runs LEFT JOIN states ON observed_by_run_id = run_id""")
def run_history(spark, sf):
    return L.history(star.runs(spark, sf), star.states(spark, sf)).drop("completed_at")


@query("WITH" + star.RATING + "," + star.book_sql(2023) + "," + star.VERSIONS + "," + star.RUNS + "," + star.CONTRACTS + """,
n AS (SELECT product_id % 8 + 1 AS for_version, count(*) AS rates FROM book GROUP BY 1)
SELECT CAST(s.source_state_id AS BIGINT) AS source_state_id, s.content_hash, CAST(r.run_id AS BIGINT) AS run_id, r.status AS run_status,
  CAST(v.rate_version_id AS BIGINT) AS rate_version_id, CAST(v.effective_date AS VARCHAR) AS effective_date, any_value(rates) AS rates,
  count(contract_id) AS contracts, CAST(sum(modal_premium) AS DOUBLE) AS premium
FROM states s JOIN runs r ON r.run_id = s.observed_by_run_id JOIN versions v ON v.created_by_run_id = r.run_id JOIN n ON for_version = rate_version_id
JOIN contracts ON issued_rate_version_id = rate_version_id GROUP BY ALL""")
def lineage_chain(spark, sf):
    """The book's products are dealt to eight versions."""
    rates = star.book(spark, sf).withColumn("rate_version_id", F.col("product_id") % 8 + 1)
    return J.lineage(star.states(spark, sf), star.runs(spark, sf), star.versions(spark, sf), rates, star.contracts(spark, sf))


@query("""WITH r AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS p, count(*) AS c FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT CAST(p AS VARCHAR) AS activity_period, count(DISTINCT user_id) AS participating, CAST(sum(c) AS BIGINT) AS activities,
  (SELECT count(*) FROM customer) AS total_enrollments FROM r GROUP BY 1""")
def participation_by_period(spark, sf):
    return A.participation(A.period_rollup(star.activity(spark, sf), "week"), table(spark, sf, "customer"))


@query("WITH" + star.VERSIONS + "," + star.RUNS + """
SELECT (SELECT count(*) FROM versions) AS versions, (SELECT count(*) FROM runs WHERE lower(status) = 'success') AS successful_runs,
  (SELECT count(*) FROM events WHERE event_type <> 'error') AS verified_activities""")
def dashboard_tiles(spark, sf):
    return A.tiles(star.versions(spark, sf), star.runs(spark, sf), A.period_rollup(star.activity(spark, sf), "month"))


@query("""SELECT c_custkey, count(*) AS orders_seen FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey IN (SELECT user_id FROM events)
AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000) GROUP BY 1""")
def exists_checks(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey")
    c = J.exists(c, table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")), ["c_custkey"])
    c = J.not_exists(c, o.where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])
    n = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders_seen"))
    return c.join(n, "c_custkey")


@query("""WITH h AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity)::DOUBLE AS q FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey, o_custkey FROM orders), c AS (SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT b.o_orderkey, o_custkey, n, q, CAST(CAST(d AS DATE) AS VARCHAR) AS d FROM b LEFT JOIN h ON h.l_orderkey = b.o_orderkey LEFT JOIN c ON c.o_orderkey = b.o_orderkey""")
def one_to_one_merge(spark, sf):
    line = table(spark, sf, "lineitem")
    a = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    b = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    c = line.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").cast("date").alias("d"))
    return J.merge_components(a, b, c, "o_orderkey")


@query("""SELECT s_name, n_name, r_name, CAST(p_type AS VARCHAR) AS p_type, count(*) AS n, round(sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE, 6) AS billed
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
JOIN part ON p_partkey = l_partkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY ALL""")
def eight_table_chain(spark, sf):
    """Line items through every dimension: one joined row each, summed before anything is sent on."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    chain = line.join(o.join(c, "o_custkey").select("l_orderkey"), "l_orderkey").join(broadcast_if_small(s), "l_suppkey").join(p, "l_partkey")
    summed = chain.groupBy("s_name", "n_nationkey", "p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("billed"))
    return summed.join(n, "n_nationkey").join(table(spark, sf, "region"), "r_regionkey").select(
        "s_name", "n_name", "r_name", "p_type", "n", "billed")


@query("""SELECT p_brand, p_type, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY p_brand), 6) AS share
FROM part GROUP BY 1, 2""")
def share_of_total(spark, sf):
    return A.share_of(table(spark, sf, "part"), ["p_brand"], "p_type")


@query("""SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation ORDER BY n_name""")
def options_list(spark, sf):
    return P.options(table(spark, sf, "nation"), ["n_nationkey", "n_name"], ["n_name"])


@query("WITH" + star.CONTRACTS + "," + star.WELLNESS + """
SELECT contract_id, contract_number FROM contracts WHERE contract_id IN (SELECT contract_id FROM enrollments)
AND application_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ORDER BY contract_id LIMIT 40""")
def candidate_list(spark, sf):
    apps = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("application_id"))
    return J.candidates(star.contracts(spark, sf), star.enrollments(spark, sf), apps, 40)
