"""Data-quality rules, repairs, profiles and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators import quality as Q
from ratemill.operators.cumulative import numbered
from ratemill.operators.sets import coverage_diff, sample_n, stratified_split, union_facts, vocabulary
from ratemill.plans.staging import training_audit

# ---- a raw text table with faults, one row per order -----------------------------------------

CLAIM_COLUMNS = ["claim_id", "claim_date", "settlement_date", "amount", "state", "contract_id"]


def claims(spark, sf):
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    status, prio, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("row_no"),
        (F.col("o_orderkey") + 1).cast("string").alias("claim_id"),
        F.when((prio == "1-URGENT") & (status == "P"), "Error: invalid date range").otherwise(d.cast("string")).alias("claim_date"),
        F.when((prio == "2-HIGH") & (status == "P"), "undefined method x for nil:NilClass").when(status == "P", "")
        .otherwise(F.date_add(d, F.when(price > 400000, -10).otherwise(30)).cast("string")).alias("settlement_date"),
        F.when(price > 450000, F.concat(F.floor(price).cast("string"), F.lit(".125"))).when(price < 50000, F.lit("n/a"))
        .otherwise(F.concat(F.floor(price).cast("string"), F.lit(".50"))).alias("amount"),
        F.when(status == "P", " ").otherwise(F.substring("o_orderpriority", 3, 20)).alias("state"),
        F.when(price < 100000, "").otherwise(F.col("o_custkey").cast("string")).alias("contract_id"))


_CLAIMS = """
claims AS (SELECT o_orderkey AS row_no, CAST(o_orderkey + 1 AS VARCHAR) AS claim_id,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'Error: invalid date range' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS claim_date,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'undefined method x for nil:NilClass' WHEN o_orderstatus = 'P' THEN ''
    ELSE strftime(CAST(o_orderdate AS DATE) + CASE WHEN o_totalprice > 400000 THEN -10 ELSE 30 END, '%Y-%m-%d') END AS settlement_date,
  CASE WHEN o_totalprice > 450000 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.125' WHEN o_totalprice < 50000 THEN 'n/a'
    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.50' END AS amount,
  CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE substr(o_orderpriority, 3, 20) END AS state,
  CASE WHEN o_totalprice < 100000 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS contract_id FROM orders)"""

SPEC = Q.TableSpec(
    columns=[*CLAIM_COLUMNS, "adjuster"], sequential_key="claim_id", not_null=["claim_id", "state", "settlement_date"],
    max_length={"state": 8}, numeric={"amount": (12, 2)}, unique=[["claim_id"], ["contract_id", "claim_date"]],
    date_order=[("claim_date", "settlement_date")])
FKS = [("claims", "contract_id", "customers", "customer_id")]


def parents(spark, sf):
    return table(spark, sf, "customer").where("c_mktsegment <> 'HOUSEHOLD'").select(F.col("c_custkey").alias("customer_id"))


_PARENTS = " (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"


def issues_sql(t: str) -> str:
    iso = "CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST({c} AS DATE) END"
    early = f"({iso.format(c='settlement_date')} < {iso.format(c='claim_date')})"
    mal = "regexp_matches({c}, 'undefined method|nil:NilClass|error:\\s*invalid', 'i')"
    def fact(check, col, bad, example, detail):
        return (f"SELECT 'claims' AS table_name, '{check}' AS check_name, '{col}' AS column_name, count(*) AS n, {example} AS example, '{detail}' AS detail "
                f"FROM {t} WHERE {bad} HAVING count(*) > 0")
    parts = [
        "SELECT 'claims' AS table_name, 'columns' AS check_name, 'adjuster' AS column_name, 1::BIGINT AS n, 'adjuster' AS example, 'missing' AS detail",
        "SELECT 'claims', 'columns', 'row_no', 1::BIGINT, 'row_no', 'not declared'",
        fact("not_null", "state", "trim(state) = ''", "NULL", "blank"),
        fact("not_null", "settlement_date", "trim(settlement_date) = ''", "NULL", "blank"),
        fact("length", "state", "length(state) > 8", "arg_min(state, (-length(state), state))", "max length 8"),
        fact("numeric", "amount", "NOT regexp_matches(amount, '^[0-9]{1,10}(\\.[0-9]{0,2})?$')", "min(amount)", "numeric(12,2)"),
        fact("malformed", "claim_date", mal.format(c="claim_date"), "min(claim_date)", "generator error text"),
        fact("malformed", "settlement_date", mal.format(c="settlement_date"), "min(settlement_date)", "generator error text"),
        fact("date_order", "settlement_date", early, "min(settlement_date)", "before claim_date"),
        f"""SELECT 'claims', 'unique', 'contract_id, claim_date', n, k, 'repeated key' FROM (SELECT count(*) AS n, contract_id || '|' || claim_date AS k
          FROM {t} GROUP BY contract_id, claim_date HAVING count(*) > 1 ORDER BY n DESC, contract_id, claim_date LIMIT 1)""",
        fact("orphan", "contract_id", f"trim(contract_id) <> '' AND contract_id NOT IN {_PARENTS}", "min(contract_id)", "no parent in customers.customer_id"),
    ]
    return " UNION ALL ".join(parts)


@query("WITH" + _CLAIMS + " " + issues_sql("claims"))
def dq_issue_report(spark, sf):
    return Q.issue_report({"claims": claims(spark, sf), "customers": parents(spark, sf)}, {"claims": SPEC}, FKS)


def repaired(df):
    text = F.col("settlement_date")
    states = ["CA", "FL", "IL", "NY"]
    return Q.repair(df, {
        "claim_date": Q.repaired_value("claim_date", "row_no", date(1996, 1, 1), date(1996, 12, 31)),
        "settlement_date": Q.repaired_value("settlement_date", "row_no", date(1995, 6, 1), date(1998, 6, 30), (10, 3), "claim_date"),
        "state": Q.cycled(R.is_blank("state") | (F.length("state") > 8), "state", "row_no", states)})


_REPAIRED = """
r1 AS (SELECT * REPLACE (CASE WHEN claim_date LIKE 'Error%' THEN strftime(DATE '1996-01-01' + CAST(row_no % 366 AS INT), '%Y-%m-%d') ELSE claim_date END AS claim_date) FROM claims),
fixed AS (SELECT * REPLACE (CASE WHEN settlement_date LIKE 'undefined%' THEN CASE WHEN row_no % 10 < 3 THEN '' ELSE
    strftime(greatest(DATE '1995-06-01' + CAST(row_no % 1126 AS INT), TRY_CAST(claim_date AS DATE)), '%Y-%m-%d') END ELSE settlement_date END AS settlement_date,
  CASE WHEN trim(state) = '' OR length(state) > 8 THEN (['CA','FL','IL','NY'])[CAST(row_no % 4 AS INT) + 1] ELSE state END AS state) FROM r1)"""


@query("WITH" + _CLAIMS + "," + _REPAIRED + " SELECT row_no, claim_date, settlement_date, state FROM fixed")
def dq_repair(spark, sf):
    return repaired(claims(spark, sf)).select("row_no", "claim_date", "settlement_date", "state")


@query("WITH" + _CLAIMS + "," + _REPAIRED + f""",
b AS ({issues_sql('claims')}), a AS ({issues_sql('fixed')})
SELECT table_name, check_name, column_name, detail, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after,
  CASE WHEN coalesce(a.n, 0) = 0 THEN 'fixed' WHEN coalesce(b.n, 0) = 0 THEN 'new' WHEN a.n < b.n THEN 'reduced' ELSE 'open' END AS outcome
FROM b FULL JOIN a USING (table_name, check_name, column_name, detail)""")
def dq_before_after(spark, sf):
    raw, p = claims(spark, sf), parents(spark, sf)
    before = Q.issue_report({"claims": raw, "customers": p}, {"claims": SPEC}, FKS)
    after = Q.issue_report({"claims": repaired(raw), "customers": p}, {"claims": SPEC}, FKS)
    return Q.before_after(before, after)


@query("""WITH kids AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT 'orders.o_custkey' AS fk, 'customer.c_custkey' AS parent, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM kids)) AS orphans,
  (SELECT min(CAST(o_custkey AS VARCHAR)) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM kids)) AS example
UNION ALL SELECT 'lineitem.l_orderkey', 'orders.o_orderkey', count(*), min(CAST(l_orderkey AS VARCHAR)) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'events.user_id', 'customer.c_custkey', count(*), min(CAST(user_id AS VARCHAR)) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM kids)""")
def dq_fk_orphans(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem", "events")}
    tables["customer"] = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    return J.fk_orphans(tables, [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
                                 ("events", "user_id", "customer", "c_custkey")])


@query("""WITH n AS (SELECT c_custkey, count(DISTINCT l_suppkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT count(CASE WHEN n = 1 THEN 1 END) AS exactly_one, count(CASE WHEN n = 0 THEN 1 END) AS "none", count(CASE WHEN n > 1 THEN 1 END) AS several FROM n""")
def dq_reachability(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    return A.reachability(c.join(o, "c_custkey", "left").join(line, "o_orderkey", "left"), "c_custkey", "l_suppkey")


@query("""SELECT count(*) AS rows, count(CASE WHEN l_shipdate < o_orderdate + INTERVAL 30 DAY THEN 1 END) AS violations,
  round(CAST(""" + star.half_up("count(CASE WHEN l_shipdate < o_orderdate + INTERVAL 30 DAY THEN 1 END)*100", "count(*)", 4, "DECIMAL(8,4)") + """ AS DOUBLE), 6) AS pct
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def date_order_violation(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due"))
    j = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("l_shipdate")).join(o, "l_orderkey")
    return A.order_violation(j, "due", "l_shipdate")


@query("""SELECT count(*) AS rows, count(CASE WHEN l_shipdate < o_orderdate OR (o_orderstatus = 'F' AND l_shipdate >= o_orderdate + INTERVAL 60 DAY) THEN 1 END) AS violations
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def dq_within_window(spark, sf):
    d = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), d.alias("lo"), F.when(F.col("o_orderstatus") == "F", F.date_add(d, 60)).alias("hi"))
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("date").alias("on_date"))
    return Q.within_window(line, o, "k", "on_date", "lo", "hi")


@query("WITH" + star.RECORDS + """
SELECT 'bmi band' AS check_name, count(CASE WHEN bmi_band IS DISTINCT FROM CASE WHEN bmi_value < 18.5 THEN 'under' WHEN bmi_value < 25 THEN 'normal'
  WHEN bmi_value < 30 THEN 'over' WHEN bmi_value IS NOT NULL THEN 'obese' END THEN 1 END) AS mismatches FROM records
UNION ALL SELECT 'activity', count(CASE WHEN activity_code IS DISTINCT FROM activity_any_code THEN 1 END) FROM records
UNION ALL SELECT 'smoking by sex', count(CASE WHEN smoking_status IS DISTINCT FROM CASE WHEN gender = 'M' THEN 'never' ELSE 'current' END THEN 1 END) FROM records""")
def dq_consistency(spark, sf):
    return Q.consistency(star.records(spark, sf), {
        "bmi band": ("bmi_band", R.bmi_band("bmi_value")), "activity": ("activity_code", F.col("activity_any_code")),
        "smoking by sex": ("smoking_status", F.when(F.col("gender") == "M", "never").otherwise("current"))})


@query("""SELECT 'orders.o_orderdate' AS date_column, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS min_date, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS max_date FROM orders
UNION ALL SELECT 'lineitem.l_shipdate', CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR), CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'events.ts', CAST(CAST(min(ts) AS DATE) AS VARCHAR), CAST(CAST(max(ts) AS DATE) AS VARCHAR) FROM events""")
def profile_dates(spark, sf):
    return union_facts(*[A.date_profile(table(spark, sf, t), t, [c]) for t, c in
                         (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))])


@query("WITH" + star.RECORDS + """
SELECT 'age_band' AS column_name, age_band AS value, count(*) AS n FROM records GROUP BY 2
UNION ALL SELECT 'smoking_status', smoking_status, count(*) FROM records GROUP BY 2
UNION ALL SELECT 'diabetes_status', diabetes_status, count(*) FROM records GROUP BY 2
UNION ALL SELECT 'bmi_band', bmi_band, count(*) FROM records GROUP BY 2""")
def profile_categories(spark, sf):
    return A.value_counts(star.records(spark, sf), ["age_band", "smoking_status", "diabetes_status", "bmi_band"])


@query("""WITH a AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 2),
b AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderpriority <> '5-LOW' GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_totalprice > 100000 AND o_orderpriority <> '5-LOW' GROUP BY 2),
sa AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY column_name) AS s FROM a), sb AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY column_name) AS s FROM b)
SELECT column_name, value, coalesce(sa.n, 0) AS rows_a, coalesce(sb.n, 0) AS rows_b, round(coalesce(sa.s, 0) - coalesce(sb.s, 0), 6) AS share_diff
FROM sa FULL JOIN sb USING (column_name, value)""")
def distribution_diff(spark, sf):
    o = table(spark, sf, "orders")
    return A.distribution_diff(o.where("o_orderdate < date'1998-01-01'"), o.where("o_totalprice > 100000 and o_orderpriority <> '5-LOW'"),
                               ["o_orderstatus", "o_orderpriority"])


@query("WITH" + star.SURVEY + """
SELECT CAST(activity_any_code AS BIGINT) AS activity_any_code, CAST(activity_code AS BIGINT) AS activity_code, count(*) AS n,
  (SELECT count(*) FROM survey WHERE activity_any_code IN (1,2) AND activity_code IN (1,2)) AS valid_rows,
  (SELECT count(*) FROM survey WHERE activity_any_code IN (1,2) AND activity_code IN (1,2) AND activity_any_code <> activity_code) AS off_diagonal
FROM survey GROUP BY 1, 2""")
def crosstab_agreement(spark, sf):
    s = star.survey(spark, sf)
    return A.crosstab(s, "activity_any_code", "activity_code").join(
        F.broadcast(A.agreement(s, "activity_any_code", "activity_code", [1, 2])))


@query("WITH" + star.SURVEY + """,
f AS (SELECT diabetes_code IN (1,3,4) AS a, age_code BETWEEN 1 AND 13 AS b, smoker_code IN (1,2,3,4) AS c, activity_code IN (1,2) AS d, bmi_implied IS NOT NULL AS e FROM survey),
n AS (SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2, count(*) FILTER (a AND b AND c) AS n3,
  count(*) FILTER (a AND b AND c AND d) AS n4, count(*) FILTER (a AND b AND c AND d AND e) AS n5 FROM f)
SELECT 0::BIGINT AS step_no, n0 AS remaining, 0::BIGINT AS removed FROM n UNION ALL SELECT 1, n1, n0 - n1 FROM n UNION ALL SELECT 2, n2, n1 - n2 FROM n
UNION ALL SELECT 3, n3, n2 - n3 FROM n UNION ALL SELECT 4, n4, n3 - n4 FROM n UNION ALL SELECT 5, n5, n4 - n5 FROM n""")
def attrition_audit(spark, sf):
    return training_audit(star.survey(spark, sf))[1].select("step_no", "remaining", "removed")


@query("WITH" + star.RECORDS + """,
s AS (SELECT diabetes_status, bmi_value FROM records WHERE age_band IS NOT NULL)
SELECT (SELECT count(*) FROM records) AS source_rows, count(*) AS retained, (SELECT count(*) FROM records WHERE age_band IS NULL) AS excluded FROM s""")
def scope_report(spark, sf):
    return P.scope_filter(star.records(spark, sf), F.col("age_band").isNotNull())[1]


_CELLS = star.RECORDS + """,
cells AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, count(*) AS n, count(*) FILTER (WHERE diabetes_status = 'yes') AS y,
  count(*) FILTER (WHERE diabetes_status IS NOT NULL) AS base FROM records WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL
  AND bmi_band IS NOT NULL AND exercise_freq IS NOT NULL GROUP BY ALL)"""


@query("WITH" + _CELLS + """
SELECT count(*) AS cells, 624 - count(*) AS empty_cells, min(n) AS min_n, round(quantile_cont(n, 0.1), 6) AS p10, round(quantile_cont(n, 0.25), 6) AS p25,
  round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.75), 6) AS p75, round(quantile_cont(n, 0.9), 6) AS p90, max(n) AS max_n,
  count(*) FILTER (WHERE n < 30) AS small_cells, count(*) FILTER (WHERE n = 1) AS singletons, round(count(*) FILTER (WHERE n < 30)::DOUBLE / count(*), 6) AS small_share FROM cells""")
def sparsity_profile(spark, sf):
    return A.sparsity(star.counts(spark, sf), fixed.PROFILE, 624, weight="n")


def grid(spark):
    return J.profile_grid(spark, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                                  "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS})


_GEST = star.RECORDS + """,
cells AS (SELECT DISTINCT age_band, gender, smoking_status, bmi_band, exercise_freq FROM records WHERE diabetes_status = 'gest')"""


@query("WITH" + _GEST + "," + star._GRID + """
SELECT grid.* FROM grid ANTI JOIN cells USING (age_band, gender, smoking_status, bmi_band, exercise_freq)""")
def zero_cells(spark, sf):
    """Profiles without a record of the rarest outcome."""
    rare = star.counts(spark, sf).where("diabetes_status = 'gest'").dropna(subset=fixed.PROFILE)
    return J.zero_cells(grid(spark), rare, fixed.PROFILE)


@query("WITH" + _GEST + "," + star._GRID + """,
z AS (SELECT grid.* FROM grid ANTI JOIN cells USING (age_band, gender, smoking_status, bmi_band, exercise_freq))
SELECT * FROM z ORDER BY ALL LIMIT 1""")
def first_zero_cell(spark, sf):
    return zero_cells(spark, sf).orderBy(*fixed.PROFILE).limit(1)


@query("WITH" + _CELLS + """
SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, n FROM cells ORDER BY n, age_band, gender, smoking_status, bmi_band, exercise_freq LIMIT 5""")
def sparsest_five(spark, sf):
    c = star.counts(spark, sf).dropna(subset=fixed.PROFILE).groupBy(*fixed.PROFILE).agg(F.sum("n").alias("n"))
    return c.orderBy("n", *fixed.PROFILE).limit(5)


@query("WITH" + _CELLS + """
SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, round(((y+1)::DOUBLE/(base+1) - y::DOUBLE/nullif(base, 0))*100, 6) AS pp_change FROM cells""")
def one_more_case(spark, sf):
    c = star.counts(spark, sf).dropna(subset=fixed.PROFILE)
    cells = A.prevalence(c, fixed.PROFILE, weight="n")
    return A.one_more_case(cells).select(*fixed.PROFILE, "pp_change")


@query("SELECT 'age_band' AS variable, value FROM (WITH" + star.RECORDS + """ SELECT DISTINCT age_band AS value FROM records WHERE age_band IS NOT NULL)
UNION ALL SELECT 'gender', value FROM (WITH""" + star.RECORDS + """ SELECT DISTINCT gender AS value FROM records WHERE gender IS NOT NULL)
UNION ALL SELECT 'smoking_status', value FROM (WITH""" + star.RECORDS + " SELECT DISTINCT smoking_status AS value FROM records WHERE smoking_status IS NOT NULL)")
def vocab_union(spark, sf):
    return vocabulary(star.records(spark, sf), ["age_band", "gender", "smoking_status"])


@query("""SELECT DISTINCT p_type, p_size::BIGINT AS p_size, 'unexpected' AS problem FROM part p WHERE p_retailprice < 1200 AND NOT EXISTS (SELECT 1 FROM part q WHERE q.p_retailprice >= 1200 AND q.p_type = p.p_type AND q.p_size = p.p_size)
UNION ALL SELECT DISTINCT p_type, p_size, 'missing' FROM part p WHERE p_retailprice >= 1200 AND NOT EXISTS (SELECT 1 FROM part q WHERE q.p_retailprice < 1200 AND q.p_type = p.p_type AND q.p_size = p.p_size)""")
def coverage_check(spark, sf):
    p = table(spark, sf, "part")
    return coverage_diff(p.where("p_retailprice < 1200"), p.where("p_retailprice >= 1200"), ["p_type", "p_size"])


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES))
def table_inventory(spark, sf):
    return A.row_counts({t: table(spark, sf, t) for t in TABLES})


@query("SELECT count(DISTINCT o_custkey) AS distinct_keys, min(o_custkey) AS min_key, max(o_custkey) AS max_key, count(*) AS rows FROM orders")
def key_profile(spark, sf):
    return A.key_profile(table(spark, sf, "orders"), "o_custkey")


@query("""SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd, min(l_quantity) AS min, max(l_quantity) AS max,
  round(quantile_cont(l_quantity, 0.25), 6) AS q25, round(quantile_cont(l_quantity, 0.5), 6) AS median, round(quantile_cont(l_quantity, 0.75), 6) AS q75 FROM lineitem
UNION ALL SELECT 'l_tax', count(l_tax), round(avg(l_tax), 6), round(stddev_samp(l_tax), 6), min(l_tax), max(l_tax), round(quantile_cont(l_tax, 0.25), 6),
  round(quantile_cont(l_tax, 0.5), 6), round(quantile_cont(l_tax, 0.75), 6) FROM lineitem""")
def numeric_describe(spark, sf):
    return A.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])


@query("""SELECT min(n)::DOUBLE AS min, max(n)::DOUBLE AS max, count(CASE WHEN n = 0 THEN 1 END) AS zeros, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.9), 6) AS p90,
  round(quantile_cont(n, 0.5) FILTER (WHERE n <> 0), 6) AS nonzero_median FROM (SELECT c_custkey, count(event_id) AS n FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1)""")
def dist_summary(spark, sf):
    n = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    per = table(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return A.dist_summary(per, "n")


@query("""WITH c AS (SELECT l_suppkey, 'l_returnflag' AS c, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_suppkey, 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY ALL),
m AS (SELECT l_suppkey, c, arg_min(v, (-n, v)) AS v FROM c GROUP BY 1, 2)
SELECT l_suppkey, count(*) AS size, round(avg(l_quantity), 6) AS mean_l_quantity, (SELECT v FROM m WHERE m.l_suppkey = l.l_suppkey AND c = 'l_returnflag') AS mode_l_returnflag,
  (SELECT v FROM m WHERE m.l_suppkey = l.l_suppkey AND c = 'l_linenumber') AS mode_l_linenumber, round(count(*)*100.0/(SELECT count(*) FROM lineitem), 6) AS size_percent
FROM lineitem l GROUP BY l_suppkey""")
def group_modes(spark, sf):
    return A.group_modes(table(spark, sf, "lineitem"), "l_suppkey", ["l_returnflag", "l_linenumber"], ["l_quantity"])


@query("WITH" + star.RECORDS + """
SELECT bmi_band, round(avg(CAST(bmi_value AS DOUBLE)), 6) AS representative_bmi_value FROM records WHERE bmi_band IS NOT NULL GROUP BY 1""")
def representatives(spark, sf):
    return A.representatives(star.records(spark, sf), "bmi_band", "bmi_value")


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT count(*) AS duplicate_keys, CAST(sum(n) AS BIGINT) AS duplicate_rows, max(n) AS worst_count,
  (SELECT l_orderkey || '|' || l_linenumber FROM d ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 1) AS worst_key FROM d""")
def counts_and_duplicates(spark, sf):
    return A.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT year(o_orderdate) - 1994 AS issued_rate_version_id, count(*) AS n FROM orders GROUP BY 1")
def counts_by_version(spark, sf):
    return A.counts_by(star.contracts(spark, sf), "issued_rate_version_id")


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, event_id) AS seq FROM events")
def identity_rows(spark, sf):
    """1..N over the whole table in order of user and event."""
    return numbered(table(spark, sf, "events").select("event_id", "user_id"), "user_id", "seq", ["event_id"])


@query("""SELECT count(*) FILTER (WHERE o_orderkey + 1 <> pos) AS n, CAST(min(o_orderkey) FILTER (WHERE o_orderkey + 1 <> pos) AS BIGINT) + 1 AS example
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders WHERE o_orderstatus <> 'P')""")
def dq_sequence(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select((F.col("o_orderkey") + 1).alias("k"))
    return Q.sequence_in_order(o.withColumn("o", F.col("k")), "k", "o")


@query("""SELECT count(*) AS rows, count(DISTINCT event_id) AS keys FROM (SELECT event_id FROM events LIMIT 5000)""")
def uniform_sample(spark, sf):
    """5,000 events (all, when there are fewer), drawn by a seeded hash of the event id."""
    s = sample_n(table(spark, sf, "events"), ["event_id"], 5000, 11)
    return s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("keys"))


@query("""SELECT o_orderstatus AS label, split, CASE split WHEN 'test' THEN CAST(floor(n*0.2 + 0.5) AS BIGINT) ELSE n - CAST(floor(n*0.2 + 0.5) AS BIGINT) END AS n_rows
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), (VALUES ('test'), ('train')) s(split)""")
def split_counts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    return stratified_split(o, "label", ["o_orderkey"]).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT event_id, event_type FROM events ORDER BY md5('11|' || event_id), event_id LIMIT 5000")
def sampled_rows(spark, sf):
    """The rows of that sample."""
    return sample_n(table(spark, sf, "events"), ["event_id"], 5000, 11).select("event_id", "event_type")


@query("""SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || CAST(l_shipdate AS DATE)))
  <= floor(count(*) OVER (PARTITION BY l_returnflag) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM lineitem""")
def split_rows(spark, sf):
    """Which line items are held out, a fifth of each return flag."""
    line = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return stratified_split(line, "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "day"]).select("l_orderkey", "l_linenumber", "l_returnflag", "split")
