"""Stand-ins for the rating tables, derived from the given star tables, in Spark and in SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratemill import fixed
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators.ranking import version_chain
from ratemill.plans import pricing, rollups
from ratemill.plans.staging import survey_records
from ratemill.session import cut_lineage, shared_dir
from ratemill.sources import commits
from ratemill.sources.files import version_of


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A star table. Its schema is read from the file footer once for each state of the file, not once per query."""
    path = f"{sf}/{name}.parquet"
    key = path, version_of(spark, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def stored_rollup(spark: SparkSession, sf: str, name: str, activity: DataFrame, grain: str) -> DataFrame:
    """The rollup of a star table as a stored table by period; when the table's file has changed, the periods that differ are written again."""
    source = f"{sf}/{name}.parquet"
    path = f"{shared_dir(spark)}/rollup-{hashlib.sha256(f'{source} {grain}'.encode()).hexdigest()[:32]}"
    last = commits.entry(spark, path, commits.position(spark, path))
    version = version_of(spark, source)
    if last is None or last["version"] != version:
        rollups.refresh(activity, path, grain, version)
    return rollups.read(spark, path, activity, grain)


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types any SQL engine prints alike."""
    def one(f: T.StructField) -> Column:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            return F.round(c.cast("double"), 6).alias(f.name)
        if isinstance(t, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(t, (T.BooleanType, T.IntegralType)):
            return c.cast("bigint").alias(f.name)
        return c.alias(f.name)
    return df.select(*[one(f) for f in df.schema.fields])


def pct(col: str) -> Column:
    """A two-digit fraction as whole percent; plain arithmetic, as round() on doubles goes through decimals."""
    return F.floor(F.col(col) * 100 + 0.5).cast("int")


def half_up(a: str, b: str, digits: int, dtype: str) -> str:
    """SQL for a/b of non-negative whole numbers, rounded half up to the last digit in integer arithmetic."""
    unit = "0." + "0" * (digits - 1) + "1"
    return f"CAST(CAST((2*CAST({a} AS HUGEINT)*{10 ** digits} + ({b})) // (2*({b})) AS DECIMAL(20,0)) * {unit} AS {dtype})"


# ---- respondents ------------------------------------------------------------------------------

def survey(spark: SparkSession, sf: str) -> DataFrame:
    """Coded respondents, one per line item."""
    disc, tax = pct("l_discount"), pct("l_tax")
    implied = F.when(tax != 7, (F.floor(F.col("l_extendedprice") / 25) + 1200).cast("int"))
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.when(disc <= 1, 1).when(disc == 2, 2).when(disc <= 7, 3).when(disc == 8, 4).when(disc == 9, 7).otherwise(9).alias("diabetes_code"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("sex_code"),
        F.when(tax == 8, 9).when((F.col("l_returnflag") == "A") & (tax < 4), 1).when(F.col("l_returnflag") == "A", 2)
        .when(F.col("l_returnflag") == "R", 3).otherwise(4).alias("smoker_code"),
        F.when(F.col("l_linenumber") <= 4, 1).when(F.col("l_linenumber") <= 6, 2).otherwise(9).alias("activity_code"),
        F.when(F.col("l_linenumber") <= 4, 1).when(F.col("l_linenumber") <= 6, 2).when(tax == 0, 7).otherwise(9).alias("activity_any_code"),
        implied.alias("bmi_implied"), F.ceil(F.col("l_quantity") * 14 / 50).cast("int").alias("age_code"))
    i = F.col("bmi_implied")
    return raw.withColumn("bmi_code", F.when(i < 1850, 1).when(i < 2500, 2).when(i < 3000, 3).when(i.isNotNull(), 4))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return survey_records(survey(spark, sf))


SURVEY = """
survey AS (SELECT *, CASE WHEN bmi_implied < 1850 THEN 1 WHEN bmi_implied < 2500 THEN 2 WHEN bmi_implied < 3000 THEN 3
    WHEN bmi_implied IS NOT NULL THEN 4 END AS bmi_code FROM (
  SELECT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS l_shipdate,
    CASE WHEN round(l_discount*100) <= 1 THEN 1 WHEN round(l_discount*100) = 2 THEN 2 WHEN round(l_discount*100) <= 7 THEN 3
         WHEN round(l_discount*100) = 8 THEN 4 WHEN round(l_discount*100) = 9 THEN 7 ELSE 9 END AS diabetes_code,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS sex_code,
    CASE WHEN round(l_tax*100) = 8 THEN 9 WHEN l_returnflag = 'A' AND round(l_tax*100) < 4 THEN 1 WHEN l_returnflag = 'A' THEN 2
         WHEN l_returnflag = 'R' THEN 3 ELSE 4 END AS smoker_code,
    CASE WHEN l_linenumber <= 4 THEN 1 WHEN l_linenumber <= 6 THEN 2 ELSE 9 END AS activity_code,
    CASE WHEN l_linenumber <= 4 THEN 1 WHEN l_linenumber <= 6 THEN 2 WHEN round(l_tax*100) = 0 THEN 7 ELSE 9 END AS activity_any_code,
    CASE WHEN round(l_tax*100) <> 7 THEN CAST(floor(l_extendedprice/25) AS INT) + 1200 END AS bmi_implied,
    CAST(ceil(l_quantity*14/50) AS INT) AS age_code
  FROM lineitem))"""

_AGE_CASE = " ".join(f"WHEN {{c}} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in fixed.AGE_BANDS)
_CODE_CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in fixed.AGE_CODES.items())
_COARSE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.COARSE_GROUP.items())


def age_case(c: str) -> str:
    return f"CASE {_AGE_CASE.format(c=c)} END"


def coarse_case(c: str) -> str:
    return f"CASE {c} {_COARSE_CASE} END"


def band_no(c: str) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN '{v}' THEN {i + 1}" for i, v in enumerate(fixed.AGE_LABELS)) + " END"


RECORDS = SURVEY + f""",
records AS (SELECT *, CASE age_code {_CODE_CASE} END AS age_band,
    CASE sex_code WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS gender,
    CASE smoker_code WHEN 1 THEN 'current' WHEN 2 THEN 'current' WHEN 3 THEN 'former' WHEN 4 THEN 'never' END AS smoking_status,
    CASE diabetes_code WHEN 1 THEN 'yes' WHEN 2 THEN 'gest' WHEN 3 THEN 'no' WHEN 4 THEN 'pre' END AS diabetes_status,
    CASE bmi_code WHEN 1 THEN 'under' WHEN 2 THEN 'normal' WHEN 3 THEN 'over' WHEN 4 THEN 'obese' END AS bmi_band,
    CASE activity_code WHEN 1 THEN 'yes' WHEN 2 THEN 'no' END AS exercise_freq,
    CAST(bmi_implied/100.0 AS DECIMAL(5,2)) AS bmi_value FROM survey)"""


# ---- life table and mortality -----------------------------------------------------------------

def _age() -> Column:
    return (F.floor(F.col("l_extendedprice") / 1300) + 18).cast("int")


def deaths(spark: SparkSession, sf: str) -> DataFrame:
    """Lives and deaths per single age and sex; everything below reads this small table."""
    dead = (F.col("l_returnflag") == "R") & (pct("l_tax") <= 1)
    late, ill = F.col("l_shipdate") >= F.lit("1998-01-01").cast("date"), pct("l_discount") <= 2
    return table(spark, sf, "lineitem").groupBy(
        _age().alias("age"), F.when(F.col("l_linestatus") == "O", "M").otherwise("F").alias("gender")).agg(
        F.count(F.lit(1)).alias("n24"), F.count_if(late).alias("n23"), F.count_if(dead).alias("a24"), F.count_if(dead & ill).alias("d24"),
        F.count_if(dead & late).alias("a23"), F.count_if(dead & ill & late).alias("d23"), F.sum("l_quantity").cast("bigint").alias("q"))


def life_table(dead: DataFrame) -> DataFrame:
    """One row per single age, both sexes side by side."""
    def side(s: str, gender: str) -> list[Column]:
        def of(c: str) -> Column:
            return F.sum(F.when(F.col("gender") == gender, F.col(c))).cast("decimal(12,0)")
        return [F.coalesce(of("n24"), F.lit(0)).cast("int").alias(f"{s}_lives"),
                (of("a24") / of("n24")).cast("decimal(7,6)").alias(f"{s}_death_probability"),
                (of("q") / of("n24")).cast("decimal(5,2)").alias(f"{s}_life_expectancy")]
    return dead.groupBy("age").agg(*side("male", "M"), *side("female", "F"))


def mortality(dead: DataFrame) -> DataFrame:
    """Long staging table: baseline bands, and two cohorts of all-cause and condition rates."""
    base = pricing.life_table_baseline(life_table(dead)).select(
        F.lit(fixed.BASELINE_YEAR).alias("source_year"), "age_band", "gender", F.lit("BASELINE").alias("condition_flag"),
        "mortality_rate", "life_expectancy")
    def crude(a: str, n: str) -> Column:
        return (F.sum(a).cast("decimal(12,0)") * 100000 / F.nullif(F.sum(n), F.lit(0))).cast("decimal(18,1)")
    g = dead.groupBy(R.coarse_group(R.age_band("age")).alias("age_band"), "gender").agg(
        crude("a24", "n24").alias("a24"), crude("d24", "n24").alias("d24"), crude("a23", "n23").alias("a23"), crude("d23", "n23").alias("d23"))
    rows = F.array(*[F.struct(F.lit(y).alias("source_year"), F.lit(flag).alias("condition_flag"), F.col(c).alias("crude"))
                     for y, flag, c in ((2024, "ALLCAUSE", "a24"), (2024, "DIABETES", "d24"), (2023, "ALLCAUSE", "a23"), (2023, "DIABETES", "d23"))])
    cohorts = g.select("age_band", "gender", F.inline(rows)).select(
        "source_year", "age_band", "gender", "condition_flag", R.per_100k("crude").alias("mortality_rate"),
        F.lit(None).cast("decimal(5,2)").alias("life_expectancy"))
    return base.unionByName(cohorts)


_DEAD = "(l_returnflag = 'R' AND round(l_tax*100) <= 1)"
MORTALITY = f"""
life AS (SELECT CAST(floor(l_extendedprice/1300) AS INT) + 18 AS age, CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'F' END AS gender,
    count(*) AS lives, {half_up(f'count(*) FILTER (WHERE {_DEAD})', 'count(*)', 6, 'DECIMAL(7,6)')} AS rate,
    {half_up('sum(CAST(l_quantity AS BIGINT))', 'count(*)', 2, 'DECIMAL(5,2)')} AS expectancy FROM lineitem GROUP BY ALL),
baseline AS (SELECT {age_case('age')} AS age_band, gender, CAST(sum(lives) AS BIGINT) AS lives,
    {half_up('sum(lives * CAST(rate*1000000 AS BIGINT))', 'sum(lives)*1000000', 6, 'DECIMAL(8,6)')} AS mortality_rate,
    {half_up('sum(lives * CAST(expectancy*100 AS BIGINT))', 'sum(lives)*100', 2, 'DECIMAL(5,2)')} AS life_expectancy FROM life GROUP BY ALL),
grouped AS (SELECT {coarse_case(age_case('CAST(floor(l_extendedprice/1300) AS INT) + 18'))} AS age_band,
    CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'F' END AS gender, count(*) AS n24, count(*) FILTER (WHERE year(l_shipdate) >= 1998) AS n23,
    count(*) FILTER (WHERE {_DEAD}) AS a24, count(*) FILTER (WHERE {_DEAD} AND round(l_discount*100) <= 2) AS d24,
    count(*) FILTER (WHERE {_DEAD} AND year(l_shipdate) >= 1998) AS a23,
    count(*) FILTER (WHERE {_DEAD} AND round(l_discount*100) <= 2 AND year(l_shipdate) >= 1998) AS d23 FROM lineitem GROUP BY ALL),
cohort AS (
    SELECT 2024 AS source_year, age_band, gender, 'ALLCAUSE' AS condition_flag, {half_up('a24*100000', 'n24', 1, 'DECIMAL(18,1)')} AS crude FROM grouped UNION ALL
    SELECT 2024, age_band, gender, 'DIABETES', {half_up('d24*100000', 'n24', 1, 'DECIMAL(18,1)')} FROM grouped UNION ALL
    SELECT 2023, age_band, gender, 'ALLCAUSE', {half_up('a23*100000', 'n23', 1, 'DECIMAL(18,1)')} FROM grouped UNION ALL
    SELECT 2023, age_band, gender, 'DIABETES', {half_up('d23*100000', 'n23', 1, 'DECIMAL(18,1)')} FROM grouped),
mortality AS (SELECT source_year, age_band, gender, condition_flag, CAST(crude::DOUBLE/100000 AS DECIMAL(8,6)) AS mortality_rate FROM cohort)"""


# ---- rating -----------------------------------------------------------------------------------

def products(spark: SparkSession, sf: str) -> DataFrame:
    """One product per brand, its structure factor from the mean part size."""
    mean = (F.sum("p_size").cast("decimal(18,0)") / F.count(F.lit(1)) / 100).cast("decimal(4,2)")
    return table(spark, sf, "part").groupBy(F.substring("p_brand", 7, 9).cast("int").alias("product_id")).agg(
        (mean + F.lit(1)).cast("decimal(4,2)").alias("product_factor"))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per coded profile and outcome, kept as a table: later filters then run on it, not on the records."""
    return cut_lineage(A.profile_counts(records(spark, sf)))


def probabilities(n: DataFrame) -> DataFrame:
    """Smoothed outcome share per full profile over the whole grid, exercise weighted out; ``n`` are profile counts."""
    found = n.dropna(subset=[*fixed.PROFILE, "diabetes_status"]).groupBy(*fixed.PROFILE).agg(
        F.sum(F.when(F.col("diabetes_status") == "yes", F.col("n")).otherwise(0)).alias("y"), F.sum("n").alias("n"))
    grid = J.profile_grid(n.sparkSession, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                                           "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS})
    p = (F.coalesce("y", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)
    shares = A.marginal_shares(n, "exercise_freq", fixed.EXERCISE_LEVELS, weight="n")
    return A.marginalise(grid.join(found, fixed.PROFILE, "left").withColumn("probability", p),
                         ["age_band", "gender", "smoking_status", "bmi_band"], "exercise_freq", "probability", shares)


class Inputs:
    """The two small tables the whole rating chain reads, each computed by one scan and then kept."""

    def __init__(self, spark: SparkSession, sf: str):
        self.counts = counts(spark, sf)
        self.deaths = cut_lineage(deaths(spark, sf))
        self.products = products(spark, sf)

    def cells(self, cohort: int = 2023) -> DataFrame:
        m = mortality(self.deaths)
        base = m.where(F.col("condition_flag") == "BASELINE")
        prev = A.prevalence(self.counts, ["age_band", "gender"], weight="n")
        return pricing.rating_cells(base, prev, pricing.condition_ratio(m, cohort))

    def factors(self, cohort: int = 2023) -> DataFrame:
        return pricing.risk_factors(self.cells(cohort), probabilities(self.counts))

    def book(self, cohort: int = 2023) -> DataFrame:
        return pricing.rate_book(self.factors(cohort), self.products)


def book(spark: SparkSession, sf: str) -> DataFrame:
    return Inputs(spark, sf).book()


def active_book(spark: SparkSession, sf: str) -> DataFrame:
    """The book as the active version (the last of the order years), kept as a table like a published book."""
    v = J.ci_active(versions(spark, sf)).select("rate_version_id")
    return cut_lineage(book(spark, sf).join(F.broadcast(v)))


_GRID = ("grid AS (SELECT * FROM (VALUES " + ",".join(f"('{v}')" for v in fixed.AGE_LABELS) + ") a(age_band), (VALUES ('F'),('M')) g(gender), "
         "(VALUES ('current'),('former'),('never')) s(smoking_status), (VALUES ('under'),('normal'),('over'),('obese')) b(bmi_band), "
         "(VALUES ('no'),('yes')) e(exercise_freq))")


def cells_sql(cohort: int, name: str = "cells") -> str:
    return f"""
{name}_ratio AS (SELECT a.age_band, a.gender, d.mortality_rate::DOUBLE / a.mortality_rate::DOUBLE AS f
    FROM mortality a JOIN mortality d USING (source_year, age_band, gender)
    WHERE a.condition_flag = 'ALLCAUSE' AND d.condition_flag = 'DIABETES' AND a.source_year = {cohort}),
{name}_pf AS (SELECT b.age_band, b.gender, b.mortality_rate AS m, p.p, r.f FROM baseline b JOIN prev p USING (age_band, gender)
    JOIN {name}_ratio r ON r.age_band = {coarse_case('b.age_band')} AND r.gender = b.gender),
{name}_rr AS (SELECT *, (f*p - p - f) / (p*(f - 1.0::DOUBLE)) AS rr FROM {name}_pf),
{name} AS (SELECT *, m::DOUBLE / (p*rr + (1.0::DOUBLE - p)) AS mn, rr * (m::DOUBLE / (p*rr + (1.0::DOUBLE - p))) AS md FROM {name}_rr)"""


PREV = """
prev AS (SELECT age_band, gender, count(*) FILTER (WHERE diabetes_status = 'yes')::DOUBLE
    / count(*) FILTER (WHERE diabetes_status IN ('yes','no','gest','pre')) AS p FROM records
    WHERE age_band IS NOT NULL AND gender IS NOT NULL GROUP BY ALL)"""

SHARES = """
shares AS (SELECT exercise_freq, count(*) AS share_rows, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM records
    WHERE exercise_freq IN ('yes','no') GROUP BY 1)"""

PROBS = SHARES + f""",
{_GRID},
found AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, count(*) FILTER (WHERE diabetes_status = 'yes') AS y, count(*) AS n
    FROM records WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL AND bmi_band IS NOT NULL
    AND exercise_freq IS NOT NULL AND diabetes_status IS NOT NULL GROUP BY ALL),
probs AS (SELECT age_band, gender, smoking_status, bmi_band, sum((coalesce(y,0)+1)::DOUBLE/(coalesce(n,0)+2) * share) AS probability
    FROM grid LEFT JOIN found USING (age_band, gender, smoking_status, bmi_band, exercise_freq) JOIN shares USING (exercise_freq) GROUP BY ALL)"""


def book_sql(cohort: int, c: str = "cells", name: str = "book") -> str:
    return cells_sql(cohort, c) + f""",
{name}_long AS (SELECT p.age_band, p.gender, smoking_status, bmi_band, m, p.probability, rr,
    mn * CASE smoking_status WHEN 'never' THEN 1.0::DOUBLE WHEN 'former' THEN 1.3::DOUBLE ELSE 2.3::DOUBLE END
       * CASE bmi_band WHEN 'normal' THEN 1.0::DOUBLE WHEN 'under' THEN 1.2::DOUBLE WHEN 'over' THEN 1.05::DOUBLE ELSE 1.35::DOUBLE END AS base
    FROM probs p JOIN {c} x ON x.age_band = p.age_band AND x.gender = p.gender),
{name}_factors AS (
    SELECT age_band, gender, smoking_status, 'yes' AS diabetes_status, bmi_band, m, CAST(round(base*rr/m::DOUBLE, 3) AS DECIMAL(6,3)) AS mortality_multiplier FROM {name}_long
    UNION ALL
    SELECT age_band, gender, smoking_status, 'no', bmi_band, m,
        CAST(round(base*(1.0::DOUBLE + probability*0.2::DOUBLE*(rr - 1.0::DOUBLE))/m::DOUBLE, 3) AS DECIMAL(6,3)) FROM {name}_long),
{name} AS (SELECT age_band, gender, smoking_status, diabetes_status, bmi_band, product_id, mortality_multiplier,
    CAST(1000::DECIMAL(4,0) * m * mortality_multiplier * 1.50::DECIMAL(4,2) * product_factor AS DECIMAL(12,2)) AS base_rate
    FROM {name}_factors, products)"""


PRODUCTS = f"""
products AS (SELECT CAST(substr(p_brand, 7) AS INT) AS product_id, CAST(1 + {half_up('sum(p_size)', 'count(*)*100', 2, 'DECIMAL(4,2)')} AS DECIMAL(4,2)) AS product_factor
    FROM part GROUP BY 1)"""

RATING = RECORDS + "," + MORTALITY + "," + PREV + "," + PROBS + "," + PRODUCTS


# ---- versions, runs, contracts, applications ----------------------------------------------------

def version_starts(spark: SparkSession, sf: str) -> DataFrame:
    y = F.year("o_orderdate")
    return table(spark, sf, "orders").select(y.alias("y")).distinct().select(
        (F.col("y") - 1994).alias("rate_version_id"), F.make_date("y", F.lit(1), F.lit(1)).alias("effective_date"),
        ((F.col("y") - 1994) * 10 + 1).alias("created_by_run_id"))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    return version_chain(version_starts(spark, sf))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One refresh run per order quarter; the first of a year published that year's version."""
    d = F.col("o_orderdate").cast("date")
    q = table(spark, sf, "orders").groupBy(F.year(d).alias("y"), F.quarter(d).alias("q")).agg(
        F.min(d).alias("started_at"), F.max(d).alias("completed_at"))
    return q.select(((F.col("y") - 1994) * 10 + F.col("q")).alias("run_id"), "started_at", "completed_at",
                    F.when(F.col("q") == 3, "failed").otherwise("success").alias("status"))


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Source states observed by the first two runs of each year."""
    d = F.col("o_orderdate")
    s = table(spark, sf, "orders").where(F.quarter(d) <= 2).groupBy(((F.year(d) - 1994) * 10 + F.quarter(d)).alias("run_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("s"), F.sum(F.length("o_orderpriority")).alias("byte_size"))
    return s.select((F.col("run_id") + 1000).alias("source_state_id"), F.col("run_id").alias("observed_by_run_id"), "byte_size",
                    F.sha2(F.concat_ws("|", F.col("n").cast("string"), F.col("s").cast("string")), 256).alias("content_hash"))


VERSIONS = """
versions AS (SELECT y - 1994 AS rate_version_id, make_date(y, 1, 1) AS effective_date, (y - 1994)*10 + 1 AS created_by_run_id,
    lead(make_date(y, 1, 1)) OVER (ORDER BY y) AS expiry_date, CASE WHEN lead(y) OVER (ORDER BY y) IS NULL THEN 'active' ELSE 'superseded' END AS status
    FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders))"""

RUNS = """
runs AS (SELECT (year(o_orderdate) - 1994)*10 + quarter(o_orderdate) AS run_id, CAST(min(o_orderdate) AS DATE) AS started_at,
    CAST(max(o_orderdate) AS DATE) AS completed_at, CASE WHEN max(quarter(o_orderdate)) = 3 THEN 'failed' ELSE 'success' END AS status FROM orders GROUP BY 1),
states AS (SELECT (year(o_orderdate) - 1994)*10 + quarter(o_orderdate) + 1000 AS source_state_id,
    (year(o_orderdate) - 1994)*10 + quarter(o_orderdate) AS observed_by_run_id, CAST(sum(length(o_orderpriority)) AS BIGINT) AS byte_size,
    sha256(count(*)::VARCHAR || '|' || sum(o_orderkey)::VARCHAR) AS content_hash FROM orders WHERE quarter(o_orderdate) <= 2 GROUP BY 1, 2)"""


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    status = R.mapped("o_orderstatus", {"O": "Active", "F": "Lapsed", "P": "Pending"})
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("contract_id"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("contract_number"),
        status.alias("activity_status"), F.col("o_totalprice").cast("decimal(12,2)").alias("modal_premium"),
        (F.year(d) - 1994).alias("issued_rate_version_id"), d.alias("effective_date"),
        F.when(F.col("o_orderstatus") == "F", F.add_months(d, 36)).alias("expiry_date"),
        F.col("o_orderkey").alias("application_id"), F.col("o_custkey").alias("customer_id"))


CONTRACTS = """
contracts AS (SELECT o_orderkey AS contract_id, 'C' || o_orderkey AS contract_number,
    CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Lapsed' ELSE 'Pending' END AS activity_status,
    CAST(o_totalprice AS DECIMAL(12,2)) AS modal_premium, CAST(year(o_orderdate) - 1994 AS INT) AS issued_rate_version_id,
    CAST(o_orderdate AS DATE) AS effective_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 36 MONTH AS DATE) END AS expiry_date,
    o_orderkey AS application_id, o_custkey AS customer_id FROM orders)"""


def applications(spark: SparkSession, sf: str) -> DataFrame:
    """One quote request per order, the applicant taken from its customer."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")
    price = F.col("o_totalprice")
    face = F.when(price < 125000, 100000).when(price < 250000, 250000).when(price < 375000, 500000).when(price < 490000, 1000000).otherwise(750000)
    return o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("application_id"), F.col("o_custkey").alias("customer_id"),
        (F.col("c_nationkey") + 1).alias("product_id"), (F.floor((F.col("c_acctbal") + 1000) / 130) + 18).cast("int").alias("applicant_age"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "HOUSEHOLD"), "F").otherwise("M").alias("gender"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "current").when(F.col("o_orderpriority") == "2-HIGH", "former").otherwise("never").alias("smoking_status"),
        F.when(F.col("o_orderstatus") == "P", "yes").otherwise("no").alias("diabetes_status"),
        ((F.floor(price / 125) + 1200).cast("decimal(7,0)") / 100).cast("decimal(5,2)").alias("bmi_value"),
        face.cast("decimal(12,2)").alias("face_amount"), F.col("o_orderdate").cast("date").alias("application_date"))


def profiled(apps: DataFrame) -> DataFrame:
    return apps.withColumns({"age_band": R.age_band("applicant_age"), "bmi_band": R.bmi_band("bmi_value")})


APPLICATIONS = f"""
applications AS (SELECT *, {age_case('applicant_age')} AS age_band,
    CASE WHEN bmi_value < 18.5 THEN 'under' WHEN bmi_value < 25 THEN 'normal' WHEN bmi_value < 30 THEN 'over' ELSE 'obese' END AS bmi_band FROM (
  SELECT o_orderkey AS application_id, o_custkey AS customer_id, c_nationkey + 1 AS product_id,
    CAST(floor((c_acctbal + 1000)/130) AS INT) + 18 AS applicant_age,
    CASE WHEN c_mktsegment IN ('BUILDING','FURNITURE','HOUSEHOLD') THEN 'F' ELSE 'M' END AS gender,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'current' WHEN '2-HIGH' THEN 'former' ELSE 'never' END AS smoking_status,
    CASE WHEN o_orderstatus = 'P' THEN 'yes' ELSE 'no' END AS diabetes_status,
    CAST((CAST(floor(o_totalprice/125) AS INT) + 1200)/100.0 AS DECIMAL(5,2)) AS bmi_value,
    CASE WHEN o_totalprice < 125000 THEN 100000 WHEN o_totalprice < 250000 THEN 250000 WHEN o_totalprice < 375000 THEN 500000
         WHEN o_totalprice < 490000 THEN 1000000 ELSE 750000 END AS face_amount, CAST(o_orderdate AS DATE) AS application_date
  FROM orders JOIN customer ON c_custkey = o_custkey))"""


# ---- wellness -----------------------------------------------------------------------------------

def enrollments(spark: SparkSession, sf: str) -> DataFrame:
    """One enrollment per customer, on the customer's first contract."""
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("enrollment_id")).agg(
        F.min("o_orderkey").alias("contract_id"), F.min("o_orderdate").cast("date").alias("enroll_date"))


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """Check-ins from the event table (one month)."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("activity_id"), F.col("user_id").alias("enrollment_id"), F.col("ts").cast("date").alias("activity_date"),
        F.col("event_type").alias("activity_type"), F.when(F.col("event_type") == "error", "N").otherwise("Y").alias("verified_flag"))


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Check-ins over several years: one per line item, the supplier as enrollment. The date stays a raw
    column, so range predicates reach the scan."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("enrollment_id"), F.col("l_shipdate").alias("activity_date"),
        F.when(F.col("l_returnflag") == "R", "N").otherwise("Y").alias("verified_flag"))


def improvements(spark: SparkSession, sf: str) -> DataFrame:
    """Screenings from purchase events; some percents are negative."""
    cents = F.floor(F.round(F.col("value") * 100) / 5) - 500
    return table(spark, sf, "events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("improvement_id"), F.col("user_id").alias("enrollment_id"), F.col("ts").cast("date").alias("measure_date"),
        (cents.cast("decimal(7,0)") / 100).cast("decimal(5,2)").alias("improvement_pct"))


def renewals_2024(spark: SparkSession, sf: str) -> DataFrame:
    """Renewals already recorded for 2024: contracts of low order priority."""
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").where(F.col("o_orderpriority") == "5-LOW").select(
        F.col("o_orderkey").alias("contract_id"), F.add_months(d, (F.lit(2024) - F.year(d)) * 12).alias("renewal_date"),
        F.col("o_orderkey").alias("renewal_id"))


WELLNESS = """
enrollments AS (SELECT o_custkey AS enrollment_id, min(o_orderkey) AS contract_id, CAST(min(o_orderdate) AS DATE) AS enroll_date FROM orders GROUP BY 1),
improvements AS (SELECT event_id AS improvement_id, user_id AS enrollment_id, CAST(ts AS DATE) AS measure_date,
    CAST((CAST(floor(round(value*100)/5) AS INT) - 500)/100.0 AS DECIMAL(5,2)) AS improvement_pct FROM events WHERE event_type = 'purchase')"""
