"""Recodes, shares, relative risk, rate book and publication."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.functions import recode as R
from ratemill.operators import aggregates as A
from ratemill.operators import filters as P
from ratemill.operators import joins as J
from ratemill.operators.quality import ExpectationError
from ratemill.plans import pricing, publish, refresh, staging
from ratemill.session import cut_lineage, run_folder, shared_dir
from ratemill.sources import files as S

_FACTOR_COLS = "age_band, gender, smoking_status, diabetes_status, bmi_band"


@query("WITH" + star.RECORDS + """
SELECT age_band, gender, smoking_status, diabetes_status, bmi_band, exercise_freq, count(*) AS n,
  CAST(sum(bmi_value) AS DOUBLE) AS bmi_sum, count(bmi_value) AS bmi_rows FROM records GROUP BY ALL""")
def survey_staging(spark, sf):
    rec = star.records(spark, sf)
    return rec.groupBy("age_band", "gender", "smoking_status", "diabetes_status", "bmi_band", "exercise_freq").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bmi_value").alias("bmi_sum"), F.count("bmi_value").alias("bmi_rows"))


@query(f"""WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(ceil(l_quantity*13/50) AS INT) AS code,
  CAST(CAST(round(l_extendedprice*10) AS BIGINT)/10.0::DOUBLE AS DECIMAL(18,1)) AS crude, CAST(round(l_tax*100) AS INT) AS tax FROM lineitem),
r AS (SELECT *, CASE code {star._CODE_CASE} END AS age_band FROM b)
SELECT age_band, {star.coarse_case('age_band')} AS coarse_group,
  round(CASE age_band WHEN '18-24' THEN 21.0 WHEN '80-99' THEN 89.5 ELSE 22.0 + ({star.band_no('age_band')}-1)*5 END, 6)::DOUBLE AS midpoint,
  CAST({star.band_no('age_band')} AS BIGINT) AS band_no, CASE WHEN tax <= 0 THEN 0 ELSE tax END::BIGINT AS young_age,
  CAST(q/100.0 AS DOUBLE) AS rescaled, 'lineitem' AS source, count(*) AS n,
  CAST(sum(CAST(crude::DOUBLE/100000 AS DECIMAL(8,6))) AS DOUBLE) AS rate_sum FROM r GROUP BY ALL""")
def recode_pack(spark, sf):
    """Text codes through every scalar recode, grouped."""
    line = table(spark, sf, "lineitem").select(
        F.concat(F.ceil(F.col("l_quantity") * 13 / 50).cast("string"), F.lit(".0")).alias("code"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")).alias("q"),
        F.col("l_tax").alias("tax"), F.floor(F.col("l_extendedprice") * 10 + 0.5).cast("decimal(12,0)").alias("tenths"))
    out = P.tag(line, source="lineitem").withColumns({
        "age_band": R.mapped(R.strict_int("code"), fixed.AGE_CODES),
        "young_age": R.age_int(F.floor(F.col("tax") * 100 + 0.5)),
        "rescaled": R.rescale(R.strict_int("q")),
        "rate": R.per_100k(R.rescale("tenths", 10, "decimal(12,1)"))})
    out = out.withColumns({"coarse_group": R.coarse_group("age_band"), "midpoint": R.midpoint("age_band"),
                           "band_no": R.ordinal("age_band", fixed.AGE_LABELS)})
    return out.groupBy("age_band", "coarse_group", "midpoint", "band_no", "young_age", "rescaled", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rate").alias("rate_sum"))


@query("WITH" + star.SURVEY + """,
k AS (SELECT * FROM survey WHERE diabetes_code IN (1,3,4) AND age_code BETWEEN 1 AND 13 AND smoker_code IN (1,2,3,4) AND activity_code IN (1,2) AND bmi_implied IS NOT NULL)
SELECT CAST(age_code AS BIGINT) AS age_band, CAST(CASE age_code WHEN 1 THEN 21.0 WHEN 13 THEN 89.5 ELSE 17.0 + 5*age_code END AS DOUBLE) AS midpoint,
  CASE sex_code WHEN 1 THEN 'male' ELSE 'female' END AS sex, CASE WHEN smoker_code <= 2 THEN 'current' WHEN smoker_code = 3 THEN 'former' ELSE 'never' END AS smoking_status,
  CASE activity_code WHEN 1 THEN 'yes' ELSE 'no' END AS exercise, count(*) AS n, count(CASE WHEN diabetes_code <> 4 THEN 1 END) AS labelled,
  count(CASE WHEN diabetes_code = 1 THEN 1 END) AS positives, count(CASE WHEN diabetes_code IN (1,4) THEN 1 END) AS sensitivity_positives,
  """ + ", ".join(f"count(CASE WHEN age_code = {i} THEN 1 END) AS band_{i:02d}" for i in range(1, 14)) + """ FROM k GROUP BY ALL""")
def frame_features(spark, sf):
    f = staging.training_frame(star.survey(spark, sf))
    return f.groupBy("age_band", F.col("age_midpoint_years").alias("midpoint"), "sex", "smoking_status", "exercise").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.sum(F.coalesce("label", F.lit(0))).alias("positives"),
        F.sum("label_sensitivity").alias("sensitivity_positives"), *[F.sum(f"age_band_{i:02d}").alias(f"band_{i:02d}") for i in range(1, 14)])


@query("WITH" + star.RECORDS + """
SELECT CAST(sum((age_band = '18-24')::INT) AS BIGINT) AS a18, CAST(sum((gender = 'M')::INT) AS BIGINT) AS male, CAST(sum((gender = 'F')::INT) AS BIGINT) AS female,
  CAST(sum((smoking_status = 'current')::INT) AS BIGINT) AS smokes, CAST(sum((exercise_freq = 'no')::INT) AS BIGINT) AS idle, count(*) AS n
FROM records WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL AND exercise_freq IS NOT NULL AND bmi_value IS NOT NULL""")
def indicator_sums(spark, sf):
    rec = P.complete_cases(star.records(spark, sf), ["age_band", "gender", "smoking_status", "exercise_freq", "bmi_value"])
    m = P.full_matrix(rec.withColumn("bmi", F.col("bmi_value")).select("age_band", "gender", "smoking_status", "exercise_freq", "bmi"))
    return m.agg(F.sum("age_band_18-24").cast("bigint").alias("a18"), F.sum("gender_M").cast("bigint").alias("male"),
                 F.sum("gender_F").cast("bigint").alias("female"), F.sum("smoking_status_current").cast("bigint").alias("smokes"),
                 F.sum("exercise_freq_no").cast("bigint").alias("idle"), F.count(F.lit(1)).alias("n"))


@query("WITH" + star.MORTALITY + """
SELECT age_band, gender, lives, CAST(mortality_rate AS DOUBLE) AS mortality_rate, CAST(life_expectancy AS DOUBLE) AS life_expectancy FROM baseline""")
def weighted_band_means(spark, sf):
    return pricing.life_table_baseline(star.life_table(star.deaths(spark, sf)))


@query("WITH" + star.RECORDS + "," + star.SHARES + """
SELECT exercise_freq, share_rows AS n, round(share, 6) AS share FROM shares""")
def marginal_shares(spark, sf):
    return A.marginal_shares(star.counts(spark, sf), "exercise_freq", fixed.EXERCISE_LEVELS, weight="n")


@query("WITH" + star.RECORDS + "," + star.PROBS + """
SELECT age_band, gender, smoking_status, bmi_band, round(probability, 6) AS probability FROM probs""")
def marginalise(spark, sf):
    return star.probabilities(star.counts(spark, sf))


@query("WITH" + star.RECORDS + "," + star.PREV + """
SELECT age_band, gender, round(p, 6) AS prevalence FROM prev""")
def prevalence_by_band(spark, sf):
    return A.prevalence(star.counts(spark, sf), ["age_band", "gender"], weight="n").select("age_band", "gender", "prevalence")


@query("WITH" + star.MORTALITY + """
SELECT a.age_band AS coarse_group, a.gender, round(d.mortality_rate::DOUBLE / a.mortality_rate::DOUBLE, 6) AS f
FROM mortality a JOIN mortality d USING (source_year, age_band, gender) WHERE a.condition_flag = 'ALLCAUSE' AND d.condition_flag = 'DIABETES' AND source_year = 2023""")
def pivot_ratio(spark, sf):
    return pricing.condition_ratio(star.mortality(star.deaths(spark, sf)), 2023)


@query("WITH" + star.MORTALITY + """,
d AS (SELECT age_band, gender, a.mortality_rate - b.mortality_rate AS d FROM mortality a JOIN mortality b USING (age_band, gender)
  WHERE a.condition_flag = 'ALLCAUSE' AND b.condition_flag = 'ALLCAUSE' AND a.source_year = 2024 AND b.source_year = 2023)
SELECT round(avg(abs(d)), 6) AS mean_abs_diff, CAST(max(abs(d)) AS DOUBLE) AS max_abs_diff, count(CASE WHEN d > 0 THEN 1 END) AS higher,
  count(CASE WHEN d < 0 THEN 1 END) AS lower, count(CASE WHEN d = 0 THEN 1 END) AS equal,
  (SELECT age_band || '|' || gender FROM d ORDER BY abs(d) DESC, age_band, gender LIMIT 1) AS max_at FROM d""")
def cohort_compare(spark, sf):
    m = star.mortality(star.deaths(spark, sf)).where("condition_flag = 'ALLCAUSE'")
    return A.cohort_compare(m, ["age_band", "gender"], "source_year", "mortality_rate", 2024, 2023)


@query("WITH" + star.MORTALITY + """
SELECT CAST(min(mortality_rate) FILTER (WHERE mortality_rate > 0) AS DOUBLE) AS min_nonzero,
  count(*) FILTER (WHERE mortality_rate = 0) AS zero_rates, count(*) AS rates FROM mortality""")
def rate_floor(spark, sf):
    return P.rate_floor_report(star.mortality(star.deaths(spark, sf)).where("condition_flag <> 'BASELINE'"), "mortality_rate")


@query("WITH" + star.RECORDS + "," + star.MORTALITY + "," + star.PREV + "," + star.cells_sql(2023) + """
SELECT age_band, gender, CAST(m AS DOUBLE) AS m, round(p, 6) AS p, round(f, 6) AS f, round(rr, 6) AS rr, round(mn, 6) AS mn, round(md, 6) AS md FROM cells""")
def relative_risk(spark, sf):
    return star.Inputs(spark, sf).cells().select("age_band", "gender", "m", "p", "f", "rr", "mn", "md")


@query("WITH" + star.RATING + "," + star.book_sql(2023) + f"""
SELECT {_FACTOR_COLS}, CAST(mortality_multiplier AS DOUBLE) AS mortality_multiplier, CAST(m AS DOUBLE) AS m FROM book_factors""")
def risk_factor_grid(spark, sf):
    return star.Inputs(spark, sf).factors()


@query("WITH" + star.RATING + "," + star.book_sql(2023) + f"""
SELECT {_FACTOR_COLS}, CAST(product_id AS BIGINT) AS product_id, CAST(mortality_multiplier AS DOUBLE) AS mortality_multiplier,
  CAST(base_rate AS DOUBLE) AS base_rate FROM book""")
def rate_book(spark, sf):
    return star.book(spark, sf)


@query("WITH" + star.RATING + "," + star.book_sql(2023) + "," + star.book_sql(2024, "cells24", "book24") + f"""
SELECT {_FACTOR_COLS}, CAST(product_id AS BIGINT) AS product_id, CAST(a.base_rate AS DOUBLE) AS rate_a, CAST(b.base_rate AS DOUBLE) AS rate_b,
  round(CAST(CAST(((b.base_rate - a.base_rate)*100)::DOUBLE / nullif(a.base_rate, 0)::DOUBLE AS DECIMAL(12,4)) AS DOUBLE), 6) AS pct_change
FROM book a JOIN book24 b USING ({_FACTOR_COLS}, product_id)""")
def cohort_sensitivity(spark, sf):
    inputs = star.Inputs(spark, sf)
    return pricing.cohort_sensitivity(inputs.book(2023), inputs.book(2024))


@query("WITH" + star.RATING + "," + star.book_sql(2023) + f"""
SELECT {_FACTOR_COLS}, CAST(product_id AS BIGINT) AS product_id, 1::BIGINT AS rate_version_id, CAST(base_rate AS DOUBLE) AS base_rate,
  CAST(row_number() OVER (PARTITION BY product_id ORDER BY {_FACTOR_COLS}) AS BIGINT) AS risk_factor_id FROM book""")
def publish_roundtrip(spark, sf):
    """Publishes the book under a fresh folder, has a second publication fail, and reads what is active."""
    root = f"{shared_dir(spark)}/publish-{uuid.uuid4().hex}"
    inputs = star.Inputs(spark, sf)
    book = inputs.book()
    n = inputs.products.count()
    state = {"source_path": "lineitem", "content_hash": "0" * 64, "byte_size": 1}
    publish.publish(spark, root, book, date(2026, 1, 1), n_factors=624, n_rates=624 * n, sources="lineitem", state=state, first=True)
    try:
        publish.publish(spark, root, book, date(2026, 2, 1), n_factors=624, n_rates=624 * n, state=state, fail_after_state=True)
        raise AssertionError("the forced failure did not fail")
    except RuntimeError:
        pass
    active = J.active_rate_book(publish.versions(spark, root), publish.factors(spark, root), publish.rates(spark, root))
    run = publish.versions(spark, root).where("status = 'active'").select(F.col("created_by_run_id").alias("derived_from_run_id"))
    ids = publish.factors(spark, root).join(run, "derived_from_run_id").select(*fixed.FACTOR_KEY, "risk_factor_id")
    return active.drop("mortality_multiplier").join(ids, fixed.FACTOR_KEY)


@query("WITH" + star.RATING + "," + star.book_sql(2023) + f"""
SELECT 1::BIGINT AS run_id, 'failed' AS status, NULL::BIGINT AS rate_version_id, 'expected ' || (count(*) + 1) || ' rates, wrote ' || count(*) AS notes, 0::BIGINT AS rates FROM book
UNION ALL SELECT 2, 'success', 1, '{publish.run_notes()}', count(*) FROM book""")
def publication_log(spark, sf):
    """A publication that misses its row count and leaves nothing visible, then one that succeeds, with their notes."""
    root = f"{shared_dir(spark)}/publish-{uuid.uuid4().hex}"
    book = cut_lineage(star.book(spark, sf))
    n = book.count()
    for wanted in (n + 1, n):
        try:
            publish.publish(spark, root, book, date(2026, 1, 1), n_factors=624, n_rates=wanted, notes=publish.run_notes(), first=True)
        except ExpectationError:
            if wanted == n:
                raise
    rates = publish.rates(spark, root).groupBy("rate_version_id").agg(F.count(F.lit(1)).alias("rates"))
    return publish.runs(spark, root).select("run_id", "status", "rate_version_id", "notes").join(rates, "rate_version_id", "left").withColumn("rates", F.coalesce("rates", F.lit(0)))


@query("WITH" + star.RATING + "," + star.book_sql(2023) + "," + star.book_sql(2024, "cells24", "book24") + f""",
n AS (SELECT (SELECT count(*) FROM book_factors) AS n),
f AS (SELECT *, row_number() OVER (ORDER BY {_FACTOR_COLS}) AS no FROM book_factors),
all_rates AS (SELECT 1 AS v, no, base_rate FROM book JOIN f USING ({_FACTOR_COLS}) UNION ALL SELECT 2, no, base_rate FROM book24 JOIN f USING ({_FACTOR_COLS})
  UNION ALL SELECT 3, no, base_rate FROM book JOIN f USING ({_FACTOR_COLS}))
SELECT CAST(v AS BIGINT) AS rate_version_id, CASE v WHEN 3 THEN 'active' ELSE 'superseded' END AS status, count(*) AS rates, round(CAST(sum(base_rate) AS DOUBLE), 6) AS total,
  min(no + (v - 1) * n) AS first_factor, max(no + (v - 1) * n) AS last_factor, CAST(v <= 2 AS BIGINT) AS seen_before FROM all_rates, n GROUP BY ALL""")
def publish_two_writers(spark, sf):
    """Two runs prepared from the same state and committed in the other order, and what a reader of the position between them sees."""
    root = run_folder(spark, "writers")
    inputs = star.Inputs(spark, sf)
    n = inputs.products.count()
    size = dict(n_factors=624, n_rates=624 * n)
    publish.publish(spark, root, inputs.book(), date(2026, 1, 1), first=True, **size)
    slow = publish.prepare(spark, root, inputs.book(), date(2026, 3, 1), **size)
    quick = publish.prepare(spark, root, inputs.book(2024), date(2026, 2, 1), **size)
    publish.commit(spark, quick)
    between = publish.position(spark, root)
    publish.commit(spark, slow)
    rates = publish.rates(spark, root).groupBy("rate_version_id").agg(
        F.count(F.lit(1)).alias("rates"), F.sum("base_rate").alias("total"), F.min("risk_factor_id").alias("first_factor"), F.max("risk_factor_id").alias("last_factor"))
    seen = publish.versions(spark, root, between).select("rate_version_id", F.lit(True).alias("seen_before"))
    out = publish.versions(spark, root).select("rate_version_id", "status").join(rates, "rate_version_id").join(seen, "rate_version_id", "left")
    return out.withColumn("seen_before", F.coalesce("seen_before", F.lit(False)))


@query("WITH" + star.RATING + "," + star.book_sql(2023) + f""",
f AS (SELECT *, row_number() OVER (ORDER BY {_FACTOR_COLS}) AS risk_factor_id FROM book_factors)
SELECT CAST(risk_factor_id AS BIGINT) AS risk_factor_id, CAST(product_id AS BIGINT) AS product_id, CAST(base_rate AS DOUBLE) AS base_rate
FROM book JOIN f USING ({_FACTOR_COLS})""")
def rate_factor_ids(spark, sf):
    from pyspark.sql import Window
    inputs = star.Inputs(spark, sf)
    f = inputs.factors().withColumns({
        "risk_factor_id": F.row_number().over(Window.orderBy(*fixed.FACTOR_KEY)), "derived_from_run_id": F.lit(7)})
    return J.attach_factor_ids(inputs.book(), f, 7).select("risk_factor_id", "product_id", "base_rate")


@query("""WITH n AS (SELECT count(DISTINCT p_partkey % 15) AS products FROM part), l AS (SELECT count(*) AS respondents FROM lineitem)
SELECT step, outcome, run_id, version AS rate_version_id, run_status, version_status, CASE WHEN version IS NULL THEN 0 ELSE 624 END AS factors,
  CASE WHEN version IS NULL THEN 0 ELSE 624*products END AS rates, CAST(gated AS BIGINT) AS gated, CAST(direction AS BIGINT) AS direction_passed, CAST(kept AS BIGINT) AS book_of_first, respondents
FROM n, l, (VALUES (1::BIGINT, 'retrained', 1::BIGINT, 1::BIGINT, 'success', 'superseded', 1, 1, 1), (2, 'unchanged', 2, 2, 'success', 'active', 0, NULL, 1),
  (3, 'gate_failed', 3, NULL, 'failed', NULL, 1, 0, 0)) t(step, outcome, run_id, version, run_status, version_status, gated, direction, kept)""")
def refresh_outcomes(spark, sf):
    """Three whole refresh runs over all respondents: a first source, the same again, and one whose risk falls with age while deaths from the
    condition rise with it. The last stops at the gate; the others publish a version each, the second from the profile the first one kept."""
    root = run_folder(spark, "refresh")
    raw = star.survey(spark, sf).withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_partkey", "l_shipdate", "bmi_implied"))
    kept = run_folder(spark, "respondents")
    raw.write.parquet(kept)         # by columns: most steps read a few of them
    raw = spark.read.schema(raw.schema).parquet(kept)
    deaths = star.mortality(cut_lineage(star.deaths(spark, sf)))
    of_condition = (F.col("mortality_rate") * R.ordinal("age_band", fixed.COARSE_LABELS) / 10).cast("decimal(8,6)")
    every = deaths.where("condition_flag = 'ALLCAUSE'")
    mortality = cut_lineage(deaths.where("condition_flag = 'BASELINE'").unionByName(every).unionByName(
        every.withColumns({"condition_flag": F.lit("DIABETES"), "mortality_rate": of_condition})))
    products = cut_lineage(table(spark, sf, "part").select((F.pmod("p_partkey", F.lit(15)) + 1).cast("int").alias("product_id")).distinct())

    def source(slope: int) -> DataFrame:
        """Respondents whose share of cases rises by ``slope`` percent a step of the age code, by the key's hash."""
        limit = 50 + slope * (F.col("age_code") - 7)
        return raw.withColumn("diabetes_code", F.when(F.pmod(F.xxhash64("row_key"), F.lit(100)) < limit, 1).otherwise(3))

    steps = []
    for step, slope in enumerate((4, 4, -4), 1):
        state = S.frame_fingerprint(source(slope), "survey").first().asDict()
        done = refresh.run_refresh(spark, root, source(slope), "row_key", mortality, products, date(2026, step, 1), state, cohort=2024, first=step == 1)
        direction = None if done.gate is None else bool(done.gate["direction_passed"])
        steps.append((step, done.outcome, done.run and done.run["rate_version_id"], done.gate is not None, direction))
    made = spark.createDataFrame(steps, "step bigint, outcome string, rate_version_id bigint, gated boolean, direction_passed boolean")
    log = publish.runs(spark, root).select(F.col("run_id").cast("bigint").alias("run_id"), F.col("status").alias("run_status"))
    rates = publish.rates(spark, root).groupBy("rate_version_id").agg(
        F.count(F.lit(1)).alias("rates"), F.countDistinct("risk_factor_id").alias("factors"), F.sum("base_rate").alias("total"))
    chain = publish.versions(spark, root).select("rate_version_id", F.col("status").alias("version_status"))
    first = rates.where("rate_version_id = 1").select(F.col("total").alias("first_total"))
    out = made.join(log, made["step"] == log["run_id"]).join(rates, "rate_version_id", "left").join(chain, "rate_version_id", "left").join(F.broadcast(first))
    return out.join(F.broadcast(raw.agg(F.count(F.lit(1)).alias("respondents")))).select(
        "step", "outcome", "run_id", "rate_version_id", "run_status", "version_status", F.coalesce("factors", F.lit(0)).alias("factors"),
        F.coalesce("rates", F.lit(0)).alias("rates"), "gated", "direction_passed", F.coalesce(F.col("total") == F.col("first_total"), F.lit(False)).alias("book_of_first"), "respondents")


_DOCS = """
obs AS (SELECT source || '/' || lang AS source_path, arg_max(sha256(text), doc_id) AS content_hash, arg_max(strlen(text), doc_id) AS byte_size FROM documents GROUP BY 1),
known AS (SELECT source || '/' || lang AS source_path, arg_max(sha256(text), doc_id) AS known_hash FROM documents JOIN labels USING (doc_id) GROUP BY 1)"""


@query("WITH" + _DOCS + """
SELECT source_path, content_hash, CAST(byte_size AS BIGINT) AS byte_size, known_hash, CAST(content_hash IS DISTINCT FROM known_hash AS BIGINT) AS changed,
  CASE WHEN content_hash IS NOT DISTINCT FROM known_hash THEN 'unchanged' WHEN byte_size > 2000 THEN 'retrained' ELSE 'gate_failed' END AS outcome
FROM obs LEFT JOIN known USING (source_path)""")
def change_detection(spark, sf):
    """Latest text per source and language as the observed file, labelled texts as the states on record."""
    d = table(spark, sf, "documents")
    hashed = d.select(F.concat_ws("/", "source", "lang").alias("source_path"), F.sha2("text", 256).alias("content_hash"),
                      F.octet_length("text").alias("byte_size"), F.col("doc_id").alias("source_state_id"))
    known = hashed.join(table(spark, sf, "labels").select(F.col("doc_id").alias("source_state_id")), "source_state_id", "left_semi")
    observed = hashed.groupBy("source_path").agg(F.max_by(F.struct("content_hash", "byte_size"), "source_state_id").alias("o")).select(
        "source_path", "o.*")
    out = publish.changed(known, observed)
    return out.withColumn("outcome", publish.outcome(F.col("changed"), F.col("byte_size") > 2000))


_AUC = """(SELECT (sum(r) FILTER (WHERE y = 1) - p*(p+1)/2.0) / (p*q) FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1)/2.0 AS r,
  count(*) FILTER (WHERE y = 1) OVER () AS p, count(*) FILTER (WHERE y = 0) OVER () AS q FROM {t}) GROUP BY p, q)"""


@query(f"""WITH l AS (SELECT toxic AS y, n_chars AS s, quality FROM labels JOIN documents USING (doc_id)), l2 AS (SELECT quality AS y, n_chars AS s FROM l JOIN (SELECT 1) ON TRUE),
l2x AS (SELECT quality AS y, s FROM l), a AS (SELECT {_AUC.format(t='l2x')} AS new_auc, {_AUC.format(t='l')} AS base_auc)
SELECT round(new_auc, 6) AS new_auc, round(base_auc, 6) AS base_auc, 0.5::DOUBLE AS min_spearman, 0::BIGINT AS new_violations, 1::BIGINT AS base_violations,
  round(base_auc - 0.02, 6) AS min_auc, 0::BIGINT AS baseline_recorded, CAST(new_auc >= base_auc - 0.02 AS BIGINT) AS auc_passed, 1::BIGINT AS direction_passed,
  1::BIGINT AS violations_passed, CAST(new_auc >= base_auc - 0.02 AS BIGINT) AS passed FROM a""".replace(
    ", l2 AS (SELECT quality AS y, n_chars AS s FROM l JOIN (SELECT 1) ON TRUE)", ""))
def metric_gate(spark, sf):
    """Gate of one labelled score against another; the other two metrics are given."""
    from ratemill.operators.ranking import auc
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    new = auc(d, [], "quality", "n_chars").select("auc", F.lit(0.5).alias("min_spearman"), F.lit(0).cast("bigint").alias("violations"))
    base = auc(d, [], "toxic", "n_chars").select("auc", F.lit(1).cast("bigint").alias("violations"))
    return publish.gate(new, base)


@query("""WITH t AS (SELECT doc_id, trim(replace(unnest(string_split(text, chr(10))), chr(13), '')) AS line FROM documents)
SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars, count(CASE WHEN line LIKE '%,%' THEN 1 END) AS with_comma,
  count(CASE WHEN contains(line, ',') AND TRY_CAST(trim(split_part(line, ',', 1)) AS INTEGER) IS NOT NULL THEN 1 END) AS numeric_first FROM t GROUP BY 1""")
def lake_text_tokens(spark, sf):
    """Every text as a raw lake file: lines, then positional fields."""
    lines = S.lines_of(table(spark, sf, "documents"), "text", "doc_id")
    parsed = S.tokenize(lines, "line", {"first": "int", "second": "string"})
    return parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"), F.count_if(F.col("line").like("%,%")).alias("with_comma"),
        F.count_if(F.col("line").contains(",") & F.col("first").isNotNull()).alias("numeric_first"))


@query("""SELECT event_id, CAST(TRY_CAST(nullif(rtrim(raw_k), '') AS INTEGER) AS BIGINT) AS k,
  CAST(TRY_CAST(nullif(rtrim(raw_day), '') AS DATE) AS VARCHAR) AS day, nullif(rtrim(raw_type), '') AS event_type
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN '   ' ELSE json_extract_string(props, '$.k') || '  ' END AS raw_k,
  CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') || ' ' END AS raw_day, event_type || '  ' AS raw_type FROM events)""")
def typed_load(spark, sf):
    """Padded, blank and unparsable text to typed columns."""
    e = table(spark, sf, "events")
    t = F.col("event_type")
    raw = e.select(F.col("event_id").cast("string").alias("event_id"),
                   F.when(t == "error", F.lit("   ")).otherwise(F.concat(F.get_json_object("props", "$.k"), F.lit("  "))).alias("k"),
                   F.when(t == "view", F.lit("")).when(t == "click", F.lit("n/a")).otherwise(
                       F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" "))).alias("day"),
                   F.concat(t, F.lit("  ")).alias("event_type"))
    return S.typed_load(raw, {"event_id": "bigint", "k": "int", "day": "date", "event_type": "string"})


@query("WITH" + star.MORTALITY + """,
s AS (SELECT age, l.gender, rate FROM life l WHERE age BETWEEN 45 AND 49 AND gender = 'M')
SELECT CAST(age AS BIGINT) AS age, CAST(rate AS DOUBLE) AS male_death_probability, age_band, CAST(mortality_rate AS DOUBLE) AS staged_rate
FROM s, baseline b WHERE b.age_band = '45-49' AND b.gender = 'M'""")
def lake_vs_staged(spark, sf):
    """Life-table lines parsed from text beside the staged band they belong to."""
    life = star.life_table(cut_lineage(star.deaths(spark, sf)))
    lines = life.select(F.concat_ws(",", F.col("age").cast("string"), F.col("male_death_probability").cast("string")).alias("line"))
    parsed = S.tokenize_json(lines, ["line"], "line", {"age": "int", "male_death_probability": "decimal(12,8)"})
    staged = pricing.life_table_baseline(life).select("age_band", "gender", F.col("mortality_rate").alias("staged_rate"))
    return J.lake_join(parsed, staged, F.col("age").between(45, 49), (F.col("gender") == "M") & (F.col("age_band") == "45-49")).select(
        "age", "male_death_probability", "age_band", "staged_rate")


@query(f"""WITH l AS (SELECT toxic AS y, n_chars AS s FROM labels JOIN documents USING (doc_id)), a AS (SELECT {_AUC.format(t='l')} AS auc), n AS (SELECT count(*) AS labelled FROM l)
SELECT case_no, new_auc, passed, auc_passed, direction_passed, labelled FROM n, (
  SELECT 1::BIGINT AS case_no, NULL::DOUBLE AS new_auc, 0::BIGINT AS passed, 0::BIGINT AS auc_passed, 1::BIGINT AS direction_passed
  UNION ALL SELECT 2, round(auc, 6), 0, 1, 0 FROM a UNION ALL SELECT 3, NULL, 0, 0, 0 UNION ALL SELECT 4, round(auc, 6), 1, 1, 1 FROM a)""")
def metric_gate_undefined(spark, sf):
    """Gates of the labelled documents: every row of one class has no AUC, a constant score no correlation; neither passes, both defined do."""
    from ratemill.operators.ranking import auc, spearman
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").withColumns({"one": F.lit(1), "same": F.col("n_chars") * 0})
    schema = "auc double, min_spearman double, violations bigint"
    base = spark.createDataFrame([(auc(d, [], "toxic", "n_chars").first()["auc"], 0)], "auc double, violations bigint")
    parts = []
    for case_no, label, score in ((1, "one", "n_chars"), (2, "toxic", "same"), (3, "one", "same"), (4, "toxic", "n_chars")):
        steps = d.agg(F.count_if(F.col(score) < 0).alias("violations"), F.count(F.lit(1)).alias("labelled")).first()
        row = auc(d, [], label, "n_chars").first()["auc"], spearman(d, [], score, "n_chars").first()["spearman"], steps["violations"]
        gated = publish.gate(spark.createDataFrame([row], schema), base)       # a row of metrics, as a bundle holds it
        parts.append(gated.select(F.lit(case_no).cast("bigint").alias("case_no"), "new_auc", "passed", "auc_passed", "direction_passed", F.lit(steps["labelled"]).cast("bigint").alias("labelled")))
    return reduce(DataFrame.unionAll, parts)
