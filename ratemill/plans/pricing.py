"""From prevalence and mortality to a rate book."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import recode as R
from ratemill.operators import joins as J
from ratemill.operators.aggregates import weighted_means


def relative_risk(df: DataFrame, m: str = "m", p: str = "p", f: str = "f") -> DataFrame:
    """Relative mortality of the condition from population mortality m, prevalence p and the share f of deaths
    it causes. Solving m = p*md + (1-p)*mn and f*m = p*(md-mn) for md/mn gives rr; mn and md follow."""
    m_, p_, f_ = (F.col(c).cast("double") for c in (m, p, f))
    rr = (f_ * p_ - p_ - f_) / (p_ * (f_ - 1.0))
    out = df.withColumn("rr", rr)
    mn = m_ / (p_ * F.col("rr") + (1.0 - p_))
    return out.withColumn("mn", mn).withColumn("md", F.col("rr") * F.col("mn"))


def prevalence_for_rr(rr: Column, f: Column) -> Column:
    """The prevalence that yields a given relative risk (inverse of the relation in relative_risk)."""
    return f / (rr * (1.0 - f) + f - 1.0)


def life_table_baseline(singles: DataFrame) -> DataFrame:
    """Single ages (age, male_/female_ lives, death probability, life expectancy) to lives-weighted bands."""
    sexes = [F.struct(F.lit(g).alias("gender"), F.col(f"{s}_lives").alias("lives"),
                      F.col(f"{s}_death_probability").alias("mortality_rate"),
                      F.col(f"{s}_life_expectancy").alias("life_expectancy")) for g, s in (("M", "male"), ("F", "female"))]
    long = singles.select("age", F.inline(F.array(*sexes)))
    banded = J.band_join(long, "age", J.band_table(singles.sparkSession))
    return weighted_means(banded, ["age_band", "gender"], "lives",
                          {"mortality_rate": "decimal(8,6)", "life_expectancy": "decimal(5,2)"})


def condition_ratio(mortality: DataFrame, cohort: int) -> DataFrame:
    """Share of deaths from the condition per coarse group and gender, for one cohort."""
    rows = mortality.where(F.col("source_year") == cohort)
    r = J.pivot_ratio(rows, ["age_band", "gender"], "condition_flag", "mortality_rate", "DIABETES", "ALLCAUSE", "f")
    return r.select(F.col("age_band").alias("coarse_group"), "gender", "f")


def rating_cells(baseline: DataFrame, prev: DataFrame, ratio: DataFrame) -> DataFrame:
    """(age_band, gender) with m, p, f and the derived rr, mn, md; a band without a ratio raises."""
    cells = baseline.select("age_band", "gender", F.col("mortality_rate").alias("m")).join(
        prev.select("age_band", "gender", F.col("prevalence").alias("p")), ["age_band", "gender"], "left")
    cells = J.bridged_join(cells, ratio, "f")
    lacking = F.raise_error(F.concat(F.lit("no prevalence for "), F.col("age_band"))).cast("double")
    return relative_risk(cells.withColumn("p", F.when(F.col("p").isNull(), lacking).otherwise(F.col("p"))))


def risk_factors(cells: DataFrame, probs: DataFrame, undiagnosed: Decimal = fixed.UNDIAGNOSED_FRACTION) -> DataFrame:
    """Mortality multipliers (three digits) per profile and disclosed status, relative to population mortality.

    ``probs`` holds the probability of the condition per (age_band, gender, smoking_status, bmi_band).
    """
    joined = probs.join(F.broadcast(cells), ["age_band", "gender"])
    base = F.col("mn") * R.mapped("smoking_status", fixed.SMOKING_RELATIVITY).cast("double") \
        * R.mapped("bmi_band", fixed.BMI_RELATIVITY).cast("double")
    hidden = F.col("probability") * F.lit(float(undiagnosed)) * (F.col("rr") - 1.0)
    with_base = joined.withColumn("_base", base)
    m = F.col("m").cast("double")
    both = F.array(
        F.struct(F.lit("yes").alias("diabetes_status"), (F.col("_base") * F.col("rr") / m).alias("x")),
        F.struct(F.lit("no").alias("diabetes_status"), (F.col("_base") * (1.0 + hidden) / m).alias("x")))
    long = with_base.select("age_band", "gender", "smoking_status", "bmi_band", F.inline(both), "m")
    rounded = F.round("x", 3)
    bad = F.raise_error(F.concat(F.lit("multiplier out of range: "), F.col("x").cast("string"))).cast("decimal(6,3)")
    mult = F.when((rounded <= 0) | (rounded > 999.999) | rounded.isNull(), bad).otherwise(rounded.cast("decimal(6,3)"))
    return long.select(*fixed.FACTOR_KEY, mult.alias("mortality_multiplier"), F.col("m").cast("decimal(8,6)").alias("m"))


def product_factors(products: DataFrame) -> DataFrame:
    """Products with their structure factor; a product id without one raises."""
    factor = R.mapped("product_id", fixed.PRODUCT_FACTORS).cast("decimal(4,2)")
    unknown = F.raise_error(F.concat(F.lit("no factor for product "), F.col("product_id").cast("string"))).cast("decimal(4,2)")
    return products.select("product_id", F.when(factor.isNull(), unknown).otherwise(factor).alias("product_factor"))


def rate_book(factors: DataFrame, products: DataFrame, loading: Decimal = fixed.LOADING) -> DataFrame:
    """Annual rate per 1,000 of cover for every factor and product, in exact decimals."""
    crossed = J.cross_products(factors, products.select("product_id", "product_factor"))
    rate = (F.lit(Decimal("1000")).cast("decimal(4,0)") * F.col("m") * F.col("mortality_multiplier")
            * F.lit(loading).cast("decimal(4,2)") * F.col("product_factor").cast("decimal(4,2)")).cast("decimal(12,2)")
    return crossed.select(*fixed.FACTOR_KEY, "product_id", "mortality_multiplier", rate.alias("base_rate"))


def cohort_sensitivity(book_a: DataFrame, book_b: DataFrame) -> DataFrame:
    """The same profile and product priced from two cohorts, with the change in percent."""
    key = [*fixed.FACTOR_KEY, "product_id"]
    a = book_a.select(*key, F.col("base_rate").alias("rate_a"))
    b = book_b.select(*key, F.col("base_rate").alias("rate_b"))
    pct = ((F.col("rate_b") - F.col("rate_a")) * 100 / F.nullif(F.col("rate_a"), F.lit(0))).cast("decimal(12,4)")
    return a.join(b, key).withColumn("pct_change", pct)
