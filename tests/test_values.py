"""Single-value rules: recodes, bands, dates and premium arithmetic."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import money, recode as R


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()], F.lit(0).alias("_"))
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("age,band", [(17, None), (18, "18-24"), (24, "18-24"), (25, "25-29"), (79, "75-79"), (80, "80-99"), (99, "80-99"), (100, None)])
def test_age_band(spark, age, band):
    assert one(spark, R.age_band("a"), a=age) == band


@pytest.mark.parametrize("bmi,band", [("18.49", "under"), ("18.50", "normal"), ("24.99", "normal"), ("25.00", "over"), ("29.99", "over"), ("30.00", "obese")])
def test_bmi_band(spark, bmi, band):
    assert one(spark, R.bmi_band("b"), b=D(bmi)) == band


def test_every_band_has_a_group_and_midpoint(spark):
    rows = spark.createDataFrame([(x,) for x in fixed.AGE_LABELS], "b string").select(
        "b", R.coarse_group("b").alias("g"), R.midpoint("b").alias("m"), R.ordinal("b", fixed.AGE_LABELS).alias("o")).collect()
    assert {r["b"]: r["g"] for r in rows} == fixed.COARSE_GROUP
    by = {r["b"]: r["m"] for r in rows}
    assert (by["18-24"], by["25-29"], by["80-99"]) == (21.0, 27.0, 89.5)
    assert sorted(r["o"] for r in rows) == list(range(1, 14))


@pytest.mark.parametrize("text,value", [("3", 3), (" 3.0 ", 3), ("", None), (None, None), ("-1", -1)])
def test_strict_int(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(R.strict_int("c").alias("r")).first()["r"] == value


@pytest.mark.parametrize("text", ["3.5", "abc"])
def test_strict_int_rejects(spark, text):
    with pytest.raises(Exception, match="not a whole number"):
        spark.createDataFrame([(text,)], "c string").select(R.strict_int("c")).collect()


@pytest.mark.parametrize("text,value", [("5.397605346934028e-79", 0), ("0.9", 0), ("1", 1), ("44", 44), ("", None)])
def test_age_int(spark, text, value):
    assert one(spark, R.age_int("a"), a=text) == value


def test_recode_unknown_is_null(spark):
    assert one(spark, R.mapped("c", fixed.SMOKING_CODES), c=9) is None
    assert one(spark, R.mapped("c", fixed.SMOKING_CODES), c=2) == "current"


def test_quoted_constants(spark):
    assert one(spark, R.mapped("c", {"it's": "a\\b"}), c="it's") == "a\\b"


def test_rescale_and_rates(spark):
    assert one(spark, R.rescale("v"), v=2834) == D("28.34")
    assert one(spark, R.per_100k("v"), v="106.2") == D("0.001062")
    assert one(spark, R.per_100k("v"), v="Not Applicable") is None


@pytest.mark.parametrize("dob,on,age", [(date(2000, 2, 29), date(2025, 2, 28), 24), (date(2000, 2, 29), date(2025, 3, 1), 25), (date(1980, 7, 1), date(2020, 7, 1), 40)])
def test_age_at(spark, dob, on, age):
    assert one(spark, R.age_at("d", "o"), d=dob, o=on) == age


def test_text_rules(spark):
    assert one(spark, R.same_text("a", "b"), a="Active", b="aCTIVE") is True
    assert one(spark, R.malformed("a"), a="ERROR:   Invalid date") is True
    assert one(spark, R.malformed("a"), a="(blank)") is True
    assert one(spark, R.malformed("a"), a="2024-01-01") is False
    assert one(spark, R.iso_date("a"), a="2024-02-30") is None
    assert one(spark, R.iso_date("a"), a="2024-2-3") is None
    assert one(spark, R.iso_date("a"), a="2024-02-29") == date(2024, 2, 29)


def test_premiums(spark):
    assert one(spark, money.premium("b", "f"), b=D("9.93"), f=250000) == D("2482.50")
    assert one(spark, money.premium("b", "f"), b=D("57.27"), f=250000) == D("14317.50")
    assert one(spark, money.premium("b", "f"), b=D("7.15"), f=250000) == D("1787.50")
    assert one(spark, money.renewal_premium("b", "c"), b=D("2905.00"), c=D("15")) == D("2469.25")
    assert one(spark, money.renewal_premium("b", "c"), b=D("10.050"), c=D("50")) == D("5.03")


def test_improvement(spark):
    assert one(spark, money.improvement_pct("t", "b", "v"), t="BMI", b=D("30"), v=D("27")) == D("10.00")
    assert one(spark, money.improvement_pct("t", "b", "v"), t="Exercise", b=D("30"), v=D("36")) == D("20.00")
    assert one(spark, money.improvement_pct("t", "b", "v"), t="smoking", b=D("0"), v=D("36")) is None


def test_ratio_rounds_once(spark):
    # 129.999855 / 1878 is 0.0692225 less a hair's breadth in wide decimals, and must not be lifted by a second rounding
    num, den = D("129.999300"), 1878
    want = (num / den).quantize(D("0.000001"), rounding="ROUND_HALF_UP")
    assert one(spark, money.exact_ratio(F.col("n"), F.col("d"), "decimal(8,6)"), n=num, d=den) == want


def test_anniversary_of_leap_day(spark):
    assert one(spark, money.anniversary("d", 1), d=date(2020, 2, 29)) == date(2021, 2, 28)
