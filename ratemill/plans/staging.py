"""Raw coded sources to staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratemill import fixed
from ratemill.functions import recode as R
from ratemill.operators import filters as P

SURVEY_CODES = ["diabetes_code", "smoker_code", "activity_code", "bmi_implied", "bmi_code", "age_code", "sex_code"]


def code(df: DataFrame, col: str) -> Column:
    """A numeric code column as int: whole-number types pass, doubles are checked, text is parsed strictly."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("int")
    if isinstance(kind, T.FractionalType):
        bad = F.raise_error(F.concat(F.lit("not a whole number: "), F.col(col).cast("string"))).cast("int")
        return F.when(F.col(col) != F.floor(col), bad).otherwise(F.col(col).cast("int"))
    return R.strict_int(col)


def survey_records(raw: DataFrame) -> DataFrame:
    """Respondent rows with recoded factors; a code outside its map becomes null and the row stays.

    Expects the columns of SURVEY_CODES as text or numbers; other columns pass through.
    """
    return _coded(raw).withColumns({
        "age_band": R.mapped("age_code", fixed.AGE_CODES),
        "gender": R.mapped("sex_code", fixed.GENDER_CODES),
        "smoking_status": R.mapped("smoker_code", fixed.SMOKING_CODES),
        "diabetes_status": R.mapped("diabetes_code", fixed.DIABETES_CODES),
        "bmi_band": R.mapped("bmi_code", fixed.BMI_CODES),
        "exercise_freq": R.mapped("activity_code", fixed.EXERCISE_CODES),
        "bmi_value": R.rescale("bmi_implied"),
    })


def _coded(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: code(raw, c) for c in SURVEY_CODES if c != "bmi_implied"})


def exam_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adult exam rows and the retained/excluded report.

    Expects age, sex_code, diabetes_code and bmi. An adult age above the last band or an unknown sex raises.
    """
    aged = raw.withColumn("age", R.age_int("age"))
    adults, report = P.scope_filter(aged, F.col("age") >= 18)
    band, sex = R.age_band("age"), R.mapped(R.strict_int("sex_code"), fixed.GENDER_CODES)
    no_band = F.raise_error(F.concat(F.lit("no band for age "), F.col("age").cast("string"))).cast("string")
    no_sex = F.raise_error(F.concat(F.lit("no gender for code "), F.col("sex_code").cast("string"))).cast("string")
    staged = adults.withColumns({
        "age_band": F.when(band.isNull(), no_band).otherwise(band),
        "gender": F.when(sex.isNull(), no_sex).otherwise(sex),
        "diabetes_biomarker": R.mapped(R.strict_int("diabetes_code"), fixed.EXAM_DIABETES_CODES),
        "bmi_measured": F.trim(F.col("bmi").cast("string")).try_cast("decimal(5,2)"),
    })
    return staged, report


def training_audit(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Modelling rows and the attrition of each exclusion, in order."""
    steps = [("outcome: gestational and non-response dropped", F.col("diabetes_code").isin(1, 3, 4)),
             ("age: unknown dropped", F.col("age_code").between(1, 13)),
             ("smoking: unknown dropped", F.col("smoker_code").isin(1, 2, 3, 4)),
             ("activity: non-response dropped", F.col("activity_code").isin(1, 2)),
             ("bmi: missing dropped", F.col("bmi_implied").isNotNull())]
    return P.filter_with_audit(raw, steps)


def training_frame(raw: DataFrame) -> DataFrame:
    """The wide modelling frame: labels, age band with one-hot columns and midpoint, sex, smoking, exercise, bmi."""
    kept, _ = training_audit(_coded(raw))
    f = P.labels(kept, "diabetes_code").withColumns({
        "age_band_label": R.mapped("age_code", fixed.AGE_CODES),
        "sex": R.mapped("sex_code", {1: "male", 2: "female"}),
        "smoking_status": R.mapped("smoker_code", fixed.SMOKING_CODES),
        "exercise": R.mapped("activity_code", fixed.EXERCISE_CODES),
        "bmi": R.rescale("bmi_implied").cast("float")})
    hot = [(F.col("age_code") == i).cast("byte").alias(f"age_band_{i:02d}") for i in range(1, 14)]
    return f.select(F.col("diabetes_code").cast("byte").alias("diabetes_response"), "label", "label_sensitivity",
                    F.col("age_code").cast("byte").alias("age_band"), *hot,
                    R.midpoint("age_band_label").alias("age_midpoint_years"), "sex", "smoking_status", "exercise", "bmi")


def mortality_extract(raw: DataFrame, source_year: int, flag: str, source_file: str,
                      sex: str = "Sex Code", group: str = "Ten-Year Age Groups Code", rate: str = "Crude Rate") -> DataFrame:
    """Sex-specific rows of an extract as probabilities; totals, footers and suppressed rates are dropped."""
    value = R.per_100k(rate)
    keep = F.col(sex).isin("M", "F") & ~R.is_blank(group) & value.isNotNull()
    long = F.raise_error(F.concat(F.lit("group code too long: "), F.col(group))).cast("string")
    rows = raw.where(keep).select(F.when(F.length(group) > 10, long).otherwise(F.col(group)).alias("age_band"),
                                  F.col(sex).alias("gender"), value.alias("mortality_rate"))
    return P.tag(rows, source_year=source_year, condition_flag=flag, source_file=source_file,
                 life_expectancy=F.lit(None).cast("decimal(5,2)"))
