"""Projections and filters over whole frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.functions import recode as R


def recode(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, R.mapped(col, mapping))


def tag(df: DataFrame, **const) -> DataFrame:
    """Constant columns such as load date, source file or cohort."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in const.items()})


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    """File name a row was read from; call it directly on a file read."""
    return df.withColumn(out, F.col("_metadata.file_name"))


def per_100k(df: DataFrame, rate: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or rate, R.per_100k(rate))


def rate_floor_report(df: DataFrame, rate: str) -> DataFrame:
    """Smallest non-zero rate and number of zero rates after normalising."""
    return df.agg(F.min(F.when(F.col(rate) > 0, F.col(rate))).alias("min_nonzero"),
                  F.count_if(F.col(rate) == 0).alias("zero_rates"), F.count(rate).alias("rates"))


def filter_with_audit(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every step, and one aggregate pass giving rows left and removed after each step."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("s0")]
    for i, (_, cond) in enumerate(steps, start=1):
        passed = passed & F.coalesce(cond, F.lit(False))
        counts.append(F.count_if(passed).alias(f"s{i}"))
    names = ["source rows"] + [name for name, _ in steps]
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"s{i}").alias("remaining"),
                     (F.col(f"s{max(i - 1, 0)}") - F.col(f"s{i}")).alias("removed")) for i, n in enumerate(names)]
    audit = df.agg(*counts).select(F.inline(F.array(*rows)))
    return df.where(passed), audit


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def scope_filter(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows in scope and a one-row count of kept and excluded rows."""
    inside = F.coalesce(cond, F.lit(False))
    report = df.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(inside).alias("retained"),
                    F.count_if(~inside).alias("excluded"))
    return df.where(inside), report


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def half_open(df: DataFrame, col: str, lo: date, hi: date, year_partition: str | None = None) -> DataFrame:
    """lo <= col < hi. A year partition column, if the layout has one, gets its own pruning predicate."""
    out = df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))
    if year_partition:
        last = hi.year - 1 if (hi.month, hi.day) == (1, 1) else hi.year
        out = out.where(F.col(year_partition).between(lo.year, last))
    return out


def by_status(df: DataFrame, col: str, status: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of one status; ``cols`` keeps the read to the columns asked for."""
    out = df.where(F.col(col) == status)
    return out.select(*cols) if cols else out


def status_count(df: DataFrame, col: str, status: str) -> DataFrame:
    return by_status(df, col, status).agg(F.count(F.lit(1)).alias("n"))


def ci_equals(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(R.same_text(col, F.lit(value)))


def options(df: DataFrame, cols: Sequence[str], order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Ordered pick list; with ``limit`` the first n in order."""
    out = df.select(*cols).orderBy(*order)
    return out.limit(limit) if limit else out


def one_hot(df: DataFrame, col: str, levels: Iterable, prefix: str) -> DataFrame:
    return df.select("*", *R.one_hot(col, list(levels), prefix))


def _indicator(col: str, level: str) -> Column:
    return F.coalesce(F.col(col) == level, F.lit(False)).cast("double").alias(f"{col}_{level}")


REFERENCE_LEVELS = {"age_band": "40-44", "gender": "F", "smoking_status": "never", "exercise_freq": "yes"}
FEATURE_LEVELS = {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS,
                  "smoking_status": fixed.SMOKING_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS}


def dummy_columns() -> list[Column]:
    """Indicators with one reference level left out per factor, plus numeric bmi."""
    return [_indicator(c, v) for c, levels in FEATURE_LEVELS.items() for v in levels
            if v != REFERENCE_LEVELS[c]] + [F.col("bmi").cast("double").alias("bmi_num")]


def full_columns() -> list[Column]:
    """Indicators of every level of every factor, plus numeric bmi."""
    return [_indicator(c, v) for c, levels in FEATURE_LEVELS.items() for v in levels] + [
        F.col("bmi").cast("double").alias("bmi_num")]


def dummy_names() -> list[str]:
    return [f"{c}_{v}" for c, levels in FEATURE_LEVELS.items() for v in levels
            if v != REFERENCE_LEVELS[c]] + ["bmi_num"]


def full_names() -> list[str]:
    return [f"{c}_{v}" for c, levels in FEATURE_LEVELS.items() for v in levels] + ["bmi_num"]


def dummy_matrix(df: DataFrame) -> DataFrame:
    return df.select("*", *dummy_columns())


def full_matrix(df: DataFrame) -> DataFrame:
    return df.select("*", *full_columns())


def labels(df: DataFrame, col: str = "diabetes_code") -> DataFrame:
    """Primary label (null for the in-between class 4) and the sensitivity label that counts it positive."""
    return df.withColumns({
        "label": R.mapped(col, {1: 1, 3: 0}).cast("byte"),
        "label_sensitivity": R.mapped(col, {1: 1, 3: 0, 4: 1}).cast("byte"),
    })
