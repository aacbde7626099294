"""Premium arithmetic on exact decimals, rounded half up."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratemill.functions.recode import _col


def premium_3dp(base_rate: Column | str, face: Column | str) -> Column:
    """Base rate per 1,000 of cover times face amount, held to a tenth of a cent."""
    product = F.round(_col(base_rate).cast("decimal(12,2)") * _col(face).cast("decimal(12,2)"), 0)
    return (product.cast("decimal(22,0)") * F.lit(Decimal("0.001"))).cast("decimal(18,3)")


def premium(base_rate: Column | str, face: Column | str) -> Column:
    return premium_3dp(base_rate, face).cast("decimal(12,2)")


def renewal_premium(base: Column | str, credit_pct: Column | str) -> Column:
    """Base premium less the credit percentage, rounded to cents."""
    keep = (F.lit(Decimal("100")) - _col(credit_pct).cast("decimal(9,6)")).cast("decimal(9,6)")
    return (_col(base).cast("decimal(15,3)") * keep * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def improvement_pct(measure_type: Column | str, baseline: Column | str, current: Column | str) -> Column:
    """Percent improvement against baseline; for exercise more is better, otherwise less."""
    b, v = _col(baseline).cast("decimal(8,2)"), _col(current).cast("decimal(8,2)")
    gain = F.when(F.lower(_col(measure_type)) == "exercise", v - b).otherwise(b - v)
    return (gain * F.lit(100) / F.nullif(b, F.lit(Decimal("0")))).cast("decimal(8,2)")


def anniversary(effective: Column | str, years: Column | int) -> Column:
    """Same day in a later year; 29 Feb falls back to 28 Feb."""
    n = F.lit(years) if isinstance(years, int) else years
    return F.add_months(_col(effective), n * 12)


def exact_ratio(num: Column, den: Column, dtype: str, digits: int = 6) -> Column:
    """num / den rounded half up once. Both sides are narrowed first: on wide decimals Spark shortens the
    quotient's scale, and rounding that again can turn a value just below a tie upwards."""
    quotient = num.cast(f"decimal(22,{digits})") / F.nullif(den, F.lit(0)).cast("decimal(14,0)")
    return quotient.cast(dtype)
