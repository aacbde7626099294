"""Column expressions that recode, band and parse single values. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratemill import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal(v) -> str:
    """A constant as SQL text, so that a long list of constants is one expression to build instead of many."""
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, float):
        return f"{v!r}D"
    return str(v)


def constants(values) -> Column:
    """An array of constants."""
    return F.expr(f"array({', '.join(literal(v) for v in values)})")


def mapped(c: Column | str, mapping: Mapping) -> Column:
    """Value of ``mapping`` for ``c``; null for a value the mapping does not hold.

    A constant map keeps ``c`` to one evaluation however deep recodes are nested.
    """
    pairs = ", ".join(literal(x) for kv in mapping.items() for x in kv)
    return F.try_element_at(F.expr(f"map({pairs})"), _col(c))


def blank_to_null(c: Column | str) -> Column:
    """Trailing blanks dropped, empty text as null."""
    return F.nullif(F.rtrim(_col(c).cast("string")), F.lit(""))


def _trimmed(c: Column | str) -> Column:
    return F.trim(_col(c).cast("string"))


def strict_int(c: Column | str) -> Column:
    """Numeric code such as ``3`` or ``3.0``; blank is null, a fraction or text raises."""
    text = _trimmed(c)
    v = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("int")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(None).cast("int")).when(v == F.floor(v), v.cast("int")).otherwise(bad)


def age_int(c: Column | str) -> Column:
    """Age in whole years; a value of at least 0 and below 1 counts as 0."""
    v = _trimmed(c).try_cast("double")
    return F.when((v >= 0) & (v < 1), F.lit(0)).otherwise(strict_int(c))


def rescale(c: Column | str, by: int = 100, dtype: str = "decimal(5,2)") -> Column:
    """Value with implied decimals, e.g. 2834 -> 28.34, rounded half up. ``by`` is a power of ten."""
    return (_col(c).cast("decimal(14,4)") * F.lit(Decimal(1) / Decimal(by))).cast(dtype)


def per_100k(c: Column | str, dtype: str = "decimal(8,6)") -> Column:
    """Crude rate per 100,000 as a probability with six digits."""
    return (_trimmed(c).try_cast("decimal(12,4)") * F.lit(Decimal("0.00001"))).cast(dtype)


def age_band(c: Column | str) -> Column:
    """One of 13 inclusive age bands of a whole age; null outside 18 to 99."""
    lowest = fixed.AGE_BANDS[0][0]
    per_age = constants(label for lo, hi, label in fixed.AGE_BANDS for _ in range(lo, hi + 1))
    return F.get(per_age, _col(c).cast("int") - lowest)


def bmi_band(c: Column | str) -> Column:
    """Half-open BMI bands under / normal / over / obese; null stays null."""
    c = _col(c)
    ladder = F.when(c.isNull(), F.lit(None).cast("string"))
    for label, upper in fixed.BMI_UPPER:
        ladder = ladder.when(c < F.lit(upper), F.lit(label))
    return ladder.otherwise(F.lit("obese"))


def coarse_group(c: Column | str) -> Column:
    """Ten-year mortality group of a fine age band."""
    return mapped(c, fixed.COARSE_GROUP)


def midpoint(c: Column | str) -> Column:
    return mapped(c, fixed.age_midpoints()).cast("float")


def ordinal(c: Column | str, order: Sequence[str]) -> Column:
    """Position (from 1) of a label in a fixed order, for sorting; null for an unknown label."""
    return mapped(c, {label: i + 1 for i, label in enumerate(order)})


def one_hot(c: Column | str, levels: Sequence, prefix: str) -> list[Column]:
    """One byte column per level, named prefix + level."""
    c = _col(c)
    return [F.coalesce(c == F.lit(v), F.lit(False)).cast("byte").alias(f"{prefix}{v}") for v in levels]


def same_text(a: Column | str, b: Column | str) -> Column:
    """Text equality that ignores case."""
    return F.collate(_col(a), "UTF8_LCASE") == F.collate(_col(b), "UTF8_LCASE")


def malformed(c: Column | str) -> Column:
    """True for generator error text left in a cell."""
    return F.coalesce(_col(c).cast("string").rlike(fixed.MALFORMED_PATTERN), F.lit(False))


def is_blank(c: Column | str) -> Column:
    c = _col(c).cast("string")
    return c.isNull() | (F.trim(c) == "")


def iso_date(c: Column | str) -> Column:
    """Date of a well-formed yyyy-MM-dd text, else null."""
    c = _col(c).cast("string")
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def age_at(dob: Column | str, on: Column | str) -> Column:
    """Completed years, decided by comparing month and day (29 Feb counts from 1 Mar)."""
    dob, on = _col(dob), _col(on)
    before = (F.month(on) * 100 + F.dayofmonth(on)) < (F.month(dob) * 100 + F.dayofmonth(dob))
    return F.year(on) - F.year(dob) - before.cast("int")
