"""Data-quality rules. Each yields rows of one issue table; expectations raise on a breach."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.functions import recode as R
from ratemill.operators.aggregates import duplicates
from ratemill.operators.cumulative import numbered
from ratemill.operators.sets import union_facts

ISSUE_COLUMNS = ["table_name", "check_name", "column_name", "n", "example", "detail"]


@dataclass
class TableSpec:
    """Declared shape of a raw (all text) table."""

    columns: Sequence[str]
    identity: Sequence[str] = ()
    sequential_key: str | None = None
    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    numeric: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    date_order: Sequence[tuple[str, str]] = ()


Fact = tuple[str, str, Column, Column, str]


def _facts(df: DataFrame, table: str, facts: Sequence[Fact]) -> DataFrame:
    """Issue rows of (check, column, count, example, detail) facts, all from one aggregate pass."""
    if not facts:
        return _none(df)
    one = df.agg(*[F.struct(n.alias("n"), ex.alias("e")).alias(f"f{i}") for i, (_, _, n, ex, _) in enumerate(facts)])
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(c).alias("column_name"),
                     F.col(f"f{i}.n").alias("n"), F.col(f"f{i}.e").alias("example"), F.lit(d).alias("detail"))
            for i, (check, c, _, _, d) in enumerate(facts)]
    return one.select(F.inline(F.array(*rows))).where("n > 0")


def _none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "table_name string, check_name string, column_name string, n bigint, example string, detail string")


def column_issues(df: DataFrame, table: str, spec: TableSpec) -> DataFrame:
    """Columns not declared, and declared ones that are absent (identity columns may be)."""
    found = [(table, "columns", c, 1, c, "not declared") for c in df.columns if c not in spec.columns]
    found += [(table, "columns", c, 1, c, "missing") for c in spec.columns
              if c not in df.columns and c not in spec.identity]
    found += [(table, "identity", c, 1, c, "identity must not be supplied") for c in spec.identity if c in df.columns]
    return df.sparkSession.createDataFrame(found, _none(df).schema)


def not_null_facts(cols: Sequence[str]) -> list[Fact]:
    return [("not_null", c, F.count_if(R.is_blank(c)), F.lit(None).cast("string"), "blank") for c in cols]


def length_facts(limits: Mapping[str, int]) -> list[Fact]:
    out = []
    for c, limit in limits.items():
        v = F.col(c).cast("string")
        bad = F.length(v) > limit
        out.append(("length", c, F.count_if(bad), F.min_by(F.when(bad, v), F.struct(-F.length(v), v)), f"max length {limit}"))
    return out


def numeric_facts(types: Mapping[str, tuple[int, int]]) -> list[Fact]:
    """Text that is no number or does not fit NUMERIC(p, s) as written."""
    out = []
    for c, (p, s) in types.items():
        v = F.trim(F.col(c).cast("string"))
        fits = v.rlike(rf"^[+-]?0*[0-9]{{0,{p - s}}}(\.[0-9]{{0,{s}}})?$") & v.rlike("[0-9]")
        bad = ~R.is_blank(c) & ~fits
        out.append(("numeric", c, F.count_if(bad), F.min(F.when(bad, v)), f"numeric({p},{s})"))
    return out


def malformed_facts(cols: Sequence[str]) -> list[Fact]:
    return [("malformed", c, F.count_if(R.malformed(c)), F.min(F.when(R.malformed(c), F.col(c).cast("string"))), "generator error text")
            for c in cols]


def date_order_facts(pairs: Sequence[tuple[str, str]]) -> list[Fact]:
    out = []
    for a, b in pairs:
        bad = R.iso_date(b) < R.iso_date(a)
        out.append(("date_order", b, F.count_if(bad), F.min(F.when(bad, F.col(b).cast("string"))), f"before {a}"))
    return out


def column_facts(df: DataFrame, spec: TableSpec) -> list[Fact]:
    """Every rule that looks at one row at a time, over the declared columns the table has."""
    here = set(df.columns)
    return [*not_null_facts([c for c in spec.not_null if c in here]),
            *length_facts({c: n for c, n in spec.max_length.items() if c in here}),
            *numeric_facts({c: t for c, t in spec.numeric.items() if c in here}),
            *malformed_facts([c for c in spec.columns if c in here]),
            *date_order_facts([(a, b) for a, b in spec.date_order if {a, b} <= here])]


def row_issues(df: DataFrame, table: str, spec: TableSpec) -> DataFrame:
    """The row rules of a table in one scan."""
    return _facts(df, table, column_facts(df, spec))


def unique_issues(df: DataFrame, table: str, keys: Sequence[Sequence[str]]) -> DataFrame:
    out = _none(df)
    for cols in keys:
        out = out.unionByName(duplicates(df, cols).where("duplicate_keys > 0").select(
            F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"),
            F.lit(", ".join(cols)).alias("column_name"), F.col("worst_count").alias("n"),
            F.col("worst_key").alias("example"), F.lit("repeated key").alias("detail")))
    return out


def sequential_issues(df: DataFrame, table: str, key: str) -> DataFrame:
    """A key must hold exactly 1..n. Distinct values inside the range prove it; no sort is needed."""
    v = F.col(key).try_cast("bigint")
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(v).alias("d"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    gaps = F.when((F.col("lo") == 1) & (F.col("hi") == F.col("rows")) & (F.col("d") == F.col("rows")), F.lit(0)).otherwise(
        F.greatest(F.col("rows") - F.col("d"), F.lit(1)))
    return facts.where("rows > 0").select(
        F.lit(table).alias("table_name"), F.lit("sequence").alias("check_name"), F.lit(key).alias("column_name"),
        gaps.cast("bigint").alias("n"), F.concat_ws("..", "lo", "hi").alias("example"),
        F.lit("must be 1..row count").alias("detail")).where("n > 0")


def sequence_in_order(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key differs from their position in ``order`` (1..n), with the first such key."""
    run = numbered(df.select(F.col(key), F.col(order).alias("_order")), "_order", "_pos", [key])
    bad = ~F.col(key).eqNullSafe(F.col("_pos"))
    return run.agg(F.count_if(bad).alias("n"), F.min_by(F.when(bad, F.col(key)), F.when(bad, F.col("_pos"))).alias("example"))


def fk_issues(tables: Mapping[str, DataFrame], fks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Child values with no parent; blank child values are allowed. A missing parent key column stands for
    an identity that numbers the parent's rows 1..n."""
    out = None
    for child, col, parent, pcol in fks:
        c = tables[child].where(~R.is_blank(col)).groupBy(F.col(col).cast("string").alias("_k")).agg(
            F.count(F.lit(1)).alias("_n"))
        p = tables[parent]
        if pcol in p.columns:
            bad = c.join(p.select(F.col(pcol).cast("string").alias("_k")), "_k", "left_anti")
        else:
            top = p.agg(F.count(F.lit(1)).alias("_top"))
            num = F.col("_k").try_cast("bigint")
            known = F.coalesce((num >= 1) & (num <= F.col("_top")) & (num.cast("string") == F.col("_k")), F.lit(False))
            bad = c.join(F.broadcast(top)).where(~known)
        row = bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.min("_k").alias("example")).where("n > 0").select(
            F.lit(child).alias("table_name"), F.lit("orphan").alias("check_name"), F.lit(col).alias("column_name"),
            "n", "example", F.lit(f"no parent in {parent}.{pcol}").alias("detail"))
        out = row if out is None else out.unionByName(row)
    return out


def issue_report(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec],
                 fks: Sequence[tuple[str, str, str, str]] = ()) -> DataFrame:
    """All rules over all tables as one long issue table."""
    parts = []
    for name, spec in specs.items():
        df = tables[name]
        parts += [column_issues(df, name, spec), row_issues(df, name, spec), unique_issues(df, name, spec.unique)]
        if spec.sequential_key:
            parts.append(sequential_issues(df, name, spec.sequential_key))
    if fks:
        parts.append(fk_issues(tables, fks))
    return union_facts(*parts).select(*ISSUE_COLUMNS)


def report_markdown(issues: DataFrame, title: str) -> str:
    """The issue table (a few rows per declared column) as Markdown text, row by row."""
    lines = [f"# {title}", ""]
    rows = ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |"
            for r in issues.select(*ISSUE_COLUMNS).orderBy(*ISSUE_COLUMNS[:3]).toLocalIterator()]
    if not rows:
        return "\n".join([*lines, "No issues found.", ""])
    lines += ["| " + " | ".join(ISSUE_COLUMNS) + " |", "|" + "---|" * len(ISSUE_COLUMNS)]
    return "\n".join([*lines, *rows, ""])


def repaired_value(col: str, index: str, start: date, end: date, blank: tuple[int, int] | None = None,
                   not_before: str | None = None) -> Column:
    """Malformed dates replaced by start + index mod span; some blanked by index; floored at another date."""
    i = F.col(index)
    made = F.date_add(F.lit(start), F.pmod(i, F.lit((end - start).days + 1)).cast("int"))
    if not_before:
        made = F.greatest(made, F.coalesce(R.iso_date(not_before), made))
    text = made.cast("string")
    if blank:
        text = F.when(F.pmod(i, F.lit(blank[0])) < blank[1], F.lit("")).otherwise(text)
    return F.when(R.malformed(col), text).otherwise(F.col(col))


def cycled(cond: Column, col: str, index: str, values: Sequence[str]) -> Column:
    """Cells that meet ``cond`` take values in turn by row index."""
    picks = R.constants(values)
    return F.when(cond, F.get(picks, F.pmod(F.col(index), F.lit(len(values))).cast("int"))).otherwise(F.col(col))


def repair(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Applies column repairs one after another, so a later rule sees an earlier repair."""
    for name, expr in rules.items():
        df = df.withColumn(name, expr)
    return df


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Issues of both states side by side with what became of each."""
    keys = ["table_name", "check_name", "column_name", "detail"]
    j = before.select(*keys, F.col("n").alias("n_before")).join(after.select(*keys, F.col("n").alias("n_after")), keys, "full")
    return j.select(*keys, F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after")
                    ).withColumn("outcome", F.when(F.col("n_after") == 0, "fixed").when(F.col("n_before") == 0, "new")
                                 .when(F.col("n_after") < F.col("n_before"), "reduced").otherwise("open"))


def consistency(df: DataFrame, derived: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Rows whose stored value differs from the one derived again, per named check."""
    facts = df.agg(*[F.count_if(~F.col(c).eqNullSafe(e)).alias(n) for n, (c, e) in derived.items()])
    return facts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("mismatches"))
                                           for n in derived])))


def within_window(df: DataFrame, parent: DataFrame, key: str, on: str, lo: str, hi: str) -> DataFrame:
    """Rows dated outside their parent's [lo, hi) window; an open end never violates."""
    days = df.groupBy(key, on).agg(F.count(F.lit(1)).alias("_n"))
    j = days.join(parent.select(key, lo, hi), key)
    bad = (F.col(on) < F.col(lo)) | F.coalesce(F.col(on) >= F.col(hi), F.lit(False))
    return j.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                 F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("violations"))


def verify_pack(tables: Mapping[str, DataFrame], date_cols: Mapping[str, Sequence[str]],
                fks: Sequence[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Post-load facts: row counts, date ranges and orphans."""
    from ratemill.operators.aggregates import date_profile, row_counts
    from ratemill.operators.joins import fk_orphans
    return {"row_counts": row_counts(tables),
            "dates": union_facts(*[date_profile(tables[t], t, c) for t, c in date_cols.items()]),
            "orphans": fk_orphans(tables, fks)}


class ExpectationError(ValueError):
    """A data expectation does not hold."""


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ExpectationError(message)


def expect_columns(df: DataFrame, cols: Sequence[str], optional: Sequence[str] = ()) -> None:
    missing = [c for c in cols if c not in df.columns and c not in optional]
    _check(not missing, f"missing columns: {missing}")


def expect_values(df: DataFrame, col: str, allowed: Sequence) -> None:
    odd = df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))).groupBy(col).count()
    found = odd.agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("rows"), F.min(col).alias("low"), F.max(col).alias("high")).first()
    _check(not found["n"], f"{col} holds {found['n']} values outside {list(allowed)} in {found['rows']} rows, from {found['low']} to {found['high']}")


def expect_count(df: DataFrame, n: int, what: str = "rows") -> None:
    found = df.count()
    _check(found == n, f"expected {n} {what}, found {found}")


def expect_range(df: DataFrame, value: Column, lo: float, hi: float, what: str) -> None:
    v = df.agg(value.cast("double").alias("v")).first()["v"]
    _check(v is not None and lo <= v <= hi, f"{what} = {v} outside {lo}..{hi}")


def expect_one_active(versions: DataFrame) -> None:
    n = versions.where(R.same_text("status", F.lit("active"))).count()
    _check(n == 1, f"expected one active version, found {n}")


def expect_same_groups(extracts: Mapping[str, DataFrame], group: str, sex: str, required: Sequence[str],
                       suppressed: Sequence[tuple[str, str, str]] = (), same: Sequence[Sequence[str]] = ()) -> None:
    """Extracts must share headers, hold both sexes for the required groups, lack the (extract, group, sex)
    named as suppressed, and have equal group sets where listed in ``same``. Cells are compared by joins, whatever their number."""
    headers = {tuple(d.columns) for d in extracts.values()}
    _check(len(headers) == 1, "headers differ between extracts")
    cells = {name: d.select(group, sex).where(F.col(sex).isin("F", "M")).distinct() for name, d in extracts.items()}
    for name, found in cells.items():
        if required:
            kind = found.schema[group].dataType
            needed = found.sparkSession.createDataFrame([(str(g), s) for g in required for s in ("F", "M")], "g string, s string").select(F.col("g").cast(kind).alias(group), F.col("s").alias(sex))
            lacking = sorted({str(r[0]) for r in needed.join(found, [group, sex], "left_anti").collect()})     # at most the required ones
            _check(not lacking, f"{name} lacks a sex for {lacking}")
    for names in same:
        first = cells[names[0]].select(group).distinct()
        for other in names[1:]:
            groups = cells[other].select(group).distinct()
            equal = first.join(groups, group, "left_anti").isEmpty() and groups.join(first, group, "left_anti").isEmpty()
            _check(equal, f"groups differ between {list(names)}")
    for name, g, s in suppressed:
        _check(cells[name].where((F.col(group) == g) & (F.col(sex) == s)).isEmpty(), f"{name} should not hold {g}/{s}")
