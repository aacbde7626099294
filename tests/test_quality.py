"""Rules, repairs and expectations on small dirty tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ratemill.operators import aggregates as A
from ratemill.operators import quality as Q
from ratemill.operators.sets import coverage_diff

CLAIMS = [("1", "2024-01-05", "2024-02-01", "10.50", "NY", "1"), ("2", "error: invalid date", "2024-01-01", "12345.678", "California", "9"),
          ("3", "2024-03-01", "2024-02-01", "abc", " ", ""), ("5", "2024-03-01", "", "-0.10", "NY", "2")]
COLS = "claim_id string, claim_date string, settlement_date string, amount string, state string, customer_id string"
SPEC = Q.TableSpec(columns=["claim_id", "claim_date", "settlement_date", "amount", "state", "customer_id", "note", "serial"], identity=["serial"],
                   sequential_key="claim_id", not_null=["state"], max_length={"state": 2}, numeric={"amount": (6, 2)}, unique=[["claim_id"], ["state"]],
                   date_order=[("claim_date", "settlement_date")])


def tables(spark):
    return {"claims": spark.createDataFrame(CLAIMS, COLS), "customers": spark.createDataFrame([("a",), ("b",)], "name string")}


def issues(spark, t=None):
    return Q.issue_report(t or tables(spark), {"claims": SPEC}, [("claims", "customer_id", "customers", "customer_id")])


def test_report(spark):
    got = {(r["check_name"], r["column_name"]): (r["n"], r["example"]) for r in issues(spark).collect()}
    assert got == {("columns", "note"): (1, "note"), ("not_null", "state"): (1, None), ("length", "state"): (1, "California"), ("numeric", "amount"): (2, "12345.678"),
                   ("malformed", "claim_date"): (1, "error: invalid date"), ("date_order", "settlement_date"): (1, "2024-02-01"), ("unique", "state"): (2, "NY"),
                   ("sequence", "claim_id"): (1, "1..5"), ("orphan", "customer_id"): (1, "9")}
    text = Q.report_markdown(issues(spark), "Claims")
    assert text.startswith("# Claims") and "| claims | orphan | customer_id | 1 | 9 |" in text


def test_supplied_identity(spark):
    df = spark.createDataFrame([("1", "2")], "serial string, note string")
    got = {(r["check_name"], r["column_name"]) for r in Q.column_issues(df, "t", SPEC).collect()}
    assert ("identity", "serial") in got and ("columns", "amount") in got


@pytest.mark.parametrize("text,bad", [("1234.56", 0), ("12345.6", 1), ("0001234.5", 0), ("-1.2", 0), ("1.234", 1), (".", 1), ("+.5", 0), ("", 0), ("1e3", 1)])
def test_numeric_fit(spark, text, bad):
    df = spark.createDataFrame([(text,)], "amount string")
    assert Q.row_issues(df, "t", Q.TableSpec(columns=[], numeric={"amount": (6, 2)})).count() == bad


def test_repair_and_comparison(spark):
    t = tables(spark)
    df = t["claims"].withColumn("i", F.col("claim_id").cast("int"))
    fixed = Q.repair(df, {"claim_date": Q.repaired_value("claim_date", "i", date(2024, 1, 1), date(2024, 1, 31)),
                          "state": Q.cycled(R_blank(), "state", "i", ["CA", "NY"])}).drop("i")
    assert [r["claim_date"] for r in fixed.where("claim_id = '2'").collect()] == ["2024-01-03"]
    after = issues(spark, {**t, "claims": fixed})
    got = {(r["check_name"], r["column_name"]): r["outcome"] for r in Q.before_after(issues(spark), after).collect()}
    assert got[("malformed", "claim_date")] == "fixed" and got[("not_null", "state")] == "fixed"
    assert got[("numeric", "amount")] == "open" and got[("date_order", "settlement_date")] == "new" or got[("date_order", "settlement_date")] == "open"


def R_blank():
    return F.trim("state") == ""


def test_repair_blanks_and_floor(spark):
    df = spark.createDataFrame([(i, "error: invalid", "2024-06-01") for i in range(10)], "i int, d string, a string")
    got = [r["d"] for r in df.select("i", Q.repaired_value("d", "i", date(2024, 1, 1), date(2024, 1, 5), (10, 3), "a").alias("d")).orderBy("i").collect()]
    assert got == [""] * 3 + ["2024-06-01"] * 7


def test_sequence_in_order(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (4, 3), (3, 4)], "k int, o int")
    r = Q.sequence_in_order(df, "k", "o").first()
    assert (r["n"], r["example"]) == (2, 4)


def test_consistency_and_windows(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, None), (4, None, "x")], "k int, a string, b string")
    assert Q.consistency(df, {"same": ("a", F.col("b"))}).first()["mismatches"] == 2
    child = spark.createDataFrame([(1, date(2024, 1, 1)), (1, date(2024, 1, 9)), (1, date(2023, 1, 1)), (2, date(2030, 1, 1))], "k int, d date")
    parent = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 9)), (2, date(2024, 1, 1), None)], "k int, lo date, hi date")
    assert tuple(Q.within_window(child, parent, "k", "d", "lo", "hi").first()) == (4, 2)


def test_expectations(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    Q.expect_columns(df, ["k", "z"], optional=["z"])
    Q.expect_values(df, "v", ["x", "y"])
    Q.expect_count(df, 2)
    Q.expect_range(df, F.avg("k"), 1, 2, "mean")
    for fails in (lambda: Q.expect_columns(df, ["z"]), lambda: Q.expect_values(df, "v", ["x"]), lambda: Q.expect_count(df, 3),
                  lambda: Q.expect_range(df, F.avg("k"), 0.08, 0.16, "mean"), lambda: Q.expect_one_active(spark.createDataFrame([("Active",), ("active",)], "status string"))):
        with pytest.raises(Q.ExpectationError):
            fails()


def test_extract_structure(spark):
    def ext(cells):
        return spark.createDataFrame(cells, "grp string, sex string")
    both = [(g, s) for g in ("15-24", "25-34") for s in "FM"]
    good = {"all": ext(both + [("1-4", "M")]), "part": ext(both + [("1-4", "M")])}
    Q.expect_same_groups(good, "grp", "sex", ["15-24", "25-34"], [("part", "1-4", "F")], [["all", "part"]])
    with pytest.raises(Q.ExpectationError, match="lacks a sex"):
        Q.expect_same_groups({"a": ext(both[:-1])}, "grp", "sex", ["25-34"])
    with pytest.raises(Q.ExpectationError, match="should not hold"):
        Q.expect_same_groups(good, "grp", "sex", [], [("part", "1-4", "M")])
    with pytest.raises(Q.ExpectationError, match="groups differ"):
        Q.expect_same_groups({"a": ext(both), "b": good["all"]}, "grp", "sex", [], [], [["a", "b"]])
    with pytest.raises(Q.ExpectationError, match="headers"):
        Q.expect_same_groups({"a": ext(both), "b": ext(both).withColumn("x", F.lit(1))}, "grp", "sex", [])


def test_sets_and_duplicates(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(map(tuple, coverage_diff(a, b, ["k"]).collect())) == [(1, "unexpected"), (3, "missing")]
    assert coverage_diff(a, a, ["k"]).count() == 0
    assert tuple(A.duplicates(a, ["k"]).first()) == (1, 2, 2, "2")
    assert tuple(A.reachability(spark.createDataFrame([(1, 1), (1, 2), (2, 5), (2, 5), (3, None)], "k int, t int"), "k", "t").first()) == (1, 1, 1)


def test_verify_pack(spark):
    t = {"p": spark.createDataFrame([(1, date(2024, 1, 1))], "id int, d date"), "c": spark.createDataFrame([(1,), (7,), (None,)], "pid int")}
    out = Q.verify_pack(t, {"p": ["d"]}, [("c", "pid", "p", "id")])
    assert {tuple(r) for r in out["row_counts"].collect()} == {("p", 1), ("c", 3)}
    assert tuple(out["dates"].first()) == ("p.d", date(2024, 1, 1), date(2024, 1, 1))
    assert tuple(out["orphans"].first()) == ("c.pid", "p.id", 1, "7")


def test_extract_structure_of_many_groups(spark):
    cells = spark.range(12_000).selectExpr("concat('g', id) as grp", "explode(array('F', 'M')) as sex")
    Q.expect_same_groups({"a": cells, "b": cells}, "grp", "sex", ["g0", "g11999"], [("a", "g12000", "F")], [["a", "b"]])
    with pytest.raises(Q.ExpectationError, match="groups differ"):
        Q.expect_same_groups({"a": cells, "b": cells.where("grp <> 'g11998'")}, "grp", "sex", [], [], [["a", "b"]])


def test_values_are_counted(spark):
    with pytest.raises(Q.ExpectationError, match="500 values"):
        Q.expect_values(spark.range(500).selectExpr("cast(id as string) as v"), "v", ["x"])
