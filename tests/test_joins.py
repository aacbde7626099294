"""Joins, as-of matching, pair-free counts and credits against brute force."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.operators import aggregates as A
from ratemill.operators import joins as J
from ratemill.operators import ranking as K
from ratemill.session import broadcast_if_small


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_spreading_join(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, None), (4, 11)], "c long, e long")
    right = spark.createDataFrame([(10, "a"), (2, "no"), (3, "no")], "e long, v string")
    got = {r["c"]: r["v"] for r in J.left_join_spreading_nulls(left, right, "e", "c").collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None}


VERSIONS = [(1, date(2021, 1, 1), date(2022, 1, 1)), (2, date(2022, 1, 1), date(2023, 1, 1)), (3, date(2022, 6, 1), date(2022, 7, 1)), (4, date(2023, 1, 1), None)]


def test_as_of_version(spark):
    v = spark.createDataFrame(VERSIONS, "rate_version_id int, effective_date date, expiry_date date")
    days = [date(2020, 12, 31) + timedelta(days=i) for i in range(0, 900, 7)] + [date(2021, 1, 1), date(2022, 1, 1), date(2022, 6, 1), date(2022, 7, 1), date(2023, 1, 1)]
    got = {r["d"]: r["rate_version_id"] for r in K.as_of_version(spark.createDataFrame([(d,) for d in days], "d date"), "d", v).collect()}
    for d in days:
        hits = [i for i, a, b in VERSIONS if a <= d and (b is None or d < b)]
        assert got[d] == (max(hits) if hits else None)


def as_of(spark, versions, times, kind):
    v = spark.createDataFrame(versions, f"rate_version_id int, effective_date {kind}, expiry_date {kind}")
    return {r["t"]: r["rate_version_id"] for r in K.as_of_version(spark.createDataFrame([(t,) for t in times], f"t {kind}"), "t", v).collect()}


@pytest.mark.parametrize("range_rows", [3, 10_000])
def test_as_of_far_dates_and_times(spark, monkeypatch, range_rows):
    """A date of the year 9999 costs nothing, times within a day count, many overlapping versions are one by one the highest."""
    from ratemill.operators import cumulative
    monkeypatch.setattr(cumulative, "RANGE_ROWS", range_rows)
    assert as_of(spark, VERSIONS, [date(9999, 12, 31), date(1, 1, 1), date(2022, 6, 15), None], "date") == {date(9999, 12, 31): 4, date(1, 1, 1): None, date(2022, 6, 15): 3, None: None}
    rng = np.random.default_rng(8)
    t0 = datetime(2024, 1, 1)
    versions = []
    for i in range(60):
        a = int(rng.integers(0, 500))
        versions.append((i, t0 + timedelta(hours=a), None if i % 17 == 3 else t0 + timedelta(hours=a + int(rng.integers(-3, 120)))))
    times = [t0 + timedelta(minutes=int(m)) for m in rng.integers(-600, 45_000, 300)] + [v[1] for v in versions]
    got = as_of(spark, versions, times, "timestamp")
    for t in times:
        hits = [i for i, a, b in versions if a <= t and (b is None or t < b)]
        assert got[t] == (max(hits) if hits else None), t
    none = spark.createDataFrame([], "rate_version_id int, effective_date date, expiry_date date")
    assert [r["rate_version_id"] for r in K.as_of_version(spark.createDataFrame([(date(2020, 1, 1),)], "t date"), "t", none).collect()] == [None]


def test_version_chain_leaves_one_active(spark):
    v = spark.createDataFrame([(i, date(2020 + i, 1, 1)) for i in range(1, 5)], "rate_version_id int, effective_date date")
    out = K.version_chain(v).orderBy("rate_version_id").collect()
    assert [r["status"] for r in out] == ["superseded"] * 3 + ["active"]
    assert [r["expiry_date"] for r in out] == [date(2022, 1, 1), date(2023, 1, 1), date(2024, 1, 1), None]


@pytest.mark.parametrize("shared", [False, True])
def test_reachable_pairs_brute_force(spark, shared):
    rng = np.random.default_rng(3)
    ca = pd.DataFrame({"contract_id": rng.integers(0, 40, 90), "account_id": rng.choice(6, 90, p=[0.5, 0.1, 0.1, 0.1, 0.1, 0.1])}).drop_duplicates()
    ab = pd.DataFrame({"account_id": [b % 5 for b in range(12)], "billing_account_id": range(12)})
    if shared:
        ab = pd.concat([ab, pd.DataFrame({"account_id": [1, 2], "billing_account_id": [0, 0]})])
    cd = pd.DataFrame({"contract_id": range(40), "effective_date": [date(2024, 1, 1) + timedelta(days=int(x)) for x in rng.integers(0, 60, 40)]})
    inv = pd.DataFrame({"invoice_id": range(200), "billing_account_id": rng.choice(12, 200), "run_date": [date(2024, 1, 1) + timedelta(days=int(x)) for x in rng.integers(0, 60, 200)]})
    pairs = ca.merge(ab).merge(inv).merge(cd)[["contract_id", "invoice_id", "run_date", "effective_date"]].drop_duplicates()
    got = J.reachable_pair_facts(*[spark.createDataFrame(x) for x in (ca, ab, cd, inv)]).first()
    assert got["pairs"] == len(pairs)
    assert got["before_effective"] == (pairs.run_date < pairs.effective_date).sum()
    assert got["contracts_with_invoice"] == pairs.contract_id.nunique()


def test_profile_grid_and_products(spark):
    g = J.profile_grid(spark, {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS,
                               "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS})
    assert g.count() == g.distinct().count() == 624
    products = spark.createDataFrame([(i,) for i in range(1, 16)], "product_id int")
    crossed = J.cross_products(g, products)
    assert crossed.count() == 9360 and crossed.columns[-1] == "product_id"
    assert J.cross_products(g.limit(2), spark.range(2500)).count() == 5000


def test_band_join_of_many_bands(spark):
    bands = spark.range(1500).selectExpr("cast(2 * id as int) as lower", "cast(2 * id + 1 as int) as upper", "concat('b', id) as name")
    got = {r["v"]: r["name"] for r in J.band_join(spark.createDataFrame([(0,), (1,), (2999,), (3000,)], "v int"), "v", bands).collect()}
    assert got == {0: "b0", 1: "b0", 2999: "b1499"}


@pytest.mark.parametrize("kind", ["double", "decimal(20,4)", "bigint", "date", "timestamp"])
def test_band_join_of_any_kind(spark, kind):
    rng = np.random.default_rng(2)
    def value(x):
        if kind == "date":
            return date(2020, 1, 1) + timedelta(days=int(x))
        if kind == "timestamp":
            return datetime(2020, 1, 1) + timedelta(seconds=float(x))
        return {"double": float, "bigint": int}.get(kind, lambda y: Decimal(str(round(float(y), 4))))(x)
    low = rng.integers(-1000, 1000, 80)
    bands = [(i, None if i % 19 == 5 else value(a), None if i % 23 == 7 else value(a + n)) for i, (a, n) in enumerate(zip(low, rng.choice([0, 1, 7, 300, 1500, -5], 80)))]
    rows = [(i, value(x)) for i, x in enumerate(rng.integers(-2500, 2500, 200))] + [(900, None), (901, value(low[0])), (902, value(10 ** 6))]
    got = J.band_join(spark.createDataFrame(rows, f"id int, v {kind}").withColumn("lower", F.lit("mine")), "v", spark.createDataFrame(bands, f"band int, lower {kind}, upper {kind}"))
    assert got.columns == ["id", "v", "lower", "band"]
    want = {(i, b) for i, v in rows if v is not None for b, a, z in bands if (a is None or a <= v) and (z is None or v <= z) and (a is None or z is None or a <= z)}
    found = [(r["id"], r["band"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert J.band_join(spark.createDataFrame(rows, f"id int, v {kind}"), "v", spark.createDataFrame([], f"band int, lower {kind}, upper {kind}")).count() == 0


def test_guards(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    b = spark.createDataFrame([(1, 2)], "k int, w int")
    with pytest.raises(ValueError, match="repeat"):
        J.join_one_to_one(a, b, ["k"])
    assert J.join_one_to_one(b, a.limit(1), ["k"]).count() == 1
    with pytest.raises(Exception, match="no coarse value"):
        J.bridged_join(spark.createDataFrame([("18-24", "F")], "age_band string, gender string"),
                       spark.createDataFrame([("25-34", "F", 0.1)], "coarse_group string, gender string, f double"), "f").collect()
    plan = broadcast_if_small(spark.range(100), 10)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan


def test_latest_and_effective_premium(spark):
    c = spark.createDataFrame([(1, D("10.00")), (2, D("20.00"))], "contract_id int, modal_premium decimal(12,2)")
    r = spark.createDataFrame([(5, 1, date(2024, 1, 1), D("11.00")), (6, 1, date(2025, 1, 1), D("12.00")), (7, 1, date(2023, 1, 1), D("13.00"))],
                              "renewal_id int, contract_id int, renewal_date date, final_premium decimal(12,2)")
    got = {x["contract_id"]: x["effective_premium"] for x in K.effective_premium(c, r).collect()}
    assert got == {1: D("12.00"), 2: D("20.00")}


def test_prior_quote_brute_force(spark):
    rng = np.random.default_rng(8)
    q = pd.DataFrame({"application_id": np.arange(300), "p": rng.choice(["x", "y", "z"], 300, p=[0.7, 0.2, 0.1]),
                      "rate_version_id": rng.integers(1, 4, 300), "quoted_premium": rng.integers(1, 100, 300).astype(float)})
    df = spark.createDataFrame(q).withColumn("quoted_premium", F.col("quoted_premium").cast("decimal(12,2)"))
    got = {r["application_id"]: r["prior_application_id"] for r in K.prior_quote(df, ["p"]).collect()}
    for r in q.itertuples():
        other = q[(q.p == r.p) & (q.rate_version_id != r.rate_version_id)].application_id
        assert got[r.application_id] == (other.max() if len(other) else None)


def credit(spark, measures, at=date(2025, 1, 1), **kw):
    m = spark.createDataFrame([(1, d, D(p)) for d, p in measures], "enrollment_id long, measure_date date, improvement_pct decimal(5,2)")
    r = spark.createDataFrame([(1, at)], "enrollment_id long, renewal_date date")
    return A.wellness_credit(m, r, **kw).first()["credit_pct"]


def test_credit_cases(spark):
    d = date(2024, 5, 1)
    assert credit(spark, [(d, "-3.00"), (d, "0.00")]) == 0
    assert credit(spark, [(date(2025, 1, 1), "9.00")]) == 0
    assert credit(spark, [(date(2024, 12, 31), "9.00")]) == 9
    assert credit(spark, [(d, "17.30")]) == 15
    assert credit(spark, [(d, "11.23"), (d, "11.24"), (d, "-1.00")]) == D("11.24")
    assert credit(spark, [(d, "10.00"), (d, "10.00"), (d, "10.01")], scale=6) == D("10.003333")
    e = spark.createDataFrame([(1, date(2024, 6, 1))], "enrollment_id long, enroll_date date")
    assert credit(spark, [(d, "9.00")], enrollments=e) == 0


def test_credit_property(spark):
    rng = np.random.default_rng(2)
    m = pd.DataFrame({"enrollment_id": rng.choice(20, 800, p=[0.4] + [0.6 / 19] * 19), "measure_date": [date(2024, 1, 1) + timedelta(days=int(x)) for x in rng.integers(0, 90, 800)],
                      "cents": rng.integers(-500, 4000, 800)})
    r = pd.DataFrame({"enrollment_id": np.repeat(np.arange(22), 4), "renewal_date": [date(2024, 1, 1) + timedelta(days=int(x)) for x in rng.integers(0, 100, 88)]}).drop_duplicates()
    im = spark.createDataFrame(m).withColumn("improvement_pct", (F.col("cents").cast("decimal(7,0)") / 100).cast("decimal(5,2)"))
    got = {(x["enrollment_id"], x["renewal_date"]): x["credit_pct"] for x in A.wellness_credit(im, spark.createDataFrame(r)).collect()}
    assert len(got) == len(r)
    for e, d in r.itertuples(index=False):
        c = m[(m.enrollment_id == e) & (m.measure_date < d) & (m.cents > 0)].cents
        want = min(D(15), (D(int(c.sum())) / len(c) / 100).quantize(D("0.01"), rounding="ROUND_HALF_UP")) if len(c) else D(0)
        assert got[(e, d)] == want


def test_anniversaries(spark):
    c = spark.createDataFrame([(1, date(2020, 2, 29), None), (2, date(2020, 5, 1), date(2022, 5, 1)), (3, date(2024, 6, 1), None)],
                              "contract_id int, effective_date date, expiry_date date")
    got = rows(K.anniversaries(c, date(2024, 3, 1)).select("contract_id", "renewal_date"))
    assert got == [(1, date(2021, 2, 28)), (1, date(2022, 2, 28)), (1, date(2023, 2, 28)), (1, date(2024, 2, 28)), (2, date(2021, 5, 1))]


def test_lookups_for_one_key(spark):
    act = spark.createDataFrame([(1, date(2025, 1, 1), "Y"), (1, date(2025, 12, 31), "Y"), (1, date(2026, 1, 1), "Y"), (1, date(2025, 2, 1), "N"), (2, date(2025, 2, 1), "Y")],
                                "enrollment_id int, activity_date date, verified_flag string")
    one = A.verified_counts(act, date(2025, 1, 1), date(2026, 1, 1), enrollment_id=1)
    assert rows(one) == [(1, 2)]
    rollup = A.period_rollup(act, "year")
    assert rows(A.range_from_rollup(act, rollup, date(2025, 1, 1), date(2026, 1, 1))) == rows(A.verified_counts(act, date(2025, 1, 1), date(2026, 1, 1)))
    assert rows(A.range_from_rollup(act, rollup, date(2025, 1, 2), date(2026, 1, 1))) == [(1, 1), (2, 1)]
    parties = spark.createDataFrame([(1, 10), (2, 10), (1, 11)], "customer_id int, contract_id int")
    c = spark.createDataFrame([(10, "C10", "Active", date(2024, 1, 1), None), (11, "C11", "Lapsed", date(2024, 1, 1), None)],
                              "contract_id int, contract_number string, activity_status string, effective_date date, expiry_date date")
    assert J.party_contracts(parties, c, 1).count() == 2 and J.party_contracts(parties, c).count() == 3
