"""Bucketed ranks and sums against brute force, with ties, nulls and a value holding a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratemill.operators import cumulative as C
from ratemill.operators import ranking as K
from ratemill.operators.sets import sample_n, stratified_split


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
                        "v": np.where(rng.random(n) < 0.34, 7.0, np.round(rng.normal(0, 50, n), 1)),
                        "y": rng.integers(0, 2, n)})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "c", F.col("g")))
    pdf.loc[pdf.g == "c", "g"] = None
    return df, pdf


def test_average_ranks(frame):
    df, pdf = frame
    got = {(r["g"], r["v"]): r["avg_rank"] for r in C.value_ranks(df, ["g"], "v").collect()}
    want = pdf.assign(g=pdf.g.fillna("-"))
    want["r"] = want.groupby("g").v.rank(method="average")
    for g, v, r in want[["g", "v", "r"]].drop_duplicates().itertuples(index=False):
        assert got[(None if g == "-" else g, v)] == r


@pytest.mark.parametrize("probs", [[0.0, 0.1, 0.5, 0.99, 1.0]])
def test_quantiles(frame, probs):
    df, pdf = frame
    got = {r["prob"]: r["quantile"] for r in C.quantiles(df, [], "v", probs).collect()}
    assert np.allclose([got[p] for p in probs], np.quantile(pdf.v, probs))


def test_numbered(frame):
    df, pdf = frame
    got = {r["id"]: r["n"] for r in C.numbered(df, "v", "n", ["id"]).select("id", "n").collect()}
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    assert [got[i] for i in want.id] == list(range(1, len(pdf) + 1))


def test_hash_rank_is_a_permutation_and_ignores_input_order(frame):
    df, pdf = frame
    a = {r["id"]: r["r"] for r in C.hash_rank(df, ["g"], ["id"], 3, "r").collect()}
    b = {r["id"]: r["r"] for r in C.hash_rank(df.orderBy(F.desc("v")), ["g"], ["id"], 3, "r").collect()}
    assert a == b
    for _, ids in pdf.fillna("-").groupby("g").id:
        assert sorted(a[i] for i in ids) == list(range(1, len(ids) + 1))


def test_sampling(frame):
    df, pdf = frame
    assert sample_n(df, ["id"], 500, 1).count() == 500
    split = stratified_split(df, "y", ["id"], 0.2).groupBy("y", "split").count().collect()
    sizes = pdf.y.value_counts()
    for r in split:
        test = int(np.floor(sizes[r["y"]] * 0.2 + 0.5))
        assert r["count"] == (test if r["split"] == "test" else sizes[r["y"]] - test)


def test_auc_and_spearman(frame):
    df, pdf = frame
    got = {r["g"]: r["auc"] for r in K.auc(df, ["g"], "y", "v").collect()}
    for g, part in pdf.assign(g=pdf.g.fillna("-")).groupby("g"):
        p, q = part[part.y == 1].v.to_numpy(), part[part.y == 0].v.to_numpy()
        want = ((p[:, None] > q).sum() + 0.5 * (p[:, None] == q).sum()) / (len(p) * len(q))
        assert got[None if g == "-" else g] == pytest.approx(want)
    s = K.spearman(df.withColumn("w", F.col("v") + F.col("id") % 50), ["g"], "v", "w").collect()
    pdf2 = pdf.assign(g=pdf.g.fillna("-"), w=pdf.v + pdf.id % 50)
    want = {g: part.v.rank().corr(part.w.rank()) for g, part in pdf2.groupby("g")}
    assert {("-" if r["g"] is None else r["g"]): pytest.approx(r["spearman"]) for r in s} == want


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert K.auc(df, [], "y", "p").first()["auc"] is None


def test_numbers_of_a_hot_key_are_spread(spark):
    """One key holds half the rows: the ties deal it to many ranges, and the numbers still run 1..N in order."""
    from ratemill.operators import cumulative as C
    seen = {}
    cut = C.cut_lineage

    def watched(df):
        out = cut(df)
        seen.update({r[0]: r[1] for r in out.groupBy(F.shiftright("_place", 33)).count().collect()})
        return out
    df = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("k"), "id").repartition(8)
    C.cut_lineage = watched
    try:
        rows = C.numbered(df, "k", "n", ["id"]).collect()
    finally:
        C.cut_lineage = cut
    assert [r["n"] for r in sorted(rows, key=lambda r: (r["k"], r["id"]))] == list(range(1, 60_001))
    assert len(seen) == 1 or max(seen.values()) < 20_000


@pytest.mark.parametrize("range_rows", [7, 60, 10_000])
def test_ranges_follow_the_size(frame, monkeypatch, range_rows):
    """Ranks, quantiles and curves do not depend on where ranges are cut; ranges rise with group and value and are as many as the rows take."""
    df, pdf = frame
    monkeypatch.setattr(C, "RANGE_ROWS", range_rows)
    counts = C.tie_counts(df, ["g"], "v")
    ranged = C.with_ranges(counts, ["g", "v"]).toPandas().assign(g=lambda x: x.g.fillna("")).sort_values(["g", "v"])
    assert ranged._range.is_monotonic_increasing
    n = len(ranged)
    assert n / range_rows / 2 <= ranged._range.nunique() <= -(-n // range_rows) and ranged._range.value_counts().max() <= max(8 * range_rows, n // 3)
    test_average_ranks(frame)
    test_quantiles(frame, [0.0, 0.1, 0.5, 0.99, 1.0])
    test_auc_and_spearman(frame)
    test_hash_rank_is_a_permutation_and_ignores_input_order(frame)


def test_one_shuffle_of_the_counts(frame, monkeypatch):
    """Past the aggregate the rows move once, into their ranges; what else is exchanged are sums of ranges."""
    df, _ = frame
    monkeypatch.setattr(C, "RANGE_ROWS", 60)
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = C.rank_ties(C.tie_counts(df, ["g"], "v"), ["g"], "v")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 4 and sum("_range" in line.split("hashpartitioning")[1].split(",")[0] for line in exchanges) == 3
    window = plan[plan.index("Window"):]
    assert window.count("Window") >= 2 and "CartesianProduct" not in plan


def plain_order(rows, seed):
    import hashlib
    return sorted(rows, key=lambda r: hashlib.md5(f"{seed}|{r}".encode()).hexdigest())


@pytest.mark.parametrize("digits", [1, 4])
def test_samples_are_the_smallest_hashes(frame, monkeypatch, digits):
    from ratemill.operators import sets
    monkeypatch.setattr(sets, "DIGITS", digits)
    df, pdf = frame
    for n in (0, 1, 499, 2999, 3000, 5000):
        assert sorted(r["id"] for r in sample_n(df, ["id"], n, 3).collect()) == sorted(plain_order(pdf.id, 3)[:n])
    got = {r["id"] for r in stratified_split(df, "g", ["id"], 0.35).where("split = 'test'").collect()}
    want = set()
    for _, part in pdf.fillna("-").groupby("g"):
        want |= set(plain_order(part.id, 7)[:int(np.floor(len(part) * 0.35 + 0.5))])
    assert got == want
    assert sample_n(df.limit(0), ["id"], 5, 3).count() == 0 and stratified_split(df.limit(0), "g", ["id"]).count() == 0


def test_sampling_does_not_shuffle_the_table(frame):
    df, _ = frame
    for out in (sample_n(df, ["id"], 500, 1), stratified_split(df, "y", ["id"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Sort" not in plan
