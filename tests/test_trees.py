"""Tree search against a plain one that grows each tree by itself, record by record."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratemill.operators.sets import stratified_folds
from ratemill.plans import trees as T


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.integers(0, 2, n).astype(float), "b": rng.integers(0, 5, n).astype(float), "c": np.round(rng.normal(0, 1, n), 2)})
    p = 1 / (1 + np.exp(-(1.5 * pdf.a * (pdf.b > 2) - 0.5 + pdf.c)))
    pdf["label"] = (rng.random(n) < p).astype(int)
    return pdf


def plain_folds(pdf, folds):
    fold = {}
    for _, g in pdf.groupby("label"):
        ids = sorted(g["id"], key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())
        for k in range(folds):
            for i in ids[len(ids) * k // folds:len(ids) * (k + 1) // folds]:
                fold[i] = k
    return pdf["id"].map(fold).to_numpy()


def grow(x, y, cuts, depth):
    """Leaf value of a node as a function of a row."""
    n, pos = len(y), y.sum()
    best, whole = None, (pos ** 2 + (n - pos) ** 2) / n
    if depth:
        for f, values in enumerate(cuts):
            for v in values:
                left = x[:, f] <= v
                if 0 < left.sum() < n:
                    value = sum((y[m].sum() ** 2 + (m.sum() - y[m].sum()) ** 2) / m.sum() for m in (left, ~left))
                    if value > whole + 1e-9 and (best is None or value > best[0] + 1e-9):
                        best = (value, f, v)
    if best is None:
        return lambda row: pos / n
    _, f, v = best
    left = x[:, f] <= v
    low, high = grow(x[left], y[left], cuts, depth - 1), grow(x[~left], y[~left], cuts, depth - 1)
    return lambda row: low(row) if row[f] <= v else high(row)


def plain_auc(y, p):
    gap = p[y == 1][:, None] - p[y == 0]
    return (gap > 0).mean() + 0.5 * (gap == 0).mean()


def test_search_by_plain_trees(spark, rows):
    names, depths = ["a", "b", "c"], (1, 2, 4)
    df = spark.createDataFrame(rows).repartition(5)
    found = T.tree_search(df, "label", names, ["id"], depths, folds=3, bins=8)
    assert found.cuts["a"] == [0.0] and found.cuts["b"] == [0.0, 1.0, 2.0, 3.0]
    values = np.sort(rows["c"])
    assert found.cuts["c"] == sorted({values[-(-len(values) * i // 8) - 1] for i in range(1, 8)})
    x, y, fold = rows[names].to_numpy(), rows["label"].to_numpy(), plain_folds(rows, 3)
    got = {(r["fold"], r["depth"]): r["auc"] for r in found.folds.collect()}
    want = {}
    for k in range(3):
        for d in depths:
            tree = grow(x[fold != k], y[fold != k], [found.cuts[c] for c in names], d)
            want[k, d] = plain_auc(y[fold == k], np.array([tree(r) for r in x[fold == k]]))
    assert got == pytest.approx(want, abs=1e-9)
    means = {d: np.mean([want[k, d] for k in range(3)]) for d in depths}
    assert found.by_depth == pytest.approx(means) and found.depth == max(means, key=means.get) and found.cv_auc == pytest.approx(max(means.values()))
    whole = grow(x, y, [found.cuts[c] for c in names], found.depth)
    scored = {r["id"]: r["probability"] for r in T.score_tree(found, df, names).collect()}
    assert scored == pytest.approx({i: whole(r) for i, r in zip(rows["id"], x)})
    root = found.tree.where("node = 1").first()
    assert root["n_rows"] == len(rows) and root["positive_rows"] == y.sum()


def test_weights_count_as_rows(spark, rows):
    names = ["a", "b", "c"]
    df = spark.createDataFrame(rows)
    twice = df.unionByName(df)
    a = T.tree_search(twice, "label", names, ["id"], (2,), folds=3, bins=8)
    b = T.tree_search(df.withColumn("weight", F.lit(2.0)), "label", names, ["id"], (2,), folds=3, bins=8)
    assert a.tree.orderBy("node").collect() == b.tree.orderBy("node").collect() and a.cuts == b.cuts      # folds deal rows by key, weighted or not


def test_missing_values_labels_and_one_class(spark):
    data = [(i, None if i % 4 == 0 else 0.0, 1 if i % 4 == 0 else 0) for i in range(40)] + [(99, 5.0, None)]
    df = spark.createDataFrame(data, "id int, x double, label int")
    found = T.tree_search(df, "label", ["x"], ["id"], (1, 2), folds=2)
    assert found.cuts == {"x": []} and found.by_depth == {1: 0.5, 2: 0.5} and found.depth == 1       # one value: nothing to cut at
    both = T.tree_search(df.withColumn("x", F.when(F.col("id") % 5 == 0, 0.5).otherwise(F.col("x"))), "label", ["x"], ["id"], (3,), folds=2)
    assert both.cuts["x"] == [0.0] and both.cv_auc > 0.5                                             # missing goes beyond the cut
    with pytest.raises(ValueError, match="both classes"):
        T.tree_search(df.where("label = 0"), "label", ["x"], ["id"], (1,), folds=2)
    with pytest.raises(ValueError, match="both classes"):
        T.tree_search(df.limit(0), "label", ["x"], ["id"], (1,), folds=2)


def test_folds_are_even_in_each_label(spark):
    df = spark.range(0, 1003).select("id", F.when(F.col("id") % 10 < 3, 1).when(F.col("id") % 10 < 9, 0).alias("label"))
    n = {}
    for r in stratified_folds(df, "label", ["id"], 4).groupBy("label", "fold").count().collect():
        n.setdefault(r["label"], []).append(r["count"])
    assert set(n) == {0, 1, None} and all(len(v) == 4 and max(v) - min(v) <= 1 for v in n.values())
    few = stratified_folds(df.limit(2), "label", ["id"], 5).collect()
    assert len(few) == 2 and all(0 <= r["fold"] < 5 for r in few)
    again = stratified_folds(df.repartition(7), "label", ["id"], 4)
    assert again.exceptAll(stratified_folds(df, "label", ["id"], 4)).count() == 0
