"""Prefix sums, quantiles and ranking metrics against brute force."""

import numpy as np
from pyspark.sql import Window, functions as F

from riskloom.operators import metrics as M
from riskloom.operators import orderstat


def test_prefix_sums_equal_single_window(spark):
    df = spark.range(5000).select((F.col("id") % 97).cast("double").alias("s"), (F.col("id") % 3).alias("g"),
                                  F.lit(1).cast("long").alias("n"))
    got = {(r["g"], r["s"]): r["cum_n"] for r in orderstat.prefix_sums(df, "s", ["n"], by=["g"], n_buckets=7).collect()}
    agg = df.groupBy("g", "s").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("g").orderBy("s")
    ref = {(r["g"], r["s"]): r["c"] for r in agg.select("g", "s", F.sum("n").over(w).alias("c")).collect()}
    assert got == ref


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=2001).round(3)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["p"]: r["q"] for r in orderstat.exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert abs(got[p] - np.percentile(x, p * 100)) < 1e-12


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def test_auc_ks_ap_against_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 600)
    s = (rng.random(600) * 0.5 + 0.3 * y).round(2)   # ties on purpose
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, pd_score double")
    m = M.binary(df, n_buckets=4).first()
    assert abs(m["auc_roc"] - _brute_auc(y, s)) < 1e-12
    grid = np.unique(s)
    ks = max(abs((s[y == 1] <= t).mean() - (s[y == 0] <= t).mean()) for t in grid)
    assert abs(m["ks"] - ks) < 1e-12
    ap = 0.0
    for t in grid:
        sel = s >= t
        ap += ((s == t) & (y == 1)).sum() / y.sum() * (y[sel].sum() / sel.sum())
    assert abs(m["auc_pr"] - ap) < 1e-12
    assert abs(m["brier"] - ((s - y) ** 2).mean()) < 1e-12


def test_auc_symmetry_and_one_class(spark):
    df = spark.createDataFrame([(i % 2, float(i % 7) / 7) for i in range(200)], "y int, pd_score double")
    a = M.binary(df).first()["auc_roc"]
    b = M.binary(df.withColumn("pd_score", -F.col("pd_score"))).first()["auc_roc"]
    assert abs(a + b - 1) < 1e-12
    one = M.binary(df.where("y = 1")).first()
    assert one["auc_roc"] is None and one["ks"] == 0.0


def test_thresholds_by_brute_force(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    s = rng.random(300).round(2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, pd_score double")
    t = M.thresholds(df).first()
    grid = np.unique(s)
    rec = {g: ((s >= g) & (y == 1)).sum() / y.sum() for g in grid}
    assert t["threshold_recall"] == max(g for g in grid if rec[g] >= 0.8)
    cost = [(((s >= g) & (y == 0)).sum() * 100 + ((s < g) & (y == 1)).sum() * 5000, g) for g in grid[:-1]]
    assert t["threshold_cost"] == min(cost)[1]


def test_qcut_matches_pandas(spark):
    import pandas as pd
    vals = [float(v) for v in np.random.default_rng(3).integers(0, 50, 500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    got = {r["id"]: r["b"] for r in M.qcut(df, "x", M.BUCKET_LABELS, "b").collect()}
    ref = pd.qcut(pd.Series(vals), q=5, labels=M.BUCKET_LABELS, duplicates="drop") if False else pd.qcut(pd.Series(vals), q=5, labels=M.BUCKET_LABELS)
    assert all(got[i] == ref[i] for i in range(len(vals)))
