"""Digit selection, tail probabilities and pointer commits."""

import math
import struct
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, orderstat, selection, tails
from riskloom.sources import commit, io


def ieee(x):
    bits = struct.unpack(">q", struct.pack(">d", x))[0]
    return bits if bits >= 0 else -(bits & (2 ** 63 - 1))


def test_order_key_equals_ieee_bits(spark):
    r = np.random.default_rng(1)
    x = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
         1.0, -1.0, 0.1, 1 / 3, float("inf"), float("-inf")]
    x += [float(2.0 ** e * f) for e in range(-1070, 1024, 13) for f in (1.0, 1.0 - 2 ** -53, 1.0 + 2 ** -52, -1.5)]
    x += (r.normal(size=300) * 10.0 ** r.integers(-300, 300, 300)).tolist()
    got = spark.createDataFrame([(v,) for v in x], "x double").select("x", selection.order_key(F.col("x")).alias("k")).collect()
    assert all(g["k"] == ieee(g["x"]) for g in got)
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(selection.order_key(F.col("x"))).first()[0]
    assert nan > ieee(float("inf"))


def test_quantiles_of_groups_equal_numpy(spark):
    r = np.random.default_rng(2)
    groups = {"normal": r.normal(size=1500), "tied": r.integers(0, 4, 1000).astype(float), "wide": np.exp(r.normal(size=800) * 60) * r.choice([-1, 1], 800),
              "near": 1.0 + r.integers(0, 900, 700) * 2.0 ** -50, "single": np.array([7.25]), None: r.random(501)}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("none", None), ("normal", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.05, 0.25, 0.5, 0.77, 1.0]
    got = {(q["g"], q["p"]): q["q"] for q in selection.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert len(got) == len(groups) * len(probs)
    for g, x in groups.items():
        for p in probs:
            want = float(np.percentile(x, p * 100))
            assert got[g, p] == pytest.approx(want, rel=1e-12, abs=1e-300), (g, p)


def test_wide_quantiles_sort_nothing(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("b"))
    q = {(r["feature"], r["p"]): r["q"] for r in orderstat.wide_quantiles(df, ["a", "b"], [0.5]).collect()}
    p = df.toPandas()
    assert q["a", 0.5] == p.a.median() and q["b", 0.5] == pytest.approx(p.b.median(), rel=1e-15)
    empty = orderstat.wide_quantiles(df.limit(0), ["a", "b"], [0.5])
    assert empty.count() == 0 and empty.columns == ["feature", "p", "q"]


# upper tails computed with 40 digits (closed forms for even dof, the incomplete gamma function otherwise)
def chi2_even(x, dof):
    """exp(-x/2) * sum of (x/2)**k / k! below dof/2, in exact fractions of logs."""
    h = x / 2
    logs = np.array([-h + k * math.log(h) - math.lgamma(k + 1) for k in range(dof // 2)])
    top = logs.max()
    return math.exp(top) * math.fsum(np.exp(logs - top))


def test_chi_square_tail_up_to_large_dof(spark):
    cases = [(x, dof) for dof in (2, 4, 10, 18, 20, 22, 100, 1000, 10_000, 100_000)
             for x in (0.3 * dof, dof - 2 * math.sqrt(2 * dof), dof, dof + 1, dof + 250.0, dof + 4 * math.sqrt(2 * dof)) if x > 0]
    df = spark.createDataFrame([(float(x), k, chi2_even(x, k)) for x, k in cases], "x double, k int, p double")
    for r in df.select("x", "k", "p", tails.chi2_sf(F.col("x"), F.col("k")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, rel=2e-9, abs=1e-300), (r.x, r.k)
    odd = [(3.841458820694124, 1, 0.05), (6.634896601021214, 1, 0.01), (7.814727903251179, 3, 0.05), (0.0, 3, 1.0)]
    for r in spark.createDataFrame(odd, "x double, k int, p double").select("p", tails.chi2_sf(F.col("x"), F.col("k")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, rel=1e-9)


def ks_by_counting(d, n1, n2):
    hits = total = 0
    for pick in combinations(range(n1 + n2), n1):
        i = j = 0
        worst, chosen = 0.0, set(pick)
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            worst = max(worst, abs(i / n1 - j / n2))
        total += 1
        hits += worst >= d - 1e-12
    return hits / total


@pytest.mark.parametrize("n1,n2", [(1, 1), (2, 3), (4, 4), (5, 3), (3, 7), (6, 6), (7, 5)])
def test_exact_ks_equals_counting(n1, n2):
    gaps = sorted({abs(i / n1 - j / n2) for i in range(n1 + 1) for j in range(n2 + 1)})
    for d in gaps:
        assert tails.ks_exact(d, n1, n2) == pytest.approx(ks_by_counting(d, n1, n2), rel=1e-12)


def test_exact_ks_nears_the_limit():
    for n1, n2, d in ((2000, 3000, 0.04), (9000, 7000, 0.02), (500, 500, 0.1)):
        lam = math.sqrt(n1 * n2 / (n1 + n2)) * d
        limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
        assert abs(tails.ks_exact(d, n1, n2) - limit) < 0.03
    assert 0 < tails.ks_exact(0.9, 300, 400) < 1e-100


def test_no_pass_sorts_the_values(spark, monkeypatch):
    """All four passes hash their counters: a buffer that cannot be hashed would sort every value in every pass."""
    plans, hits = [], selection._hits
    monkeypatch.setattr(selection, "_hits", lambda cells, *a: plans.append(cells._jdf.queryExecution().executedPlan().toString()) or hits(cells, *a))
    v = [1.0 + k * 2.0 ** -52 for k in range(40)] + [float(k) for k in range(40)]
    df = spark.createDataFrame([(g, x) for g in ("a", "b", None) for x in v], "g string, value double")
    got = {(r.g, r.p): r.q for r in selection.exact_quantiles(df, "value", [0.1, 0.5], ["g"]).collect()}
    assert got == {(g, p): float(np.quantile(v, p)) for g in ("a", "b", None) for p in (0.1, 0.5)}
    assert len(plans) == 4 and not any("SortAggregate" in p for p in plans)


def test_exact_ks_beside_windows_that_are_too_large(spark):
    """A feature beyond the exact bound, and one without values, beside one within it: none stops the batch."""
    rows = [("few", w, float(i + 3 * (w == "cur"))) for w in ("ref", "cur") for i in range(6)]
    rows += [("many", w, float(i + 5 * (w == "cur"))) for w in ("ref", "cur") for i in range(30)]
    rows += [("one side", "ref", float(i)) for i in range(5)]
    values = spark.createDataFrame(rows, "feature string, window string, value double").coalesce(1)
    got = {r.feature: r for r in drift.ks_two_sample(values, n_buckets=1, exact_up_to=10).collect()}
    limit = {r.feature: r for r in drift.ks_two_sample(values, n_buckets=1).collect()}
    assert got["few"].ks_pvalue == pytest.approx(ks_by_counting(0.5, 6, 6), rel=1e-12) != limit["few"].ks_pvalue
    assert got["many"].ks_pvalue == limit["many"].ks_pvalue and got["one side"].ks_pvalue is None


def test_interrupted_commits(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "t")
    assert io.replace_table(spark.range(5), out) == 5 and io.read_table(spark, out).count() == 5
    # before the version is written: the job fails
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        io.replace_table(bad, out)
    assert io.read_table(spark, out).count() == 5
    # between: the version is written, the pointer is not replaced
    commit.write_version(spark.range(9), out)
    assert io.read_table(spark, out).count() == 5
    # after: the pointer is replaced, nothing is cleaned up
    with monkeypatch.context() as m:
        m.setattr(commit, "vacuum", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            io.replace_table(spark.range(7), out)
    assert io.read_table(spark, out).count() == 7
    # the next commit clears what was left, and may read the table it replaces
    assert io.replace_table(io.read_table(spark, out).where("id < 2"), out) == 2
    assert sorted(r[0] for r in io.read_table(spark, out).collect()) == [0, 1]
    assert len(list((tmp_path / "t" / "_versions").iterdir())) == 2


def test_plain_table_becomes_a_versioned_one(spark, tmp_path):
    out = str(tmp_path / "t")
    spark.range(4).write.parquet(out)
    assert io.read_table(spark, out).count() == 4
    held = io.read_table(spark, out).select((F.col("id") + 10).alias("id"))
    assert io.replace_table(held, out) == 4 and io.read_table(spark, out).agg(F.min("id")).first()[0] == 10


def test_reader_keeps_the_version_it_resolved(spark, tmp_path):
    out = str(tmp_path / "t")
    io.replace_table(spark.range(5), out)
    old = io.read_table(spark, out)
    io.replace_table(spark.range(50), out)
    assert old.count() == 5 and io.read_table(spark, out).count() == 50


def test_predictions_commit_replaces_batch_rows(spark, tmp_path):
    out = str(tmp_path / "p")
    rows = lambda v, n: spark.range(n).select("id", F.lit(v).alias("model_version"))
    io.replace_table(rows("batch:a:rf", 6).unionByName(rows("online:a", 3)), out)
    assert io.predictions_commit(spark, out, rows("batch:b:gbt", 4)) == 7
    got = {r[0]: r[1] for r in io.read_table(spark, out).groupBy("model_version").count().collect()}
    assert got == {"online:a": 3, "batch:b:gbt": 4}
