"""Drift (PSI, KS) and data-quality checks."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators import quality as Q


def _vals(spark, ref, cur):
    rows = [("x", "ref", float(v)) for v in ref] + [("x", "cur", float(v)) for v in cur]
    return spark.createDataFrame(rows, "feature string, window string, value double")


def test_psi_same_and_shifted(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=2000)
    assert D.psi(_vals(spark, a, a)).first()["psi"] < 0.05
    assert D.psi(_vals(spark, a, rng.normal(1.5, 1, 2000))).first()["psi"] > 0.1


def test_psi_constant_and_small(spark):
    assert D.psi(_vals(spark, [1.0] * 100, [2.0] * 100)).first()["psi"] == 0.0     # < 2 edges
    assert D.psi(_vals(spark, [1.0, 2.0] * 4, [1.0] * 20)).first()["psi"] == 0.0    # < 10 values
    assert D.psi(_vals(spark, [1.0, 2.0] * 4, [1.0] * 20), variant="eda").first()["psi"] is None


def test_ks_symmetric_and_identical(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=300), rng.normal(0.5, 1, 400)
    k1 = D.ks_two_sample(_vals(spark, a, b)).first()
    k2 = D.ks_two_sample(_vals(spark, b, a)).first()
    assert abs(k1["ks_statistic"] - k2["ks_statistic"]) < 1e-12
    grid = np.unique(np.concatenate([a, b]))
    brute = max(abs((a <= t).mean() - (b <= t).mean()) for t in grid)
    assert abs(k1["ks_statistic"] - brute) < 1e-12
    assert D.ks_two_sample(_vals(spark, a, a)).first()["ks_statistic"] == 0.0


def _checks(df):
    return {r["check"]: r for r in df.collect()}


def test_validate_applications_outcomes(spark):
    base = [(i, "2022-01-01", 100.0 + i, 5000.0, i % 5 == 0) for i in range(100)]
    schema = "client_id long, application_date string, loan_amount double, income double, is_default boolean"
    ok = _checks(Q.applications(spark.createDataFrame(base, schema)))
    assert all(r["severity"] in ("ok", "info") for r in ok.values())
    neg = _checks(Q.applications(spark.createDataFrame(base[:-1] + [(999, "2022-01-01", -5.0, 1.0, False)], schema)))
    assert neg["loan_amount<=0"]["severity"] == "error"
    nulls = [(i, "2022-01-01", 100.0, None if i < 51 else 1.0, False) for i in range(100)]
    assert _checks(Q.applications(spark.createDataFrame(nulls, schema)))["income_null_rate"]["severity"] == "error"
    miss = _checks(Q.applications(spark.createDataFrame([(1, 2.0)], "client_id long, loan_amount double")))
    assert miss["missing_columns"]["severity"] == "error"


def test_validate_features_outcomes(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)] * 4 + [(None, 1.0, 1.0)], "loan_to_income double, credit_utilization double, income_log double")
    c = _checks(Q.features(df))
    assert c["nulls:loan_to_income"]["severity"] == "error"
    c = _checks(Q.features(df.dropna(), row_count_min=100))
    assert c["row_count_min"]["severity"] == "error"


def test_request_refused(spark):
    good = (1, 10000.0, 50000.0, 36, 12.0, 5.0, 700.0, 20.0, 3, 0, 20000.0, "rent", " Car ")
    bad = (2, 10000.0, 50000.0, 36, 12.0, 5.0, 1500.0, 20.0, 3, 0, 20000.0, "RENT", "car")
    schema = ("application_id long, loan_amount double, income double, loan_term int, interest_rate double, employment_years double, "
              "credit_score double, dti_ratio double, num_open_accounts int, num_delinquencies int, total_credit_limit double, "
              "home_ownership string, purpose string")
    valid, refused = Q.validate_requests(spark.createDataFrame([good, bad], schema))
    v = valid.collect()
    assert [r["application_id"] for r in v] == [1] and v[0]["home_ownership"] == "RENT" and v[0]["purpose"] == "car"
    r = refused.collect()
    assert [x["application_id"] for x in r] == [2] and r[0]["failed_rules"] == ["credit_score in [300,850]"]


def test_overlap_and_splits_partition(spark):
    from riskloom.operators import sampling as S
    df = spark.range(100).select(F.col("id").alias("application_id"),
                                 F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("application_date"))
    assert Q.overlap_check(df, "2020-02-01", "2020-03-01").first()["overlap_count"] == 0
    s = S.time_split(df, "2020-02-01", "2020-03-01")
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 100 and set(counts) == {"train", "val", "test"}


def test_zero_rows(spark):
    from riskloom.operators import metrics as M
    empty = spark.createDataFrame([], "y int, pd_score double")
    m = M.binary(empty).collect()          # a global aggregate: one row, nothing to rank
    assert len(m) == 1 and m[0]["n"] == 0 and m[0]["auc_roc"] is None and m[0]["ks"] == 0.0
    assert D.psi(spark.createDataFrame([], "feature string, window string, value double")).count() == 0
    checks = {r["check"]: r for r in Q.applications(spark.createDataFrame(
        [], "client_id long, application_date string, loan_amount double, income double, is_default boolean")).collect()}
    assert checks["row_count"]["value"] == 0 and checks["loan_amount<=0"]["severity"] == "ok"


def test_fe_ids_no_repeats_and_size(spark, small_dir):
    from riskloom.sources import fixtures
    from riskloom.operators import sampling as S
    fx = fixtures.load(spark, small_dir)
    ids = S.fe_ids(fx.applications, fx.payments, 1000, S.portable_order())
    n = ids.count()
    assert n == ids.distinct().count() == min(1000, fx.applications.count())


def test_pair_correlations_one_pass(spark):
    """Against numpy on complete pairs, with an outlier far from the rest, nulls and a constant column."""
    import numpy as np
    from riskloom.operators import profile as P

    rng = np.random.default_rng(3)
    a = rng.normal(5, 1, 400)
    b, c = a + rng.normal(0, 1, 400), rng.normal(0, 1, 400)
    c[7], a[7] = 1e9, -1e9
    rows = [(float(x), float(y) if i % 5 else None, float(z), 2.5) for i, (x, y, z) in enumerate(zip(a, b, c))]
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in
           P.correlation_pairs(spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(5), ["a", "b", "c", "k"]).collect()}
    keep = np.arange(400) % 5 != 0
    want = {("a", "b"): np.corrcoef(a[keep], b[keep]), ("a", "c"): np.corrcoef(a, c), ("b", "c"): np.corrcoef(b[keep], c[keep])}
    for pair, m in want.items():
        assert abs(got[pair] - m[0, 1]) < 1e-9
    assert all(got[x, "k"] is None for x in "abc")
