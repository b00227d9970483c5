"""Feature operators on tiny literal frames (edges the reference tests and the survey list)."""

import datetime as dt

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators import features as fe

D = dt.date


def apps(spark, rows):
    return spark.createDataFrame(rows, "application_id long, client_id long, application_date date, income double, "
                                       "loan_amount double")


def pays(spark, rows):
    return spark.createDataFrame(rows, "application_id long, payment_date date, amount_due double, amount_paid double, "
                                       "days_overdue int")


def test_leak_case_future_payment_excluded(spark):
    a = apps(spark, [(1, 1, D(2023, 1, 15), 1000.0, 100.0)])
    p = pays(spark, [(1, D(2023, 1, 10), 10.0, 10.0, 0), (1, D(2023, 1, 20), 10.0, 10.0, 30)])
    r = fe.payment_windows(p, a).collect()
    assert len(r) == 1
    assert r[0]["max_days_overdue_90d"] == 0 and r[0]["avg_days_overdue_90d"] == 0


def test_window_bounds(spark):
    base = D(2023, 6, 1)
    a = apps(spark, [(1, 1, base, 1000.0, 100.0)])
    p = pays(spark, [(1, base - dt.timedelta(days=d), 1.0, 1.0, d) for d in (10, 20, 40)]
             + [(1, base - dt.timedelta(days=30), 1.0, 1.0, 5),   # exactly 30 days before: inside the 30d window
                (1, base, 1.0, 1.0, 99)])                        # on the loan date: never inside
    r = fe.payment_windows(p, a).collect()[0]
    assert r["num_payments_30d"] == 3 and r["num_payments_90d"] == 4 and r["num_payments_180d"] == 4
    assert r["max_days_overdue_30d"] == 20.0
    assert abs(r["avg_days_overdue_90d"] - (10 + 20 + 40 + 5) / 4) < 1e-12


def test_single_payment_std_null_consistency_one(spark):
    a = apps(spark, [(1, 1, D(2023, 6, 1), 1000.0, 100.0)])
    p = pays(spark, [(1, D(2023, 5, 20), 1.0, 1.0, 7)])
    r = fe.payment_windows(p, a).collect()[0]
    assert r["std_days_overdue_90d"] is None
    assert r["payment_consistency_90d"] == 1.0
    assert r["pct_late_payments_90d"] == 1.0


def test_only_old_payments_row_absent_then_null_with_keep_all(spark):
    a = apps(spark, [(1, 1, D(2023, 6, 1), 1000.0, 100.0), (2, 1, D(2023, 6, 1), 1000.0, 100.0)])
    p = pays(spark, [(1, D(2022, 1, 1), 1.0, 1.0, 0), (2, D(2023, 5, 30), 1.0, 1.0, 0)])
    assert sorted(r["application_id"] for r in fe.payment_windows(p, a).collect()) == [2]
    allr = {r["application_id"]: r for r in fe.payment_windows(p, a, keep_all=True).collect()}
    assert allr[1]["avg_days_overdue_180d"] is None and allr[2]["avg_days_overdue_180d"] == 0.0


def test_numerical_ratios_buckets_and_missing_columns(spark):
    df = spark.createDataFrame(
        [(1, D(2022, 1, 1), 1000.0, 0.0, 10.0, 580.0, 0.0), (2, D(2022, 1, 2), 1000.0, 5000.0, 10.0000001, 900.0, 2000.0),
         (3, D(2022, 1, 3), 1000.0, 5000.0, None, None, 2000.0), (4, D(2022, 1, 4), 1000.0, 5000.0, 50.0, 0.0, 2000.0)],
        "application_id long, application_date date, loan_amount double, income double, dti_ratio double, "
        "credit_score double, total_credit_limit double")
    r = {x["application_id"]: x for x in fe.numerical(df).collect()}
    assert r[1]["loan_to_income"] is None and r[1]["credit_utilization"] is None   # denominators <= 0
    assert r[1]["dti_bucket"] == "very_low" and r[2]["dti_bucket"] == "low"         # right-closed at 10
    assert r[3]["dti_bucket"] == "nan" and r[3]["credit_score_bucket"] == "nan"
    assert r[1]["credit_score_bucket"] == "poor" and r[2]["credit_score_bucket"] == "exceptional"
    assert r[4]["credit_score_bucket"] == "nan" and r[4]["dti_bucket"] == "high"   # 0 is outside (0, 900]
    assert r[1]["loan_term"] == 36.0 and r[1]["grade"] == 3.0 and r[1]["num_inquiries_6m"] == 0.0  # absent columns
    for x in r.values():
        assert x["loan_to_income"] is None or x["loan_to_income"] >= 0


def test_target_encoding_unseen_to_global_mean(spark):
    df = spark.createDataFrame([("A", True)] * 12 + [("A", False)] * 8 + [("B", True)] * 3 + [(None, False)] * 5,
                               "purpose string, is_default boolean").withColumn("home_ownership", F.lit("RENT"))
    enc, mean = fe.target_fit(df)
    g = mean.first()["global_mean"]
    assert abs(g - 15 / 28) < 1e-12
    m = {(r["column"], r["category"]): r["encoded"] for r in enc.collect()}
    assert abs(m[("purpose", "A")] - (0.6 * 20 + g * 20) / 40) < 1e-12
    assert m[("purpose", "B")] == g                      # n < 10
    assert ("purpose", None) not in m
    new = spark.createDataFrame([("Z", "OWN"), (None, "RENT")], "purpose string, home_ownership string")
    out = fe.target_apply(new, enc, mean).collect()
    assert all(r["purpose_target_enc"] == g for r in out)
    assert all(0.0 <= r["home_ownership_target_enc"] <= 1.0 for r in out)


def test_critical_fill_median_then_zero(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, None), (3, None, None)],
                               "application_id long, loan_to_income double, credit_utilization double") \
        .withColumn("income_log", F.lit(None).cast("double")).withColumn("grade", F.lit(None).cast("double"))
    r = {x["application_id"]: x for x in fe.critical_fill(df).collect()}
    assert r[3]["loan_to_income"] == 2.0          # exact median of 1, 3
    assert r[1]["credit_utilization"] == 0.0      # no median: 0
    assert r[1]["grade"] == 0.0                   # every feature NULL to 0


def test_constants_feature_lists():
    assert len(K.ALL_FEATURES) == 30 and len(K.COLD_START_FEATURES) == 23
