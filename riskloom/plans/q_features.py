"""Queries for the feature operators (C, E1-E3, E7-E9, F1-F8) and the snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import features as fe
from ..session import materialise
from ..sources import fixtures
from . import oracle_features as OF
from .catalog import register
from .oracle_views import with_ctes
from .snapshot import snapshot

TE_CUTOFF = "1999-12-31"
SNAPSHOT_SQL = with_ctes(["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF),
                         OF.rounded_select(K.ALL_FEATURES + ["avg_account_age_months"], "snapshot",
                                           passthrough=["application_id", "feature_date", "feature_version",
                                                        "dti_bucket", "credit_score_bucket"]))


def features_snapshot_df(spark, sf_dir, strategy="timeline"):
    fx = fixtures.load(spark, sf_dir)
    return snapshot(fx.applications, fx.payments, fx.bureau, TE_CUTOFF, bureau_strategy=strategy)


@register("features_snapshot", SNAPSHOT_SQL)
def q_features_snapshot(spark, sf_dir):
    return round_doubles(features_snapshot_df(spark, sf_dir))


NUM_DOUBLES = K.NUMERICAL_FEATURES + ["dti_x_credit_score", "loan_amount_x_interest_rate"]


@register("numerical_features", with_ctes(["applications_v"], [("num", OF.num_select())],
                                          OF.rounded_select(NUM_DOUBLES, "num", passthrough=[
                                              "application_id", "feature_date", "dti_bucket", "credit_score_bucket"])))
def q_numerical(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.numerical(fx.applications))


PW_COLS = [f"{m}_{n}d" for n in K.PAYMENT_WINDOWS for m in (
    "avg_days_overdue", "max_days_overdue", "total_paid", "num_payments", "std_days_overdue",
    "pct_late_payments", "payment_consistency")]
PW_DOUBLES = [c for c in PW_COLS if not c.startswith("num_payments")]


@register("payment_windows", with_ctes(["applications_v", "payments_v"],
                                       [("pw", OF.payments_join()), ("agg", OF.windows_select())],
                                       OF.rounded_select(PW_DOUBLES, "agg", passthrough=[
                                           "application_id"] + [c for c in PW_COLS if c.startswith("num_payments")])))
def q_payment_windows(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.payment_windows(fx.payments, fx.applications))


@register("payment_windows_all", with_ctes(
    ["applications_v", "payments_v"],
    [("pw", OF.payments_join()), ("agg0", OF.windows_select()),
     ("agg", "SELECT a.application_id, " + ", ".join(f"g.{c}" for c in PW_COLS)
      + " FROM applications_v a LEFT JOIN agg0 g ON g.application_id = a.application_id")],
    OF.rounded_select(PW_DOUBLES, "agg", passthrough=["application_id"] + [c for c in PW_COLS if c.startswith("num_payments")])))
def q_payment_windows_all(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.payment_windows(fx.payments, fx.applications, keep_all=True))


@register("payments_join", with_ctes(
    ["applications_v", "payments_v"], [("pw", OF.payments_join(90))],
    "SELECT application_id, payment_date, application_date, round(amount_paid, 4) AS amount_paid, days_overdue FROM pw"))
def q_payments_join(spark, sf_dir):
    """E1 + D3: payments strictly before the loan date and within 90 days of it."""
    fx = fixtures.load(spark, sf_dir)
    j = fe.payments_in_lookback(fx.payments, fx.applications, 90)
    return j.select("application_id", "payment_date", "application_date",
                    F.round("amount_paid", 4).alias("amount_paid"), "days_overdue")


ASOF_SQL = with_ctes(["applications_v", "bureau_v"], [("bureau_asof", OF.BUREAU_ASOF)],
                     "SELECT application_id, client_id, application_date, bureau_id, report_date, num_inquiries_6m, "
                     "num_active_loans, round(total_balance, 4) AS total_balance, oldest_account_months FROM bureau_asof")


def _asof(spark, sf_dir, strategy):
    fx = fixtures.load(spark, sf_dir)
    r = fe.bureau_asof(fx.applications, fx.bureau, strategy).drop("income")
    return r.withColumn("total_balance", F.round("total_balance", 4))


@register("bureau_asof", ASOF_SQL)
def q_bureau_asof(spark, sf_dir):
    return _asof(spark, sf_dir, "timeline")


@register("bureau_asof_maxby", ASOF_SQL)
def q_bureau_asof_maxby(spark, sf_dir):
    """Same as-of join with the plain equi-join + max_by strategy."""
    return _asof(spark, sf_dir, "max_by")


@register("bureau_ratios", with_ctes(["applications_v", "bureau_v"],
                                     [("bureau_asof", OF.BUREAU_ASOF), ("bur", OF.BUREAU_FEATURES)],
                                     OF.rounded_select(K.BUREAU_FEATURES + ["avg_account_age_months"], "bur",
                                                       passthrough=["application_id"])))
def q_bureau_ratios(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.bureau(fx.applications, fx.bureau))


@register("target_encode_fit", with_ctes(["applications_v"], OF.te_blocks(TE_CUTOFF),
                                         "SELECT col AS \"column\", cat AS category, n, round(enc, 6) AS encoded FROM te_enc"))
def q_target_fit(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    apps = fx.applications.where(F.col("application_date") <= F.to_date(F.lit(TE_CUTOFF)))
    enc, _ = fe.target_fit(apps)
    return round_doubles(enc)


@register("target_encode_fallback", with_ctes(
    ["applications_v"], OF.te_blocks("1900-01-01", "applications_v") + [
        ("te_all", "SELECT * FROM applications_v WHERE is_default IS NOT NULL"),
    ],
    # the cutoff selects no row, so the fit falls back to every labelled row
    "SELECT col AS \"column\", cat AS category, n, round(enc, 6) AS encoded FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS cat, count(*) AS n, "
        f"CASE WHEN count(*) < {K.TE_MIN_SAMPLES} THEN (SELECT avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) FROM te_all) "
        f"ELSE (avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) * count(*) + (SELECT avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) FROM te_all) * {float(K.TE_SMOOTHING)}e0) / (count(*) + {float(K.TE_SMOOTHING)}e0) END AS enc "
        f"FROM te_all WHERE {c} IS NOT NULL GROUP BY {c}" for c in K.CATEGORICAL_FEATURES) + ") t"))
def q_target_fallback(spark, sf_dir):
    """a cutoff before every loan date makes the fit fall back to all labelled rows."""
    fx = fixtures.load(spark, sf_dir)
    enc, _ = fe.target_fit_fallback(fx.applications, "1900-01-01")
    return round_doubles(enc)


@register("encode_join", with_ctes(
    ["applications_v"], OF.te_blocks(TE_CUTOFF),
    "SELECT a.application_id, a.purpose, a.home_ownership, "
    + ", ".join(f"round(coalesce(e_{c}.enc, (SELECT g FROM te_mean)), 6) AS {c}_target_enc" for c in K.CATEGORICAL_FEATURES)
    + " FROM applications_v a "
    + " ".join(f"LEFT JOIN te_enc e_{c} ON e_{c}.col = '{c}' AND e_{c}.cat = a.{c}" for c in K.CATEGORICAL_FEATURES)))
def q_encode_join(spark, sf_dir):
    """Encodings fitted on loans up to the cutoff applied to every loan."""
    fx = fixtures.load(spark, sf_dir)
    apps = fx.applications
    enc, mean = fe.target_fit(apps.where(F.col("application_date") <= F.to_date(F.lit(TE_CUTOFF))))
    out = fe.target_apply(apps.select("application_id", "purpose", "home_ownership"), enc, mean)
    return round_doubles(out)


@register("plain_target_mean", with_ctes(
    ["applications_v"], [],
    "SELECT col AS \"column\", cat AS category, n, round(m, 6) AS target_mean FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS cat, count(*) AS n, avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) AS m "
        f"FROM applications_v WHERE {c} IS NOT NULL AND is_default IS NOT NULL GROUP BY {c}"
        for c in ["home_ownership", "purpose", "loan_term", "num_open_accounts"]) + ") t "
    "WHERE col IN (SELECT col FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(DISTINCT {c}) AS k FROM applications_v WHERE {c} IS NOT NULL AND is_default IS NOT NULL"
        for c in ["home_ownership", "purpose", "loan_term", "num_open_accounts"]) + ") d WHERE k < 50)"))
def q_plain_target_mean(spark, sf_dir):
    """unsmoothed means for columns with < 50 levels (loan id-like columns are gated out)."""
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.plain_target_mean(fx.applications, ["home_ownership", "purpose", "loan_term", "num_open_accounts"]))


T1, T2 = "1998-12-31", "1999-12-31"  # last train and validation day

SPLIT_SQL = f"CASE WHEN feature_date <= DATE '{T1}' THEN 'train' WHEN feature_date <= DATE '{T2}' THEN 'val' ELSE 'test' END"


@register("median_impute", with_ctes(
    ["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF) + [
        ("tmed", "SELECT " + ", ".join(f"median({c}) AS {c}" for c in K.ALL_FEATURES) + f" FROM merged WHERE feature_date <= DATE '{T1}'")],
    f"SELECT m.application_id, {SPLIT_SQL} AS split, " + ", ".join(f"round(coalesce(m.{c}, t.{c}, 0.0e0), 6) AS {c}" for c in K.ALL_FEATURES)
    + " FROM merged m, tmed t"))
def q_median_impute(spark, sf_dir):
    """every row of the merged (unfilled) snapshot with its missing values imputed by the medians of the train rows."""
    fx = fixtures.load(spark, sf_dir)
    enc, mean = fe.target_fit_fallback(fx.applications, TE_CUTOFF)
    num = fe.target_apply(fe.numerical(fx.applications, keep=K.CATEGORICAL_FEATURES), enc, mean)
    merged = materialise(num.join(fe.payment_windows(fx.payments, fx.applications), "application_id", "left")
                         .join(fe.bureau(fx.applications, fx.bureau), "application_id", "left"), "merged")
    d = F.col("feature_date")
    split = F.when(d <= F.to_date(F.lit(T1)), "train").when(d <= F.to_date(F.lit(T2)), "val").otherwise("test")
    rows = merged.withColumn("split", split)
    med = fe.medians(rows.where(F.col("split") == "train"), K.ALL_FEATURES)
    return round_doubles(fe.fill_with(rows, med, K.ALL_FEATURES).select("application_id", "split", *K.ALL_FEATURES))


@register("critical_fill", with_ctes(
    ["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF),
    "SELECT application_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in K.CRITICAL_NO_NULL) + " FROM snapshot"))
def q_critical_fill(spark, sf_dir):
    """critical columns after the median fill (income is NULL for part of the loans)."""
    df = features_snapshot_df(spark, sf_dir)
    return round_doubles(df.select("application_id", *K.CRITICAL_NO_NULL))


@register("class_weight", with_ctes(
    ["applications_v", "payments_v"], [],
    "SELECT count(*) AS n, round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 6) AS pos_rate, "
    "round(CASE WHEN sum(CASE WHEN is_default THEN 1 ELSE 0 END) > 0 THEN (count(*) - sum(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END)) "
    "/ sum(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) ELSE 1.0e0 END, 6) AS pos_weight FROM applications_v"))
def q_class_weight(spark, sf_dir):
    """F8: positive rate and the neg/pos weight."""
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(fe.class_weight(fx.applications.withColumn("y", F.col("is_default").cast("int"))))
