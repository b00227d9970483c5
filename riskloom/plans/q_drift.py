"""Queries for drift monitoring (J1-J8) and the drift dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import drift as D
from ..operators import reports as R
from ..session import cut_lineage
from ..sources import fixtures
from . import oracle_features as OF
from .catalog import register
from .oracle_views import with_ctes
from .q_features import TE_CUTOFF, features_snapshot_df
from .q_reports import PRED_SQL, predictions

CHECK_DATE = "2001-08-01"
FEATS = D.DRIFT_FEATURES


def _lam(x: str) -> str:
    return f"lambda {x}:"


WIN_SQL = """
SELECT greatest(dmin, ref_end - cur) AS reference_start, ref_end AS reference_end,
  dmax - cur AS current_start, dmax AS current_end
FROM (SELECT dmin, dmax, cur,
    CASE WHEN dmax - (cur + gap) <= dmin THEN dmin + CAST(greatest(floor(span / 3), 1) AS INT) ELSE dmax - (cur + gap) END AS ref_end
  FROM (SELECT dmin, dmax, span, CAST(greatest(least(floor(span / 6), 120), least(30, span)) AS INT) AS cur,
      CAST(greatest(floor(span / 10), 7) AS INT) AS gap
    FROM (SELECT min(feature_date) AS dmin, max(feature_date) AS dmax,
        CAST(greatest(max(feature_date) - min(feature_date), 1) AS INT) AS span FROM {src} HAVING min(feature_date) IS NOT NULL) a) b) c"""


def drift_blocks(src: str = "snapshot", feats=FEATS, variant: str = "monitor") -> list[tuple[str, str]]:
    cols = ", ".join(feats)
    probs = "[" + ", ".join(f"{i / K.PSI_BINS}" for i in range(K.PSI_BINS + 1)) + "]"
    if variant == "eda":
        rp, cp, enough, fb = "c.c_ref * 1.0e0 / n.n_ref", "c.c_cur * 1.0e0 / n.n_cur", 50, "NULL"
    else:
        rp, cp, enough, fb = "c.c_ref * 1.0e0 / greatest(t.in_ref, 1)", "c.c_cur * 1.0e0 / greatest(t.in_cur, 1)", 10, "0.0e0"
    last = "e.edges[len(e.edges)]"
    return [
        ("win", WIN_SQL.replace("{src}", src)),
        ("tagged", f"SELECT 'ref' AS wnd, {cols} FROM {src}, win WHERE feature_date BETWEEN win.reference_start AND win.reference_end "
                   f"UNION ALL SELECT 'cur' AS wnd, {cols} FROM {src}, win WHERE feature_date BETWEEN win.current_start AND win.current_end"),
        ("vals", f"SELECT * FROM (UNPIVOT tagged ON {cols} INTO NAME feature VALUE value) u WHERE value IS NOT NULL"),
        ("edges", f"SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs}))) AS edges FROM vals WHERE wnd = 'ref' GROUP BY feature"),
        ("nn", "SELECT feature, count(CASE WHEN wnd = 'ref' THEN 1 END) AS n_ref, count(CASE WHEN wnd = 'cur' THEN 1 END) AS n_cur "
               "FROM vals GROUP BY feature"),
        ("binned", f"SELECT v.feature, v.wnd, CASE WHEN v.value < e.edges[1] OR v.value > {last} THEN NULL "
                   f"WHEN v.value = {last} THEN len(e.edges) - 2 ELSE len(list_filter(e.edges, lambda x: x <= v.value)) - 1 END AS bin "
                   "FROM vals v JOIN edges e ON e.feature = v.feature"),
        ("counts", "SELECT feature, bin, count(CASE WHEN wnd = 'ref' THEN 1 END) AS c_ref, "
                   "count(CASE WHEN wnd = 'cur' THEN 1 END) AS c_cur FROM binned WHERE bin IS NOT NULL GROUP BY feature, bin"),
        ("tot", "SELECT feature, sum(c_ref) AS in_ref, sum(c_cur) AS in_cur FROM counts GROUP BY feature"),
        ("terms", f"SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM (SELECT c.feature, greatest({rp}, 1e-6) AS rp, "
                  f"greatest({cp}, 1e-6) AS cp FROM counts c JOIN tot t ON t.feature = c.feature JOIN nn n ON n.feature = c.feature) x "
                  "GROUP BY feature"),
        ("psi", f"SELECT n.feature, n.n_ref, n.n_cur, CASE WHEN n.n_ref >= {enough} AND n.n_cur >= {enough} AND "
                f"coalesce(len(e.edges), 0) >= 2 THEN coalesce(t.psi, 0.0e0) ELSE {fb} END AS psi "
                "FROM nn n LEFT JOIN edges e ON e.feature = n.feature LEFT JOIN terms t ON t.feature = n.feature"),
        ("kv", "SELECT feature, value, count(CASE WHEN wnd = 'ref' THEN 1 END) AS r, count(CASE WHEN wnd = 'cur' THEN 1 END) AS c "
               "FROM vals GROUP BY feature, value"),
        ("kc", "SELECT *, sum(r) OVER w AS cum_r, sum(c) OVER w AS cum_c, sum(r) OVER (PARTITION BY feature) AS tot_r, "
               "sum(c) OVER (PARTITION BY feature) AS tot_c FROM kv WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)"),
        ("ks0", "SELECT feature, CAST(max(tot_r) AS BIGINT) AS n_ref, CAST(max(tot_c) AS BIGINT) AS n_cur, max(abs(cum_r * 1.0e0 / tot_r - cum_c * 1.0e0 / tot_c)) AS d "
                "FROM kc GROUP BY feature"),
        ("ks", "SELECT feature, n_ref, n_cur, d AS ks_statistic, CASE WHEN lam < 0.2e0 THEN 1.0e0 ELSE least(greatest(list_sum("
               "list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0e0 ELSE -1.0e0 END * 2.0e0 * exp(-2.0e0 * k * k * lam * lam))), "
               "0.0e0), 1.0e0) END AS ks_pvalue FROM (SELECT *, sqrt(n_ref * 1.0e0 * n_cur / (n_ref + n_cur)) * d AS lam FROM ks0) z"),
    ]


def check_blocks(src: str = "snapshot") -> list[tuple[str, str]]:
    return drift_blocks(src) + [
        ("gate", f"SELECT count(CASE WHEN feature_date BETWEEN reference_start AND reference_end THEN 1 END) AS rows_ref, "
                 f"count(CASE WHEN feature_date BETWEEN current_start AND current_end THEN 1 END) AS rows_cur, "
                 f"max(CAST(reference_start AS VARCHAR) || '/' || CAST(reference_end AS VARCHAR)) AS reference_period, "
                 f"max(CAST(current_start AS VARCHAR) || '/' || CAST(current_end AS VARCHAR)) AS current_period FROM {src}, win"),
        ("dchk", f"SELECT coalesce(p.feature, k.feature) AS feature_name, DATE '{CHECK_DATE}' AS check_date, "
                 "coalesce(p.psi, 0.0e0) AS psi_value, k.ks_statistic, k.ks_pvalue, coalesce(p.psi, 0.0e0) > 0.15e0 AS is_drifted, "
                 "coalesce(p.psi, 0.0e0) > 0.1e0 AND NOT coalesce(p.psi, 0.0e0) > 0.15e0 AS is_warning, g.reference_period, g.current_period "
                 "FROM psi p FULL JOIN ks k ON k.feature = p.feature, gate g WHERE g.rows_ref >= 50 AND g.rows_cur >= 50"),
    ]


SNAP = OF.snapshot_blocks(TE_CUTOFF)
BASE = ["applications_v", "payments_v", "bureau_v"]


def snapshot_table(spark, sf_dir):
    """What the monitoring job reads of the feature snapshot, as a table and not as a plan to run again: the date and
    the monitored features."""
    return cut_lineage(features_snapshot_df(spark, sf_dir).select("feature_date", *FEATS))


def _drift_inputs(spark, sf_dir):
    snap = snapshot_table(spark, sf_dir)
    return snap, D.windows(snap)


@register("drift_windows", with_ctes(BASE, SNAP + [("win", WIN_SQL.replace("{src}", "snapshot"))], "SELECT * FROM win"))
def q_drift_windows(spark, sf_dir):
    """Reference and current windows from the snapshot's feature dates (a row per loan, dated by its application)."""
    return D.windows(fixtures.load(spark, sf_dir).applications.select(F.col("application_date").alias("feature_date")))


@register("psi", with_ctes(BASE, SNAP + drift_blocks(), "SELECT feature, n_ref, n_cur, round(psi, 6) AS psi FROM psi"))
def q_psi(spark, sf_dir):
    """PSI of the 26 monitored features, current vs reference window."""
    snap, win = _drift_inputs(spark, sf_dir)
    return round_doubles(D.psi(D.window_values(snap, win, FEATS)))


@register("ks_drift", with_ctes(BASE, SNAP + drift_blocks(),
                                "SELECT feature, n_ref, n_cur, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue FROM ks"))
def q_ks_drift(spark, sf_dir):
    """Two-sample KS statistic and asymptotic p-value per feature."""
    snap, win = _drift_inputs(spark, sf_dir)
    return round_doubles(D.ks_two_sample(D.window_values(snap, win, FEATS)))


@register("ks_drift_exact")
def q_ks_drift_exact(spark, sf_dir):
    """J4 with the exact p-value where neither window has more than 10,000 values."""
    snap, win = _drift_inputs(spark, sf_dir)
    return round_doubles(D.ks_two_sample(D.window_values(snap, win, FEATS), exact_up_to=10_000))


CHECK_SQL = with_ctes(BASE, SNAP + check_blocks(),
                      "SELECT feature_name, check_date, round(psi_value, 6) AS psi_value, round(ks_statistic, 6) AS ks_statistic, "
                      "round(ks_pvalue, 6) AS ks_pvalue, is_drifted, is_warning, reference_period, current_period FROM dchk")


# a change that the monitor must see: from this day on two features are scaled
SHIFT_FROM, SHIFTS = "2001-01-01", {"loan_to_income": 1.6, "credit_score_norm": 1.12}
SHIFTED = [("shifted", "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN feature_date >= DATE '{SHIFT_FROM}' THEN {c} * {k}e0 ELSE {c} END AS {c}" for c, k in SHIFTS.items()) + ") FROM snapshot")]


def shifted_check_df(spark, sf_dir):
    """The drift check over a snapshot whose newest rows have shifted features."""
    snap = snapshot_table(spark, sf_dir)
    new = F.col("feature_date") >= F.to_date(F.lit(SHIFT_FROM))
    snap = snap.withColumns({c: F.when(new, F.col(c) * k).otherwise(F.col(c)) for c, k in SHIFTS.items()})
    return D.check(snap, D.windows(snap), FEATS, CHECK_DATE)


def drift_check_df(spark, sf_dir):
    snap, win = _drift_inputs(spark, sf_dir)
    return D.check(snap, win, FEATS, CHECK_DATE)


@register("drift_check", CHECK_SQL)
def q_drift_check(spark, sf_dir):
    """The monitoring drift check (PSI + KS, 26 features, both windows >= 50 rows)."""
    return round_doubles(drift_check_df(spark, sf_dir))


def _alert_sql(text: str, *args: str) -> str:
    """An alert text filled in by DuckDB's printf."""
    return f"printf('{text}', {', '.join(args)})"


ALERT_SQL_BODY = ("SELECT feature_name, check_date, substr(CASE WHEN is_drifted THEN " + _alert_sql(
    K.DRIFT_ALERT, "feature_name", "psi_value", f"'{K.PSI_THRESHOLD}'", *[f"split_part({p}_period, '/', {i})" for p in ("current", "reference") for i in (1, 2)])
    + " ELSE " + _alert_sql(K.DRIFT_WARNING, "feature_name", "psi_value", f"'{K.PSI_WARNING}'")
    + " END, 1, 4000) AS message, 'pending' AS status, CAST(check_date AS TIMESTAMP) AS created_at, "
      "CAST(NULL AS TIMESTAMP) AS sent_at, CAST(NULL AS VARCHAR) AS error FROM dchk WHERE is_drifted OR is_warning")


@register("drift_alerts", with_ctes(BASE, SNAP + SHIFTED + check_blocks("shifted"), ALERT_SQL_BODY))
def q_drift_alerts(spark, sf_dir):
    """Alert messages (pending) for drifted and warned features."""
    return D.alerts(shifted_check_df(spark, sf_dir))


FEATURE_LIST = "[" + ", ".join(f"'{f}'" for f in FEATS) + "]"


@register("alert_drain", with_ctes(BASE, SNAP + SHIFTED + check_blocks("shifted") + [
    ("aq0", ALERT_SQL_BODY),
    ("aq", f"SELECT CAST(list_position({FEATURE_LIST}, feature_name) AS BIGINT) AS alert_id, * FROM aq0"),
    ("taken", "SELECT alert_id FROM aq WHERE status = 'pending' ORDER BY created_at, alert_id LIMIT 50"),
], "SELECT alert_id, feature_name, status, sent_at FROM aq WHERE alert_id NOT IN (SELECT alert_id FROM taken) "
   "UNION ALL SELECT alert_id, feature_name, 'sent' AS status, TIMESTAMP '2001-08-02 00:00:00' AS sent_at FROM aq "
   "WHERE alert_id IN (SELECT alert_id FROM taken)"))
def q_alert_drain(spark, sf_dir):
    """Oldest 50 pending alerts marked sent; the queue after one drain."""
    a = D.alerts(shifted_check_df(spark, sf_dir))
    a = a.withColumn("alert_id", F.array_position(F.array(*[F.lit(f) for f in FEATS]), F.col("feature_name")))
    return D.drain(a, "2001-08-02 00:00:00").select("alert_id", "feature_name", "status", "sent_at")


@register("prediction_health", with_ctes(["scored_v"], [("preds", PRED_SQL)], """
SELECT n, round(mean_pd, 6) AS mean_pd, round(std_pd, 6) AS std_pd,
  CASE WHEN n < 10 THEN 'skip' WHEN mean_pd > 0.5 OR mean_pd < 0.01 THEN 'error' WHEN std_pd < 0.001 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN n < 10 THEN 'too few predictions' WHEN mean_pd > 0.5 OR mean_pd < 0.01 THEN printf('Suspicious mean PD: %.4f', mean_pd)
       WHEN std_pd < 0.001 THEN printf('Model predictions degenerated (std=%.6f)', std_pd) END AS reason
FROM (SELECT count(*) AS n, avg(pd_calibrated) AS mean_pd, stddev_samp(pd_calibrated) AS std_pd
  FROM (SELECT * FROM preds ORDER BY predicted_at DESC, prediction_id DESC LIMIT 5000) l) s"""))
def q_prediction_health(spark, sf_dir):
    """J7 (with G4): health of the newest 5,000 predictions."""
    return round_doubles(D.prediction_health(predictions(spark, sf_dir)))


ERAS = {"early (1995-1996)": ("1995-01-01", "1996-12-31"), "middle (1997-1998)": ("1997-01-01", "1998-12-31"),
        "late (1999-2001)": ("1999-01-01", "2001-12-31")}
ERA_REF = "middle (1997-1998)"
EDA_FEATS = ["credit_score", "income", "loan_amount", "interest_rate", "dti_ratio"]


def era_label(date_col="application_date", eras=ERAS):
    """Era label of a date (fixed eras; first matching era wins)."""
    expr = None
    for name, (a, b) in eras.items():
        cond = F.col(date_col).between(F.to_date(F.lit(a)), F.to_date(F.lit(b)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def _era_sql(col="application_date"):
    return "CASE " + " ".join(f"WHEN {col} BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}'" for n, (a, b) in ERAS.items()) + " END"


@register("era_filter", with_ctes(["applications_v"], [], f"SELECT {_era_sql()} AS era, count(*) AS n, "
                                  "round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 6) AS default_rate "
                                  f"FROM applications_v WHERE {_era_sql()} IS NOT NULL GROUP BY 1"))
def q_era_filter(spark, sf_dir):
    """Loans and default rate per fixed date era."""
    a = fixtures.load(spark, sf_dir).applications.withColumn("era", era_label())
    return round_doubles(a.where(F.col("era").isNotNull()).groupBy("era").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("is_default"), 1.0).otherwise(0.0)).alias("default_rate")))


def _eda_values(spark, sf_dir):
    """(era, window, feature, value): one scan; a reference-era row is tagged once for every other era."""
    a = fixtures.load(spark, sf_dir).applications.withColumn("era", era_label()).where(F.col("era").isNotNull())
    others = [e for e in ERAS if e != ERA_REF]
    tag = lambda era, w: F.struct(era.alias("era"), F.lit(w).alias("window"))
    tags = F.when(F.col("era") == ERA_REF, F.array(*[tag(F.lit(e), "ref") for e in others])) \
        .otherwise(F.array(tag(F.col("era"), "cur")))
    u = a.select(F.explode(tags).alias("t"), *[F.col(c).cast("double").alias(c) for c in EDA_FEATS]).select("t.*", *EDA_FEATS)
    return u.unpivot(["era", "window"], EDA_FEATS, "feature", "value").where(F.col("value").isNotNull())


def _eda_sql():
    others = [e for e in ERAS if e != ERA_REF]
    cols = ", ".join(EDA_FEATS)
    tag = " UNION ALL ".join(
        f"SELECT '{e}' AS era, '{w}' AS wnd, {cols} FROM applications_v WHERE {_era_sql()} = '{src}'"
        for e in others for w, src in (("ref", ERA_REF), ("cur", e)))
    probs = "[" + ", ".join(f"{i / K.PSI_BINS}" for i in range(K.PSI_BINS + 1)) + "]"
    last = "e.edges[len(e.edges)]"
    return with_ctes(["applications_v"], [
        ("tagged", tag),
        ("vals", f"SELECT * FROM (UNPIVOT tagged ON {cols} INTO NAME feature VALUE value) u WHERE value IS NOT NULL"),
        ("edges", f"SELECT era, feature, list_sort(list_distinct(quantile_cont(value, {probs}))) AS edges FROM vals WHERE wnd = 'ref' GROUP BY era, feature"),
        ("nn", "SELECT era, feature, count(CASE WHEN wnd = 'ref' THEN 1 END) AS n_ref, count(CASE WHEN wnd = 'cur' THEN 1 END) AS n_cur FROM vals GROUP BY era, feature"),
        ("binned", f"SELECT v.era, v.feature, v.wnd, CASE WHEN v.value < e.edges[1] OR v.value > {last} THEN NULL "
                   f"WHEN v.value = {last} THEN len(e.edges) - 2 ELSE len(list_filter(e.edges, lambda x: x <= v.value)) - 1 END AS bin "
                   "FROM vals v JOIN edges e ON e.feature = v.feature AND e.era = v.era"),
        ("counts", "SELECT era, feature, bin, count(CASE WHEN wnd = 'ref' THEN 1 END) AS c_ref, count(CASE WHEN wnd = 'cur' THEN 1 END) AS c_cur "
                   "FROM binned WHERE bin IS NOT NULL GROUP BY era, feature, bin"),
        ("terms", "SELECT era, feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM (SELECT c.era, c.feature, "
                  "greatest(c.c_ref * 1.0e0 / n.n_ref, 1e-6) AS rp, greatest(c.c_cur * 1.0e0 / n.n_cur, 1e-6) AS cp FROM counts c "
                  "JOIN nn n ON n.feature = c.feature AND n.era = c.era) x GROUP BY era, feature"),
        ("psi", "SELECT n.era, n.feature, n.n_ref, n.n_cur, CASE WHEN n.n_ref >= 50 AND n.n_cur >= 50 AND coalesce(len(e.edges), 0) >= 2 "
                "THEN coalesce(t.psi, 0.0e0) END AS psi FROM nn n LEFT JOIN edges e ON e.feature = n.feature AND e.era = n.era "
                "LEFT JOIN terms t ON t.feature = n.feature AND t.era = n.era"),
    ], "SELECT era, feature, n_ref, n_cur, round(psi, 6) AS psi, CASE WHEN psi > 0.25 THEN 'HIGH' WHEN psi > 0.1 THEN 'MODERATE' "
       "ELSE 'LOW' END AS level FROM psi")


@register("psi_eda", _eda_sql())
def q_psi_eda(spark, sf_dir):
    """PSI of each era against the reference era (shares of all rows), with its level."""
    p = D.psi(_eda_values(spark, sf_dir), by=["era", "feature"], variant="eda")
    return round_doubles(p.withColumn("level", D.psi_level(F.col("psi"))))


# F15/F16 read the drift table written by the check
def _drift_table(spark, sf_dir):
    return drift_check_df(spark, sf_dir).withColumn("checked_at", F.col("check_date").cast("timestamp"))


@register("drift_summary", with_ctes(BASE, SNAP + check_blocks(), """
SELECT count(*) AS n_checks, count(DISTINCT CASE WHEN is_drifted THEN feature_name END) AS n_drifted_features,
  round(max(CASE WHEN check_date = (SELECT max(check_date) FROM dchk) THEN psi_value END), 6) AS latest_max_psi FROM dchk"""))
def q_drift_summary(spark, sf_dir):
    """checks, distinct drifted features, max PSI of the latest check."""
    return round_doubles(R.drift_summary(_drift_table(spark, sf_dir)))


@register("drift_trend", with_ctes(BASE, SNAP + check_blocks(),
                                   "SELECT CAST(check_date AS TIMESTAMP) AS time, round(psi_value, 6) AS psi, "
                                   "round(ks_statistic, 6) AS ks, feature_name FROM dchk ORDER BY 1, 4"))
def q_drift_trend(spark, sf_dir):
    """F16: psi and ks per feature over check time."""
    return round_doubles(R.drift_trend(_drift_table(spark, sf_dir)))
