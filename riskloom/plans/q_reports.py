"""Queries for the dashboard reports (F9-F14) and simple filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import reports as R
from ..sources import fixtures
from .catalog import register
from .oracle_views import with_ctes

PRED_SQL = """
SELECT application_id AS prediction_id, application_id, 'batch:' || segment || ':logistic' AS model_version,
  pd_score, CASE WHEN pd_score < 0.0e0 THEN 0.0e0 WHEN pd_score > 1.0e0 THEN 1.0e0 ELSE pd_score END AS pd_calibrated,
  CASE WHEN pd_score < 0.05e0 THEN 'LOW' WHEN pd_score < 0.15e0 THEN 'MEDIUM' WHEN pd_score < 0.30e0 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_bucket,
  CAST(application_date AS TIMESTAMP) AS predicted_at
FROM scored_v"""


def predictions(spark, sf_dir):
    return R.predictions_table(fixtures.load(spark, sf_dir).scored)


@register("risk_bucket", with_ctes(["scored_v"], [("preds", PRED_SQL)],
                                   "SELECT prediction_id, model_version, round(pd_calibrated, 6) AS pd_calibrated, risk_bucket FROM preds"))
def q_risk_bucket(spark, sf_dir):
    """C10 + C14: calibrated PD and risk bucket of every scored loan."""
    p = predictions(spark, sf_dir)
    return round_doubles(p.select("prediction_id", "model_version", "pd_calibrated", "risk_bucket"))


@register("table_counts", with_ctes(["scored_v"], [("preds", PRED_SQL)],
                                    "SELECT (SELECT count(*) FROM applications_v) AS n_applications, "
                                    "(SELECT count(*) FROM payments_v) AS n_payments, (SELECT count(*) FROM preds) AS n_predictions"))
def q_table_counts(spark, sf_dir):
    """loans, payments and predictions counts."""
    fx = fixtures.load(spark, sf_dir)
    return R.table_counts(fx.applications, fx.payments, predictions(spark, sf_dir))


@register("default_rate", with_ctes(["applications_v"], [],
                                    "SELECT round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 4) AS value FROM applications_v"))
def q_default_rate(spark, sf_dir):
    """overall default rate (4 decimals)."""
    return R.default_rate(fixtures.load(spark, sf_dir).applications)


@register("monthly_volume", with_ctes(["applications_v"], [],
                                      "SELECT CAST(date_trunc('month', application_date) AS TIMESTAMP) AS time, "
                                      "CAST(count(*) AS DOUBLE) AS applications, "
                                      "round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 6) AS default_rate "
                                      "FROM applications_v GROUP BY 1"))
def q_monthly(spark, sf_dir):
    """monthly loan volume and default rate."""
    return round_doubles(R.monthly(fixtures.load(spark, sf_dir).applications))


@register("segment_prediction_stats", with_ctes(["scored_v"], [("preds", PRED_SQL)], " UNION ALL ".join(
    f"SELECT '{s}' AS segment, count(*) AS n, round(avg(pd_calibrated), 4) AS mean_pd FROM preds WHERE model_version LIKE '%{s}%'"
    for s in ("with_history", "cold_start"))))
def q_segment_stats(spark, sf_dir):
    """F12 (D4 LIKE filter): count and mean PD per segment."""
    return R.segment_prediction_stats(predictions(spark, sf_dir))


@register("risk_distribution", with_ctes(["scored_v"], [("preds", PRED_SQL)], " UNION ALL ".join(
    f"SELECT '{scope}' AS scope, risk_bucket AS metric, round(count(*) * 100.0e0 / (SELECT count(*) FROM preds WHERE {cond}), 1) AS value "
    f"FROM preds WHERE {cond} GROUP BY risk_bucket"
    for scope, cond in (("all", "true"), ("with_history", "model_version LIKE '%with_history%'"),
                        ("cold_start", "model_version LIKE '%cold_start%'")))))
def q_risk_distribution(spark, sf_dir):
    """risk bucket shares (percent, 1 decimal) overall and per segment."""
    return R.risk_distribution(predictions(spark, sf_dir))


@register("pd_histogram", with_ctes(["scored_v"], [("preds", PRED_SQL)], """
SELECT segment, bin, bin / 20.0e0 AS bin_start, count(*) AS n FROM (
  SELECT CASE WHEN model_version LIKE '%with_history%' THEN 'with_history' WHEN model_version LIKE '%cold_start%' THEN 'cold_start' END AS segment,
    CAST(least(floor(pd_calibrated * 20), 19) AS INT) AS bin FROM preds) t WHERE segment IS NOT NULL GROUP BY segment, bin"""))
def q_pd_histogram(spark, sf_dir):
    """F14 (re-aimed from a raw score list): 20-bin PD histogram per segment."""
    return round_doubles(R.score_histogram(predictions(spark, sf_dir)))


@register("date_between", with_ctes(["applications_v"], [], """
SELECT count(*) AS n, round(avg(loan_amount), 4) AS avg_loan FROM applications_v
WHERE application_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"""))
def q_date_between(spark, sf_dir):
    """Inclusive date range filter (pushed to the scan as two bounds)."""
    a = fixtures.load(spark, sf_dir).applications
    f = a.where(F.col("application_date").between(F.to_date(F.lit("1997-01-01")), F.to_date(F.lit("1997-12-31"))))
    return f.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("loan_amount"), 4).alias("avg_loan"))
