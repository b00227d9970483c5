"""Dashboard queries (F9-F16) and the scored-predictions table they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.expr import clip, risk_bucket


def predictions_table(scored: DataFrame, model_type: str = "logistic") -> DataFrame:
    """Batch predictions (K8 shape): version ``batch:<segment>:<type>``, calibrated = clip(score),
    risk bucket (C10, C14)."""
    p = clip(F.col("pd_score"), 0.0, 1.0)
    return scored.select(
        F.col("application_id").alias("prediction_id"), "application_id",
        F.concat(F.lit("batch:"), F.col("segment"), F.lit(f":{model_type}")).alias("model_version"),
        "pd_score", p.alias("pd_calibrated"), risk_bucket(p, K.RISK_BUCKET_BOUNDS, K.RISK_BUCKET_LABELS).alias("risk_bucket"),
        F.col("application_date").cast("timestamp").alias("predicted_at"),
    )


def table_counts(applications: DataFrame, payments: DataFrame, predictions: DataFrame) -> DataFrame:
    """row counts of loans, payments and predictions (one row)."""
    return applications.agg(F.count(F.lit(1)).alias("n_applications")) \
        .withColumn("n_payments", payments.agg(F.count(F.lit(1))).scalar()) \
        .withColumn("n_predictions", predictions.agg(F.count(F.lit(1))).scalar())


def default_rate(applications: DataFrame) -> DataFrame:
    """share of defaults, 4 decimals."""
    return applications.agg(F.round(F.avg(F.when(F.col("is_default"), 1.0).otherwise(0.0)), 4).alias("value"))


def monthly(applications: DataFrame) -> DataFrame:
    """loans and default rate per month."""
    m = F.date_trunc("month", F.col("application_date").cast("timestamp"))
    return applications.groupBy(m.alias("time")).agg(
        F.count(F.lit(1)).cast("double").alias("applications"),
        F.avg(F.when(F.col("is_default"), 1.0).otherwise(0.0)).alias("default_rate"))


def segment_prediction_stats(preds: DataFrame, segments=("with_history", "cold_start")) -> DataFrame:
    """F12 (with D4): count and mean calibrated PD of the versions matching each segment."""
    rows = None
    for s in segments:
        part = preds.where(F.col("model_version").like(f"%{s}%")).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("pd_calibrated"), 4).alias("mean_pd")) \
            .select(F.lit(s).alias("segment"), "n", "mean_pd")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def risk_distribution(preds: DataFrame, segments=("with_history", "cold_start")) -> DataFrame:
    """percentage of each risk bucket, over all predictions and per segment (1 decimal)."""
    scope = F.explode(F.array(F.lit("all"), *[F.when(F.col("model_version").like(f"%{s}%"), F.lit(s)) for s in segments]))
    tagged = preds.select("risk_bucket", scope.alias("scope")).where(F.col("scope").isNotNull())
    counts = tagged.groupBy("scope", "risk_bucket").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("scope").agg(F.sum("n").alias("total"))
    return counts.join(totals, "scope").select("scope", F.col("risk_bucket").alias("metric"),
                                                F.round(F.col("n") / F.col("total") * 100, 1).alias("value"))


def score_histogram(preds: DataFrame, bins: int = 20, segments=("with_history", "cold_start")) -> DataFrame:
    """F14 (re-aimed): fixed-width histogram of calibrated PD per segment instead of the raw list."""
    seg = None
    for s in segments:
        c = F.col("model_version").like(f"%{s}%")
        seg = F.when(c, F.lit(s)) if seg is None else seg.when(c, F.lit(s))
    b = F.least(F.floor(F.col("pd_calibrated") * bins), F.lit(bins - 1)).cast("int")
    return preds.select(seg.alias("segment"), b.alias("bin")).where(F.col("segment").isNotNull()) \
        .groupBy("segment", "bin").agg(F.count(F.lit(1)).alias("n")) \
        .select("segment", "bin", (F.col("bin") / float(bins)).alias("bin_start"), "n")


def drift_summary(drift: DataFrame, time_col: str = "checked_at") -> DataFrame:
    """number of checks, distinct drifted features, max PSI of the latest check
    (the latest time is a scalar subquery)."""
    latest = drift.agg(F.max(time_col)).scalar()
    return drift.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_distinct(F.when(F.col("is_drifted"), F.col("feature_name"))).alias("n_drifted_features"),
        F.max(F.when(F.col(time_col) == latest, F.col("psi_value"))).alias("latest_max_psi"))


def drift_trend(drift: DataFrame, time_col: str = "checked_at") -> DataFrame:
    """F16: psi and ks per feature in check-time order."""
    return drift.select(F.col(time_col).alias("time"), F.col("psi_value").alias("psi"),
                        F.col("ks_statistic").alias("ks"), "feature_name").orderBy("time", "feature_name")
