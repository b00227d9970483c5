"""Queries for the streaming jobs (S1, S2); rows-only checks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import features as fe
from ..operators import models as MD
from ..session import checkpoint_dir, cut_lineage
from ..sources import fixtures
from ..streaming import streams as ST
from .catalog import register
from .oracle_views import with_ctes
from .q_drift import ALERT_SQL_BODY, BASE, SHIFTED, SNAP, check_blocks, shifted_check_df
from .q_features import TE_CUTOFF
from .q_models import FEATS_COLD, FEATS_HIST, model_dataset


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def requests_frame(spark, sf_dir):
    """Scoring requests derived from the loans: application fields, payment signals (F2) and
    bureau ratios; home ownership mapped onto the API's four values by the caller."""
    fx = fixtures.load(spark, sf_dir)
    a = fx.applications
    agg = fe.payment_windows(fx.payments, a).select("application_id", *K.AGGREGATION_FEATURES)
    bur = fe.bureau(a, fx.bureau).select("application_id", *K.BUREAU_FEATURES)
    home = F.when(F.upper("home_ownership").isin(*K.HOME_OWNERSHIP_ALLOWED), F.upper("home_ownership")).otherwise("OTHER")
    req = a.withColumn("home_ownership", home).join(agg, "application_id", "left").join(bur, "application_id", "left")
    return req.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ST.REQUEST_SCHEMA.fields])


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Requests streamed from files, validated, featurised, routed, scored and bucketed
    micro-batch by micro-batch (availableNow); scored and refused rows read back."""
    d = model_dataset(spark, sf_dir)
    train = d.where(F.col("split") == "train")
    bundles = {}
    for seg, feats in (("with_history", FEATS_HIST), ("cold_start", FEATS_COLD)):
        part = train.where(F.col("segment") == seg)
        # side tables are materialised once, not recomputed by every micro-batch
        bundles[seg] = ("logistic", MD.fit(part, "logistic", feats), feats, cut_lineage(fe.medians(part, feats)))
    fx = fixtures.load(spark, sf_dir)
    enc, mean = fe.target_fit_fallback(fx.applications, TE_CUTOFF)
    enc, mean = cut_lineage(enc), cut_lineage(mean)
    in_dir, out_dir = _scratch(spark, "requests"), _scratch(spark, "scored")
    requests_frame(spark, sf_dir).write.parquet(in_dir)
    ST.score_stream(spark, in_dir, out_dir, _scratch(spark, "ckpt-score"), bundles, enc, mean)
    scores = spark.read.parquet(os.path.join(out_dir, "scores")).select(
        "application_id", "model_version", F.round("pd_calibrated", 6).alias("pd_calibrated"), "risk_bucket",
        F.lit(None).cast("string").alias("failed_rules"))
    refused = spark.read.parquet(os.path.join(out_dir, "refused")).select(
        "application_id", F.lit(None).cast("string").alias("model_version"), F.lit(None).cast("double").alias("pd_calibrated"),
        F.lit(None).cast("string").alias("risk_bucket"), "failed_rules")
    return scores.unionByName(refused)


def _drift_files(spark, sf_dir):
    """Two runs of the drift check land as files (the second a re-delivery of the first)."""
    rows = shifted_check_df(spark, sf_dir).withColumn("checked_at", F.col("check_date").cast("timestamp"))
    path = _scratch(spark, "drift-rows")
    rows.write.parquet(os.path.join(path, "run=1"))
    rows.write.parquet(os.path.join(path, "run=2"))
    return path


SHIFTED_CHECK = SNAP + SHIFTED + check_blocks("shifted")


@register("stream_dedup", with_ctes(BASE, SHIFTED_CHECK, "SELECT feature_name, check_date, round(psi_value, 6) AS psi_value FROM dchk"))
def q_stream_dedup(spark, sf_dir):
    """S2 (input side): drift rows deduplicated within the watermark on (feature, check date)."""
    src = _drift_files(spark, sf_dir)
    out = _scratch(spark, "drift-dedup")
    ST.dedup_stream(spark, os.path.join(src, "*"), out, _scratch(spark, "ckpt-dedup"))
    return spark.read.schema(ST.DRIFT_SCHEMA).parquet(out).select("feature_name", "check_date", F.round("psi_value", 6).alias("psi_value"))


@register("stream_alerts", with_ctes(BASE, SHIFTED_CHECK + [("aq", ALERT_SQL_BODY)], "SELECT feature_name, check_date, status, message FROM aq"))
def q_stream_alerts(spark, sf_dir):
    """Pending alert rows for drifted or warned features, appended by the alert stream."""
    src = _drift_files(spark, sf_dir)
    out = _scratch(spark, "alerts")
    ST.alert_stream(spark, os.path.join(src, "*"), out, _scratch(spark, "ckpt-alerts"))
    schema = "feature_name string, check_date date, message string, status string, created_at timestamp, " \
             "sent_at timestamp, error string, checked_at timestamp"
    return spark.read.schema(schema).parquet(out).select("feature_name", "check_date", "status", "message")


QUEUE_SQL = ("SELECT feature_name, check_date, message, 'sent' AS status, CASE WHEN message LIKE '" + K.DRIFT_ALERT.split("%s")[0]
             + "%' THEN 1 ELSE 2 END AS attempts FROM aq")


@register("alert_queue", with_ctes(BASE, SHIFTED_CHECK + [("aq", ALERT_SQL_BODY)], QUEUE_SQL))
def q_alert_queue(spark, sf_dir):
    """S2 with J8: the alert queue after two micro-batches, the second a re-delivery of the first; warnings are not
    delivered at the first attempt and are retried with the second batch."""
    rows = cut_lineage(shifted_check_df(spark, sf_dir).withColumn("checked_at", F.col("check_date").cast("timestamp")))
    src, queue = _scratch(spark, "drift-rows"), _scratch(spark, "alert-queue")
    for run in ("run=1", "run=2"):  # a row a feature: one file a run, one run a micro-batch
        rows.coalesce(1).write.parquet(os.path.join(src, run))
    drifted = F.col("message").startswith(K.DRIFT_ALERT.split("%s")[0])
    ST.alert_queue_stream(spark, os.path.join(src, "*"), queue, _scratch(spark, "ckpt-queue"),
                          delivered=drifted | (F.col("attempts") >= 1), max_files_per_trigger=1)
    return ST.read_alert_queue(spark, queue).select("feature_name", "check_date", "message", "status", "attempts")
