"""Structured Streaming jobs.

S1 re-aims the online scoring endpoint as a stream: scoring requests land as
files, each micro-batch is validated (A9), turned into serving features (C12,
C13, C11), routed to a segment model (K9), scored, bucketed (C10) and written
with exactly-once file-sink semantics (``foreachBatch`` keyed by batch id).

S2 re-aims the alert polling loop: drift check rows stream in, duplicates of a
(feature, check date) are dropped within a watermark, and drifted or warned
features become pending alert rows in the alert table.  ``alert_queue_stream`` is
the whole loop: the queue with its statuses and attempts is kept between batches.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from ..functions.expr import clip, risk_bucket
from ..operators import drift as D
from ..operators import features as fe
from ..operators import models as MD
from ..operators import quality as Q
from ..session import cut_lineage
from ..sources import commit

REQUEST_SCHEMA = T.StructType([
    T.StructField("application_id", T.LongType()),
    T.StructField("loan_amount", T.DoubleType()),
    T.StructField("income", T.DoubleType()),
    T.StructField("loan_term", T.IntegerType()),
    T.StructField("interest_rate", T.DoubleType()),
    T.StructField("employment_years", T.DoubleType()),
    T.StructField("credit_score", T.DoubleType()),
    T.StructField("dti_ratio", T.DoubleType()),
    T.StructField("num_open_accounts", T.IntegerType()),
    T.StructField("num_delinquencies", T.IntegerType()),
    T.StructField("total_credit_limit", T.DoubleType()),
    T.StructField("home_ownership", T.StringType()),
    T.StructField("purpose", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in K.AGGREGATION_FEATURES + K.BUREAU_FEATURES],
])


def serving_features(valid: DataFrame, encodings: DataFrame, mean: DataFrame, medians: DataFrame,
                     features: Sequence[str]) -> DataFrame:
    """C12 + C13 + C11: request features (serving rules), category encodings with the global-mean
    fallback, then missing values to the training medians and finally 0."""
    num = fe.numerical(valid, mode="serving", keep=["home_ownership", "purpose", *K.AGGREGATION_FEATURES, *K.BUREAU_FEATURES])
    enc = fe.target_apply(num, encodings, mean)
    missing = [c for c in features if c not in enc.columns]
    enc = enc.select("*", *[F.lit(None).cast("double").alias(c) for c in missing])
    return fe.fill_with(enc, medians, list(features)).select("application_id", *features)


def score_requests(batch: DataFrame, bundles: dict, encodings: DataFrame, mean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of requests to (scores, refused)."""
    valid, refused = Q.validate_requests(batch)
    routed = valid.withColumn("segment", MD.route(valid, "with_history" in bundles, "cold_start" in bundles))
    out = None
    for seg, (kind, model, feats, med) in bundles.items():
        part = routed.where(F.col("segment") == seg)
        x = serving_features(part, encodings, mean, med, feats)
        s = MD.score(model, x).select("application_id", "pd_score")
        p = clip(F.col("pd_score"), 0.0, 1.0)
        s = s.select("application_id", "pd_score", p.alias("pd_calibrated"),
                     risk_bucket(p, K.RISK_BUCKET_BOUNDS, K.RISK_BUCKET_LABELS).alias("risk_bucket"),
                     F.lit(f"{seg}:{kind}").alias("model_version"))
        out = s if out is None else out.unionByName(s)
    return out, refused.select("application_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def score_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, bundles: dict,
                 encodings: DataFrame, mean: DataFrame, max_files_per_trigger: int | None = None):
    """File-source stream of requests scored batch by batch (availableNow trigger).

    ``bundles``: segment -> (kind, PipelineModel, feature list, medians frame).
    The sink writes ``scores/batch=<id>`` and ``refused/batch=<id>`` with overwrite,
    so a replayed batch after a failure rewrites the same folder (idempotent).
    """
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:  # a caller's own bound of a micro-batch; by default a batch takes all that has arrived
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(in_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        scores, refused = score_requests(batch, bundles, encodings, mean)
        scores.write.mode("overwrite").parquet(os.path.join(out_dir, "scores", f"batch={batch_id}"))
        refused.write.mode("overwrite").parquet(os.path.join(out_dir, "refused", f"batch={batch_id}"))

    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


DRIFT_SCHEMA = T.StructType([
    T.StructField("feature_name", T.StringType()), T.StructField("check_date", T.DateType()),
    T.StructField("psi_value", T.DoubleType()), T.StructField("ks_statistic", T.DoubleType()),
    T.StructField("ks_pvalue", T.DoubleType()), T.StructField("is_drifted", T.BooleanType()),
    T.StructField("is_warning", T.BooleanType()), T.StructField("reference_period", T.StringType()),
    T.StructField("current_period", T.StringType()), T.StructField("checked_at", T.TimestampType()),
])


def alert_stream(spark: SparkSession, drift_dir: str, alerts_dir: str, checkpoint: str, watermark: str = "2 days"):
    """Drift rows -> deduplicated within the watermark on (feature, check date) -> alert rows
    for drifted or warned features, appended to the alert table (file sink, exactly once)."""
    rows = spark.readStream.schema(DRIFT_SCHEMA).parquet(drift_dir)
    dedup = rows.withWatermark("checked_at", watermark).dropDuplicatesWithinWatermark(["feature_name", "check_date"])
    alerts = D.alerts(dedup).withColumn("checked_at", F.col("created_at"))
    q = alerts.writeStream.format("parquet").option("path", alerts_dir).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def dedup_stream(spark: SparkSession, drift_dir: str, out_dir: str, checkpoint: str, watermark: str = "2 days"):
    """The deduplicated drift rows of S2 (the alert stream's input after the watermark)."""
    rows = spark.readStream.schema(DRIFT_SCHEMA).parquet(drift_dir)
    dedup = rows.withWatermark("checked_at", watermark).dropDuplicatesWithinWatermark(["feature_name", "check_date"])
    q = dedup.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


ALERT_KEY = ["feature_name", "check_date"]
QUEUE_SCHEMA = "feature_name string, check_date date, message string, status string, created_at timestamp, " \
               "sent_at timestamp, error string, attempts int"


def _open_alerts(spark: SparkSession, queue_dir: str) -> DataFrame:
    now = commit.current(spark, f"{queue_dir}/open")
    return spark.read.schema(QUEUE_SCHEMA).parquet(now) if now else spark.createDataFrame([], QUEUE_SCHEMA)


def _closed_alerts(spark: SparkSession, queue_dir: str, stream: str | None = None, before: int | None = None) -> DataFrame:
    """Closed alerts of all committed batches; with ``before``, without the batches of ``stream`` from that one on,
    which a writer that stopped may have left."""
    path = f"{queue_dir}/closed"
    if not commit.exists(spark, path):
        return spark.createDataFrame([], QUEUE_SCHEMA)
    rows = spark.read.schema(f"{QUEUE_SCHEMA}, stream string, batch bigint").option("basePath", path).parquet(path)
    if before is not None:
        rows = rows.where((F.col("stream") != stream) | (F.col("batch") < before))
    return rows.drop("stream", "batch")


def read_alert_queue(spark: SparkSession, queue_dir: str) -> DataFrame:
    """The queue as of the last commit: open alerts (pending) and closed ones (sent, or error after the last attempt)."""
    tag = commit.current_tag(spark, f"{queue_dir}/open")
    if tag is None:
        return spark.createDataFrame([], QUEUE_SCHEMA)
    stream, batch = tag.split(".")
    return _open_alerts(spark, queue_dir).unionByName(_closed_alerts(spark, queue_dir, stream, int(batch) + 1))


def queue_batch(drift: DataFrame, batch_id: int, queue_dir: str, stream: str = "0", batch: int = 50, max_attempts: int = 3,
                delivered: Column | None = None) -> bool:
    """One micro-batch of drift rows into the alert queue, then one drain; False if the batch was committed before.

    New alerts are those whose (feature, check date) is neither open nor closed; of repeated rows in a batch the one
    checked first counts.  The oldest ``batch`` pending alerts, by created_at and feature whatever batch they came with,
    are tried: ``delivered`` (an expression over the queue's columns) closes an alert as sent; otherwise it stays pending
    with its error and one attempt more, until ``max_attempts`` closes it as error.  Closed alerts go to a folder of this
    batch, open ones into a new version of the table, whose tag names the batch: a batch that is repeated after a
    restart either finds its tag and does nothing, or finds the queue as it was and writes the same folder again.
    One writer a queue at a time.
    """
    spark = drift.sparkSession
    done = commit.current_tag(spark, f"{queue_dir}/open")
    if done and done.split(".")[0] == stream and int(done.split(".")[1]) >= batch_id:
        return False
    open_, closed = _open_alerts(spark, queue_dir), _closed_alerts(spark, queue_dir, stream, batch_id)
    first = drift.groupBy(*ALERT_KEY).agg(F.min(F.struct("checked_at", *[c for c in drift.columns if c not in (*ALERT_KEY, "checked_at")])).alias("r"))
    new = D.alerts(first.select(*ALERT_KEY, "r.*")).withColumn("attempts", F.lit(0))
    same = lambda known: F.expr(" and ".join(f"n.{c} <=> {known}.{c}" for c in ALERT_KEY))
    new = new.alias("n").join(open_.alias("o"), same("o"), "left_anti").join(closed.alias("c"), same("c"), "left_anti")
    queue = open_.unionByName(new.select(*open_.columns))
    oldest = queue.orderBy("created_at", *ALERT_KEY).limit(batch).select(*ALERT_KEY).withColumn("_tried", F.lit(True))
    at = queue.alias("n").join(oldest.alias("t"), same("t"), "left").select("n.*", F.col("_tried").isNotNull().alias("_tried"))
    ok = F.col("_tried") & F.coalesce(F.lit(True) if delivered is None else delivered, F.lit(False))
    failed = F.col("_tried") & ~F.col("_ok")
    at = at.withColumn("_ok", ok).withColumns({
        "attempts": F.col("attempts") + F.col("_tried").cast("int"),
        "sent_at": F.when(F.col("_ok"), F.current_timestamp()),
        "error": F.when(failed, "delivery failed").when(~F.col("_ok"), F.col("error")),
        "status": F.when(F.col("_ok"), "sent").when(failed & (F.col("attempts") + 1 >= max_attempts), "error").otherwise("pending")})
    at = cut_lineage(at.select(*open_.columns))
    at.where("status <> 'pending'").write.mode("overwrite").parquet(f"{queue_dir}/closed/stream={stream}/batch={batch_id}")
    table = f"{queue_dir}/open"
    commit.publish(spark, table, commit.write_version(at.where("status = 'pending'"), table, tag=f"{stream}.{batch_id}"))
    commit.vacuum(spark, table)
    return True


def alert_queue_stream(spark: SparkSession, drift_dir: str, queue_dir: str, checkpoint: str, batch: int = 50, max_attempts: int = 3,
                       delivered: Column | None = None, max_files_per_trigger: int | None = None):
    """S2 with J8: drift rows -> alerts -> the kept queue, one drain a micro-batch (``queue_batch``).  Repeated and late
    rows are told by the queue itself, so no watermark bounds how late they may come."""
    reader = spark.readStream.schema(DRIFT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"  # batch numbers are those of a checkpoint
    q = reader.parquet(drift_dir).writeStream \
        .foreachBatch(lambda rows, i: queue_batch(rows, i, queue_dir, stream, batch, max_attempts, delivered) and None) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
