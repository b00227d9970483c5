"""Queries for sources and sinks.

Writes go under the session's shared checkpoint folder (``spark.checkpoint.dir``),
one fresh sub-folder per call.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.expr import round_doubles
from ..operators import sampling as S
from ..session import checkpoint_dir
from ..sources import fixtures, io
from .catalog import register
from .q_metrics import _binary, _binary_sql
from .oracle_views import with_ctes
from .q_clean import PARSED_SQL
from .q_features import SNAPSHOT_SQL, TE_CUTOFF, features_snapshot_df
from . import oracle_features as OF
from .q_reports import PRED_SQL, predictions

T1, T2 = "1998-12-31", "1999-12-31"


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


RAW_COLS = ["id", "member_id", "loan_amnt", "term", "int_rate", "annual_inc", "emp_length", "home_ownership", "purpose",
            "grade", "fico_range_low", "fico_range_high", "issue_d", "loan_status"]


@register("csv_scan", with_ctes(["raw_loans_v"], [], "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_COLS)
                                + " FROM raw_loans_v"))
def q_csv_scan(spark, sf_dir):
    """A1: the vendor rows written as CSV and scanned back as all-string columns
    (an empty field reads as missing, as in the vendor loader)."""
    raw = fixtures.load(spark, sf_dir).raw_loans
    path = _scratch(spark, "vendor-csv")
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return io.csv_scan(spark, path).select(*RAW_COLS)


@register("load_replace", with_ctes(["raw_loans_v"], [("parsed", PARSED_SQL)], """
SELECT count(*) AS rows_loaded FROM parsed WHERE loan_amount IS NOT NULL AND income IS NOT NULL
  AND application_date IS NOT NULL AND loan_amount > 0 AND income > 0"""))
def q_load_replace(spark, sf_dir):
    """A3: clean and load the vendor rows (probe before replace); the loaded row count."""
    raw = fixtures.load(spark, sf_dir).raw_loans
    n = io.load_replace(spark, raw, _scratch(spark, "raw-applications"))
    return spark.createDataFrame([(n,)], "rows_loaded long")


@register("scan_applications", with_ctes(["applications_v"], [], f"""
SELECT application_id, application_date, round(loan_amount, 4) AS loan_amount FROM applications_v
WHERE application_date <= DATE '{T1}' ORDER BY application_date, application_id LIMIT 1000"""))
def q_scan_applications(spark, sf_dir):
    """A4: loans up to a date in (date, id) order, first 1,000 (the optional limit is the feature)."""
    a = fixtures.load(spark, sf_dir).applications
    out = io.applications(a, T1, 1000)
    return out.select("application_id", "application_date", F.round("loan_amount", 4).alias("loan_amount"))


@register("scan_applications_all", with_ctes(["applications_v"], [], f"""
SELECT application_id, application_date, round(loan_amount, 4) AS loan_amount FROM applications_v
WHERE application_date <= DATE '{T1}' ORDER BY application_date, application_id"""))
def q_scan_applications_all(spark, sf_dir):
    """A4: all loans up to a date, in (date, id) order."""
    out = io.applications(fixtures.load(spark, sf_dir).applications, T1)
    return out.select("application_id", "application_date", F.round("loan_amount", 4).alias("loan_amount"))


@register("scan_payments", with_ctes(["applications_v", "payments_v"], [], """
SELECT application_id, payment_date, round(amount_paid, 4) AS amount_paid, days_overdue FROM payments_v
WHERE application_id IN (SELECT application_id FROM applications_v WHERE year(application_date) = 1998)"""))
def q_scan_payments(spark, sf_dir):
    """A5: payments of an id set (the loans of 1998) by left semi join."""
    fx = fixtures.load(spark, sf_dir)
    # a date range (pushed to the scan) rather than year() (not pushable)
    ids = fx.applications.where(F.col("application_date").between(F.to_date(F.lit("1998-01-01")), F.to_date(F.lit("1998-12-31")))) \
        .select("application_id")
    p = io.payments(fx.payments, ids)
    return p.select("application_id", "payment_date", F.round("amount_paid", 4).alias("amount_paid"), "days_overdue")


@register("feature_dataset", SNAPSHOT_SQL.replace(SNAPSHOT_SQL[SNAPSHOT_SQL.rindex("\nSELECT"):], "") + f"""
SELECT s.application_id, a.application_date, a.is_default, round(s.loan_to_income, 6) AS loan_to_income,
  round(s.avg_days_overdue_90d, 6) AS avg_days_overdue_90d,
  CASE WHEN a.application_date <= DATE '{T1}' THEN 'train' WHEN a.application_date <= DATE '{T2}' THEN 'val' ELSE 'test' END AS split
FROM snapshot s JOIN applications_v a ON a.application_id = s.application_id WHERE s.feature_version = 'v1.0'""")
def q_feature_dataset(spark, sf_dir):
    """A6 (+ D1 version filter, H1): snapshot of version v1.0 with label, date and split."""
    fx = fixtures.load(spark, sf_dir)
    d = io.feature_dataset(features_snapshot_df(spark, sf_dir), fx.applications, T1, T2)
    return round_doubles(d.select("application_id", "application_date", "is_default", "loan_to_income",
                                  "avg_days_overdue_90d", "split"))


@register("snapshot_write", with_ctes(["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF),
                                      "SELECT feature_version, count(*) AS n, round(sum(loan_to_income), 4) AS sum_lti "
                                      "FROM snapshot GROUP BY feature_version"))
def q_snapshot_write(spark, sf_dir):
    """The snapshot written partitioned by version and read back (partition-pruned scan)."""
    path = _scratch(spark, "snapshot")
    io.snapshot_write(features_snapshot_df(spark, sf_dir), path)
    back = io.read_table(spark, path).where(F.col("feature_version") == "v1.0")
    return back.groupBy("feature_version").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("loan_to_income"), 4).alias("sum_lti"))


@register("predictions_replace", with_ctes(["scored_v"], [("preds", PRED_SQL), ("existing", f"""
SELECT prediction_id, application_id, 'online:' || split_part(model_version, ':', 2) AS model_version, pd_score, pd_calibrated,
  risk_bucket, predicted_at FROM preds WHERE predicted_at <= TIMESTAMP '{T1} 00:00:00'
UNION ALL SELECT prediction_id, application_id, 'batch:old:logistic', pd_score, pd_calibrated, risk_bucket, predicted_at FROM preds""")],
    """SELECT model_version, count(*) AS n, round(avg(pd_calibrated), 6) AS mean_pd FROM (
  SELECT * FROM existing WHERE model_version NOT LIKE 'batch:%' UNION ALL SELECT * FROM preds) t GROUP BY model_version"""))
def q_predictions_replace(spark, sf_dir):
    """On a stored table, previous batch rows replaced by the new batch, online rows kept (counts per version)."""
    p = predictions(spark, sf_dir)
    online = p.where(F.col("predicted_at") <= F.lit(f"{T1} 00:00:00").cast("timestamp")) \
        .withColumn("model_version", F.concat(F.lit("online:"), F.split("model_version", ":")[1]))
    old = p.withColumn("model_version", F.lit("batch:old:logistic"))
    path = _scratch(spark, "predictions")
    io.replace_table(online.unionByName(old), path)
    io.predictions_commit(spark, path, p)
    out = io.read_table(spark, path)
    return round_doubles(out.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"), F.avg("pd_calibrated").alias("mean_pd")))


N_RECENT = 5000


@register("export_recent_subset", with_ctes(["raw_loans_v"], [
    ("dated", "SELECT id, coalesce(CAST(try_strptime(trim(issue_d), '%b-%Y') AS DATE), CAST(try_strptime(trim(issue_d), '%Y-%m-%d') AS DATE)) AS d "
              "FROM raw_loans_v"),
    ("recent", f"SELECT * FROM dated WHERE d IS NOT NULL ORDER BY d DESC, id DESC LIMIT {N_RECENT}"),
    ("cuts", "SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(CAST(d - DATE '1970-01-01' AS DOUBLE), 0.70)) AS INT) AS t1, "
             "DATE '1970-01-01' + CAST(floor(quantile_cont(CAST(d - DATE '1970-01-01' AS DOUBLE), 0.85)) AS INT) AS t2 FROM recent"),
], "SELECT id, d AS issue_date, CASE WHEN d <= t1 THEN 'train' WHEN d <= t2 THEN 'val' ELSE 'test' END AS split FROM recent, cuts"))
def q_export_recent(spark, sf_dir):
    """A10 (+ H2): newest 5,000 vendor rows by issue date and the 70/85% date cuts over them."""
    raw = fixtures.load(spark, sf_dir).raw_loans
    recent = io.export_recent_subset(raw, N_RECENT).select("id", F.col("_issue_date").alias("issue_date"))
    cuts = S.auto_cuts(recent, date_col="issue_date")
    c = cuts.select(F.struct("train_end", "val_end").alias("c")).scalar()
    r = recent.withColumn("_c", c)
    return r.select("id", "issue_date", F.when(F.col("issue_date") <= F.col("_c.train_end"), "train")
                    .when(F.col("issue_date") <= F.col("_c.val_end"), "val").otherwise("test").alias("split"))


METRICS = ["n", "auc_roc", "gini", "auc_pr", "auc_pr_trapz", "brier", "log_loss", "ks"]


@register("metrics_export", _binary_sql(METRICS))
def q_metrics_export(spark, sf_dir):
    """The metrics table written as CSV with a header, read back and cast to its types."""
    m = _binary(spark, sf_dir, METRICS)
    path = _scratch(spark, "metrics-csv")
    io.metrics_export(m, path)
    return io.csv_scan(spark, path).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in m.schema.fields])
