"""S1 on a tiny request set: refused rows, routing by payment signals, scores in range."""

import os
import tempfile

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators import features as fe
from riskloom.operators import models as MD
from riskloom.streaming import streams as ST


def test_score_stream_routes_and_refuses(spark):
    feats = ["loan_to_income", "credit_score_norm", "dti_ratio_clipped", "purpose_target_enc"]
    hist_feats = feats + ["avg_days_overdue_90d"]
    train = spark.range(400).select(
        (F.col("id") % 7 / 10.0).alias("loan_to_income"), (F.col("id") % 11 / 11.0).alias("credit_score_norm"),
        (F.col("id") % 50).cast("double").alias("dti_ratio_clipped"), F.lit(0.2).alias("purpose_target_enc"),
        (F.col("id") % 5).cast("double").alias("avg_days_overdue_90d"), ((F.col("id") % 3) == 0).cast("int").alias("y"),
        F.lit(1.0).alias("weight"))
    bundles = {"with_history": ("logistic", MD.fit(train, "logistic", hist_feats), hist_feats, fe.medians(train, hist_feats)),
               "cold_start": ("logistic", MD.fit(train, "logistic", feats), feats, fe.medians(train, feats))}
    cats = spark.createDataFrame([("car", "RENT", True)] * 12 + [("car", "OWN", False)] * 8,
                                 "purpose string, home_ownership string, is_default boolean")
    enc, mean = fe.target_fit(cats)
    base = dict(loan_amount=1000.0, income=5000.0, loan_term=36, interest_rate=10.0, employment_years=3.0, credit_score=700.0,
                dti_ratio=20.0, num_open_accounts=2, num_delinquencies=0, total_credit_limit=4000.0, home_ownership="rent",
                purpose=" Car ")
    rows = [dict(base, application_id=1), dict(base, application_id=2, avg_days_overdue_90d=3.0),
            dict(base, application_id=3, credit_score=1500.0)]
    full = [{f.name: r.get(f.name) for f in ST.REQUEST_SCHEMA.fields} for r in rows]
    d = tempfile.mkdtemp(prefix="riskloom-s1-")
    spark.createDataFrame(full, ST.REQUEST_SCHEMA).write.parquet(os.path.join(d, "in"))
    ST.score_stream(spark, os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ck"), bundles, enc, mean)
    scores = {r["application_id"]: r for r in spark.read.parquet(os.path.join(d, "out", "scores")).collect()}
    refused = {r["application_id"]: r["failed_rules"] for r in spark.read.parquet(os.path.join(d, "out", "refused")).collect()}
    assert set(scores) == {1, 2} and refused == {3: "credit_score in [300,850]"}
    assert scores[1]["model_version"] == "cold_start:logistic" and scores[2]["model_version"] == "with_history:logistic"
    assert all(0.0 <= r["pd_calibrated"] <= 1.0 and r["risk_bucket"] in K.RISK_BUCKET_LABELS for r in scores.values())
