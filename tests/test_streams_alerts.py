"""Alert formatting, the alert queue drain and the two streaming jobs on tiny inputs."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators import drift as D
from riskloom.streaming import streams as ST


def drift_rows(spark):
    rows = [("a", dt.date(2020, 1, 1), 0.2, 0.3, 0.01, True, False, "2019-01-01/2019-06-30", "2019-10-01/2019-12-31"),
            ("b", dt.date(2020, 1, 1), 0.12, 0.1, 0.2, False, True, "2019-01-01/2019-06-30", "2019-10-01/2019-12-31"),
            ("c", dt.date(2020, 1, 1), 0.01, 0.05, 0.9, False, False, "2019-01-01/2019-06-30", "2019-10-01/2019-12-31")]
    return spark.createDataFrame(rows, "feature_name string, check_date date, psi_value double, ks_statistic double, "
                                       "ks_pvalue double, is_drifted boolean, is_warning boolean, reference_period string, "
                                       "current_period string")


def test_alert_messages(spark):
    a = {r["feature_name"]: r for r in D.alerts(drift_rows(spark)).collect()}
    assert set(a) == {"a", "b"}
    assert a["a"]["message"].startswith(K.DRIFT_ALERT.split("%s")[0] + "a\nPSI: 0.2000 (threshold: 0.15)")
    assert "Current: 2019-10-01 → 2019-12-31\nReference: 2019-01-01 → 2019-06-30" in a["a"]["message"]
    assert a["b"]["message"] == "⚠️ Feature drift warning\nFeature: b\nPSI: 0.1200 (warning: 0.1)"
    assert all(r["status"] == "pending" for r in a.values())


def test_drain_oldest_first(spark):
    q = spark.createDataFrame([(i, f"m{i}", "pending", dt.datetime(2020, 1, 1, 0, i)) for i in range(5)]
                              + [(9, "old", "sent", dt.datetime(2019, 1, 1))],
                              "alert_id long, message string, status string, created_at timestamp") \
        .withColumn("sent_at", F.lit(None).cast("timestamp")).withColumn("error", F.lit(None).cast("string"))
    out = {r["alert_id"]: r["status"] for r in D.drain(q, "2020-02-01 00:00:00", batch=3).collect()}
    assert out == {0: "sent", 1: "sent", 2: "sent", 3: "pending", 4: "pending", 9: "sent"}


def test_dedup_stream(spark):
    base = tempfile.mkdtemp(prefix="riskloom-s2-")
    rows = drift_rows(spark).withColumn("checked_at", F.col("check_date").cast("timestamp"))
    rows.write.parquet(os.path.join(base, "in", "run=1"))
    rows.write.parquet(os.path.join(base, "in", "run=2"))
    ST.dedup_stream(spark, os.path.join(base, "in", "*"), os.path.join(base, "out"), os.path.join(base, "ck"))
    assert spark.read.schema(ST.DRIFT_SCHEMA).parquet(os.path.join(base, "out")).count() == 3
    ST.alert_stream(spark, os.path.join(base, "in", "*"), os.path.join(base, "alerts"), os.path.join(base, "ck2"))
    assert spark.read.parquet(os.path.join(base, "alerts")).count() == 2


def queue_rows(spark, *rows):
    """Drift rows (feature, day of January 2020, checked on that day or on the one given, drifted)."""
    period = "2019-01-01/2019-06-30"
    return spark.createDataFrame([(f, dt.date(2020, 1, d), 0.2, 0.3, 0.01, drifted, not drifted, period, period, dt.datetime(2020, 1, on))
                                  for f, d, on, drifted in rows], ST.DRIFT_SCHEMA)


def queue_state(spark, path):
    return {(r["feature_name"], r["check_date"].day): (r["status"], r["attempts"], r["error"]) for r in ST.read_alert_queue(spark, path).collect()}


def test_alert_queue_order_retries_and_errors(spark, tmp_path):
    q, sent, bad = str(tmp_path / "q"), ("sent", 1, None), "delivery failed"
    step = lambda i, *rows: ST.queue_batch(queue_rows(spark, *rows), i, q, batch=2, max_attempts=2, delivered=F.col("feature_name") != "x")
    assert queue_state(spark, q) == {}
    assert step(0, ("x", 2, 2, True), ("a", 3, 3, True), ("a", 3, 4, True), ("b", 4, 4, False))
    assert queue_state(spark, q) == {("x", 2): ("pending", 1, bad), ("a", 3): sent, ("b", 4): ("pending", 0, None)}
    # a late row goes before all others; a repeated one, sent or pending, is none
    assert step(1, ("c", 1, 9, True), ("a", 3, 9, True), ("b", 4, 9, True))
    assert queue_state(spark, q) == {("x", 2): ("error", 2, bad), ("a", 3): sent, ("b", 4): ("pending", 0, None), ("c", 1): sent}
    assert step(2) and queue_state(spark, q)["b", 4] == sent
    assert step(3, ("x", 2, 9, True)) and queue_state(spark, q)["x", 2] == ("error", 2, bad)
    assert ST.read_alert_queue(spark, q).where("status = 'sent' and sent_at is null").count() == 0


def test_alert_queue_restarted_batch(spark, tmp_path, monkeypatch):
    q = str(tmp_path / "q")
    rows = queue_rows(spark, ("a", 1, 1, True), ("b", 2, 2, True))
    assert ST.queue_batch(rows, 0, q, batch=1)
    before = queue_state(spark, q)
    assert not ST.queue_batch(rows, 0, q, batch=1) and queue_state(spark, q) == before  # committed: nothing is sent twice
    with monkeypatch.context() as m:  # stops after the closed alerts are written, before the commit
        m.setattr(ST.commit, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        try:
            ST.queue_batch(queue_rows(spark, ("c", 3, 3, True)), 1, q, batch=2)
        except RuntimeError:
            pass
    assert queue_state(spark, q) == before
    assert ST.queue_batch(queue_rows(spark, ("c", 3, 3, True)), 1, q, batch=2)
    assert queue_state(spark, q) == {k: ("sent", 1, None) for k in (("a", 1), ("b", 2), ("c", 3))}
    # another checkpoint counts its batches anew
    assert ST.queue_batch(queue_rows(spark, ("d", 4, 4, True)), 0, q, stream="1", batch=2) and len(queue_state(spark, q)) == 4


def test_alert_queue_stream_restarts(spark, tmp_path):
    src, q, ck = str(tmp_path / "in"), str(tmp_path / "q"), str(tmp_path / "ck")
    run = lambda: ST.alert_queue_stream(spark, src + "/*", q, ck, max_files_per_trigger=1)
    queue_rows(spark, ("a", 5, 5, True)).coalesce(1).write.parquet(src + "/run=1")
    run()
    queue_rows(spark, ("a", 5, 5, True), ("b", 1, 6, False)).coalesce(1).write.parquet(src + "/run=2")
    run()
    run()
    assert queue_state(spark, q) == {("a", 5): ("sent", 1, None), ("b", 1): ("sent", 1, None)}
