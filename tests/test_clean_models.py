"""Vendor cleaning, fixed-value rules and model bundle round trip."""

import datetime as dt

from pyspark.sql import functions as F

from riskloom.functions.expr import risk_bucket
from riskloom import constants as K
from riskloom.operators import clean, features


def test_vendor_rows(spark):
    rows = [(10000, 50000, "36 months", "12.5%", "5 years", "rent", "Debt_Consolidation", 12.3, 690, 694, 5, 0, 1000,
             "Jan-2022", "Charged Off", 1),
            (20000, 80000, "60 months", "9%", "10+ years", "OWN", "other", 20.1, 720, 724, 8, 1, 2000, "Jun-2023", "Fully Paid", 2)]
    schema = ("loan_amnt long, annual_inc long, term string, int_rate string, emp_length string, home_ownership string, "
              "purpose string, dti double, fico_range_low long, fico_range_high long, open_acc long, delinq_2yrs long, "
              "revol_bal long, issue_d string, loan_status string, member_id long")
    out = clean.applications(spark.createDataFrame(rows, schema)).orderBy("client_id").collect()
    assert [r["is_default"] for r in out] == [True, False]
    assert out[0]["loan_term"] == 36 and out[1]["loan_term"] == 60
    assert out[0]["home_ownership"] == "RENT" and out[0]["purpose"] == "debt_consolidation"
    assert out[0]["credit_score"] == 692.0 and out[1]["employment_years"] == 10.0
    assert out[0]["application_date"] == dt.date(2022, 1, 1) and out[0]["interest_rate"] == 12.5
    assert out[0]["total_credit_limit"] == 20000.0 and out[0]["num_inquiries_6m"] == 0


def test_footer_and_aliases(spark):
    df = spark.createDataFrame([("1", "100"), ("Total amount funded", "5"), (None, "7")], "id string, loan_amnt string")
    assert clean.drop_footer(df).count() == 2
    plan = clean.rename_plan([" LOAN_AMNT", "funded_amnt", "member_id"])
    assert plan == [(" LOAN_AMNT", "loan_amount"), ("member_id", "client_id")]


def test_risk_bucket_cases(spark):
    df = spark.createDataFrame([(0.01,), (0.10,), (0.20,), (0.50,)], "p double")
    got = [r[0] for r in df.select(risk_bucket(F.col("p"), K.RISK_BUCKET_BOUNDS, K.RISK_BUCKET_LABELS)).collect()]
    assert got == ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]


def test_bundle_round_trip_and_probabilities(spark, tmp_path):
    import numpy as np
    from riskloom.operators import models as MD
    rng = np.random.default_rng(42)
    X = rng.normal(size=(500, 3))
    y = (rng.random(500) < 0.2).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *map(float, X[i]), 1.0) for i in range(500)],
                               "application_id long, y int, a double, b double, c double, weight double")
    m = MD.fit(df, "logistic", ["a", "b", "c"])
    s1 = {r["application_id"]: r["pd_score"] for r in MD.score(m, df).collect()}
    assert all(0.0 <= v <= 1.0 for v in s1.values())
    path = str(tmp_path / "bundle")
    MD.save_bundle(path, m, ["a", "b", "c"], kind="logistic")
    b = MD.load_bundle(spark, path)
    s2 = {r["application_id"]: r["pd_score"] for r in MD.score(b["model"], df).collect()}
    assert s1 == s2 and b["features"] == ["a", "b", "c"]


def test_model_dataset_is_written_once(spark, small_dir, monkeypatch):
    """Split, label and weight are expressions over one written table (beside it: the snapshot's inputs)."""
    from riskloom.plans import q_models

    cut, names = q_models.cut_lineage, []
    monkeypatch.setattr(q_models, "cut_lineage", lambda df: names.append(df.columns) or cut(df))
    d = q_models.model_dataset(spark, small_dir)
    assert len(names) == 1 and {"segment", "is_default"} <= set(names[0])
    w = {(r.y, r.weight) for r in d.select("y", "weight").distinct().collect()}
    train = d.where("split = 'train'").agg(F.sum("y").alias("pos"), F.count("y").alias("n")).first()
    assert w == {(0, 1.0), (1, (train.n - train.pos) / train.pos)}


def test_fill_looks_nothing_up_by_name(spark):
    df = spark.createDataFrame([(1, None, None, 2.0), (2, 5.0, None, None)], "id int, a double, b double, c double")
    med = spark.createDataFrame([("a", 1.5), ("b", None), ("other", 9.0)], "feature string, median double")
    out = features.fill_with(df, med, ["a", "b", "c"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1.5, 0.0, 2.0), (2, 5.0, 0.0, 0.0)]
    assert "map_from_entries" not in out._jdf.queryExecution().optimizedPlan().toString()
