"""Model expressions against the fitted models and a plain walk; permutation importance; searched training; date cuts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ensembles as EN
from riskloom.operators import features as fe
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.plans import q_models as QM

FEATS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(500, 4)).round(2)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + r.normal(size=500) * 0.6 > 0.4).astype(int)
    data = [(i, *map(float, v), int(k), 1.0, "train" if i < 300 else "val" if i < 420 else "test", f"{2000 + i // 100}-01-{1 + i % 28:02d}")
            for i, (v, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "application_id long, a double, b double, c double, d double, y int, weight double, split string, day string")
    df = df.withColumn("c", F.when(F.col("application_id") % 17 != 0, F.col("c")).otherwise(F.lit(float("nan"))))
    return df.withColumn("application_date", F.to_date("day")).drop("day").cache()


@pytest.fixture(scope="module")
def models(rows):
    train = rows.where("split = 'train' and not isnan(c)")  # learners refuse missing values; trees score them
    return {k: MD.fit(train, k, FEATS, {"n_estimators": 7, "max_depth": 4}) for k in ("logistic", "rf", "gbt")}


@pytest.mark.parametrize("kind", ["logistic", "rf", "gbt"])
def test_scorer_equals_the_model(rows, models, kind):
    s = MD.score(models[kind], rows if kind != "logistic" else rows.where("not isnan(c)"))
    gap = s.select(F.max(F.abs(F.col("pd_score") - EN.scorer(models[kind])(EN.feature_array(FEATS))))).first()[0]
    assert gap < 1e-12


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_contributions_equal_a_plain_walk(rows, models, kind):
    f = EN.Forest(models[kind].stages[-1])
    got = EN.tree_contributions(models[kind], MD.score(models[kind], rows), FEATS, keep=["pd_score", *FEATS]).collect()
    for r in got:
        x, sums = [r[c] for c in FEATS], [0.0] * 4
        for root in f.roots:
            n = root
            while f.left[n] >= 0:
                to = f.left[n] if x[f.feature[n]] <= f.threshold[n] else f.right[n]
                sums[f.feature[n]] += f.value[to] - f.value[n]
                n = to
        assert [c["feature"] for c in r.contributions] == FEATS
        assert [c["value"] for c in r.contributions] == pytest.approx(sums, abs=1e-12)
        total = r.base + sum(sums)
        assert r.pd_score == pytest.approx(1 / (1 + np.exp(-2 * total)) if kind == "gbt" else total, abs=1e-9)


@pytest.mark.parametrize("kind", ["logistic", "gbt"])
def test_permutation_importance_by_scoring_each_column(spark, rows, models, kind):
    val = rows.where("split = 'val' and not isnan(c)")
    got = {r.feature: (r.importance, r.std) for r in MD.permutation_importance(models[kind], val, FEATS, repeats=2, seed=5).collect()}
    pdf = val.toPandas().sort_values("application_id")
    base = M.binary(MD.score(models[kind], val)).first()["auc_pr"]
    for c in FEATS:
        drops = []
        for r in range(2):
            order = [x[0] for x in val.orderBy(F.xxhash64("application_id", F.lit(5 + r)), "application_id").select("application_id").collect()]
            p = pdf.copy()
            p[c] = pdf.set_index("application_id").loc[order, c].to_numpy()
            drops.append(base - M.binary(MD.score(models[kind], spark.createDataFrame(p))).first()["auc_pr"])
        assert got[c] == pytest.approx((np.mean(drops), np.std(drops)), abs=1e-9)


def test_search_before_the_fit(rows):
    best, model, table = MD.train_segment(rows.where("not isnan(c)"), FEATS, kinds=("logistic", "gbt"), search_trials=2, tree_share=0.01)
    aucs = {r.model: r.auc_roc for r in table.where("split = 'val'").collect()}
    assert best == max(aucs, key=lambda k: (aucs[k], k)) and set(aucs) == {"logistic", "gbt"}


def test_empty_parts_are_cut_by_quantiles(rows):
    d = rows.drop("split")
    given = MD.with_split(d, "2001-12-31", "2002-12-31").groupBy("split").count().collect()
    assert {r[0]: r[1] for r in given} == {"train": 200, "val": 100, "test": 200}
    for t1, t2 in (("1990-01-01", "1991-01-01"), ("2003-12-31", "2003-12-31")):
        n = {r[0]: r[1] for r in MD.with_split(d, t1, t2).groupBy("split").count().collect()}
        assert n["train"] >= 300 and n["val"] > 0


def test_bundle_tables_are_optional_and_damage_is_an_error(spark, rows, models, tmp_path):
    p = str(tmp_path / "b")
    MD.save_bundle(p, models["rf"], FEATS, kind="rf")
    b = MD.load_bundle(spark, p)
    assert b["medians"] is None and b["features"] == FEATS and b["kind"] == "rf"
    (tmp_path / "b" / "metrics").mkdir()
    (tmp_path / "b" / "metrics" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        MD.load_bundle(spark, p)


@pytest.mark.parametrize("kind", ["logistic", "rf", "gbt"])
def test_a_stored_vector_is_read_instead_of_assembled(rows, kind):
    whole = rows.where("not isnan(c)").withColumn("segment", F.lit("s")).drop("weight")
    seg = QM._seg(whole, "s", FEATS)
    assert "features" in seg.columns and not set(FEATS) & set(seg.columns)  # so no pass can assemble it again
    assert MD.assembled(seg, FEATS) is seg
    beside = QM._seg(whole, "s", FEATS, raw=FEATS)
    p = {"n_estimators": 3, "max_depth": 3}
    a = MD.fit(seg.where("split = 'train'").coalesce(1), kind, FEATS, p)
    b = MD.fit(beside.drop("features").where("split = 'train'").coalesce(1), kind, FEATS, p)
    read, made = (MD.score(m, d) for m, d in ((a, seg), (b, beside.drop("features"))))
    assert "features" in read.columns and "features" not in made.columns
    scores = lambda d: dict(d.select("application_id", "pd_score").collect())
    assert scores(read) == pytest.approx(scores(made), abs=1e-12)


def test_a_vector_of_other_features_is_not_taken(rows):
    part = MD.assembled(rows, FEATS[:2])
    assert MD.assembled(part, FEATS[:2]) is part
    with pytest.raises(Exception, match="features"):
        MD.assembled(part, FEATS[::-1][:2]).count()


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration_of_a_frame_that_holds_its_vector(rows, models, method):
    val = rows.where("split = 'val' and not isnan(c)")
    plain, held = MD.score(models["logistic"], val), MD.score(models["logistic"], MD.assembled(val, FEATS))
    assert "features" in held.columns and "features" not in plain.columns
    values = lambda d: dict(MD.apply_calibration(MD.calibrate(d, method), d).select("application_id", "pd_calibrated").collect())
    got = values(held)
    assert got == pytest.approx(values(plain), abs=1e-9) and len(set(got.values())) > 2
    assert set(MD.apply_calibration(MD.calibrate(held, method), held).columns) == {*held.columns, "pd_calibrated"}


@pytest.fixture
def fits(rows, monkeypatch):
    """The model queries on ``rows`` without fitting: (kind, parameters, train rows) of every fit."""
    seen = []
    monkeypatch.setattr(QM, "model_dataset", lambda *_: rows.where("not isnan(c)").withColumn("segment", F.lit("s")))
    monkeypatch.setattr(QM, "SEGMENTS", (("s", FEATS),))
    monkeypatch.setattr(MD, "fit", lambda df, kind, features, params=None, **_: seen.append((kind, params, df)))
    monkeypatch.setattr(MD, "score", lambda m, df: df.withColumn("pd_score", F.lit(0.5)))
    return seen


def test_hyper_search_tries_the_whole_spaces(spark, fits, monkeypatch):
    monkeypatch.setattr(MD, "auc_of", lambda df: 0.5)
    got = QM.q_hyper_search(spark, "").groupBy("model").count().collect()
    assert {r["model"]: r["count"] for r in got} == {"logistic": 30, "rf": 30, "gbt": 30}
    for kind in ("rf", "gbt"):
        trees = [p["n_estimators"] for k, p, _ in fits if k == kind]
        assert len(trees) == 30 and 200 <= min(trees) < 300 and 700 < max(trees) <= 800


def test_side_by_side_trials_keep_their_order(spark, rows):
    train = rows.where("split = 'train' and not isnan(c)").cache()
    _, _, found = MD.search(train, rows.where("split = 'val' and not isnan(c)"), "logistic", FEATS, 5)
    assert [p for p, _ in found] == MD.draw_params("logistic", 5)
    alone = [MD.auc_of(MD.score(MD.fit(train, "logistic", FEATS, p), rows.where("split = 'val' and not isnan(c)"))) for p in MD.draw_params("logistic", 5)[:2]]
    assert [a for _, a in found[:2]] == pytest.approx(alone, abs=1e-9)


def test_train_searched_fits_the_best_of_whole_searches(spark, fits, monkeypatch):
    monkeypatch.setattr(MD, "auc_of", lambda df: 0.5)
    got = QM.q_train_searched(spark, "").collect()
    assert {(r.model, r.split) for r in got} == {(k, s) for k in ("logistic", "rf", "gbt") for s in ("val", "test")}
    for kind in ("logistic", "rf", "gbt"):
        tried = [p for k, p, _ in fits if k == kind]
        assert len(tried) == 11 and tried[-1] in tried[:-1]  # ten trials and the fit of the best
        assert kind == "logistic" or all(200 <= p["n_estimators"] <= 800 for p in tried)


def test_curve_sizes_reach_all_rows():
    assert QM.curve_sizes(4100) == [500, 1000, 2000, 4000, 4100]
    assert QM.curve_sizes(9_000_000)[-2:] == [8_192_000, 9_000_000] and QM.curve_sizes(500) == [500] and QM.curve_sizes(1000) == [500, 1000]


def test_learning_curve_trains_on_all_rows(spark, fits, monkeypatch):
    monkeypatch.setattr(QM, "curve_sizes", lambda n, whole=QM.curve_sizes: whole(n, 60))
    got = sorted(r["size"] for r in QM.q_learning_curve(spark, "").collect())
    n = fits[0][2].count()
    assert got == [60, 120, 240, n] and n > 240
    assert sorted(df.count() for _, _, df in fits[3:]) == got  # after the three candidates
    assert {p["n_estimators"] for k, p, _ in fits if k != "logistic"} == {200}


def test_learning_curve_of_every_size(spark, rows):
    d = MD.assembled(rows.where("not isnan(c)"), FEATS)
    got = {r["size"]: r for r in MD.learning_curve(d, FEATS, [240, 60], "logistic").collect()}
    train = MD.sampling.nested_sizes(d.where("split = 'train'"), [60, 240])
    for s in (60, 240):
        m = MD.fit(train.where(F.col("rank") < s), "logistic", FEATS)
        assert got[s].val_auc == pytest.approx(MD.auc_of(MD.score(m, d.where("split = 'val'"))), abs=1e-9) and got[s].n_val > 100


def test_every_bundle_holds_all_its_parts(spark, fits, monkeypatch):
    kept = []
    monkeypatch.setattr(QM.fixtures, "load", lambda *_: type("Fx", (), {"applications": spark.createDataFrame(
        [(i, i % 3 == 0, f"p{i % 2}", "h", dt.date(1999, 1, 1)) for i in range(300)],
        "application_id long, is_default boolean, purpose string, home_ownership string, application_date date")}))
    monkeypatch.setattr(QM, "model_dataset", lambda *_, **k: fits_rows(spark))
    monkeypatch.setattr(MD, "save_bundle", lambda path, m, feats, med=None, enc=None, metrics=None, kind="", mean=None: kept.append(
        (kind, med, enc, metrics, mean)))
    monkeypatch.setattr(MD, "load_bundle", lambda spark, path: {"features": FEATS, "kind": kept[-1][0], "model": None})
    monkeypatch.setattr(MD, "score_bundle", lambda b, df: df.withColumn("pd_score", F.lit(0.5)))
    got = QM.q_model_bundle(spark, "").collect()
    assert [r.model for r in got] == ["logistic", "rf", "gbt"] and {r.max_abs_diff for r in got} == {0.0}
    for kind, med, enc, metrics, mean in kept:
        assert {r.feature for r in med.collect()} == set(FEATS) and enc.where("column = 'purpose'").count() == 2
        assert metrics.count() == 1 and mean == pytest.approx(1 / 3)


def fits_rows(spark):
    return spark.createDataFrame([(i, *[float(i % k) for k in (2, 3, 5, 7)], i % 2, "train" if i < 50 else "val", "s", "p0", "h", dt.date(1999, 1, 1))
                                  for i in range(80)],
                                 "application_id long, a double, b double, c double, d double, y int, split string, segment string, "
                                 "purpose string, home_ownership string, application_date date")


def test_a_bundle_alone_scores_raw_rows(spark, tmp_path):
    r = np.random.default_rng(1)
    data = [(i, float(r.normal()), f"p{i % 3}", int(r.random() < 0.2 + 0.2 * (i % 3))) for i in range(300)]
    df = spark.createDataFrame(data, "application_id long, a double, purpose string, y int")
    enc, mean = fe.target_fit(df, ["purpose"], "y", min_samples=1)
    coded = fe.target_apply(df, enc, mean, ["purpose"])
    feats, g = ["a", "purpose_target_enc"], mean.first()["global_mean"]
    m = MD.fit(coded, "rf", feats, {"n_estimators": 5}, weight=None)
    p = str(tmp_path / "b")
    MD.save_bundle(p, m, feats, fe.medians(coded, feats), enc, kind="rf", global_mean=g)
    b = MD.load_bundle(spark, p)
    scores = lambda d: dict(d.select("application_id", "pd_score").collect())
    assert scores(MD.score_bundle(b, df)) == scores(MD.score(m, coded))
    # an unseen category has the mean, a missing feature its median
    odd = spark.createDataFrame([(1, None, "new"), (2, float("nan"), None)], "application_id long, a double, purpose string")
    med = coded.agg(F.median("a")).first()[0]
    plain = spark.createDataFrame([(1, med, g), (2, med, g)], "application_id long, a double, purpose_target_enc double")
    assert scores(MD.score_bundle(b, odd)) == scores(MD.score_bundle(b, odd.drop("a"))) == scores(MD.score(m, plain))


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_mean_contributions_evaluate_a_row_once(rows, models, kind):
    got = EN.tree_contributions(models[kind], MD.score(models[kind], rows), FEATS, keep=["pd_score"])
    per_row = [{c["feature"]: c["value"] for c in r.contributions} for r in got.collect()]
    out = EN.mean_contributions(got, FEATS, F.lit(2.0) * F.col("pd_score"))
    for r in out.collect():
        assert r.mean_abs == pytest.approx(np.mean([abs(p[r.feature]) for p in per_row]), abs=1e-12)
        assert r.max_gap == pytest.approx(2 * max(x.pd_score for x in got.collect()), abs=1e-12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence") + plan.count("[0,1,2,3]") <= 1 and "size(" not in plan  # no filter that evaluates them again
    assert EN.mean_contributions(got.where("application_id < 0"), FEATS, F.col("pd_score")).count() == 0


def test_permutations_delete_what_they_write(spark, rows, models, monkeypatch):
    from pathlib import Path

    from riskloom import session
    val, held, write = rows.where("split = 'val' and not isnan(c)"), [], session.written
    before = set(session._WRITTEN)
    monkeypatch.setattr(session, "written", lambda path: held.append(sum(Path(p).exists() for p in set(session._WRITTEN) - before)) or write(path))
    out = MD.permutation_importance(models["logistic"], val, FEATS, repeats=6)
    assert len(held) == 11 and max(held) <= 4  # two tables of all repeats, three of every two
    assert set(session._WRITTEN) == before and out.count() == 4


def test_scratch_keeps_what_is_taken_out(spark):
    from pathlib import Path

    from riskloom.session import materialise, scratch
    paths = []
    with scratch(spark) as outer:
        a = materialise(spark.range(3), "a")
        with scratch(spark) as inner:
            materialise(spark.range(3), "b")
            b = materialise(spark.range(4), "c")
            paths += [*outer, *inner]
            inner.pop()
        assert a.count() == 3 and b.count() == 4 and len(paths) == 3
    assert [Path(p).exists() for p in paths] == [False, False, True]
