"""Model training, calibration, search, stacking, scoring, bundles and
explanations on Spark ML (K1-K17).

The boosting libraries of the original pipeline are replaced by Spark ML
learners: ``gbt`` (GBTClassifier), ``rf`` (RandomForestClassifier) and
``logistic`` (LogisticRegression).  All fitting runs as distributed Spark ML
jobs over the feature snapshot; only metric rows and hyper-parameter draws
live on the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions.expr import clip, risk_bucket
from ..session import cut_lineage, scratch
from . import metrics as M
from . import ensembles, orderstat, sampling

SEED = 42


# ----------------------------------------------------------------- K1, K2
def feature_matrix(features: Sequence[str], out: str = "features") -> VectorAssembler:
    """K1: the model's feature columns (cast to DOUBLE upstream) as one vector column."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with its feature vector (K1); a vector of just these features that it holds already is taken as it is, so a
    table that many passes read can keep the vector instead of assembling it in each of them."""
    if "features" in df.columns:
        attrs = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
        names = [a.get("name") for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]
        if names == list(features):
            return df
    return feature_matrix(features).transform(df)


def estimator(kind: str, params: dict | None = None, label: str = "y", weight: str | None = "weight",
              validation_col: str | None = None):
    """K2: one of the three candidate learners with class weights."""
    p = dict(params or {})
    common = dict(featuresCol="features", labelCol=label)
    if weight:
        common["weightCol"] = weight
    if kind == "gbt":
        extra = {"validationIndicatorCol": validation_col} if validation_col else {}
        return GBTClassifier(maxIter=int(p.get("n_estimators", 50)), maxDepth=int(p.get("max_depth", 4)),
                             stepSize=float(p.get("learning_rate", 0.1)), subsamplingRate=float(p.get("subsample", 1.0)),
                             featureSubsetStrategy=str(p.get("feature_subset", "all")), seed=SEED, **extra, **common)
    if kind == "rf":
        return RandomForestClassifier(numTrees=int(p.get("n_estimators", 50)), maxDepth=int(p.get("max_depth", 6)),
                                      subsamplingRate=float(p.get("subsample", 1.0)), seed=SEED, **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=int(p.get("max_iter", 100)), regParam=float(p.get("reg", 0.0)),
                                  elasticNetParam=float(p.get("l1_ratio", 0.0)), **common)
    raise ValueError(f"unknown model kind {kind}")


def fit(df: DataFrame, kind: str, features: Sequence[str], params: dict | None = None, label: str = "y",
        weight: str | None = "weight", validation_col: str | None = None) -> PipelineModel:
    """K2: assemble + learner as one Spark ML pipeline fitted on ``df``."""
    learner = estimator(kind, params, label, weight, validation_col).fit(assembled(df, features))
    return PipelineModel([feature_matrix(features), learner])


def score(model: PipelineModel, df: DataFrame, out: str = "pd_score") -> DataFrame:
    """Probability of default (class 1) as a DOUBLE column; model columns dropped, but for a vector that ``df`` holds."""
    first, learner = model.stages
    s = learner.transform(assembled(df, first.getInputCols()))
    s = s.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
    return s if "features" in df.columns else s.drop("features")


# fits that run side by side: a boosted tree is a chain of short jobs, which leave most cores idle.  A forest grows all its
# trees in the same jobs, and the driver holds it whole
AT_ONCE = {"gbt": 4, "logistic": 4, "rf": 1}


def side_by_side(one: Callable, items: Sequence, kind: str, spark) -> list:
    """``one`` of every item, in order, as many at a time as fits of ``kind`` may run."""
    with ThreadPoolExecutor(AT_ONCE[kind]) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), items))


def training_frame(dataset: DataFrame, features: Sequence[str], label: str = "is_default") -> DataFrame:
    """Label as 0/1 ``y``, features as DOUBLE, neg/pos weight column (F8) from the train rows."""
    d = dataset.select("*", F.col(label).cast("int").alias("y"), *[F.col(c).cast("double").alias(f"__{c}") for c in features])
    for c in features:
        d = d.drop(c).withColumnRenamed(f"__{c}", c)
    from .features import class_weight, with_weight
    return with_weight(d, class_weight(d.where(F.col("split") == "train")))


def auc_of(scored: DataFrame, y: str = "y", p: str = "pd_score") -> float | None:
    row = M.binary(scored, y, p).first()
    return None if row is None else row["auc_roc"]


# ----------------------------------------------------------------- K3, K5
SEARCH_SPACE = {
    "gbt": {"n_estimators": ("int", 200, 800), "learning_rate": ("log", 0.01, 0.2), "max_depth": ("int", 3, 6),
            "subsample": ("float", 0.6, 1.0)},
    "rf": {"n_estimators": ("int", 200, 800), "max_depth": ("int", 4, 10), "subsample": ("float", 0.6, 1.0)},
    "logistic": {"reg": ("log", 1e-4, 1.0), "l1_ratio": ("float", 0.0, 1.0)},
}


def draw_params(kind: str, trials: int, seed: int = SEED) -> list[dict]:
    """K5: seeded random draws from the search space (the TPE sampler is not built)."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trials):
        p = {}
        for name, (t, lo, hi) in SEARCH_SPACE[kind].items():
            if t == "int":
                p[name] = int(rng.integers(lo, hi + 1))
            elif t == "log":
                p[name] = float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
            else:
                p[name] = float(rng.uniform(lo, hi))
        out.append(p)
    return out


def search(train: DataFrame, val: DataFrame, kind: str, features: Sequence[str], trials: int = 5,
           seed: int = SEED, tree_share: float = 1.0) -> tuple[dict, float, list[tuple[dict, float]]]:
    """K5: best parameters by validation AUC over seeded random trials (fixed time split).

    ``tree_share`` scales the number of trees of every draw (the other parameters are searched as they are)."""
    def trial(p):
        if "n_estimators" in p:
            p["n_estimators"] = max(2, round(p["n_estimators"] * tree_share))
        return p, auc_of(score(fit(train, kind, features, p), val))

    results = side_by_side(trial, draw_params(kind, trials, seed), kind, train.sparkSession)
    best = max(results, key=lambda r: -1 if r[1] is None else r[1])
    return best[0], best[1], results


def with_split(dataset: DataFrame, train_end: str, val_end: str, date_col: str = "application_date") -> DataFrame:
    """H1 by the given dates; where they leave the train or the val part empty, H2's quantile cuts of the dates instead."""
    cut = sampling.time_split(dataset, train_end, val_end, date_col)
    n = cut.agg(*[F.count(F.when(F.col("split") == s, 1)).alias(s) for s in ("train", "val")]).first()
    if n["train"] and n["val"]:
        return cut
    c = sampling.auto_cuts(dataset, date_col=date_col).first()
    return sampling.time_split(dataset, str(c["train_end"]), str(c["val_end"]), date_col)


def train_segment(dataset: DataFrame, features: Sequence[str], kinds: Sequence[str] = ("logistic", "rf", "gbt"),
                  params: dict | None = None, early_stopping: bool = False, search_trials: int = 0,
                  tree_share: float = 1.0) -> tuple[str, PipelineModel, DataFrame]:
    """K3: per segment, fit every candidate on train, keep the best raw validation AUC.

    With ``search_trials`` each candidate is searched (K5) before its fit, and its best draw overrides ``params``.  With
    ``early_stopping`` the boosting learner sees the validation rows as its stopping set.
    Returns (best kind, its model, metrics table of all candidates on the val and test rows).
    """
    params = dict(params or {})
    train = dataset.where(F.col("split") == "train")
    val = dataset.where(F.col("split") == "val")
    table, models = None, {}
    for kind in kinds:
        if search_trials:
            params[kind] = {**params.get(kind, {}), **search(train, val, kind, features, search_trials, tree_share=tree_share)[0]}
        if kind == "gbt" and early_stopping:
            rows = dataset.where(F.col("split").isin("train", "val")).withColumn("stopping_row", F.col("split") == "val")
            m = fit(rows, kind, features, params.get(kind), validation_col="stopping_row")
        else:
            m = fit(train, kind, features, params.get(kind))
        models[kind] = m
        for split, part in (("val", val), ("test", dataset.where(F.col("split") == "test"))):
            mm = M.binary(score(m, part)).withColumn("model", F.lit(kind)).withColumn("split", F.lit(split))
            table = mm if table is None else table.unionByName(mm)
    table = cut_lineage(table)  # a few rows; the fits behind them are not scored again
    best = table.where(F.col("split") == "val").orderBy(F.col("auc_roc").desc_nulls_last(), "model").first()["model"]
    return best, models[best], table


# ----------------------------------------------------------------- K4
def calibrate(val_scored: DataFrame, method: str = "isotonic", y: str = "y", p: str = "pd_score"):
    """K4: isotonic or sigmoid calibration of the raw score on validation rows.

    Skipped (None) with fewer than 50 rows or one class; kept only when the
    calibrated validation AUC is not below the raw one.
    """
    stats = val_scored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(y).alias("k")).first()
    if method == "none" or stats["n"] < 50 or stats["k"] < 2:
        return None
    if method == "isotonic":
        cal = IsotonicRegression(featuresCol=p, labelCol=y, predictionCol="pd_calibrated").fit(val_scored)
    else:
        # the score's vector has a name of its own: a scored frame may hold its feature vector as ``features``
        cal = Pipeline(stages=[VectorAssembler(inputCols=[p], outputCol="_score"),
                               LogisticRegression(featuresCol="_score", labelCol=y, predictionCol="_pred", probabilityCol="_prob",
                                                  rawPredictionCol="_raw")]).fit(val_scored)
    cal_scored = apply_calibration(cal, val_scored, p)
    raw_auc = auc_of(val_scored, y, p)
    new_auc = auc_of(cal_scored, y, "pd_calibrated")
    if raw_auc is None or new_auc is None or new_auc < raw_auc:
        return None
    return cal


def apply_calibration(cal, df: DataFrame, p: str = "pd_score") -> DataFrame:
    if cal is None:
        return df.withColumn("pd_calibrated", clip(F.col(p), 0.0, 1.0))
    out = cal.transform(df)
    if "_prob" in out.columns:
        out = out.withColumn("pd_calibrated", vector_to_array("_prob")[1]).drop("_score", "_raw", "_prob", "_pred")
    return out.withColumn("pd_calibrated", clip(F.col("pd_calibrated"), 0.0, 1.0))


# ----------------------------------------------------------------- K6
def stack(dataset: DataFrame, features: Sequence[str], kinds: Sequence[str] = ("logistic", "rf", "gbt"),
          folds: int = 5, params: dict | None = None) -> tuple[PipelineModel, list[PipelineModel], DataFrame]:
    """K6: out-of-fold base scores over expanding time folds (G6), rows never scored get the
    mean, a logistic meta-model on the base scores; returns (meta, base models, val scored)."""
    params = params or {}
    train = dataset.where(F.col("split") == "train")
    val = dataset.where(F.col("split") == "val")
    f = cut_lineage(sampling.time_series_folds(train, max_folds=folds))  # read by every fold, learner and optimiser pass
    info = f.select("n_folds", "fold_size").first()
    k, ts = info["n_folds"], info["fold_size"]
    n = f.count()
    first = n - k * ts
    oof = f.select("application_id", "row_idx", "test_fold", "y", "weight")
    bases = []
    for kind in kinds:
        parts = None
        for i in range(k):
            start = first + i * ts
            m = fit(f.where(F.col("row_idx") < start), kind, features, params.get(kind))
            s = score(m, f.where(F.col("test_fold") == i)).select("application_id", F.col("pd_score").alias(f"s_{kind}"))
            parts = s if parts is None else parts.unionByName(s)
        parts = cut_lineage(parts)
        oof = oof.join(parts, "application_id", "left")
        mean = parts.agg(F.avg(f"s_{kind}")).scalar()
        oof = oof.withColumn(f"s_{kind}", F.coalesce(F.col(f"s_{kind}"), mean))
        bases.append(fit(train, kind, features, params.get(kind)))
    meta_cols = [f"s_{kind}" for kind in kinds]
    meta = fit(cut_lineage(oof), "logistic", meta_cols, weight=None)
    v = val
    for kind, b in zip(kinds, bases):
        v = score(b, v, out=f"s_{kind}")
    return meta, bases, score(meta, v.drop("features"))


# ----------------------------------------------------------------- K7, K8, K9
def champion(metrics: DataFrame, by: Sequence[str] = ("segment",), bar: float = K.MIN_AUC_FOR_REGISTRATION) -> DataFrame:
    """K7: best model per segment by AUC (ties: the larger model name), registered when AUC >= bar."""
    best = metrics.groupBy(*by).agg(F.max_by("model", F.struct("auc_roc", "model")).alias("champion"),
                                    F.max("auc_roc").alias("auc_roc"))
    return best.select(*by, "champion", "auc_roc", (F.col("auc_roc") >= bar).alias("registered"))


def score_batch(frames: dict[str, DataFrame], models: dict[str, tuple[str, PipelineModel]]) -> DataFrame:
    """K8: each segment's rows scored with its own model; calibrated = clip(score); bucket;
    version ``batch:<segment>:<type>``; segments concatenated by name (H9)."""
    out = None
    for seg, df in frames.items():
        kind, m = models[seg]
        s = score(m, df).select("application_id", F.lit(f"batch:{seg}:{kind}").alias("model_version"), "pd_score")
        p = clip(F.col("pd_score"), 0.0, 1.0)
        s = s.withColumn("pd_calibrated", p).withColumn("risk_bucket", risk_bucket(p, K.RISK_BUCKET_BOUNDS, K.RISK_BUCKET_LABELS))
        out = s if out is None else out.unionByName(s)
    return out


def route(df: DataFrame, history_ready: bool = True, cold_ready: bool = True,
          signals: Sequence[str] = K.HISTORY_SIGNALS) -> Column:
    """K9: history model when any payment signal is present, else cold start; fall back to
    whichever model exists."""
    present = F.lit(False)
    for c in signals:
        present = present | F.col(c).isNotNull()
    if history_ready and cold_ready:
        return F.when(present, "with_history").otherwise("cold_start")
    if history_ready:
        return F.lit("with_history")
    if cold_ready:
        return F.lit("cold_start")
    raise RuntimeError("No model available")


# ----------------------------------------------------------------- K10
def save_bundle(path: str, model: PipelineModel, features: Sequence[str], medians: DataFrame | None = None,
                encodings: DataFrame | None = None, metrics: DataFrame | None = None, kind: str = "",
                global_mean: float | None = None) -> None:
    """Model, feature list, medians, encodings (with the mean of what they do not hold) and metrics saved together (no
    pickle)."""
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = medians.sparkSession if medians is not None else None
    meta = {"features": list(features), "kind": kind, "global_mean": global_mean}
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(os.path.join(path, "meta"))
    for name, t in (("medians", medians), ("encodings", encodings), ("metrics", metrics)):
        if t is not None:
            t.write.mode("overwrite").parquet(os.path.join(path, name))


def load_bundle(spark, path: str) -> dict:
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    out = {"model": PipelineModel.load(os.path.join(path, "model")), **meta}
    for name in ("medians", "encodings", "metrics"):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
        saved = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # optional; a damaged table is an error
        out[name] = spark.read.parquet(os.path.join(path, name)) if saved else None
    return out


def score_bundle(bundle: dict, df: DataFrame, suffix: str = "_target_enc") -> DataFrame:
    """Rows scored by a loaded bundle alone: categories encoded by its map, missing features filled by its medians (0
    where it has none), then its model."""
    from .features import fill_with, target_apply
    feats = bundle["features"]
    if bundle["encodings"] is not None:
        coded = [f.removesuffix(suffix) for f in feats if f.endswith(suffix)]
        mean = df.sparkSession.range(1).select(F.lit(bundle.get("global_mean")).cast("double").alias("global_mean"))
        df = target_apply(df.drop(*[f"{c}{suffix}" for c in coded]), bundle["encodings"], mean, coded, suffix)
    missing = set(feats) - set(df.columns)
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) if c in feats else F.col(c) for c in df.columns if c != "features"],
                   *[F.lit(None).cast("double").alias(c) for c in feats if c in missing])
    if bundle["medians"] is not None:
        df = fill_with(df, bundle["medians"], feats)
    return score(bundle["model"], df.fillna(0.0, subset=feats))


# ----------------------------------------------------------------- K11-K13
def linear_contributions(df: DataFrame, coefs: dict[str, float], means: dict[str, Column] | None = None,
                         id_col: str = "application_id", keep: Sequence[str] = ()) -> DataFrame:
    """K12 (linear models, exact): contribution_j = b_j * (x_j - mean_j) as an array of
    (feature, value) structs per row; the means are scalar subqueries over ``df``."""
    means = means or {c: df.agg(F.avg(c)).scalar() for c in coefs}
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(float(b)) * (F.col(c) - means[c])).alias("value"))
                    for c, b in coefs.items()])
    return df.select(id_col, *keep, arr.alias("contributions"))


def reasons(contrib: DataFrame, n: int = 3, positive_only: bool = False, col: str = "contributions") -> DataFrame:
    """Top ``n`` features by |contribution| (ties by name) with direction, row-local
    (array sort + slice, no shuffle)."""
    arr = F.col(col)
    if positive_only:
        arr = F.filter(arr, lambda s: s["value"] > 0)
    ranked = F.array_sort(arr, lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
                          .when(F.abs(a["value"]) < F.abs(b["value"]), 1)
                          .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))
    top = F.slice(ranked, 1, n)
    out = F.transform(top, lambda s, i: F.struct((i + 1).alias("rank"), s["feature"].alias("feature"),
                                                 s["value"].alias("shap_value"),
                                                 F.when(s["value"] > 0, "increases_risk").otherwise("decreases_risk").alias("direction")))
    keep = [c for c in contrib.columns if c != col]
    return contrib.select(*keep, F.inline(out))


def importance_summary(contrib: DataFrame, by: Sequence[str] = ("segment",), top: int = 10,
                       col: str = "contributions") -> DataFrame:
    """Mean |contribution| per feature (and segment) with its rank; the top ``top`` flagged."""
    long = contrib.select(*by, F.inline(col))
    imp = long.groupBy(*by, "feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    # rank inside each segment: the table has (segments x features) rows
    w = Window.partitionBy(*by).orderBy(F.col("mean_abs").desc(), "feature")
    return imp.withColumn("rank", F.row_number().over(w)).withColumn("top", F.col("rank") <= top)


def shared_importance(imp: DataFrame, a: str = "with_history", b: str = "cold_start") -> DataFrame:
    """Importances of two segments on shared features, ratio a / max(b, 1e-6)."""
    x = imp.where(F.col("segment") == a).select("feature", F.col("mean_abs").alias(a))
    y = imp.where(F.col("segment") == b).select("feature", F.col("mean_abs").alias(b))
    return x.join(y, "feature", "inner").withColumn("ratio", F.col(a) / F.greatest(F.col(b), F.lit(1e-6)))


# ----------------------------------------------------------------- K14
def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], repeats: int = 3,
                           seed: int = SEED, y: str = "y", id_col: str = "application_id") -> DataFrame:
    """Mean and std of the PR-AUC drop when one feature is permuted, all features of two repeats in one job.

    The permutation of repeat r sends row i the value of the row whose seeded-hash rank equals i's id rank (an exact
    shuffle, by a join on the rank).  A row holds its own features and the ones it was sent, and is scored once per feature
    by an expression; only (feature, label, score) is multiplied.  The repeats run two at a time and delete what they wrote,
    so the disk holds the scores of two."""
    spark = df.sparkSession
    with scratch(spark):
        drops = _permutation_drops(model, df, features, repeats, seed, y, id_col)
    # a row a feature and repeat
    ap = spark.createDataFrame(drops, "feature string, drop double")
    return ap.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))


def _permutation_drops(model, df, features, repeats, seed, y, id_col) -> list[tuple[str, float | None]]:
    """(feature, PR-AUC drop) of every feature and repeat."""
    base = M.binary(score(model, df), y).select("auc_pr").first()
    prob = ensembles.scorer(model)
    rows = assembled(df, features).select(id_col, F.col(y).alias("_y"), vector_to_array("features").alias("_x"))
    own = orderstat.row_index(rows, [id_col], out="_i")
    swapped = lambda j: F.transform("_x", lambda v, i: F.when(i == j, F.get("_p", i)).otherwise(v))
    variants = F.transform(F.sequence(F.lit(0), F.lit(len(features) - 1)), lambda j: prob(swapped(j)))
    drops = []
    for r in range(0, repeats, 2):
        with scratch(df.sparkSession):
            found = _permuted_ap(own, rows, [seed + k for k in range(r, min(r + 2, repeats))], variants, id_col)
        drops += [(features[f], None if base is None or base["auc_pr"] is None or ap is None else base["auc_pr"] - ap) for f, ap in found]
    return drops


def _permuted_ap(own: DataFrame, rows: DataFrame, seeds: Sequence[int], variants: Column, id_col: str) -> list[tuple[int, float | None]]:
    """(number of the feature, PR-AUC with it permuted) of every seed; the plans are gone when it returns."""
    scored = None
    for seed in seeds:
        order = F.xxhash64(id_col, F.lit(seed)).alias("_o")
        sent = orderstat.row_index(rows.select(id_col, F.col("_x").alias("_p"), order), ["_o", id_col], out="_i")
        both = own.join(sent.select("_i", "_p"), "_i").withColumn("_r", F.lit(seed))
        scored = both if scored is None else scored.unionByName(both)
    long = scored.select("_r", "_y", F.posexplode(variants).alias("_f", "_s"))
    return [(r["_f"], r["auc_pr"]) for r in M.binary(long, "_y", "_s", by=["_f", "_r"]).select("_f", "auc_pr").collect()]


# ----------------------------------------------------------------- K15, K16
def redundancy_prune(importance: DataFrame, pairs: DataFrame, threshold: float = 0.85, keep_share: float = 0.1) -> DataFrame:
    """Of each pair with |r| > threshold drop the less important feature (ties drop
    feature_a); keep features with importance >= keep_share x median importance."""
    imp_a = importance.select(F.col("feature").alias("feature_a"), F.col("importance").alias("imp_a"))
    imp_b = importance.select(F.col("feature").alias("feature_b"), F.col("importance").alias("imp_b"))
    hi = pairs.where(F.abs("r") > threshold).join(imp_a, "feature_a").join(imp_b, "feature_b")
    redundant = hi.select(F.when(F.col("imp_b") < F.col("imp_a"), F.col("feature_b")).otherwise(F.col("feature_a")).alias("feature")).distinct()
    med = importance.agg(F.median("importance")).scalar()  # over the feature table (one row per feature)
    kept = importance.where(F.col("importance") >= keep_share * med).join(redundant, "feature", "left_anti")
    return kept.select("feature", "importance")


FAMILIES = {"Numerical": K.NUMERICAL_FEATURES, "Target Encoded": K.TARGET_ENCODED_FEATURES,
            "Aggregation": K.AGGREGATION_FEATURES, "Bureau": K.BUREAU_FEATURES}


def category_importance(importance: DataFrame, families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """Total and mean importance per feature family (mean over the family's size)."""
    fam = None
    for name, feats in families.items():
        c = F.col("feature").isin(*feats)
        fam = F.when(c, F.lit(name)) if fam is None else fam.when(c, F.lit(name))
    size = None
    for name, feats in families.items():
        c = F.col("category") == name
        size = F.when(c, F.lit(len(feats))) if size is None else size.when(c, F.lit(len(feats)))
    t = importance.withColumn("category", fam).where(F.col("category").isNotNull()) \
        .groupBy("category").agg(F.sum("importance").alias("total_importance"))
    return t.select("category", size.alias("n_features"), "total_importance",
                    (F.col("total_importance") / size).alias("avg_importance"))


# ----------------------------------------------------------------- K17
def diagnose(train_auc: Column, val_auc: Column) -> Column:
    """Fit diagnosis of one learning-curve point: train AUC > 0.95 overfitting, val AUC < 0.65
    underfitting, else good."""
    return F.when(train_auc > 0.95, "overfitting").when(val_auc < 0.65, "underfitting").otherwise("good")


def learning_curve(dataset: DataFrame, features: Sequence[str], sizes: Sequence[int], kind: str = "logistic",
                   params: dict | None = None, order: Column | None = None) -> DataFrame:
    """Metrics by training size (nested random subsets, G7) with the fit diagnosis."""
    train = dataset.where(F.col("split") == "train")
    val = dataset.where(F.col("split") == "val")
    ranked = cut_lineage(sampling.nested_sizes(train, sizes, order))  # ordered once for all sizes
    rows, sizes = None, sorted(sizes)
    part = lambda s: ranked.where(F.col("rank") < s).drop("rank", "min_size")
    fitted = side_by_side(lambda s: fit(part(s), kind, features, params), sizes, kind, train.sparkSession)
    for s, m in zip(sizes, fitted):
        sub = part(s)
        tr = M.binary(score(m, sub)).select(F.col("auc_roc").alias("train_auc"))
        va = M.binary(score(m, val)).select(F.col("n").alias("n_val"), F.col("auc_roc").alias("val_auc"),
                                             F.col("auc_pr").alias("val_pr_auc"), F.col("brier").alias("val_brier"))
        row = tr.select(F.lit(s).alias("size"), "train_auc", va.select(F.struct("*")).scalar().alias("v"))
        rows = row if rows is None else rows.unionByName(row)
    return rows.select("size", F.col("v.n_val").alias("n_val"), "train_auc", F.col("v.val_auc").alias("val_auc"),
                       F.col("v.val_pr_auc").alias("val_pr_auc"), F.col("v.val_brier").alias("val_brier"),
                       (F.col("train_auc") - F.col("v.val_auc")).alias("gap"),
                       diagnose(F.col("train_auc"), F.col("v.val_auc")).alias("diagnosis"))
