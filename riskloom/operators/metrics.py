"""Model metrics, curves, thresholds and error analysis.

Every ranking metric comes from one bucketed prefix sum over the distinct
scores (``orderstat.prefix_sums``): no single-task global window, exact ties.
At a threshold t the prediction is ``score >= t``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.expr import right_closed_bucket
from . import orderstat

EPS = 2.220446049250313e-16  # float64 machine epsilon (log-loss clip)


def score_counts(df: DataFrame, y: str = "y", p: str = "pd_score", by: Sequence[str] = (),
                 n_buckets: int | None = None) -> DataFrame:
    """Per distinct score: pos, neg, inclusive running sums and class totals."""
    base = df.select(*by, F.col(p).cast("double").alias("s"),
                     F.when(F.col(y).cast("int") == 1, 1).otherwise(0).cast("long").alias("pos"),
                     F.when(F.col(y).cast("int") == 1, 0).otherwise(1).cast("long").alias("neg"))
    return orderstat.prefix_sums(base.where(F.col("s").isNotNull()), "s", ["pos", "neg"], by, n_buckets)


def _at_threshold(ps: DataFrame) -> DataFrame:
    """Confusion counts when predicting positive for score >= s, per distinct s."""
    P, N = F.col("tot_pos"), F.col("tot_neg")
    tp = P - (F.col("cum_pos") - F.col("pos"))
    fp = N - (F.col("cum_neg") - F.col("neg"))
    return ps.withColumn("tp", tp).withColumn("fp", fp).withColumn("fn", P - tp).withColumn("tn", N - fp)


def binary(df: DataFrame, y: str = "y", p: str = "pd_score", by: Sequence[str] = (),
           n_buckets: int | None = None) -> DataFrame:
    """N, auc_roc, gini, auc_pr (average precision), auc_pr_trapz, brier, log_loss, ks per group."""
    by = list(by)
    ps = _at_threshold(score_counts(df, y, p, by, n_buckets))
    P, N = F.col("tot_pos"), F.col("tot_neg")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), P)  # NULL for a class-free group, not an ANSI error
    tp_prev, fp_prev = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    prec_prev = F.when(tp_prev + fp_prev > 0, tp_prev / (tp_prev + fp_prev)).otherwise(F.lit(1.0))
    rec_prev = F.try_divide(tp_prev, P)
    sc = F.col("s")
    scl = F.when(sc < EPS, EPS).when(sc > 1 - EPS, 1 - EPS).otherwise(sc)
    pos, neg = F.col("pos"), F.col("neg")
    ranked = ps.groupBy(*by).agg(
        F.first("tot_pos").alias("n_pos"), F.first("tot_neg").alias("n_neg"),
        F.sum(pos * (F.col("cum_neg") - 0.5 * neg)).alias("_auc_num"),
        F.sum(pos * prec).alias("_ap_num"),
        F.sum((rec - rec_prev) * (prec + prec_prev) / 2.0).alias("_trapz"),
        F.max(F.abs(F.try_divide(F.col("cum_pos"), P) - F.try_divide(F.col("cum_neg"), N))).alias("_ks"),
        # point metrics from the same per-score counts (no second pass, no join)
        F.sum(pos * (sc - 1.0) * (sc - 1.0) + neg * sc * sc).alias("_sq"),
        F.sum(pos * F.log(scl) + neg * F.log(1.0 - scl)).alias("_ll"),
    )
    n = F.coalesce(F.col("n_pos") + F.col("n_neg"), F.lit(0))
    both = F.coalesce((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.lit(False))
    auc = F.when(both, F.col("_auc_num") / (F.col("n_pos") * F.col("n_neg")))
    return ranked.select(
        *by, n.alias("n"), auc.alias("auc_roc"), (2 * auc - 1).alias("gini"),
        F.when(F.col("n_pos") > 0, F.col("_ap_num") / F.col("n_pos")).alias("auc_pr"),
        F.when(F.col("n_pos") > 0, F.col("_trapz")).alias("auc_pr_trapz"),
        (F.col("_sq") / n).alias("brier"), (-F.col("_ll") / n).alias("log_loss"),
        F.when(both, F.col("_ks")).otherwise(F.lit(0.0)).alias("ks"),
    )


def curve(df: DataFrame, y: str = "y", p: str = "pd_score", by: Sequence[str] = (),
          n_buckets: int | None = None) -> DataFrame:
    """ROC and PR points per distinct score (threshold, tpr, fpr, precision, recall)."""
    ps = _at_threshold(score_counts(df, y, p, by, n_buckets))
    P, N = F.col("tot_pos"), F.col("tot_neg")
    return ps.select(*by, F.col("s").alias("threshold"),
                     F.when(P > 0, F.col("tp") / P).alias("tpr"), F.when(N > 0, F.col("fp") / N).alias("fpr"),
                     (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                     F.when(P > 0, F.col("tp") / P).alias("recall"), "tp", "fp", "fn", "tn")


def thresholds(df: DataFrame, y: str = "y", p: str = "pd_score", by: Sequence[str] = (),
               recall: float = 0.80, precision: float = 0.90, cost_fp: float = K.COST_FP,
               cost_fn: float = K.COST_FN, n_buckets: int | None = None) -> DataFrame:
    """Highest threshold with recall >= target; lowest with precision >= target
    (NULL if none); cheapest threshold by cost_fp*FP + cost_fn*FN over all distinct
    scores but the highest, the lowest threshold winning ties."""
    by = list(by)
    ps = _at_threshold(score_counts(df, y, p, by, n_buckets))
    rec = F.try_divide(F.col("tp"), F.col("tot_pos"))
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    cost = F.col("fp") * float(cost_fp) + F.col("fn") * float(cost_fn)
    # the highest distinct score is the row whose running count reaches the total
    below_top = (F.col("cum_pos") + F.col("cum_neg")) < (F.col("tot_pos") + F.col("tot_neg"))
    return ps.groupBy(*by).agg(
        F.max(F.when(rec >= recall, F.col("s"))).alias("threshold_recall"),
        F.min(F.when(prec >= precision, F.col("s"))).alias("threshold_precision"),
        F.min_by(F.when(below_top, F.col("s")), F.when(below_top, F.struct(cost, F.col("s")))).alias("threshold_cost"),
        F.min(F.when(below_top, cost)).alias("min_cost"),
    )


def threshold_metrics(df: DataFrame, y: str = "y", p: str = "pd_score", by: Sequence[str] = (),
                      cuts: Sequence[float] = K.REPORT_THRESHOLDS) -> DataFrame:
    """Precision, recall, F1 at fixed cut points (0 when undefined); one pass, one row per cut."""
    by = list(by)
    yy = F.col(y).cast("int") == 1
    aggs = []
    for i, t in enumerate(cuts):
        pred = F.col(p) >= float(t)
        aggs += [F.count(F.when(pred & yy, 1)).alias(f"tp{i}"), F.count(F.when(pred & ~yy, 1)).alias(f"fp{i}"),
                 F.count(F.when(~pred & yy, 1)).alias(f"fn{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                              F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn")) for i, t in enumerate(cuts)])
    long = wide.select(*by, F.inline(rows))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    return long.select(*by, "threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


# ----------------------------------------------------------- error analysis
def error_frame(scored: DataFrame, threshold: float = 0.5, y: str = "y", p: str = "pd_score") -> DataFrame:
    """y_pred, error and error_type (correct / FP / FN) per scored row."""
    yp = (F.col(p) >= float(threshold)).cast("int")
    yt = F.col(y).cast("int")
    return scored.withColumn("y_true", yt).withColumn("y_pred_proba", F.col(p)).withColumn("y_pred", yp) \
        .withColumn("error", (F.col("y_pred") != F.col("y_true")).cast("int")) \
        .withColumn("error_type", F.when((F.col("y_pred") == 1) & (F.col("y_true") == 0), "FP")
                    .when((F.col("y_pred") == 0) & (F.col("y_true") == 1), "FN").otherwise("correct"))


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TN FP FN TP, precision, recall, FPR, FNR of an error frame."""
    c = lambda cond: F.count(F.when(cond, 1))
    yt, yp = F.col("y_true"), F.col("y_pred")
    g = df.groupBy(*by).agg(c((yt == 0) & (yp == 0)).alias("tn"), c((yt == 0) & (yp == 1)).alias("fp"),
                            c((yt == 1) & (yp == 0)).alias("fn"), c((yt == 1) & (yp == 1)).alias("tp"))
    d = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.col(a) / (F.col(a) + F.col(b)))
    return g.select(*by, "tn", "fp", "fn", "tp", d("tp", "fp").alias("precision"), d("tp", "fn").alias("recall"),
                    d("fp", "tn").alias("fpr"), d("fn", "tp").alias("fnr"))


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """User cut points, right-closed, lowest edge excluded, outside to NULL."""
    return right_closed_bucket(c, edges, labels, null_label=None, open_ends=False)


def qcut_edges(df: DataFrame, col: str, q: int = 5) -> Column:
    """Quantile edges of ``col`` (linear) as an array-valued scalar subquery (q + 1 values)."""
    probs = [i / q for i in range(q + 1)]
    qs = orderstat.exact_quantiles(df, col, probs)
    return qs.agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "q"))), lambda s: s["q"]).alias("e")).scalar()


def qcut(df: DataFrame, col: str, labels: Sequence[str], out: str) -> DataFrame:
    """Equal-count buckets (pandas qcut: right-closed, lowest value included).

    The edges are one array-valued scalar subquery, attached once as a column.
    """
    tmp = f"_edges_{out}"
    d = df.withColumn(tmp, qcut_edges(df, col, len(labels)))
    x, e = F.col(col), F.col(tmp)
    expr = None
    for i, lab in enumerate(labels):
        cond = (x <= e[i + 1]) & (x >= e[0])
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return d.withColumn(out, expr).drop(tmp)


BUCKET_LABELS, CREDIT_EDGES, CREDIT_LABELS, DTI_EDGES = K.BUCKET_LABELS, K.CREDIT_EDGES, K.CREDIT_LABELS, K.DTI_EDGES


def qcut_many(df: DataFrame, specs: dict[str, str], labels: Sequence[str]) -> DataFrame:
    """G8 for several columns at once: one distributed quantile job for all edges, attached as a
    single (column -> edges) map scalar subquery; buckets as ``qcut`` (right-closed, lowest included)."""
    q = len(labels)
    probs = [i / q for i in range(q + 1)]
    cols = list(specs)
    qs = orderstat.wide_quantiles(df, cols, probs)
    per = qs.groupBy("feature").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "q"))), lambda s: s["q"]).alias("e"))
    m = per.agg(F.map_from_entries(F.collect_list(F.struct("feature", "e"))).alias("m")).scalar()
    d = df.withColumn("_qcut_edges", m)
    outs = []
    for c, out in specs.items():
        x, e = F.col(c), F.col("_qcut_edges")[F.lit(c)]
        expr = None
        for i, lab in enumerate(labels):
            cond = (x <= e[i + 1]) & (x >= e[0])
            expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
        outs.append(expr.alias(out))
    return d.select("*", *outs).drop("_qcut_edges")


QUINTILES = {"loan_amount": "loan_bucket", "income": "income_bucket", "confidence": "confidence_bucket"}


def with_error_buckets(ef: DataFrame, quintiles: Sequence[str] = tuple(QUINTILES)) -> DataFrame:
    """Buckets of the error analysis: credit and dti by cut points, loan and income by quintiles,
    confidence |p - 0.5| by quintiles.  The quintile edges of the columns asked for are found in one job."""
    out = ef.withColumn("credit_bucket", cut(F.col("credit_score"), CREDIT_EDGES, CREDIT_LABELS)) \
        .withColumn("dti_bucket", cut(F.col("dti_ratio"), DTI_EDGES, BUCKET_LABELS)) \
        .withColumn("confidence", F.abs(F.col("y_pred_proba") - 0.5))
    return qcut_many(out, {c: QUINTILES[c] for c in quintiles}, BUCKET_LABELS)


def error_by_bucket(eb: DataFrame) -> DataFrame:
    """Error rate, count and default rate per bucket of four features (rounded to 3)."""
    parts = {"credit_score": "credit_bucket", "loan_amount": "loan_bucket", "income": "income_bucket",
             "dti_ratio": "dti_bucket"}
    long = eb.select("error", "y_true", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(b).alias("bucket")) for f, b in parts.items()])).alias("fb"))
    return long.where(F.col("fb.bucket").isNotNull()).groupBy(F.col("fb.feature").alias("feature"), F.col("fb.bucket").alias("bucket")) \
        .agg(F.round(F.avg("error"), 3).alias("error_rate"), F.count(F.lit(1)).alias("count"),
             F.round(F.avg("y_true"), 3).alias("default_rate"))


def error_feature_means(ef: DataFrame, features: Sequence[str] = K.ERROR_FEATURES) -> DataFrame:
    """Means of the key features per error type."""
    return ef.groupBy("error_type").agg(*[F.avg(c).alias(c) for c in features])


def segment_cross(eb: DataFrame) -> DataFrame:
    """credit x loan buckets: error rate, count, default rate (rounded to 3)."""
    return eb.where(F.col("credit_bucket").isNotNull() & F.col("loan_bucket").isNotNull()) \
        .groupBy("credit_bucket", "loan_bucket").agg(
            F.round(F.avg("error"), 3).alias("error_rate"), F.count(F.lit(1)).alias("count"),
            F.round(F.avg("y_true"), 3).alias("default_rate"))


def worst_segments(eb: DataFrame, min_count: int = 100, min_error: float = 0.30, top: int = 10) -> DataFrame:
    """Cells with count >= 100 and error rate > 30%, the 10 worst (a top-k report)."""
    x = segment_cross(eb)
    return x.where((F.col("count") >= min_count) & (F.col("error_rate") > min_error)) \
        .orderBy(F.col("error_rate").desc(), "credit_bucket", "loan_bucket").limit(top)


def error_pivot(eb: DataFrame, min_count: int = 100) -> DataFrame:
    """Error rate of the kept cells pivoted by loan bucket."""
    x = segment_cross(eb).where(F.col("count") >= min_count)
    return x.groupBy("credit_bucket").pivot("loan_bucket", BUCKET_LABELS).agg(F.first("error_rate"))


def confidence_buckets(eb: DataFrame) -> DataFrame:
    """I16: error rate and count per quintile of |p - 0.5|."""
    return eb.where(F.col("confidence_bucket").isNotNull()).groupBy("confidence_bucket").agg(
        F.round(F.avg("error"), 3).alias("error_rate"), F.count(F.lit(1)).alias("count"))


def segment_errors(ef: DataFrame) -> DataFrame:
    """Error and default rate per scoring segment."""
    return ef.groupBy("segment").agg(F.avg("error").alias("error_rate"), F.avg("y_true").alias("default_rate"),
                                     F.count(F.lit(1)).alias("n"))


def performance_check(df: DataFrame, version_col: str = "model_version", period_col: str = "period",
                      baseline: str = "baseline", y: str = "y", p: str = "pd_score",
                      drop: float = K.AUC_DROP_THRESHOLD, min_n: int = K.MIN_PREDICTIONS_FOR_CHECK) -> DataFrame:
    """Metrics per (version, period) joined to the version's baseline row; alert when the
    AUC falls by more than ``drop`` with at least ``min_n`` predictions."""
    m = binary(df, y, p, by=[version_col, period_col])
    base = m.where(F.col(period_col) == baseline).select(version_col, F.col("auc_roc").alias("baseline_auc"))
    cur = m.where(F.col(period_col) != baseline)
    j = cur.join(base, version_col, "left")
    return j.select(version_col, period_col, "n", "auc_roc", "auc_pr", "brier", "ks", "baseline_auc",
                    ((F.col("baseline_auc") - F.col("auc_roc") > drop) & (F.col("n") >= min_n)).alias("alert"))
