"""Queries for model metrics, thresholds and error analysis (I1-I18) over scored_v."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import metrics as M
from ..session import cut_lineage
from ..sources import fixtures
from .catalog import register
from .oracle_views import with_ctes

# --------------------------------------------------------------- SQL blocks
SCORE_COUNTS = [
    ("sc0", "SELECT segment, pd_score AS s, sum(y) AS pos, sum(1 - y) AS neg FROM scored_r GROUP BY segment, pd_score"),
    ("sc", "SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, "
           "sum(pos) OVER (PARTITION BY segment) AS tot_pos, sum(neg) OVER (PARTITION BY segment) AS tot_neg "
           "FROM sc0 WINDOW w AS (PARTITION BY segment ORDER BY s ROWS UNBOUNDED PRECEDING)"),
    ("th", "SELECT *, CAST(tot_pos - (cum_pos - pos) AS BIGINT) AS tp, CAST(tot_neg - (cum_neg - neg) AS BIGINT) AS fp, "
           "CAST(cum_pos - pos AS BIGINT) AS fn, CAST(cum_neg - neg AS BIGINT) AS tn FROM sc"),
]
EPS = "2.220446049250313e-16"
_prec = "(tp * 1.0e0 / (tp + fp))"
_rec = "(tp * 1.0e0 / tot_pos)"
_tp_prev, _fp_prev = "(tp - pos)", "(fp - neg)"
_prec_prev = f"(CASE WHEN {_tp_prev} + {_fp_prev} > 0 THEN {_tp_prev} * 1.0e0 / ({_tp_prev} + {_fp_prev}) ELSE 1.0e0 END)"
_scl = f"(CASE WHEN s < {EPS} THEN {EPS} WHEN s > 1 - {EPS} THEN 1 - {EPS} ELSE s END)"
BINARY_SQL = f"""
SELECT segment, CAST(n_pos + n_neg AS BIGINT) AS n,
  CASE WHEN n_pos > 0 AND n_neg > 0 THEN auc_num / (n_pos * n_neg) END AS auc_roc,
  2 * (CASE WHEN n_pos > 0 AND n_neg > 0 THEN auc_num / (n_pos * n_neg) END) - 1 AS gini,
  CASE WHEN n_pos > 0 THEN ap_num / n_pos END AS auc_pr,
  CASE WHEN n_pos > 0 THEN trapz END AS auc_pr_trapz,
  sq / (n_pos + n_neg) AS brier, -ll / (n_pos + n_neg) AS log_loss,
  CASE WHEN n_pos > 0 AND n_neg > 0 THEN ks ELSE 0.0e0 END AS ks
FROM (SELECT segment, max(tot_pos) AS n_pos, max(tot_neg) AS n_neg,
  sum(pos * (cum_neg - 0.5e0 * neg)) AS auc_num, sum(pos * {_prec}) AS ap_num,
  sum(({_rec} - {_tp_prev} * 1.0e0 / tot_pos) * ({_prec} + {_prec_prev}) / 2.0e0) AS trapz,
  max(abs(cum_pos * 1.0e0 / tot_pos - cum_neg * 1.0e0 / tot_neg)) AS ks,
  sum(pos * (s - 1.0e0) * (s - 1.0e0) + neg * s * s) AS sq,
  sum(pos * ln({_scl}) + neg * ln(1.0e0 - {_scl})) AS ll
  FROM th GROUP BY segment) t"""


def _binary_sql(cols: list[str]) -> str:
    return with_ctes(["scored_r"], SCORE_COUNTS + [("bm", BINARY_SQL)],
                     "SELECT segment, " + ", ".join(f"round({c}, 6) AS {c}" if c != "n" else c for c in cols) + " FROM bm")


def _scored(spark, sf_dir):
    """scored_v with scores at 1e-10 resolution: mathematically tied scores differ by an
    ulp between math libraries, and tie-aware metrics must see them as ties."""
    s = fixtures.load(spark, sf_dir).scored
    return s.withColumn("pd_score", F.round("pd_score", 10))


def _binary(spark, sf_dir, cols):
    m = M.binary(_scored(spark, sf_dir), by=["segment"])
    return round_doubles(m.select("segment", *cols))


@register("auc_roc", _binary_sql(["n", "auc_roc", "gini"]))
def q_auc(spark, sf_dir):
    """Tie-aware ROC-AUC and Gini per segment."""
    return _binary(spark, sf_dir, ["n", "auc_roc", "gini"])


@register("auc_pr", _binary_sql(["auc_pr", "auc_pr_trapz"]))
def q_auc_pr(spark, sf_dir):
    """Average precision (step sum) and the trapezoid PR area per segment."""
    return _binary(spark, sf_dir, ["auc_pr", "auc_pr_trapz"])


@register("brier_logloss", _binary_sql(["brier", "log_loss"]))
def q_brier(spark, sf_dir):
    """Brier score and log loss (clipped p) per segment."""
    return _binary(spark, sf_dir, ["brier", "log_loss"])


@register("ks_statistic", _binary_sql(["ks"]))
def q_ks(spark, sf_dir):
    """I4: max gap of the two class ECDFs per segment."""
    return _binary(spark, sf_dir, ["ks"])


@register("model_metrics", _binary_sql(["n", "auc_roc", "gini", "auc_pr", "auc_pr_trapz", "brier", "log_loss", "ks"]))
def q_model_metrics(spark, sf_dir):
    """I1-I4 together (the metric set of one evaluation)."""
    return _binary(spark, sf_dir, ["n", "auc_roc", "gini", "auc_pr", "auc_pr_trapz", "brier", "log_loss", "ks"])


@register("threshold_metrics", with_ctes(["scored_r"], [], " UNION ALL ".join(
    f"""SELECT segment, {t}e0 AS threshold,
  round(CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) ELSE 0.0e0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp * 1.0e0 / (tp + fn) ELSE 0.0e0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0e0 * tp / (2 * tp + fp + fn) ELSE 0.0e0 END, 6) AS f1
FROM (SELECT segment, count(CASE WHEN pd_score >= {t}e0 AND y = 1 THEN 1 END) AS tp,
  count(CASE WHEN pd_score >= {t}e0 AND y = 0 THEN 1 END) AS fp,
  count(CASE WHEN pd_score < {t}e0 AND y = 1 THEN 1 END) AS fn FROM scored_r GROUP BY segment) t{i}"""
    for i, t in enumerate([0.05, 0.15, 0.30]))))
def q_threshold_metrics(spark, sf_dir):
    """Precision / recall / F1 at 0.05, 0.15, 0.30 per segment."""
    return round_doubles(M.threshold_metrics(_scored(spark, sf_dir), by=["segment"]))


@register("roc_pr_curves", with_ctes(["scored_r"], SCORE_COUNTS,
                                     "SELECT segment, round(s, 6) AS threshold, round(tp * 1.0e0 / tot_pos, 6) AS tpr, "
                                     "round(fp * 1.0e0 / tot_neg, 6) AS fpr, round(tp * 1.0e0 / (tp + fp), 6) AS precision, "
                                     "round(tp * 1.0e0 / tot_pos, 6) AS recall, tp, fp, fn, tn FROM th"))
def q_curves(spark, sf_dir):
    """ROC and PR curve points per distinct score and segment."""
    return round_doubles(M.curve(_scored(spark, sf_dir), by=["segment"]))


_THRESH = with_ctes(["scored_r"], SCORE_COUNTS + [("sel", f"""
SELECT segment,
  max(CASE WHEN {_rec} >= 0.8e0 THEN s END) AS threshold_recall,
  min(CASE WHEN {_prec} >= 0.9e0 THEN s END) AS threshold_precision,
  arg_min(CASE WHEN cum_pos + cum_neg < tot_pos + tot_neg THEN s END,
          CASE WHEN cum_pos + cum_neg < tot_pos + tot_neg THEN struct_pack(c := fp * 100.0e0 + fn * 5000.0e0, s := s) END) AS threshold_cost,
  min(CASE WHEN cum_pos + cum_neg < tot_pos + tot_neg THEN fp * 100.0e0 + fn * 5000.0e0 END) AS min_cost
FROM th GROUP BY segment""")], "SELECT segment, {cols} FROM sel")


def _thr(spark, sf_dir, cols):
    t = M.thresholds(_scored(spark, sf_dir), by=["segment"])
    return round_doubles(t.select("segment", *cols))


@register("threshold_by_recall", _THRESH.replace("{cols}", "round(threshold_recall, 6) AS threshold_recall"))
def q_thr_recall(spark, sf_dir):
    """Highest threshold that still catches 80% of defaults."""
    return _thr(spark, sf_dir, ["threshold_recall"])


@register("threshold_by_precision", _THRESH.replace("{cols}", "round(threshold_precision, 6) AS threshold_precision"))
def q_thr_precision(spark, sf_dir):
    """I8: lowest threshold with precision >= 0.9 (NULL when none)."""
    return _thr(spark, sf_dir, ["threshold_precision"])


@register("threshold_by_cost", _THRESH.replace("{cols}", "round(threshold_cost, 6) AS threshold_cost, round(min_cost, 2) AS min_cost"))
def q_thr_cost(spark, sf_dir):
    """Cheapest threshold at 100 per FP and 5000 per FN (highest score excluded)."""
    t = M.thresholds(_scored(spark, sf_dir), by=["segment"])
    return t.select("segment", F.round("threshold_cost", 6).alias("threshold_cost"), F.round("min_cost", 2).alias("min_cost"))


# ------------------------------------------------------------ error analysis
EF_SQL = """
SELECT s.application_id, s.segment, s.y AS y_true, s.pd_score AS y_pred_proba,
  CASE WHEN s.pd_score >= 0.5e0 THEN 1 ELSE 0 END AS y_pred,
  CASE WHEN (CASE WHEN s.pd_score >= 0.5e0 THEN 1 ELSE 0 END) <> s.y THEN 1 ELSE 0 END AS error,
  CASE WHEN s.pd_score >= 0.5e0 AND s.y = 0 THEN 'FP' WHEN s.pd_score < 0.5e0 AND s.y = 1 THEN 'FN' ELSE 'correct' END AS error_type,
  a.credit_score, a.loan_amount, a.income, a.dti_ratio, a.interest_rate, a.employment_years, a.num_open_accounts,
  CASE WHEN a.income > 0 THEN a.loan_amount / a.income END AS loan_to_income
FROM scored_r s LEFT JOIN applications_v a ON a.application_id = s.application_id"""
Q5 = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]"
QE_SQL = (f"SELECT quantile_cont(loan_amount, {Q5}) AS le, quantile_cont(income, {Q5}) AS ie, "
          f"quantile_cont(abs(y_pred_proba - 0.5e0), {Q5}) AS ce FROM ef")


def _qcut_sql(x: str, e: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {x} <= {e}[{i + 2}] AND {x} >= {e}[1] THEN '{lab}'" for i, lab in enumerate(M.BUCKET_LABELS)) + " END"


def _cut_sql(x: str, edges, labels) -> str:
    return "CASE " + " ".join(
        f"WHEN {x} > {lo}e0 AND {x} <= {hi}e0 THEN '{lab}'" for lo, hi, lab in zip(edges[:-1], edges[1:], labels)) + " END"


EB_SQL = (f"SELECT ef.*, {_cut_sql('credit_score', M.CREDIT_EDGES, M.CREDIT_LABELS)} AS credit_bucket, "
          f"{_cut_sql('dti_ratio', M.DTI_EDGES, M.BUCKET_LABELS)} AS dti_bucket, "
          f"{_qcut_sql('loan_amount', 'qe.le')} AS loan_bucket, {_qcut_sql('income', 'qe.ie')} AS income_bucket, "
          f"{_qcut_sql('abs(y_pred_proba - 0.5e0)', 'qe.ce')} AS confidence_bucket FROM ef, qe")
EA = [("ef", EF_SQL), ("qe", QE_SQL), ("eb", EB_SQL)]


def _ef(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    apps = fx.applications
    raw = apps.select("application_id", "credit_score", "loan_amount", "income", "dti_ratio", "interest_rate",
                      "employment_years", "num_open_accounts",
                      F.when(F.col("income") > 0, F.col("loan_amount") / F.col("income")).alias("loan_to_income"))
    # Validation rows enriched with raw columns; names are chosen so none clash.
    # The analysis table feeds several bucketings: written once to the shared folder.
    return cut_lineage(M.error_frame(_scored(spark, sf_dir).join(raw, "application_id", "left")))


@register("raw_enrich", with_ctes(["scored_r", "applications_v"], [("ef", EF_SQL)],
                                  "SELECT application_id, segment, y_true, round(y_pred_proba, 6) AS y_pred_proba, "
                                  "round(credit_score, 6) AS credit_score, round(loan_amount, 4) AS loan_amount, "
                                  "round(income, 4) AS income FROM ef"))
def q_raw_enrich(spark, sf_dir):
    """Scored rows left-joined with raw application columns."""
    e = _ef(spark, sf_dir)
    return e.select("application_id", "segment", "y_true", F.round("y_pred_proba", 6).alias("y_pred_proba"),
                    F.round("credit_score", 6).alias("credit_score"), F.round("loan_amount", 4).alias("loan_amount"),
                    F.round("income", 4).alias("income"))


@register("confusion_matrix", with_ctes(["scored_r", "applications_v"], [("ef", EF_SQL)], """
SELECT tn, fp, fn, tp, round(CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp * 1.0e0 / (tp + fn) END, 6) AS recall,
  round(CASE WHEN fp + tn > 0 THEN fp * 1.0e0 / (fp + tn) END, 6) AS fpr,
  round(CASE WHEN fn + tp > 0 THEN fn * 1.0e0 / (fn + tp) END, 6) AS fnr
FROM (SELECT count(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 END) AS tn, count(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 END) AS fp,
  count(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 END) AS fn, count(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 END) AS tp FROM ef) t"""))
def q_confusion(spark, sf_dir):
    """Confusion matrix and rates at threshold 0.5."""
    return round_doubles(M.confusion(_ef(spark, sf_dir)))


@register("error_type", with_ctes(["scored_r", "applications_v"], [("ef", EF_SQL)],
                                  "SELECT application_id, y_pred, error, error_type FROM ef"))
def q_error_type(spark, sf_dir):
    """Correct / FP / FN per scored loan."""
    return _ef(spark, sf_dir).select("application_id", "y_pred", "error", "error_type")


@register("error_by_bucket", with_ctes(["scored_r", "applications_v"], EA, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {b} AS bucket, round(avg(error), 3) AS error_rate, count(*) AS count, "
    f"round(avg(y_true), 3) AS default_rate FROM eb WHERE {b} IS NOT NULL GROUP BY {b}"
    for f, b in [("credit_score", "credit_bucket"), ("loan_amount", "loan_bucket"), ("income", "income_bucket"),
                 ("dti_ratio", "dti_bucket")])))
def q_error_by_bucket(spark, sf_dir):
    """I12 (with G8 quintiles and G9 cut points): error rate by feature bucket."""
    return M.error_by_bucket(M.with_error_buckets(_ef(spark, sf_dir), ["loan_amount", "income"]))


@register("error_feature_means", with_ctes(["scored_r", "applications_v"], [("ef", EF_SQL)],
                                           "SELECT error_type, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in K.ERROR_FEATURES)
                                           + " FROM ef GROUP BY error_type"))
def q_error_means(spark, sf_dir):
    """Feature means of FP, FN and correct rows."""
    return round_doubles(M.error_feature_means(_ef(spark, sf_dir)))


CROSS_SQL = ("SELECT credit_bucket, loan_bucket, round(avg(error), 3) AS error_rate, count(*) AS count, "
             "round(avg(y_true), 3) AS default_rate FROM eb WHERE credit_bucket IS NOT NULL AND loan_bucket IS NOT NULL "
             "GROUP BY credit_bucket, loan_bucket")


@register("worst_segments", with_ctes(["scored_r", "applications_v"], EA + [("x", CROSS_SQL)],
                                      "SELECT * FROM x WHERE count >= 100 AND error_rate > 0.30 "
                                      "ORDER BY error_rate DESC, credit_bucket, loan_bucket LIMIT 10"))
def q_worst_segments(spark, sf_dir):
    """The ten worst credit x loan cells (count >= 100, error > 30%)."""
    return M.worst_segments(M.with_error_buckets(_ef(spark, sf_dir), ["loan_amount"]))


@register("error_pivot", with_ctes(["scored_r", "applications_v"], EA + [("x", CROSS_SQL)],
                                   "SELECT credit_bucket, " + ", ".join(
                                       f"max(CASE WHEN loan_bucket = '{b}' THEN error_rate END) AS \"{b}\"" for b in M.BUCKET_LABELS)
                                   + " FROM x WHERE count >= 100 GROUP BY credit_bucket"))
def q_error_pivot(spark, sf_dir):
    """Error rate pivoted by loan bucket."""
    return M.error_pivot(M.with_error_buckets(_ef(spark, sf_dir), ["loan_amount"]))


@register("confidence_buckets", with_ctes(["scored_r", "applications_v"], EA,
                                          "SELECT confidence_bucket, round(avg(error), 3) AS error_rate, count(*) AS count "
                                          "FROM eb WHERE confidence_bucket IS NOT NULL GROUP BY confidence_bucket"))
def q_confidence(spark, sf_dir):
    """I16: error rate by quintile of |p - 0.5|."""
    return M.confidence_buckets(M.with_error_buckets(_ef(spark, sf_dir), ["confidence"]))


@register("segment_errors", with_ctes(["scored_r", "applications_v"], [("ef", EF_SQL)],
                                      "SELECT segment, round(avg(error), 6) AS error_rate, round(avg(y_true), 6) AS default_rate, "
                                      "count(*) AS n FROM ef GROUP BY segment"))
def q_segment_errors(spark, sf_dir):
    """Error and default rate per segment."""
    return round_doubles(M.segment_errors(_ef(spark, sf_dir)))


PERF_SQL = with_ctes(["scored_r"], [
    ("pv", "SELECT *, 'batch:' || segment || ':logistic' AS model_version, CASE WHEN application_date <= DATE '1998-12-31' "
           "THEN 'baseline' WHEN application_date <= DATE '1999-12-31' THEN 'val' ELSE 'current' END AS period FROM scored_r"),
    ("sc0", "SELECT model_version, period, pd_score AS s, sum(y) AS pos, sum(1 - y) AS neg FROM pv GROUP BY 1, 2, 3"),
    ("sc", "SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER g AS tot_pos, "
           "sum(neg) OVER g AS tot_neg FROM sc0 WINDOW w AS (PARTITION BY model_version, period ORDER BY s ROWS UNBOUNDED PRECEDING), "
           "g AS (PARTITION BY model_version, period)"),
    ("th", "SELECT *, tot_pos - (cum_pos - pos) AS tp, tot_neg - (cum_neg - neg) AS fp FROM sc"),
    ("m", f"""SELECT model_version, period, CAST(max(tot_pos) + max(tot_neg) AS BIGINT) AS n,
  CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN sum(pos * (cum_neg - 0.5e0 * neg)) / (max(tot_pos) * max(tot_neg)) END AS auc_roc,
  CASE WHEN max(tot_pos) > 0 THEN sum(pos * {_prec}) / max(tot_pos) END AS auc_pr,
  sum(pos * (s - 1.0e0) * (s - 1.0e0) + neg * s * s) / (max(tot_pos) + max(tot_neg)) AS brier,
  CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN max(abs(cum_pos * 1.0e0 / tot_pos - cum_neg * 1.0e0 / tot_neg)) ELSE 0.0e0 END AS ks
  FROM th GROUP BY model_version, period"""),
], """SELECT c.model_version, c.period, c.n, round(c.auc_roc, 6) AS auc_roc, round(c.auc_pr, 6) AS auc_pr,
  round(c.brier, 6) AS brier, round(c.ks, 6) AS ks, round(b.auc_roc, 6) AS baseline_auc,
  (b.auc_roc - c.auc_roc > 0.03e0 AND c.n >= 100) AS alert
FROM m c LEFT JOIN m b ON b.model_version = c.model_version AND b.period = 'baseline' WHERE c.period <> 'baseline'""")


@register("performance_check", PERF_SQL)
def q_performance_check(spark, sf_dir):
    """AUC/PR/Brier/KS per model version and period against the baseline period."""
    s = _scored(spark, sf_dir)
    s = s.withColumn("model_version", F.concat(F.lit("batch:"), F.col("segment"), F.lit(":logistic"))) \
        .withColumn("period", F.when(F.col("application_date") <= F.to_date(F.lit("1998-12-31")), "baseline")
                    .when(F.col("application_date") <= F.to_date(F.lit("1999-12-31")), "val").otherwise("current"))
    return round_doubles(M.performance_check(s))
