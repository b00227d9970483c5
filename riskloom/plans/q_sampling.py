"""Queries for ordering, sampling, splits, folds, buckets and schedules
(G1-G9, H1-H3, H9, H10, E4-E6, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import round_doubles
from ..operators import features as fe
from ..operators import metrics as M
from ..operators import sampling as S
from ..sources import fixtures
from .catalog import register
from .oracle_views import with_ctes

HASH_SQL = "(application_id * 7919 + 104729) % 1000003"
N_FE = 10000
T1, T2 = "1998-12-31", "1999-12-31"


def _apps(spark, sf_dir):
    return fixtures.load(spark, sf_dir).applications


@register("top_recent", with_ctes(["applications_v"], [], """
SELECT application_id, application_date FROM applications_v ORDER BY application_date DESC, application_id DESC LIMIT 100"""))
def q_top_recent(spark, sf_dir):
    """G1: the 100 newest loans (top-k report)."""
    return S.top_recent(_apps(spark, sf_dir).select("application_id", "application_date"), 100)


@register("random_sample_ids", with_ctes(["applications_v"], [],
                                         f"SELECT application_id FROM applications_v ORDER BY {HASH_SQL}, application_id LIMIT 500"))
def q_random_sample(spark, sf_dir):
    """500 pseudo-random loans by the portable integer hash (a sampling operator)."""
    return S.random_sample_ids(_apps(spark, sf_dir), 500, S.portable_order())


FE_IDS_SQL = with_ctes(["applications_v", "payments_v"], [
    ("hist", "SELECT DISTINCT application_id FROM payments_v"),
    ("nh", "SELECT count(*) AS c FROM hist"),
    ("hist_r", f"SELECT application_id, row_number() OVER (ORDER BY {HASH_SQL}, application_id) AS rn FROM hist"),
    ("cold_r", f"SELECT application_id, row_number() OVER (ORDER BY {HASH_SQL}, application_id) AS rn FROM applications_v "
               "WHERE application_id NOT IN (SELECT application_id FROM hist)"),
    ("all_r", f"SELECT application_id, row_number() OVER (ORDER BY {HASH_SQL}, application_id) AS rn FROM applications_v"),
    ("fe_ids", f"""
SELECT application_id FROM all_r, nh WHERE nh.c = 0 AND rn <= {N_FE}
UNION ALL SELECT application_id FROM hist_r, nh WHERE nh.c >= {N_FE} AND rn <= {N_FE}
UNION ALL SELECT application_id FROM hist_r, nh WHERE nh.c > 0 AND nh.c < {N_FE}
UNION ALL SELECT application_id FROM cold_r, nh WHERE nh.c > 0 AND nh.c < {N_FE} AND rn <= {N_FE} - nh.c"""),
], "SELECT application_id FROM fe_ids")


def fe_ids_df(spark, sf_dir):
    fx = fixtures.load(spark, sf_dir)
    return S.fe_ids(fx.applications, fx.payments, N_FE, S.portable_order())


@register("select_fe_ids", FE_IDS_SQL)
def q_fe_ids(spark, sf_dir):
    """History loans topped up with random cold-start loans to 10,000 ids."""
    return fe_ids_df(spark, sf_dir)


@register("fe_ids_semi", FE_IDS_SQL.replace("SELECT application_id FROM fe_ids", "") + """
SELECT a.application_id, round(CASE WHEN a.income > 0 THEN a.loan_amount / a.income END, 6) AS loan_to_income
FROM applications_v a WHERE a.application_id IN (SELECT application_id FROM fe_ids)""")
def q_fe_ids_semi(spark, sf_dir):
    """A feature task restricted to the fe_ids set by a left-semi join."""
    num = fe.numerical(_apps(spark, sf_dir)).select("application_id", "loan_to_income")
    return round_doubles(num.join(fe_ids_df(spark, sf_dir), "application_id", "left_semi"))


@register("cold_start_anti", with_ctes(["applications_v", "payments_v"], [], """
SELECT application_id FROM applications_v a WHERE NOT EXISTS (SELECT 1 FROM payments_v p WHERE p.application_id = a.application_id)"""))
def q_cold_start(spark, sf_dir):
    """E5: loans without payment history (left anti join)."""
    fx = fixtures.load(spark, sf_dir)
    return S.cold_start_ids(fx.applications, fx.payments)


@register("segment_flag", with_ctes(["applications_v", "payments_v"], [], """
SELECT application_id, application_id IN (SELECT application_id FROM payments_v) AS has_history FROM applications_v"""))
def q_segment_flag(spark, sf_dir):
    """has_history flag by membership in the payments."""
    fx = fixtures.load(spark, sf_dir)
    return S.segment_flag(fx.applications.select("application_id"), fx.payments)


@register("time_split", with_ctes(["applications_v"], [], f"""
SELECT application_id, CASE WHEN application_date <= DATE '{T1}' THEN 'train' WHEN application_date <= DATE '{T2}' THEN 'val'
  ELSE 'test' END AS split FROM applications_v"""))
def q_time_split(spark, sf_dir):
    """H1: train <= 1998-12-31 < val <= 1999-12-31 < test."""
    return S.time_split(_apps(spark, sf_dir), T1, T2).select("application_id", "split")


@register("auto_date_cuts", with_ctes(["applications_v"], [], """
SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(CAST(application_date - DATE '1970-01-01' AS DOUBLE), 0.70)) AS INT) AS train_end,
  DATE '1970-01-01' + CAST(floor(quantile_cont(CAST(application_date - DATE '1970-01-01' AS DOUBLE), 0.85)) AS INT) AS val_end
FROM applications_v"""))
def q_auto_cuts(spark, sf_dir):
    """H2: 70% / 85% date quantiles cut to the day."""
    return S.auto_cuts(_apps(spark, sf_dir))


@register("split_summary", with_ctes(["applications_v"], [], f"""
SELECT split, count(*) AS size, round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 6) AS target_rate,
  min(application_date) AS date_min, max(application_date) AS date_max
FROM (SELECT *, CASE WHEN application_date <= DATE '{T1}' THEN 'train' WHEN application_date <= DATE '{T2}' THEN 'val'
  ELSE 'test' END AS split FROM applications_v) t GROUP BY split"""))
def q_split_summary(spark, sf_dir):
    """H3: size, default rate and date range per split."""
    return round_doubles(S.split_summary(S.time_split(_apps(spark, sf_dir), T1, T2)))


@register("time_series_folds", with_ctes(["applications_v"], [
    ("nk", "SELECT n, k, n // (k + 1) AS ts FROM (SELECT count(*) AS n, least(5, greatest(2, count(*) // 50)) AS k FROM applications_v) t"),
    ("ix", "SELECT application_id, row_number() OVER (ORDER BY application_date, application_id) - 1 AS row_idx FROM applications_v"),
], """SELECT application_id, row_idx, CAST(CASE WHEN row_idx >= n - k * ts THEN floor((row_idx - (n - k * ts)) / ts) END AS INT) AS test_fold
FROM ix, nk"""))
def q_folds(spark, sf_dir):
    """Expanding time-series folds (row index by bucketed prefix count, fold by arithmetic)."""
    f = S.time_series_folds(_apps(spark, sf_dir).select("application_id", "application_date"))
    return f.select("application_id", "row_idx", "test_fold")


SIZES = [1000, 2000, 5000, 10000]


@register("nested_sizes", with_ctes(["applications_v"], [], f"""
SELECT application_id, rank, CASE {' '.join(f'WHEN rank < {s} THEN {s}' for s in SIZES)} END AS min_size
FROM (SELECT application_id, row_number() OVER (ORDER BY {HASH_SQL}, application_id) - 1 AS rank FROM applications_v) t"""))
def q_nested_sizes(spark, sf_dir):
    """Nested learning-curve subsets (rank under the portable hash; smallest size holding the row)."""
    r = S.nested_sizes(_apps(spark, sf_dir).select("application_id"), SIZES, S.portable_order())
    return r.select("application_id", "rank", "min_size")


Q5 = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]"


@register("quantile_bucket", with_ctes(["applications_v"], [("qe", f"SELECT quantile_cont(loan_amount, {Q5}) AS e FROM applications_v")],
                                       "SELECT application_id, CASE " + " ".join(
                                           f"WHEN loan_amount <= e[{i + 2}] AND loan_amount >= e[1] THEN '{lab}'"
                                           for i, lab in enumerate(M.BUCKET_LABELS)) + " END AS loan_bucket FROM applications_v, qe"))
def q_quantile_bucket(spark, sf_dir):
    """Loan amount quintiles (pandas qcut semantics)."""
    a = _apps(spark, sf_dir).select("application_id", "loan_amount")
    return M.qcut(a, "loan_amount", M.BUCKET_LABELS, "loan_bucket").select("application_id", "loan_bucket")


@register("fixed_bucket", with_ctes(["applications_v"], [], "SELECT application_id, CASE " + " ".join(
    f"WHEN dti_ratio > {lo}e0 AND dti_ratio <= {hi}e0 THEN '{lab}'"
    for lo, hi, lab in zip(M.DTI_EDGES[:-1], M.DTI_EDGES[1:], M.BUCKET_LABELS)) + " END AS dti_bucket FROM applications_v"))
def q_fixed_bucket(spark, sf_dir):
    """Right-closed cut points for dti; outside to NULL."""
    a = _apps(spark, sf_dir)
    return a.select("application_id", M.cut(F.col("dti_ratio"), M.DTI_EDGES, M.BUCKET_LABELS).alias("dti_bucket"))


@register("instalment_schedule", with_ctes(["applications_v"], [], """
SELECT application_id, CAST(m AS INT) AS m, CAST(application_date - to_months(n_pay - m) - to_days(CAST(off AS INT)) AS DATE) AS payment_date,
  floor((CASE WHEN monthly < 0 THEN 0.0e0 WHEN monthly > 1.0e9 THEN 1.0e9 ELSE monthly END) * 100.0e0 + 0.5e0) / 100.0e0 AS amount_due
FROM (SELECT application_id, application_date, least(12, greatest(coalesce(loan_term, 36), 1)) AS n_pay, 1 + application_id % 30 AS off,
  coalesce(loan_amount / least(12, greatest(coalesce(loan_term, 36), 1)), 0.0e0) AS monthly FROM applications_v) a,
  LATERAL (SELECT unnest(range(0, n_pay)) AS m) r"""))
def q_instalments(spark, sf_dir):
    """L1: the fixed part of the payment schedule: min(12, term) monthly dues before the loan date."""
    return S.instalment_schedule(_apps(spark, sf_dir))


@register("stable_window", with_ctes(["applications_v"], [], """
SELECT count(*) AS n, round(avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END), 6) AS default_rate FROM applications_v
WHERE application_date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30'"""))
def q_stable_window(spark, sf_dir):
    """Loans of the stable period only (1996-01..1999-06 on this data)."""
    a = _apps(spark, sf_dir)
    f = a.where(F.col("application_date").between(F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("1999-06-30"))))
    return round_doubles(f.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("is_default"), 1.0).otherwise(0.0)).alias("default_rate")))


@register("union_segments", with_ctes(["scored_v"], [], """
SELECT application_id, segment, 'batch:with_history:logistic' AS model_version, round(pd_score, 6) AS pd_score FROM scored_v WHERE segment = 'with_history'
UNION ALL SELECT application_id, segment, 'batch:cold_start:logistic', round(pd_score, 6) FROM scored_v WHERE segment = 'cold_start'"""))
def q_union_segments(spark, sf_dir):
    """H9: each segment scored on its own, then concatenated by name."""
    s = fixtures.load(spark, sf_dir).scored
    parts = [s.where(F.col("segment") == seg).select("application_id", "segment", F.lit(f"batch:{seg}:logistic").alias("model_version"),
                                                      F.round("pd_score", 6).alias("pd_score"))
             for seg in ("with_history", "cold_start")]
    return parts[0].unionByName(parts[1])
