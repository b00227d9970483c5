"""Queries for request validation, leakage and table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import quality as Q
from ..sources import fixtures
from .catalog import register
from .oracle_views import with_ctes
from .q_features import TE_CUTOFF, features_snapshot_df
from . import oracle_features as OF

T1, T2 = "1998-12-31", "1999-12-31"

_RULES_SQL = [
    ("loan_amount>0", "loan_amount > 0"), ("income>0", "income > 0"),
    ("loan_term in [12,84]", "loan_term BETWEEN 12 AND 84"), ("interest_rate in [0,50]", "interest_rate BETWEEN 0 AND 50"),
    ("employment_years in [0,50]", "employment_years BETWEEN 0 AND 50"),
    ("credit_score in [300,850]", "credit_score BETWEEN 300 AND 850 AND credit_score = floor(credit_score)"),
    ("dti_ratio in [0,100]", "dti_ratio BETWEEN 0 AND 100"), ("num_open_accounts>=0", "num_open_accounts >= 0"),
    ("num_delinquencies>=0", "num_delinquencies >= 0"), ("total_credit_limit>=0", "total_credit_limit >= 0"),
    ("home_ownership allowed", "upper(home_ownership) IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER')"),
    ("purpose present", "purpose IS NOT NULL"), ("application_id present", "application_id IS NOT NULL"),
]
_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in _RULES_SQL) + ")"


@register("request_validate", with_ctes(["applications_v"], [], f"""
SELECT application_id, {_FAILED} = '' AS is_valid, {_FAILED} AS failed_rules,
  CASE WHEN {_FAILED} = '' THEN upper(home_ownership) END AS home_ownership_norm FROM applications_v"""))
def q_request_validate(spark, sf_dir):
    """Every loan checked as a scoring request; failed rule names (empty when valid)."""
    a = fixtures.load(spark, sf_dir).applications
    valid, refused = Q.validate_requests(a)
    v = valid.select("application_id", F.lit(True).alias("is_valid"), F.lit("").alias("failed_rules"),
                     F.col("home_ownership").alias("home_ownership_norm"))
    r = refused.select("application_id", F.lit(False).alias("is_valid"), F.concat_ws(",", "failed_rules").alias("failed_rules"),
                       F.lit(None).cast("string").alias("home_ownership_norm"))
    return v.unionByName(r)


@register("overlap_check", with_ctes(["applications_v"], [], f"""
SELECT count(*) AS overlap_count FROM (SELECT application_id FROM applications_v WHERE application_date <= DATE '{T1}'
  INTERSECT SELECT application_id FROM applications_v WHERE application_date > DATE '{T2}') t"""))
def q_overlap(spark, sf_dir):
    """H4: train/test id overlap (must be 0)."""
    return Q.overlap_check(fixtures.load(spark, sf_dir).applications, T1, T2)


@register("future_payments_check", with_ctes(["applications_v", "payments_v"], [], """
SELECT count(CASE WHEN p.payment_date >= a.application_date THEN 1 END) AS future_payments
FROM payments_v p JOIN applications_v a ON a.application_id = p.application_id"""))
def q_future_payments(spark, sf_dir):
    """H5: payments on or after the loan date (the fixture's line items include them)."""
    fx = fixtures.load(spark, sf_dir)
    return Q.future_payments_check(fx.applications, fx.payments)


@register("validate_applications", with_ctes(["applications_v"], [("s", """
SELECT count(*) AS n, count(CASE WHEN loan_amount <= 0 THEN 1 END) AS bad_loan,
  count(CASE WHEN income IS NULL THEN 1 END) * 1.0e0 / greatest(count(*), 1) AS null_rate,
  avg(CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END) AS tr,
  count(*) - count(DISTINCT (client_id, application_date)) AS dup,
  CAST(min(application_date) AS VARCHAR) || '/' || CAST(max(application_date) AS VARCHAR) AS dr FROM applications_v""")], """
SELECT 'missing_columns' AS "check", 'ok' AS severity, 0.0e0 AS value, CAST(NULL AS VARCHAR) AS detail FROM s
UNION ALL SELECT 'loan_amount<=0', CASE WHEN bad_loan > 0 THEN 'error' ELSE 'ok' END, bad_loan, NULL FROM s
UNION ALL SELECT 'income_null_rate', CASE WHEN null_rate > 0.3 THEN 'error' WHEN null_rate > 0.1 THEN 'warning' ELSE 'ok' END, round(null_rate, 6), NULL FROM s
UNION ALL SELECT 'target_rate', CASE WHEN n = 0 THEN 'ok' WHEN tr < 0.01 THEN 'warning' WHEN tr > 0.5 THEN 'warning' ELSE 'ok' END, round(tr, 6), NULL FROM s
UNION ALL SELECT 'duplicates', CASE WHEN dup > 0 THEN 'warning' ELSE 'ok' END, dup, NULL FROM s
UNION ALL SELECT 'row_count', 'info', n, NULL FROM s
UNION ALL SELECT 'date_range', 'info', NULL, dr FROM s"""))
def q_validate_applications(spark, sf_dir):
    """H6: raw application checks over the whole table (one aggregation pass)."""
    return round_doubles(Q.applications(fixtures.load(spark, sf_dir).applications))


@register("validate_features", with_ctes(["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF), """
SELECT 'nulls:loan_to_income' AS "check", CASE WHEN count(CASE WHEN loan_to_income IS NULL THEN 1 END) > 0 THEN 'error' ELSE 'ok' END AS severity,
  CAST(count(CASE WHEN loan_to_income IS NULL THEN 1 END) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM snapshot
UNION ALL SELECT 'nulls:credit_utilization', CASE WHEN count(CASE WHEN credit_utilization IS NULL THEN 1 END) > 0 THEN 'error' ELSE 'ok' END,
  count(CASE WHEN credit_utilization IS NULL THEN 1 END), NULL FROM snapshot
UNION ALL SELECT 'nulls:income_log', CASE WHEN count(CASE WHEN income_log IS NULL THEN 1 END) > 0 THEN 'error' ELSE 'ok' END,
  count(CASE WHEN income_log IS NULL THEN 1 END), NULL FROM snapshot
UNION ALL SELECT 'range:loan_to_income', CASE WHEN count(CASE WHEN loan_to_income < 0 OR loan_to_income > 1000 THEN 1 END) > 0 THEN 'warning' ELSE 'ok' END,
  count(CASE WHEN loan_to_income < 0 OR loan_to_income > 1000 THEN 1 END), NULL FROM snapshot
UNION ALL SELECT 'row_count_min', CASE WHEN count(*) < 1 THEN 'error' ELSE 'ok' END, count(*), NULL FROM snapshot"""))
def q_validate_features(spark, sf_dir):
    """H7: snapshot checks (critical NULLs, loan_to_income range, minimum rows)."""
    return Q.features(features_snapshot_df(spark, sf_dir))


@register("duplicates", with_ctes(["applications_v"], [],
                                  "SELECT count(*) - count(DISTINCT (client_id, application_date)) AS duplicates FROM applications_v"))
def q_duplicates(spark, sf_dir):
    """H8: loans beyond the first per (client, date)."""
    return Q.duplicates(fixtures.load(spark, sf_dir).applications)
