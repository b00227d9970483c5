"""DuckDB CTE blocks for the feature operators (oracle side of the checks)."""

from __future__ import annotations

from .. import constants as K
from .oracle_views import clip

F0 = "0.0e0"


def num_select(src: str = "applications_v", extra: str = "") -> str:
    """C1-C9 over a relation with the applications columns (absent vendor columns act as NULL)."""
    norm = clip("(credit_score - 300.0e0) / 550.0e0", "0.0e0", "1.0e0")
    dti0 = "coalesce(dti_ratio, 0.0e0)"
    lab = K.DTI_BUCKET_LABELS
    e = K.DTI_BUCKET_EDGES
    dti_b = (f"CASE WHEN dti_ratio <= {e[0]} THEN '{lab[0]}' WHEN dti_ratio <= {e[1]} THEN '{lab[1]}' "
             f"WHEN dti_ratio <= {e[2]} THEN '{lab[2]}' WHEN dti_ratio <= {e[3]} THEN '{lab[3]}' "
             f"WHEN dti_ratio IS NOT NULL THEN '{lab[4]}' ELSE 'nan' END")
    ce = K.CREDIT_SCORE_BUCKET_EDGES
    cl = K.CREDIT_SCORE_BUCKET_LABELS
    cs_b = "CASE " + " ".join(
        f"WHEN credit_score > {lo} AND credit_score <= {hi} THEN '{lab_}'" for lo, hi, lab_ in zip(ce[:-1], ce[1:], cl)
    ) + " ELSE 'nan' END"
    return f"""
SELECT application_id, application_date AS feature_date,
  CASE WHEN income > 0 THEN loan_amount / income END AS loan_to_income,
  CASE WHEN total_credit_limit > 0 THEN loan_amount / total_credit_limit END AS credit_utilization,
  ln(1 + CASE WHEN income < 0 THEN 0.0e0 ELSE income END) AS income_log,
  ln(1 + CASE WHEN loan_amount < 0 THEN 0.0e0 ELSE loan_amount END) AS loan_amount_log,
  {clip('dti_ratio', '0.0e0', '100.0e0')} AS dti_ratio_clipped,
  coalesce(CAST(employment_years AS DOUBLE), 0.0e0) AS employment_years,
  {norm} AS credit_score_norm,
  coalesce(CAST(num_open_accounts AS DOUBLE), 0.0e0) AS num_open_accounts,
  coalesce(CAST(num_delinquencies AS DOUBLE), 0.0e0) AS num_delinquencies,
  CAST(interest_rate AS DOUBLE) AS interest_rate,
  {clip('coalesce(CAST(loan_term AS DOUBLE), 36.0e0)', '12.0e0', '84.0e0')} AS loan_term,
  {clip('coalesce(CAST(num_inquiries_6m AS DOUBLE), 0.0e0)', '0.0e0', '50.0e0')} AS num_inquiries_6m,
  0.0e0 AS revolving_utilization,
  0.0e0 AS total_accounts_log,
  0.0e0 AS revolving_balance_log,
  0.0e0 AS has_bankruptcy,
  3.0e0 AS grade,
  {clip(f'loan_amount * {dti0}', '-1.0e12', '1.0e12')} AS loan_amount_x_dti,
  {clip('income * coalesce(credit_score, 0.0e0)', '-1.0e12', '1.0e12')} AS income_x_credit_score,
  {clip(f'{dti0} * {norm}', '-1.0e6', '1.0e6')} AS dti_x_credit_score,
  {clip('loan_amount * coalesce(interest_rate, 0.0e0)', '-1.0e12', '1.0e12')} AS loan_amount_x_interest_rate,
  {dti_b} AS dti_bucket,
  {cs_b} AS credit_score_bucket{extra}
FROM {src}"""


def payments_join(days: int = 180) -> str:
    return f"""
SELECT a.application_id, a.application_date, p.payment_date, p.amount_paid, p.days_overdue
FROM applications_v a JOIN payments_v p ON p.application_id = a.application_id
  AND p.payment_date < a.application_date AND p.payment_date >= a.application_date - INTERVAL {days} DAY"""


def windows_select(windows=K.PAYMENT_WINDOWS, src: str = "pw", canonical_only: bool = False) -> str:
    cols = []
    for n in windows:
        inw = f"payment_date >= application_date - INTERVAL {n} DAY"
        cnt = f"count(CASE WHEN {inw} THEN 1 END)"
        std = f"stddev_samp(CASE WHEN {inw} THEN days_overdue END)"
        c = {
            f"avg_days_overdue_{n}d": f"avg(CASE WHEN {inw} THEN days_overdue END)",
            f"max_days_overdue_{n}d": f"CAST(max(CASE WHEN {inw} THEN days_overdue END) AS DOUBLE)",
            f"total_paid_{n}d": f"CASE WHEN {cnt} > 0 THEN coalesce(sum(CASE WHEN {inw} THEN amount_paid END), 0.0e0) END",
            f"num_payments_{n}d": f"CASE WHEN {cnt} > 0 THEN count(CASE WHEN {inw} THEN amount_paid END) END",
            f"std_days_overdue_{n}d": std,
            f"pct_late_payments_{n}d": f"CASE WHEN {cnt} > 0 THEN count(CASE WHEN {inw} AND days_overdue > 0 THEN 1 END) / {cnt} END",
            f"payment_consistency_{n}d": f"CASE WHEN {cnt} > 0 THEN {clip(f'1.0e0 - coalesce({std}, 0.0e0) / 90.0e0', '0.0e0', '1.0e0')} END",
        }
        for name, expr in c.items():
            if not canonical_only or name in K.AGGREGATION_FEATURES:
                cols.append(f"  {expr} AS {name}")
    return "SELECT application_id,\n" + ",\n".join(cols) + f"\nFROM {src} GROUP BY application_id"


BUREAU_ASOF = """
SELECT application_id, client_id, application_date, bureau_id, report_date, num_inquiries_6m,
  num_active_loans, total_balance, oldest_account_months, income
FROM (SELECT a.application_id, a.client_id, a.application_date, a.income, b.bureau_id, b.report_date,
    b.num_inquiries_6m, b.num_active_loans, b.total_balance, b.oldest_account_months,
    row_number() OVER (PARTITION BY a.application_id ORDER BY b.report_date DESC NULLS LAST, b.bureau_id DESC NULLS LAST) AS rn
  FROM applications_v a LEFT JOIN bureau_v b ON b.client_id = a.client_id AND b.report_date < a.application_date) s
WHERE rn = 1"""

BUREAU_FEATURES = """
SELECT application_id,
  CASE WHEN income <> 0 THEN total_balance / income END AS bureau_balance_to_income,
  CASE WHEN num_active_loans <> 0 THEN CAST(num_inquiries_6m AS DOUBLE) / num_active_loans END AS inquiries_per_account,
  CAST(oldest_account_months AS DOUBLE) AS avg_account_age_months
FROM bureau_asof"""


def te_blocks(cutoff: str, src: str = "applications_v") -> list[tuple[str, str]]:
    y = "CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END"
    return [
        ("te_fit", f"SELECT * FROM {src} WHERE is_default IS NOT NULL AND application_date <= DATE '{cutoff}'"),
        ("te_mean", f"SELECT avg({y}) AS g FROM te_fit"),
        ("te_stats", " UNION ALL ".join(
            f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS cat, count(*) AS n, avg({y}) AS m FROM te_fit "
            f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in K.CATEGORICAL_FEATURES)),
        ("te_enc", f"SELECT col, cat, n, CASE WHEN n < {K.TE_MIN_SAMPLES} THEN g ELSE (m * n + g * {float(K.TE_SMOOTHING)}e0) "
                   f"/ (n + {float(K.TE_SMOOTHING)}e0) END AS enc FROM te_stats, te_mean"),
    ]


def snapshot_blocks(cutoff: str) -> list[tuple[str, str]]:
    feats = K.ALL_FEATURES + ["avg_account_age_months"]
    crit = K.CRITICAL_NO_NULL
    te_cols = ", ".join(
        f"coalesce(e_{c}.enc, (SELECT g FROM te_mean)) AS {c}_target_enc" for c in K.CATEGORICAL_FEATURES)
    te_joins = " ".join(
        f"LEFT JOIN te_enc e_{c} ON e_{c}.col = '{c}' AND e_{c}.cat = CAST(n.{c} AS VARCHAR)" for c in K.CATEGORICAL_FEATURES)
    fills = []
    for c in feats:
        if c in crit:
            fills.append(f"coalesce({c}, (SELECT med_{c} FROM med), 0.0e0) AS {c}")
        else:
            fills.append(f"coalesce({c}, 0.0e0) AS {c}")
    return [
        ("num", num_select(extra=", purpose, home_ownership")),
        *te_blocks(cutoff),
        ("pw", payments_join(max(K.PAYMENT_WINDOWS))),
        ("agg", windows_select(canonical_only=True)),
        ("bureau_asof", BUREAU_ASOF),
        ("bur", BUREAU_FEATURES),
        ("merged", f"SELECT n.*, {te_cols}, "
                   + ", ".join(f"agg.{c}" for c in K.AGGREGATION_FEATURES) + ", "
                   + ", ".join(f"bur.{c}" for c in K.BUREAU_FEATURES + ['avg_account_age_months'])
                   + f" FROM num n {te_joins} LEFT JOIN agg ON agg.application_id = n.application_id"
                   + " LEFT JOIN bur ON bur.application_id = n.application_id"),
        ("med", "SELECT " + ", ".join(f"median({c}) AS med_{c}" for c in crit) + " FROM num"),
        ("snapshot", "SELECT application_id, feature_date, 'v1.0' AS feature_version, "
                     + ", ".join(fills) + ", dti_bucket, credit_score_bucket FROM merged"),
    ]


def rounded_select(cols: list[str], src: str, digits: int = 6, passthrough: list[str] = ()) -> str:
    return "SELECT " + ", ".join(list(passthrough) + [f"round({c}, {digits}) AS {c}" for c in cols]) + f" FROM {src}"
