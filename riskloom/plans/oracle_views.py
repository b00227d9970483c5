"""DuckDB text of the loan views and shared CTE blocks for the oracle SQL.

The view bodies are the fixed data-model definitions (same as
``riskloom.sources.fixtures``); only the base tables exist in the oracle, so
each oracle query inlines what it needs as CTEs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "applications_v": """
SELECT o_orderkey AS application_id, o_custkey AS client_id,
  CAST(o_orderdate AS DATE) AS application_date,
  o_totalprice / 10.0e0 AS loan_amount,
  CASE WHEN c_acctbal > 0 THEN c_acctbal * 10.0e0 END AS income,
  CAST(CASE WHEN o_orderkey % 10 < 7 THEN 36 ELSE 60 END AS INT) AS loan_term,
  5.0e0 + (o_orderkey % 200) / 10.0e0 AS interest_rate,
  CAST(o_orderkey % 11 AS DOUBLE) AS employment_years,
  c_mktsegment AS home_ownership, o_orderpriority AS purpose,
  ((o_orderkey * 13) % 1200) / 10.0e0 AS dti_ratio,
  CAST(300 + (o_orderkey * 37) % 620 AS DOUBLE) AS credit_score,
  CAST(o_orderkey % 23 AS INT) AS num_open_accounts,
  CAST(o_orderkey % 4 AS INT) AS num_delinquencies,
  CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice / 5.0e0 ELSE 0.0e0 END AS total_credit_limit,
  CAST(o_orderkey % 6 AS INT) AS num_inquiries_6m,
  (o_orderstatus = 'F') AS is_default
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "payments_v": """
SELECT l_orderkey AS application_id, CAST(l_shipdate AS DATE) AS payment_date,
  l_extendedprice AS amount_due, l_extendedprice * (1.0e0 - l_discount) AS amount_paid,
  CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS INT) AS days_overdue
FROM lineitem WHERE l_orderkey % 2 = 0""",
    "bureau_v": """
SELECT o_orderkey AS bureau_id, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS report_date,
  CAST(o_orderkey % 5 AS INT) AS num_inquiries_6m, CAST(o_orderkey % 7 AS INT) AS num_active_loans,
  o_totalprice AS total_balance, CAST(12 + o_orderkey % 228 AS INT) AS oldest_account_months
FROM orders""",
    "scored_v": """
SELECT application_id, application_date, is_default, CASE WHEN is_default THEN 1 ELSE 0 END AS y,
  1.0e0 / (1.0e0 + exp(-(-3.0e0 + 0.03e0 * dti_ratio - 0.004e0 * (credit_score - 600.0e0)
    + CASE WHEN is_default THEN 0.6e0 ELSE 0.0e0 END))) AS pd_score,
  CASE WHEN has_history THEN 'with_history' ELSE 'cold_start' END AS segment
FROM (SELECT a.*, EXISTS (SELECT 1 FROM payments_v p WHERE p.application_id = a.application_id)
  AS has_history FROM applications_v a) t""",
    "raw_loans_v": """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS member_id,
  CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS loan_amnt,
  CASE WHEN o_orderkey % 10 < 7 THEN ' 36 months' WHEN o_orderkey % 10 < 9 THEN ' 60 months' ELSE 'n/a' END AS term,
  concat(CAST(5 + o_orderkey % 25 AS VARCHAR), '.5%') AS int_rate,
  CASE WHEN c_acctbal > 0 THEN concat(CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR), ',000') ELSE 'nan' END AS annual_inc,
  CASE o_orderkey % 5 WHEN 0 THEN '10+ years' WHEN 1 THEN '< 1 year' WHEN 2 THEN '3 years' WHEN 3 THEN 'n/a' ELSE NULL END AS emp_length,
  CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE lower(c_mktsegment) END AS home_ownership,
  concat(' ', o_orderpriority, ' ') AS purpose,
  substr('ABCDEFG?', CAST(1 + o_orderkey % 8 AS INT), 1) AS grade,
  CAST(600 + o_orderkey % 250 AS VARCHAR) AS fico_range_low,
  CAST(604 + o_orderkey % 250 AS VARCHAR) AS fico_range_high,
  concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3),
         '-', CAST(year(o_orderdate) AS VARCHAR)) AS issue_d,
  CASE o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'P' THEN 'Late (31-120 days)' ELSE 'Fully Paid' END AS loan_status
FROM orders JOIN customer ON c_custkey = o_custkey""",
}

VIEWS["raw_dirty_v"] = """
SELECT CASE WHEN CAST(id AS BIGINT) % 499 = 0 THEN concat('Total Loans ', id) ELSE id END AS id,
  member_id,
  loan_amnt,
  '1' AS funded_amnt,
  term,
  int_rate,
  annual_inc,
  emp_length,
  home_ownership,
  purpose,
  grade,
  fico_range_low,
  fico_range_high,
  CASE CAST(id AS BIGINT) % 6 WHEN 0 THEN '1999-05-17' WHEN 1 THEN 'soon' WHEN 2 THEN NULL ELSE issue_d END AS issue_d,
  loan_status,
  CASE WHEN CAST(id AS BIGINT) % 9 = 0 THEN NULL ELSE CAST(CAST(id AS BIGINT) % 700 AS VARCHAR) END AS open_acc,
  CASE WHEN CAST(id AS BIGINT) % 8 = 0 THEN 'nan' ELSE CAST(CAST(id AS BIGINT) % 300 AS VARCHAR) END AS delinq_2yrs,
  concat(CAST(CAST(id AS BIGINT) % 1300 AS VARCHAR), '.7') AS total_acc,
  CAST(CAST(id AS BIGINT) % 120 - 5 AS VARCHAR) AS pub_rec_bankruptcies,
  CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN 'x' ELSE CAST(CAST(id AS BIGINT) % 60 AS VARCHAR) END AS inq_last_6mths,
  CASE CAST(id AS BIGINT) % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN NULL ELSE 'default' END AS is_default
FROM raw_loans_v"""

VIEWS["scored_r"] = """
SELECT application_id, application_date, is_default, y, round(pd_score, 10) AS pd_score, segment FROM scored_v"""

DEPS = {"raw_dirty_v": ["raw_loans_v"], "scored_v": ["applications_v", "payments_v"], "scored_r": ["applications_v", "payments_v", "scored_v"]}


def clip(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN ({x}) < {lo} THEN {lo} WHEN ({x}) > {hi} THEN {hi} ELSE ({x}) END)"


def with_ctes(views: list[str], extra: list[tuple[str, str]], body: str) -> str:
    """``WITH`` the named views (and their dependencies) plus extra (name, sql) CTEs."""
    names: list[str] = []
    for v in views:
        for d in DEPS.get(v, []) + [v]:
            if d not in names:
                names.append(d)
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in names] + [f"{n} AS ({q}\n)" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
