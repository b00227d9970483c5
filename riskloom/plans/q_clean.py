"""Queries for vendor cleaning (B1-B16) over raw_loans_v."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.expr import round_doubles
from ..operators import clean
from ..sources import fixtures
from .catalog import register
from .oracle_views import clip, with_ctes


def sql_num(x: str) -> str:
    s = f"trim(regexp_replace({x}, '[%,]', '', 'g'))"
    return (f"(CASE WHEN {s} IN ('', 'nan', 'None', 'NULL') THEN NULL WHEN isnan(TRY_CAST({s} AS DOUBLE)) THEN NULL "
            f"ELSE TRY_CAST({s} AS DOUBLE) END)")


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_t = "lower(trim(emp_length))"
_digits = f"regexp_replace({_t}, '[^0-9.]', '', 'g')"
_home = "upper(trim(home_ownership))"
_purp = "lower(trim(purpose))"
_loan = clip(sql_num("loan_amnt"), "0.0e0", "1.0e7")

PARSED_SQL = f"""
SELECT id AS external_id,
  CAST(coalesce(floor({sql_num('member_id')}), floor({sql_num('id')})) AS BIGINT) AS client_id,
  coalesce(CAST(try_strptime(trim(issue_d), '%b-%Y') AS DATE), CAST(try_strptime(trim(issue_d), '%Y-%m-%d') AS DATE),
           DATE '{K.DEFAULT_APPLICATION_DATE}') AS application_date,
  {_loan} AS loan_amount,
  CAST(floor({clip("coalesce(TRY_CAST(trim(replace(lower(term), 'months', '')) AS DOUBLE), 36.0e0)", '1.0e0', '120.0e0')}) AS INT) AS loan_term,
  {clip(sql_num('int_rate'), '0.0e0', '100.0e0')} AS interest_rate,
  {clip(sql_num('annual_inc'), '0.0e0', '1.0e8')} AS income,
  {clip(f"coalesce(CASE WHEN {_t} IN {_in(K.EMPLOYMENT_NULL_TOKENS)} THEN NULL WHEN starts_with({_t}, '<') THEN 0.5e0 "
        f"WHEN contains({_t}, '10') AND contains({_t}, '+') THEN 10.0e0 "
        f"ELSE CASE WHEN {_digits} <> '' THEN TRY_CAST({_digits} AS DOUBLE) END END, 0.0e0)", '0.0e0', '80.0e0')} AS employment_years,
  substr(CASE WHEN {_home} IS NULL OR {_home} IN {_in(K.HOME_OWNERSHIP_OTHER_TOKENS)} THEN 'OTHER' ELSE {_home} END, 1, 20) AS home_ownership,
  substr(CASE WHEN {_purp} IS NULL OR {_purp} IN {_in(K.PURPOSE_OTHER_TOKENS)} THEN 'other' ELSE {_purp} END, 1, 50) AS purpose,
  CAST(NULL AS DOUBLE) AS dti_ratio,
  {clip(f"({sql_num('fico_range_low')} + {sql_num('fico_range_high')}) / 2.0e0", '0.0e0', '1000.0e0')} AS credit_score,
  CAST(0 AS INT) AS num_open_accounts, CAST(0 AS INT) AS num_delinquencies,
  CAST(NULL AS DOUBLE) AS revolving_balance, CAST(NULL AS DOUBLE) AS revolving_utilization,
  CAST(0 AS INT) AS total_accounts, CAST(0 AS INT) AS pub_rec_bankruptcies,
  CAST(CASE WHEN length(upper(grade)) = 1 AND instr('{K.GRADES}', upper(grade)) > 0 THEN instr('{K.GRADES}', upper(grade)) ELSE 3 END AS INT) AS grade,
  {clip(f'{_loan} * 2.0e0', '0.0e0', '1.0e9')} AS total_credit_limit,
  CAST(0 AS INT) AS num_inquiries_6m,
  coalesce(loan_status IN {_in(K.DEFAULT_STATUSES)}, false) AS is_default,
  'vendor' AS data_source
FROM raw_loans_v
WHERE NOT coalesce(regexp_matches(id, '(?i)total|loans'), false)"""

PARSED_OUT = ", ".join(["external_id", "client_id", "application_date", "round(loan_amount, 4) AS loan_amount", "loan_term",
                        "round(interest_rate, 6) AS interest_rate", "round(income, 4) AS income",
                        "round(employment_years, 6) AS employment_years", "home_ownership", "purpose", "dti_ratio",
                        "round(credit_score, 6) AS credit_score", "num_open_accounts", "num_delinquencies",
                        "revolving_balance", "revolving_utilization", "total_accounts", "pub_rec_bankruptcies", "grade",
                        "round(total_credit_limit, 4) AS total_credit_limit", "num_inquiries_6m", "is_default",
                        "data_source"])
MONEY = {"loan_amount": 4, "income": 4, "total_credit_limit": 4}


@register("parse_vendor_fields", with_ctes(["raw_loans_v"], [("parsed", PARSED_SQL)], f"SELECT {PARSED_OUT} FROM parsed"))
def q_parse_vendor_fields(spark, sf_dir):
    """B1-B14 on every vendor row (rename, numeric cleaning, clips, term, employment,
    date, default flag, score midpoint, client id, categories, grade, counts, limit)."""
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(clean.parsed_fields(fx.raw_loans), overrides=MONEY)


def _count_sql(col: str, hi: str, bound_hi: str | None = None) -> str:
    v = sql_num(col)
    v = clip(v, "0.0e0", bound_hi) if bound_hi else v
    return f"CAST(floor({clip(f'coalesce({v}, 0.0e0)', '0.0e0', hi)}) AS INT)"


# the second vendor file: footer rows, ISO and unreadable dates, the five count columns, an explicit default flag
DIRTY_SQL = PARSED_SQL.replace("raw_loans_v", "raw_dirty_v") \
    .replace("CAST(0 AS INT) AS num_open_accounts", _count_sql("open_acc", "500.0e0", "500.0e0") + " AS num_open_accounts") \
    .replace("CAST(0 AS INT) AS num_delinquencies", _count_sql("delinq_2yrs", "200.0e0", "200.0e0") + " AS num_delinquencies") \
    .replace("CAST(0 AS INT) AS total_accounts", _count_sql("total_acc", "1000.0e0") + " AS total_accounts") \
    .replace("CAST(0 AS INT) AS pub_rec_bankruptcies", _count_sql("pub_rec_bankruptcies", "100.0e0") + " AS pub_rec_bankruptcies") \
    .replace("CAST(0 AS INT) AS num_inquiries_6m", _count_sql("inq_last_6mths", "50.0e0") + " AS num_inquiries_6m") \
    .replace(f"coalesce(loan_status IN {_in(K.DEFAULT_STATUSES)}, false) AS is_default", f"coalesce(lower(is_default) IN {_in(K.TRUE_TOKENS)}, false) AS is_default")


@register("parse_dirty_fields", with_ctes(["raw_dirty_v"], [("parsed", DIRTY_SQL)], f"SELECT {PARSED_OUT} FROM parsed"))
def q_parse_dirty_fields(spark, sf_dir):
    """B1 (a second column for one target), B2, B7 (ISO and default dates), B8 (explicit flag), B13 on every row of a
    dirtier vendor file."""
    return round_doubles(clean.parsed_fields(fixtures.load(spark, sf_dir).raw_dirty), overrides=MONEY)


@register("clean_applications", with_ctes(
    ["raw_loans_v"], [("parsed", PARSED_SQL)],
    f"SELECT {PARSED_OUT} FROM parsed WHERE loan_amount IS NOT NULL AND income IS NOT NULL "
    "AND application_date IS NOT NULL AND loan_amount > 0 AND income > 0"))
def q_clean_applications(spark, sf_dir):
    """Typed applications; rows without loan, income or date, or with
    non-positive amounts, are dropped."""
    fx = fixtures.load(spark, sf_dir)
    return round_doubles(clean.applications(fx.raw_loans), overrides=MONEY)


@register("drop_unusable", with_ctes(
    ["raw_loans_v"], [("parsed", PARSED_SQL)],
    "SELECT count(*) AS n_rows, count(CASE WHEN loan_amount IS NOT NULL AND income IS NOT NULL AND "
    "application_date IS NOT NULL AND loan_amount > 0 AND income > 0 THEN 1 END) AS n_kept, "
    "count(CASE WHEN loan_amount IS NULL THEN 1 END) AS n_no_loan, count(CASE WHEN income IS NULL THEN 1 END) AS n_no_income "
    "FROM parsed"))
def q_drop_unusable(spark, sf_dir):
    """B15 summary: vendor rows, kept rows, rows without loan amount / income."""
    fx = fixtures.load(spark, sf_dir)
    return clean.parsed_fields(fx.raw_loans).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(clean.usable()).alias("n_kept"),
        F.count_if(F.col("loan_amount").isNull()).alias("n_no_loan"), F.count_if(F.col("income").isNull()).alias("n_no_income"))


@register("drop_footer", with_ctes(
    ["raw_dirty_v"], [],
    "SELECT count(*) AS n_kept FROM raw_dirty_v WHERE NOT coalesce(regexp_matches(id, '(?i)total|loans'), false)"))
def q_drop_footer(spark, sf_dir):
    """B2: rows left after the footer filter."""
    fx = fixtures.load(spark, sf_dir)
    return clean.drop_footer(fx.raw_dirty).agg(F.count(F.lit(1)).alias("n_kept"))


@register("candidate_columns", with_ctes(
    ["raw_loans_v"], [("parsed", PARSED_SQL)],
    "SELECT feature FROM (VALUES " + ", ".join(
        f"('{c}')" for c in ["loan_amount", "loan_term", "interest_rate", "income", "employment_years", "dti_ratio",
                             "credit_score", "num_open_accounts", "num_delinquencies", "revolving_balance",
                             "revolving_utilization", "total_accounts", "pub_rec_bankruptcies", "grade",
                             "total_credit_limit", "num_inquiries_6m"]) + ") t(feature) WHERE (SELECT count(*) FROM parsed) > 0"))
def q_candidate_columns(spark, sf_dir):
    """Numeric, non-id, non-leakage columns of the cleaned vendor table (schema-driven)."""
    fx = fixtures.load(spark, sf_dir)
    p = clean.parsed_fields(fx.raw_loans)
    cols = clean.candidate_columns(p)
    # the list is a function of the schema; it is emitted only when the table has rows
    n = p.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    return n.select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
