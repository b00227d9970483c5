"""Loan-shaped views over the driver's TPC-H-like tables.

The driver's tables are orders/customer/lineitem; the loan pipeline needs
applications, payments, bureau reports, scores and a raw vendor file.  These
views derive all five from the base tables, so every job's work grows with the
data.  The derivations are fixed (they define the test data model) and are
mirrored by the DuckDB text in ``riskloom.plans.oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import Tables


def applications(t: Tables) -> DataFrame:
    """applications_v: one loan per order, income from the customer balance."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                        "o_orderpriority", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("application_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("application_date"),
        (F.col("o_totalprice") / 10.0).alias("loan_amount"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 10.0).alias("income"),
        F.when(k % 10 < 7, 36).otherwise(60).cast("int").alias("loan_term"),
        (F.lit(5.0) + (k % 200) / 10.0).alias("interest_rate"),
        (k % 11).cast("double").alias("employment_years"),
        F.col("c_mktsegment").alias("home_ownership"),
        F.col("o_orderpriority").alias("purpose"),
        (((k * 13) % 1200) / 10.0).alias("dti_ratio"),
        (F.lit(300) + (k * 37) % 620).cast("double").alias("credit_score"),
        (k % 23).cast("int").alias("num_open_accounts"),
        (k % 4).cast("int").alias("num_delinquencies"),
        F.when(k % 50 != 0, F.col("o_totalprice") / 5.0).otherwise(0.0).alias("total_credit_limit"),
        (k % 6).cast("int").alias("num_inquiries_6m"),
        (F.col("o_orderstatus") == "F").alias("is_default"),
    )


def payments(t: Tables) -> DataFrame:
    """payments_v: line items of even orders are the instalment history."""
    li = t.lineitem
    return li.where(F.col("l_orderkey") % 2 == 0).select(
        F.col("l_orderkey").alias("application_id"),
        F.col("l_shipdate").cast("date").alias("payment_date"),
        F.col("l_extendedprice").alias("amount_due"),
        (F.col("l_extendedprice") * (1.0 - F.col("l_discount"))).alias("amount_paid"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0).cast("int").alias("days_overdue"),
    )


def bureau(t: Tables) -> DataFrame:
    """bureau_v: every order is also a bureau report of its customer."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("bureau_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        (k % 5).cast("int").alias("num_inquiries_6m"),
        (k % 7).cast("int").alias("num_active_loans"),
        F.col("o_totalprice").alias("total_balance"),
        (F.lit(12) + k % 228).cast("int").alias("oldest_account_months"),
    )


def history_ids(pay: DataFrame) -> DataFrame:
    """Distinct loans with at least one payment row (partial aggregation first)."""
    return pay.select("application_id").distinct()


def scored(t: Tables) -> DataFrame:
    """scored_v: a deterministic logistic score and the history segment."""
    apps = applications(t)
    hist = history_ids(payments(t)).withColumn("_hist", F.lit(True))
    logit = (F.lit(-3.0) + 0.03 * F.col("dti_ratio") - 0.004 * (F.col("credit_score") - 600.0)
             + F.when(F.col("is_default"), 0.6).otherwise(0.0))
    return apps.join(hist, "application_id", "left").select(
        "application_id", "application_date", "is_default",
        F.when(F.col("is_default"), 1).otherwise(0).alias("y"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).alias("pd_score"),
        F.when(F.col("_hist").isNotNull(), "with_history").otherwise("cold_start").alias("segment"),
    )


def raw_loans(t: Tables) -> DataFrame:
    """raw_loans_v: the vendor file as all-string columns, with its dirt."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                        "o_orderpriority", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS member_id",
        "CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS loan_amnt",
        "CASE WHEN o_orderkey % 10 < 7 THEN ' 36 months' WHEN o_orderkey % 10 < 9 THEN ' 60 months' ELSE 'n/a' END AS term",
        "concat(CAST(5 + o_orderkey % 25 AS STRING), '.5%') AS int_rate",
        "CASE WHEN c_acctbal > 0 THEN concat(CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING), ',000') ELSE 'nan' END AS annual_inc",
        "CASE o_orderkey % 5 WHEN 0 THEN '10+ years' WHEN 1 THEN '< 1 year' WHEN 2 THEN '3 years' WHEN 3 THEN 'n/a' ELSE NULL END AS emp_length",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE lower(c_mktsegment) END AS home_ownership",
        "concat(' ', o_orderpriority, ' ') AS purpose",
        "substr('ABCDEFG?', CAST(1 + o_orderkey % 8 AS INT), 1) AS grade",
        "CAST(600 + o_orderkey % 250 AS STRING) AS fico_range_low",
        "CAST(604 + o_orderkey % 250 AS STRING) AS fico_range_high",
        "concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3), "
        "'-', CAST(year(o_orderdate) AS STRING)) AS issue_d",
        "CASE o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'P' THEN 'Late (31-120 days)' ELSE 'Fully Paid' END AS loan_status",
    )


def raw_dirty(t: Tables) -> DataFrame:
    """raw_dirty_v: raw_loans_v with footer rows, mixed dates, count columns, a second amount column and an explicit flag."""
    return raw_loans(t).selectExpr(
        "CASE WHEN CAST(id AS BIGINT) % 499 = 0 THEN concat('Total Loans ', id) ELSE id END AS id",
        "member_id", "loan_amnt", "'1' AS funded_amnt", "term", "int_rate", "annual_inc", "emp_length", "home_ownership", "purpose",
        "grade", "fico_range_low", "fico_range_high",
        "CASE CAST(id AS BIGINT) % 6 WHEN 0 THEN '1999-05-17' WHEN 1 THEN 'soon' WHEN 2 THEN NULL ELSE issue_d END AS issue_d",
        "loan_status",
        "CASE WHEN CAST(id AS BIGINT) % 9 = 0 THEN NULL ELSE CAST(CAST(id AS BIGINT) % 700 AS STRING) END AS open_acc",
        "CASE WHEN CAST(id AS BIGINT) % 8 = 0 THEN 'nan' ELSE CAST(CAST(id AS BIGINT) % 300 AS STRING) END AS delinq_2yrs",
        "concat(CAST(CAST(id AS BIGINT) % 1300 AS STRING), '.7') AS total_acc",
        "CAST(CAST(id AS BIGINT) % 120 - 5 AS STRING) AS pub_rec_bankruptcies",
        "CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN 'x' ELSE CAST(CAST(id AS BIGINT) % 60 AS STRING) END AS inq_last_6mths",
        "CASE CAST(id AS BIGINT) % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN NULL ELSE 'default' END AS is_default",
    )


class Fixtures:
    """The five loan views of one data directory."""

    def __init__(self, tables: Tables):
        self.t = tables

    @property
    def applications(self) -> DataFrame:
        return applications(self.t)

    @property
    def payments(self) -> DataFrame:
        return payments(self.t)

    @property
    def bureau(self) -> DataFrame:
        return bureau(self.t)

    @property
    def scored(self) -> DataFrame:
        return scored(self.t)

    @property
    def raw_loans(self) -> DataFrame:
        return raw_loans(self.t)

    @property
    def raw_dirty(self) -> DataFrame:
        return raw_dirty(self.t)


def load(spark, root: str) -> Fixtures:
    return Fixtures(Tables(spark, root))
