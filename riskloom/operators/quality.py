"""Data quality: request validation, leakage checks and table validation.

Checks come back as a (check, severity, value) DataFrame built by one
aggregation pass, never as driver-side loops over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K

def request_rules() -> list[tuple[str, Column]]:
    """A9 rules of the scoring request (name, predicate)."""
    return [
        ("loan_amount>0", F.col("loan_amount") > 0),
        ("income>0", F.col("income") > 0),
        ("loan_term in [12,84]", F.col("loan_term").between(12, 84)),
        ("interest_rate in [0,50]", F.col("interest_rate").between(0, 50)),
        ("employment_years in [0,50]", F.col("employment_years").between(0, 50)),
        ("credit_score in [300,850]", F.col("credit_score").between(300, 850) & (F.col("credit_score") == F.floor("credit_score"))),
        ("dti_ratio in [0,100]", F.col("dti_ratio").between(0, 100)),
        ("num_open_accounts>=0", F.col("num_open_accounts") >= 0),
        ("num_delinquencies>=0", F.col("num_delinquencies") >= 0),
        ("total_credit_limit>=0", F.col("total_credit_limit") >= 0),
        ("home_ownership allowed", F.upper(F.col("home_ownership")).isin(*K.HOME_OWNERSHIP_ALLOWED)),
        ("purpose present", F.col("purpose").isNotNull()),
        ("application_id present", F.col("application_id").isNotNull()),
    ]


def request_failures(rules: Sequence[tuple[str, Column]] | None = None) -> Column:
    """Array of the names of the rules a row fails (a NULL field fails its rule)."""
    rules = request_rules() if rules is None else rules
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules]))


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, refused).  Valid rows get upper-case home_ownership and trimmed lower-case
    purpose; refused rows carry ``failed_rules``."""
    tagged = df.withColumn("failed_rules", request_failures())
    valid = tagged.where(F.size("failed_rules") == 0).drop("failed_rules") \
        .withColumn("home_ownership", F.upper(F.col("home_ownership"))) \
        .withColumn("purpose", F.lower(F.trim(F.col("purpose"))))
    refused = tagged.where(F.size("failed_rules") > 0)
    return valid, refused


def overlap_check(df: DataFrame, train_end: str, val_end: str, date_col: str = "application_date",
                  id_col: str = "application_id") -> DataFrame:
    """H4: number of ids both in train (<= t1) and test (> t2); must be 0."""
    d = F.col(date_col)
    train = df.where(d <= F.to_date(F.lit(train_end))).select(id_col)
    test = df.where(d > F.to_date(F.lit(val_end))).select(id_col)
    return train.intersect(test).agg(F.count(F.lit(1)).alias("overlap_count"))


def future_payments_check(applications: DataFrame, payments: DataFrame) -> DataFrame:
    """H5: payments on or after their loan date; must be 0 for leakage-free history."""
    a = applications.select("application_id", "application_date")
    j = payments.select("application_id", "payment_date").join(a, "application_id", "inner")
    return j.agg(F.count(F.when(F.col("payment_date") >= F.col("application_date"), 1)).alias("future_payments"))


def _check(name: str, severity: Column, value: Column, detail: Column | None = None) -> Column:
    return F.struct(F.lit(name).alias("check"), severity.alias("severity"), value.cast("double").alias("value"),
                    (detail if detail is not None else F.lit(None).cast("string")).alias("detail"))


REQUIRED_APPLICATION_COLUMNS = ["client_id", "application_date", "loan_amount", "income", "is_default"]


def duplicates(df: DataFrame, keys: Sequence[str] = ("client_id", "application_date")) -> DataFrame:
    """H8: rows beyond the first per key (count - count distinct key)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"))


def applications(df: DataFrame) -> DataFrame:
    """H6: raw application checks over the whole table in one pass -> (check, severity, value, detail).

    loan <= 0 is an error; NULL income above 30% an error, above 10% a warning;
    default rate below 1% or above 50% a warning; duplicate (client, date) a
    warning; row count, target rate and date range are reported as info.
    """
    missing = [c for c in REQUIRED_APPLICATION_COLUMNS if c not in df.columns]
    has = lambda c: c in df.columns
    n = F.count(F.lit(1))
    checks = [_check("missing_columns", F.lit("error" if missing else "ok"), F.lit(len(missing)),
                     F.lit(",".join(missing) if missing else None))]
    if has("loan_amount"):
        bad = F.count(F.when(F.col("loan_amount") <= 0, 1))
        checks.append(_check("loan_amount<=0", F.when(bad > 0, "error").otherwise("ok"), bad))
    if has("income"):
        rate = F.count(F.when(F.col("income").isNull(), 1)) / F.greatest(n, F.lit(1))
        checks.append(_check("income_null_rate", F.when(rate > 0.3, "error").when(rate > 0.1, "warning").otherwise("ok"), rate))
    if has("is_default"):
        tr = F.avg(F.col("is_default").cast("double"))
        checks.append(_check("target_rate", F.when(n == 0, "ok").when(tr < 0.01, "warning").when(tr > 0.5, "warning").otherwise("ok"), tr))
    if has("client_id") and has("application_date"):
        dup = n - F.count_distinct(F.struct("client_id", "application_date"))
        checks.append(_check("duplicates", F.when(dup > 0, "warning").otherwise("ok"), dup))
    checks.append(_check("row_count", F.lit("info"), n))
    if has("application_date"):
        checks.append(_check("date_range", F.lit("info"), F.lit(None),
                             F.concat_ws("/", F.min("application_date").cast("string"), F.max("application_date").cast("string"))))
    return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))


def features(df: DataFrame, critical: Sequence[str] = K.CRITICAL_NO_NULL,
             ranges: dict | None = None, row_count_min: int = 1) -> DataFrame:
    """H7: NULLs in critical features are errors, range violations warnings, too few rows an error."""
    ranges = {"loan_to_income": (0, 1000)} if ranges is None else ranges
    n = F.count(F.lit(1))
    checks = []
    for c in critical:
        if c in df.columns:
            k = F.count(F.when(F.col(c).isNull(), 1))
            checks.append(_check(f"nulls:{c}", F.when(k > 0, "error").otherwise("ok"), k))
    for c, (lo, hi) in ranges.items():
        if c in df.columns:
            k = F.count(F.when((F.col(c) < lo) | (F.col(c) > hi), 1))
            checks.append(_check(f"range:{c}", F.when(k > 0, "warning").otherwise("ok"), k))
    checks.append(_check("row_count_min", F.when(n < row_count_min, "error").otherwise("ok"), n))
    return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))
