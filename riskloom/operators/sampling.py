"""Ordering, sampling, splits and schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import orderstat
from .metrics import cut, qcut  # noqa: F401  (G8, G9 live with the error analysis)


def top_recent(df: DataFrame, n: int, date_col: str = "application_date", id_col: str = "application_id") -> DataFrame:
    """G1: newest ``n`` rows by (date, id) descending (TakeOrderedAndProject, a top-k)."""
    return df.orderBy(F.col(date_col).desc(), F.col(id_col).desc()).limit(n)


def hash_order(id_col: str = "application_id", seed: int = 42) -> Column:
    """Default seeded random order (replaces the unseeded ORDER BY random())."""
    return F.xxhash64(F.col(id_col), F.lit(seed))


def portable_order(id_col: str = "application_id") -> Column:
    """Integer hash every SQL engine computes alike: (id * 7919 + 104729) % 1000003."""
    return (F.col(id_col) * 7919 + 104729) % 1000003


def random_sample_ids(df: DataFrame, n: int, order: Column | None = None, id_col: str = "application_id") -> DataFrame:
    """``n`` pseudo-random ids: order by a hash, then id; take ``n`` (a sampling operator)."""
    o = hash_order(id_col) if order is None else order
    return df.select(id_col).orderBy(o, F.col(id_col)).limit(n)


def fe_ids(applications: DataFrame, payments: DataFrame, n: int, order: Column | None = None,
           id_col: str = "application_id") -> DataFrame:
    """Every loan with history topped up with random cold-start loans to ``n``; a
    sample of the history loans when they alone reach ``n``; random loans when there is
    no history at all.  One id set for all feature tasks."""
    hist = payments.select(id_col).distinct()
    n_hist = hist.count()
    if n_hist == 0:
        return random_sample_ids(applications, n, order, id_col)
    if n_hist >= n:
        return random_sample_ids(hist, n, order, id_col)
    cold = applications.select(id_col).join(hist, id_col, "left_anti")  # E5
    return hist.unionByName(random_sample_ids(cold, n - n_hist, order, id_col))


def cold_start_ids(applications: DataFrame, payments: DataFrame, id_col: str = "application_id") -> DataFrame:
    """E5: loans without any payment row (anti join, not a null-aware NOT IN)."""
    return applications.select(id_col).join(payments.select(id_col), id_col, "left_anti")


def segment_flag(applications: DataFrame, payments: DataFrame, id_col: str = "application_id") -> DataFrame:
    """has_history = the loan id appears in the payments (membership, not a feature value)."""
    hist = payments.select(id_col).distinct().withColumn("_h", F.lit(True))
    return applications.join(hist, id_col, "left").withColumn("has_history", F.col("_h").isNotNull()).drop("_h")


# ---------------------------------------------------------------- splits
def time_split(df: DataFrame, train_end: str, val_end: str, date_col: str = "application_date",
               out: str = "split") -> DataFrame:
    """H1: train <= t1 < val <= t2 < test, as one label column in one pass."""
    d = F.col(date_col)
    return df.withColumn(out, F.when(d <= F.to_date(F.lit(train_end)), "train")
                         .when(d <= F.to_date(F.lit(val_end)), "val").otherwise("test"))


def auto_cuts(df: DataFrame, q_train: float = 0.70, q_val: float = 0.85, date_col: str = "application_date") -> DataFrame:
    """H2: linear quantiles of the dates cut to the day, one row (train_end, val_end)."""
    days = df.select(F.unix_date(F.col(date_col).cast("date")).cast("double").alias("d"))
    q = orderstat.exact_quantiles(days, "d", [q_train, q_val])
    to_day = lambda p: F.date_from_unix_date(F.floor(F.max(F.when(F.col("p") == p, F.col("q")))).cast("int"))
    return q.agg(to_day(float(q_train)).alias("train_end"), to_day(float(q_val)).alias("val_end"))


def split_summary(df: DataFrame, label: str = "is_default", date_col: str = "application_date",
                  split_col: str = "split") -> DataFrame:
    """H3: size, label rate and date range per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("size"), F.avg(F.col(label).cast("double")).alias("target_rate"),
        F.min(date_col).alias("date_min"), F.max(date_col).alias("date_max"))


# ---------------------------------------------------------------- folds
def time_series_folds(df: DataFrame, max_folds: int = 5, date_col: str = "application_date",
                      id_col: str = "application_id") -> DataFrame:
    """Expanding time-series folds over (date, id) order; k = min(5, max(2, n // 50)),
    test size n // (k + 1).  Adds ``row_idx`` and ``test_fold`` (NULL: never a test row)."""
    n = df.count()
    k = min(max_folds, max(2, n // 50))
    ts = n // (k + 1)
    idx = orderstat.row_index(df, [date_col, id_col])
    first = n - k * ts
    fold = F.when(F.col("row_idx") >= first, F.floor((F.col("row_idx") - first) / ts).cast("int"))
    return idx.withColumn("test_fold", fold).withColumn("n_folds", F.lit(k)).withColumn("fold_size", F.lit(ts))


def nested_sizes(df: DataFrame, sizes: Sequence[int], order: Column | None = None,
                 id_col: str = "application_id") -> DataFrame:
    """Nested training subsets: a row belongs to every size above its random rank.
    Returns the rows with ``rank`` and the smallest ``size`` that includes them."""
    o = hash_order(id_col) if order is None else order
    ranked = orderstat.row_index(df.withColumn("_o", o), ["_o", id_col], out="rank").drop("_o")
    sz = sorted(int(s) for s in sizes)
    smallest = None
    for s in sz:
        smallest = F.when(F.col("rank") < s, F.lit(s)) if smallest is None else smallest.when(F.col("rank") < s, F.lit(s))
    return ranked.withColumn("min_size", smallest)


# ---------------------------------------------------------------- L1
def instalment_schedule(applications: DataFrame, n_max: int = 12, offset_days: Column | None = None) -> DataFrame:
    """L1: per loan n = min(12, term) monthly due dates before the loan date with equal dues.

    Due date m (0-based) = loan date - (n - m) months - offset days; due =
    clip(loan / n, 0, 1e9) rounded to cents as floor(x * 100 + 0.5) / 100 (plain IEEE
    operations, the same in every engine; it can differ from a correctly rounded
    binary value only on exact half cents).  The generator's random parts (offset,
    lateness) are not built; the offset is a column (default 1 + id % 30).
    """
    term = F.coalesce(F.col("loan_term").cast("int"), F.lit(36))
    n = F.least(F.lit(n_max), F.greatest(term, F.lit(1)))
    off = (F.lit(1) + F.col("application_id") % 30).cast("int") if offset_days is None else offset_days
    monthly = F.col("loan_amount").cast("double") / n
    monthly = F.when(monthly < 0, 0.0).when(monthly > 1e9, 1e9).otherwise(monthly)
    base = applications.select("application_id", "application_date", n.alias("n_pay"), off.alias("off"),
                               F.coalesce(monthly, F.lit(0.0)).alias("monthly"))
    rows = base.select("*", F.explode(F.sequence(F.lit(0), F.col("n_pay") - 1)).alias("m"))
    return rows.select(
        "application_id", "m",
        F.date_sub(F.add_months("application_date", -(F.col("n_pay") - F.col("m"))), F.col("off")).alias("payment_date"),
        (F.floor(F.col("monthly") * 100.0 + 0.5) / 100.0).alias("amount_due"))
