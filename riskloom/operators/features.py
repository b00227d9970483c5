"""Point-in-time loan features: row features, payment windows, as-of bureau
join, smoothed target encoding, snapshot merge and fills.

All functions take and return lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import constants as K
from ..functions.expr import clip, col_or_null, finite_or_null, log1p_clip, nullif_zero_ratio, right_closed_bucket, safe_ratio
from ..session import materialise
from . import orderstat


# --------------------------------------------------------------------- C rows
def dti_bucket(c):
    return right_closed_bucket(c, K.DTI_BUCKET_EDGES, K.DTI_BUCKET_LABELS, null_label=K.NULL_BUCKET_LABEL)


def credit_score_bucket(c):
    return right_closed_bucket(c, K.CREDIT_SCORE_BUCKET_EDGES, K.CREDIT_SCORE_BUCKET_LABELS,
                               null_label=K.NULL_BUCKET_LABEL, open_ends=False)


def numerical(df: DataFrame, mode: str = "batch", keep: Sequence[str] = ()) -> DataFrame:
    """Application-level numeric and cross features (C1-C9; C12 with mode='serving').

    A column the input lacks acts as NULL.  ``keep`` passes extra input columns through.
    """
    g = lambda name: col_or_null(df, name).cast("double")
    loan, income, limit_ = g("loan_amount"), g("income"), g("total_credit_limit")
    dti, credit, rate = g("dti_ratio"), g("credit_score"), g("interest_rate")
    score_norm = clip((credit - 300.0) / 550.0, 0.0, 1.0)
    if mode == "serving":
        cols = {
            "loan_to_income": safe_ratio(loan, income, F.lit(0.0)),
            "credit_utilization": safe_ratio(loan, limit_, F.lit(0.0)),
            "income_log": F.log1p(income),
            "loan_amount_log": F.log1p(loan),
            "dti_ratio_clipped": clip(dti, 0.0, 100.0),
            "employment_years": g("employment_years"),
            "credit_score_norm": score_norm,
            "num_open_accounts": g("num_open_accounts"),
            "num_delinquencies": g("num_delinquencies"),
            "interest_rate": rate,
            "loan_term": g("loan_term"),
            "num_inquiries_6m": F.lit(0.0),
            "loan_amount_x_dti": loan * dti,
            "income_x_credit_score": income * credit,
            "dti_x_credit_score": dti * score_norm,
            "loan_amount_x_interest_rate": loan * rate,
        }
    else:
        dti0 = F.coalesce(dti, F.lit(0.0))
        cols = {
            "loan_to_income": safe_ratio(loan, income),
            "credit_utilization": safe_ratio(loan, limit_),
            "income_log": log1p_clip(income),
            "loan_amount_log": log1p_clip(loan),
            "dti_ratio_clipped": clip(dti, 0.0, 100.0),
            "employment_years": F.coalesce(g("employment_years"), F.lit(0.0)),
            "credit_score_norm": score_norm,
            "num_open_accounts": F.coalesce(g("num_open_accounts"), F.lit(0.0)),
            "num_delinquencies": F.coalesce(g("num_delinquencies"), F.lit(0.0)),
            "interest_rate": rate,
            "loan_term": clip(F.coalesce(g("loan_term"), F.lit(36.0)), 12.0, 84.0),
            "num_inquiries_6m": clip(F.coalesce(g("num_inquiries_6m"), F.lit(0.0)), 0.0, 50.0),
            "revolving_utilization": F.coalesce(clip(g("revolving_utilization"), 0.0, 100.0), F.lit(0.0)),
            "total_accounts_log": log1p_clip(F.coalesce(g("total_accounts"), F.lit(0.0))),
            "revolving_balance_log": log1p_clip(F.coalesce(g("revolving_balance"), F.lit(0.0))),
            "has_bankruptcy": F.when(F.coalesce(g("pub_rec_bankruptcies"), F.lit(0.0)) > 0, 1.0).otherwise(0.0),
            "grade": clip(F.coalesce(g("grade"), F.lit(3.0)), 1.0, 7.0),
            "loan_amount_x_dti": clip(loan * dti0, -1e12, 1e12),
            "income_x_credit_score": clip(income * F.coalesce(credit, F.lit(0.0)), -1e12, 1e12),
            "dti_x_credit_score": clip(dti0 * score_norm, -1e6, 1e6),
            "loan_amount_x_interest_rate": clip(loan * F.coalesce(rate, F.lit(0.0)), -1e12, 1e12),
            "dti_bucket": dti_bucket(dti),
            "credit_score_bucket": credit_score_bucket(credit),
        }
    return df.select(
        F.col("application_id"),
        col_or_null(df, "application_date", "date").cast("date").alias("feature_date"),
        *[c.alias(name) for name, c in cols.items()],
        *[F.col(k) for k in keep],
    )


# --------------------------------------------------------- E1, F1, F2 windows
def _daily_payments(payments: DataFrame) -> DataFrame:
    """One row per (loan, payment day): counts and sums that every window needs.

    Map-side combine makes a loan with a huge history a handful of rows per day
    before any shuffle; the window predicates only look at the day.
    """
    od = F.col("days_overdue")
    return payments.groupBy("application_id", "payment_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("amount_paid").alias("n_paid"),
        F.sum("amount_paid").alias("s_paid"),
        F.count(od).alias("n_od"),
        F.sum(od.cast("double")).alias("s_od"),
        F.sum((od.cast("double") * od.cast("double"))).alias("q_od"),
        F.max(od).alias("m_od"),
        F.count(F.when(od > 0, F.lit(1))).alias("n_late"),
    )


def payments_in_lookback(payments: DataFrame, applications: DataFrame, days: int) -> DataFrame:
    """E1 + D3: payments joined to their loan, strictly before the loan date, within ``days``."""
    apps = applications.select("application_id", "application_date")
    cond = ((payments.application_id == apps.application_id)
            & (payments.payment_date < apps.application_date)
            & (payments.payment_date >= F.date_sub(apps.application_date, days)))
    return payments.join(apps, cond, "inner").drop(apps.application_id)


def payment_windows(payments: DataFrame, applications: DataFrame, windows: Sequence[int] = K.PAYMENT_WINDOWS,
                    keep_all: bool = False) -> DataFrame:
    """F1 (and F2 with keep_all): look-back payment aggregates per loan.

    Per window N: avg/max/sample-std of days_overdue, sum of amount_paid, count
    of non-null amount_paid, late share (late rows / rows), consistency
    clip(1 - coalesce(std, 0)/90, 0, 1).  A loan is kept when it has a payment in
    the widest window; its narrower-window columns are NULL when empty there.
    """
    windows = sorted(int(w) for w in windows)
    widest = windows[-1]
    daily = _daily_payments(payments)
    apps = applications.select("application_id", "application_date")
    j = payments_in_lookback(daily, apps, widest)
    aggs = []
    names = []
    for n in windows:
        inw = F.col("payment_date") >= F.date_sub(F.col("application_date"), n)
        s = lambda c: F.sum(F.when(inw, F.col(c)))
        aggs += [s("n_rows").alias(f"_rows_{n}"), s("n_paid").alias(f"_paid_{n}"), s("s_paid").alias(f"_spaid_{n}"),
                 s("n_od").alias(f"_nod_{n}"), s("s_od").alias(f"_sod_{n}"), s("q_od").alias(f"_qod_{n}"),
                 F.max(F.when(inw, F.col("m_od"))).alias(f"_mod_{n}"), s("n_late").alias(f"_late_{n}")]
    g = j.groupBy("application_id").agg(*aggs)
    out = [F.col("application_id")]
    for n in windows:
        rows, k = F.col(f"_rows_{n}"), F.col(f"_nod_{n}").cast("double")
        ssum, qsum = F.col(f"_sod_{n}"), F.col(f"_qod_{n}")
        present = rows > 0
        var = F.when(k >= 2, (k * qsum - ssum * ssum) / (k * (k - 1.0)))
        std = F.sqrt(F.when(var < 0, F.lit(0.0)).otherwise(var))
        cols = {
            f"avg_days_overdue_{n}d": F.when(k > 0, ssum / k),
            f"max_days_overdue_{n}d": F.col(f"_mod_{n}").cast("double"),
            f"total_paid_{n}d": F.when(present, F.coalesce(F.col(f"_spaid_{n}"), F.lit(0.0))),
            f"num_payments_{n}d": F.when(present, F.col(f"_paid_{n}")),
            f"std_days_overdue_{n}d": std,
            f"pct_late_payments_{n}d": F.when(present, F.col(f"_late_{n}") / rows),
            f"payment_consistency_{n}d": F.when(present, clip(1.0 - F.coalesce(std, F.lit(0.0)) / 90.0, 0.0, 1.0)),
        }
        out += [c.alias(name) for name, c in cols.items()]
        names += list(cols)
    res = g.select(*out)
    for c in K.AGGREGATION_FEATURES:  # canonical columns always exist
        if c not in res.columns:
            res = res.withColumn(c, F.lit(None).cast("double"))
    if keep_all:
        res = applications.select("application_id").dropDuplicates(["application_id"]).join(res, "application_id", "left")
    return res


# ------------------------------------------------------------------ E2, E3
BUREAU_COLS = ["bureau_id", "report_date", "num_inquiries_6m", "num_active_loans", "total_balance",
               "oldest_account_months"]


def bureau_asof(applications: DataFrame, reports: DataFrame, strategy: str = "timeline") -> DataFrame:
    """Latest report of the same client strictly before the loan date (left outer).

    Ties on report_date go to the highest bureau_id.

    ``timeline`` (default, skew-safe): loans and reports collapse together to
    one row per (client, day) by one hash aggregation, a per-client window over
    the days before carries the last report forward (so the match is strict),
    and the answer joins back on (client, day).  A client holding a third of
    all rows is still at most one row per distinct day in the window.

    ``max_by``: equi-join on client with ``report_date < application_date`` and
    ``max_by`` per loan; its intermediate size is loans x reports per client.
    """
    carry = [c for c in ("income",) if c in applications.columns]  # rides along for E3, no second join
    apps = applications.select("application_id", "client_id", "application_date", *carry)
    rep = reports.select("client_id", *BUREAU_COLS)
    rstruct = F.struct(*[F.col(c) for c in BUREAU_COLS])
    if strategy == "max_by":
        j = apps.join(rep, (apps.client_id == rep.client_id) & (rep.report_date < apps.application_date), "inner")
        best = j.groupBy("application_id").agg(
            F.max_by(rstruct, F.struct(rep.report_date, rep.bureau_id)).alias("r"))
        res = apps.join(best, "application_id", "left")
    else:
        values = [c for c in BUREAU_COLS if c not in ("bureau_id", "report_date")]
        loans = apps.select("client_id", F.col("application_date").alias("day"), F.lit(True).alias("loan"))
        both = loans.unionByName(rep.select("client_id", F.col("report_date").alias("day"), F.lit(False).alias("loan"), "bureau_id", *values),
                                 allowMissingColumns=True)
        # the latest report by column, not as one struct: such a buffer is hashed, a struct would be sorted
        days = both.groupBy("client_id", "day").agg(F.max("loan").alias("loan"), F.max("bureau_id").alias("bureau_id"),
                                                    *[F.max_by(c, "bureau_id").alias(c) for c in values])
        days = days.withColumn("report_date", F.col("day").cast(rep.schema["report_date"].dataType))
        w = Window.partitionBy("client_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        r = F.when(F.col("bureau_id").isNotNull(), rstruct)
        carried = days.select("client_id", "day", "loan", F.last(r, ignorenulls=True).over(w).alias("r")).where("loan").drop("loan")
        res = apps.join(carried, (apps.client_id == carried.client_id) & (apps.application_date == carried.day), "left") \
            .drop(carried.client_id).drop("day")
    return res.select("application_id", "client_id", "application_date", *carry,
                      *[F.col(f"r.{c}").alias(c) for c in BUREAU_COLS])


def bureau(applications: DataFrame, reports: DataFrame, strategy: str = "timeline") -> DataFrame:
    """E2 + E3: bureau ratios of the as-of report; zero denominators give NULL."""
    j = bureau_asof(applications, reports, strategy).withColumn("_income", col_or_null(applications, "income").cast("double")
                                                                if "income" not in applications.columns else F.col("income").cast("double"))
    return j.select(
        "application_id",
        finite_or_null(nullif_zero_ratio(F.col("total_balance").cast("double"), F.col("_income"))).alias("bureau_balance_to_income"),
        finite_or_null(nullif_zero_ratio(F.col("num_inquiries_6m").cast("double"), F.col("num_active_loans").cast("double"))).alias("inquiries_per_account"),
        F.col("oldest_account_months").cast("double").alias("avg_account_age_months"),
    )


# ------------------------------------------------------------- F3, F4, E9
def _category_long(df: DataFrame, cols: Sequence[str], target: str | None) -> DataFrame:
    extra = [F.col(target).cast("double").alias("_y")] if target else []
    return df.select(*extra, *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot(["_y"] if target else [], list(cols), "column", "category")


def target_fit(df: DataFrame, cols: Sequence[str] = K.CATEGORICAL_FEATURES, target: str = "is_default",
               smoothing: float = K.TE_SMOOTHING, min_samples: int = K.TE_MIN_SAMPLES) -> tuple[DataFrame, DataFrame]:
    """smoothed target means per category, all columns in one grouped job.

    encoded = (mean * n + g * s) / (n + s); categories with n < min_samples get
    the global mean g; a NULL category is not a category.  Returns
    (map(column, category, n, encoded), one-row mean(global_mean)).
    """
    labelled = df.where(F.col(target).isNotNull())
    mean = labelled.agg(F.avg(F.col(target).cast("double")).alias("global_mean"))
    stats = _category_long(labelled, cols, target).where(F.col("category").isNotNull()) \
        .groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_m"))
    g = mean.select("global_mean").scalar()  # one-row scalar subquery
    enc = stats.select(
        "column", "category", "n",
        F.when(F.col("n") < min_samples, g)
        .otherwise((F.col("_m") * F.col("n") + g * float(smoothing)) / (F.col("n") + float(smoothing))).alias("encoded"),
    )
    return enc, mean


def target_fit_fallback(df: DataFrame, cutoff: str, cols: Sequence[str] = K.CATEGORICAL_FEATURES,
                        target: str = "is_default", date_col: str = "application_date", **kw) -> tuple[DataFrame, DataFrame]:
    """fit on labelled rows dated <= cutoff; else on all labelled rows; else prior 0.15 and no map.

    Lazy: the choice is a scalar subquery (the count of rows up to the cutoff),
    so no job runs while the plan is built.
    """
    labelled = df.where(F.col(target).isNotNull())
    in_cut = F.col(date_col) <= F.to_date(F.lit(cutoff))
    n_cut = labelled.agg(F.count(F.when(in_cut, 1)).alias("n")).scalar()
    fit_rows = labelled.where(in_cut | (n_cut == 0))
    enc, mean = target_fit(fit_rows, cols, target, **kw)
    mean = mean.select(F.coalesce(F.col("global_mean"), F.lit(K.TE_PRIOR)).alias("global_mean"))
    return enc, mean


MAP_ROWS = 200_000  # rows of an encoding map that may be broadcast (about 10 MB)


def target_apply(df: DataFrame, enc: DataFrame, mean: DataFrame, cols: Sequence[str] = K.CATEGORICAL_FEATURES,
                 suffix: str = "_target_enc") -> DataFrame:
    """Category to its encoding, unseen or NULL category to the global mean.

    The map is written to the shared folder and its rows counted: up to ``MAP_ROWS`` rows it is broadcast, so the loans
    are not shuffled on a handful of category values; a larger map (many categories, hence no hot ones by necessity)
    is joined by a shuffle whose skew adaptive execution splits.
    """
    g = mean.select("global_mean").scalar()  # one-row scalar subquery
    enc = materialise(enc.select("column", "category", "encoded"), "encoding-map")
    small = enc.limit(MAP_ROWS + 1).count() <= MAP_ROWS
    out = df
    for c in cols:
        m = enc.where(F.col("column") == c).select(F.col("category").alias(f"_cat_{c}"), F.col("encoded").alias(f"_enc_{c}"))
        out = out.join(F.broadcast(m) if small else m, out[c].cast("string") == m[f"_cat_{c}"], "left") \
            .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_enc_{c}"), g)) \
            .drop(f"_cat_{c}", f"_enc_{c}")
    return out


def plain_target_mean(df: DataFrame, cols: Sequence[str], target: str = "is_default", max_levels: int = 50) -> DataFrame:
    """unsmoothed category means for columns with fewer than ``max_levels`` distinct values.

    Returns (column, category, n, target_mean); the distinct-count gate is part of the same plan.
    """
    long = _category_long(df.where(F.col(target).isNotNull()), cols, target).where(F.col("category").isNotNull())
    stats = long.groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("target_mean"))
    levels = stats.groupBy("column").agg(F.count(F.lit(1)).alias("_levels"))
    return stats.join(levels.where(F.col("_levels") < max_levels), "column", "left_semi")


# ----------------------------------------------------------------- F6, F7
def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """exact per-column medians (one distributed job for all columns): (feature, median)."""
    q = orderstat.wide_quantiles(df, cols, [0.5])
    return q.select("feature", F.col("q").alias("median"))


def fill_with(df: DataFrame, med: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """Replace NULLs of ``cols`` by the per-feature value in ``med`` (else ``default``)."""
    # one scalar subquery holding a struct with a field per feature, so a row looks nothing up by name
    field = {c: f"_{i}" for i, c in enumerate(dict.fromkeys(cols))}
    m = med.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f) for c, f in field.items()]).alias("m")).scalar()
    return df.select(*[F.coalesce(F.col(c), m[field[c]], F.lit(default)).alias(c) if c in field else F.col(c)
                       for c in df.columns])


def critical_fill(df: DataFrame, critical: Sequence[str] = K.CRITICAL_NO_NULL,
                  all_features: Sequence[str] = tuple(K.ALL_FEATURES) + ("avg_account_age_months",),
                  median_source: DataFrame | None = None) -> DataFrame:
    """critical features NULL to their median (0 if none), then every feature NULL/inf to 0.

    ``median_source``: a frame with the same rows and critical columns but a
    shorter plan (the merge only adds columns), so the medians need no joins.
    """
    crit = [c for c in critical if c in df.columns]
    src = df if median_source is None else median_source
    out = fill_with(df, medians(src, crit), crit) if crit else df
    zero = set(all_features)
    # one projection (a withColumn loop would re-analyse the plan once per column)
    return out.select(*[F.coalesce(finite_or_null(F.col(c).cast("double")), F.lit(0.0)).alias(c) if c in zero else F.col(c)
                        for c in out.columns])


def class_weight(df: DataFrame, label: str = "y") -> DataFrame:
    """F8: positive rate and neg/pos weight as a one-row frame."""
    pos = F.sum(F.col(label).cast("double"))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), (pos / n).alias("pos_rate"),
                  F.when(pos > 0, (n - pos) / pos).otherwise(F.lit(1.0)).alias("pos_weight"))


def with_weight(df: DataFrame, weights: DataFrame, label: str = "y", out: str = "weight") -> DataFrame:
    """Weight column: pos_weight for positives, 1 otherwise (one-row scalar subquery)."""
    w = weights.select("pos_weight").scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, w).otherwise(1.0))
