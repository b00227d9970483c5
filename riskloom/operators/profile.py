"""Exploratory profiling as distributed jobs.

Every profile reads the table once per statistic family: columns are
unpivoted to (feature, value) and grouped by feature, so adding columns adds
rows, not jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialise
from . import orderstat, selection
from .tails import chi2_sf


def yearly_default(df: DataFrame, date_col: str = "application_date", label: str = "is_default") -> DataFrame:
    """loans, default rate and defaults per year."""
    y = F.col(label).cast("double")
    return df.groupBy(F.year(date_col).alias("year")).agg(
        F.count(F.lit(1)).alias("n_loans"), F.avg(y).alias("default_rate"), F.sum(y).cast("long").alias("n_defaults"))


def quarterly(df: DataFrame, start: str, end: str, date_col: str = "application_date", label: str = "is_default") -> DataFrame:
    """loans and default rate per quarter inside [start, end]."""
    d = F.col(date_col)
    w = df.where(d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    q = F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
    return w.groupBy(q.alias("quarter")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("dr"))


def quarterly_stability(df: DataFrame, start: str, end: str, **kw) -> DataFrame:
    """coefficient of variation (sample std / mean) of the quarterly default rates."""
    q = quarterly(df, start, end, **kw)
    return q.agg(F.count(F.lit(1)).alias("n_quarters"), F.sum("n").alias("n_loans"), F.avg("dr").alias("mean_dr"),
                 F.stddev_samp("dr").alias("std_dr"), (F.stddev_samp("dr") / F.avg("dr")).alias("cv"))


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count and rate per column, one aggregation pass."""
    cols = list(df.columns if cols is None else cols)
    n = F.count(F.lit(1))
    row = df.agg(n.alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "missing_count")
    return long.select("column", "missing_count",
                       F.when(F.col("_n") > 0, F.col("missing_count") / F.col("_n")).otherwise(0.0).alias("missing_rate"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, max_null_rate: float = 0.5) -> DataFrame:
    """Q1, Q3, IQR bounds, outlier count and rate per numeric column (skip > 50% NULL).

    Quantiles are exact, by digit selection.  With their bounds (two numbers a column) one aggregation counts all outliers.
    """
    cols = list(numeric_columns(df) if cols is None else cols)
    table = materialise(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "values")
    q: dict[str, dict] = {}
    for r in selection.exact_quantiles(orderstat.unpivot(table, cols), "value", [0.25, 0.75], ["feature"]).collect():
        q.setdefault(r["feature"], {})[r["p"]] = r["q"]
    parts = []
    for c in q:
        q1, q3 = q[c][0.25], q[c][0.75]
        iqr = q3 - q1
        out = F.count(F.when((F.col(c) < q1 - 1.5 * iqr) | (F.col(c) > q3 + 1.5 * iqr), 1))
        parts.append(F.struct(F.lit(c).alias("feature"), out.alias("outliers"), F.count(c).alias("n_values"), F.min(c).alias("min"), F.max(c).alias("max"),
                              F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr")))
    schema = "feature string, outliers bigint, outlier_rate double, min double, max double, q1 double, q3 double, iqr double"
    if not parts:
        return df.sparkSession.createDataFrame([], schema)
    g = table.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*parts).alias("x")).select("n_rows", F.inline("x"))
    g = g.where(F.col("n_values") >= (1 - max_null_rate) * F.col("n_rows"))
    return g.select("feature", "outliers", (F.col("outliers") / F.col("n_rows")).alias("outlier_rate"), "min", "max", "q1", "q3", "iqr")


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> list:
    """Pearson correlation aggregates for ``pairs`` over pairwise-complete rows; NULL where a column is constant there.

    Spark's own moment aggregates: each keeps the mean and moves the sums of squares and products to the new mean with
    every value and every merge, so one pass does and an outlier costs no precision.  Only nullable columns are
    masked by the other's; a variance that several pairs need is computed once.
    """
    nullable = {c for c in {c for p in pairs for c in p} if df.schema[c].nullable}

    def masked(c: str, other: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(F.col(other).isNotNull(), x) if other in nullable else x

    return [F.try_divide(F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")),
                         F.sqrt(F.var_pop(masked(a, b))) * F.sqrt(F.var_pop(masked(b, a)))) for a, b in pairs]


def correlation_pairs(df: DataFrame, cols: Sequence[str], high: float = 0.7, very_high: float = 0.85) -> DataFrame:
    """pairwise Pearson (pairwise-complete rows), one aggregation for all pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[c.alias(f"{i}") for i, c in enumerate(pair_correlations(df, pairs))])
    arr = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)])
    long = row.select(F.inline(arr))
    return long.select("feature_a", "feature_b", "r", (F.abs("r") > high).alias("high"), (F.abs("r") > very_high).alias("very_high"))


def gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """X'X over the rows where every column is present (one aggregation)."""
    full = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    terms = [F.sum(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    return full.agg(F.count(F.lit(1)).alias("_n"), *terms)


def vif(df: DataFrame, cols: Sequence[str], min_rows: int = 100) -> DataFrame:
    """variance inflation without intercept (uncentred R2): VIF_i = G_ii * inv(G)_ii.

    The k x k Gram matrix is one aggregation; only that tiny matrix reaches the
    driver to be inverted.  Fewer than ``min_rows`` complete rows gives no rows.
    """
    cols = list(cols)
    spark = df.sparkSession
    g = gram(df, cols).first()
    schema = "feature string, vif double"
    if g is None or g["_n"] is None or g["_n"] <= min_rows:
        return spark.createDataFrame([], schema)
    k = len(cols)
    G = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            G[i, j] = G[j, i] = g[f"{i}_{j}"] or 0.0
    inv = np.linalg.pinv(G)
    return spark.createDataFrame([(c, float(G[i, i] * inv[i, i])) for i, c in enumerate(cols)], schema)


def _decile_bin(value, edges):
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e < value))


def mutual_information(df: DataFrame, cols: Sequence[str], label: str = "is_default", n_bins: int = 10) -> DataFrame:
    """F22 (deviation: estimator): plug-in MI (nats) between each feature's decile bin and the label.

    Rows with any NULL in the columns or the label are dropped first (as the
    reference does); bins are right-closed at the exact deciles.
    """
    full = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("int").alias("_y")).dropna()
    full = materialise(full, "values")
    long = full.unpivot(["_y"], list(cols), "feature", "value")
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = selection.exact_quantiles(long, "value", probs, ["feature"])
    edges = orderstat.edge_map(q, ["feature"])  # columns x deciles numbers: no join on the feature name
    binned = long.withColumn("_m", edges).withColumn("edges", F.col("_m")[orderstat.group_key(["feature"])]) \
        .select("feature", "_y", _decile_bin(F.col("value"), F.col("edges")).alias("bin"))
    cell = binned.groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n_xy"))
    # margins over the small cell table (features x bins x labels rows)
    over = lambda *keys: F.sum("n_xy").over(Window.partitionBy(*keys))
    j = cell.withColumns({"n_x": over("feature", "bin"), "n_y": over("feature", "_y"), "n": over("feature")})
    term = (F.col("n_xy") / F.col("n")) * F.log(F.col("n_xy") * F.col("n") / (F.col("n_x") * F.col("n_y")))
    return j.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def chi_square(df: DataFrame, group_col: str, label: str = "is_default") -> DataFrame:
    """chi-squared test of label x group (defaults vs non-defaults per group); rows without a label or a group
    do not count.  With two groups Yates' correction is applied.  The p-value holds for any number of groups and is
    NULL for fewer than two."""
    y = F.col(label).cast("int")
    g = df.where(F.col(group_col).isNotNull() & y.isNotNull()).groupBy(group_col).agg(
        F.sum(y).alias("n_def"), (F.count(F.lit(1)) - F.sum(y)).alias("n_non"))
    tot = g.agg(F.sum("n_def").alias("td"), F.sum("n_non").alias("tn"), F.count(F.lit(1)).alias("r"))
    t = tot.select(F.struct("td", "tn", "r").alias("t")).scalar()
    gt = g.withColumn("_t", t)
    n = F.col("_t.td") + F.col("_t.tn")
    rows = F.col("n_def") + F.col("n_non")
    e_d, e_n = rows * F.col("_t.td") / n, rows * F.col("_t.tn") / n
    yates = F.when(F.col("_t.r") == 2, 0.5).otherwise(0.0)
    dev = lambda o, e: F.greatest(F.abs(o - e) - yates, F.lit(0.0))
    term = F.try_divide(dev(F.col("n_def"), e_d) ** 2, e_d) + F.try_divide(dev(F.col("n_non"), e_n) ** 2, e_n)
    s = gt.agg(F.sum(term).alias("chi2"), F.first("_t.r").alias("r")).withColumn("dof", F.col("r") - 1)
    p = F.when(F.col("dof") == 2, F.exp(-F.col("chi2") / 2)).when(F.col("dof") >= 1, chi2_sf(F.col("chi2"), F.col("dof")))
    return s.select("chi2", "dof", p.alias("p_value"))


def class_distributions(df: DataFrame, cols: Sequence[str], label: str = "is_default", bins: int = 40) -> DataFrame:
    """density histogram of each feature per label value (own range per subset, numpy bins)."""
    long = df.select(F.col(label).cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(["label"], list(cols), "feature", "value").where(F.col("value").isNotNull())
    rng = long.groupBy("feature", "label").agg(F.min("value").alias("lo0"), F.max("value").alias("hi0"),
                                               F.count(F.lit(1)).alias("n"))
    rng = rng.select("feature", "label", "n",
                     F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    # ranges of (feature, label) pairs, a handful of numbers, as one map-valued scalar subquery
    key = orderstat.group_key(["feature", "label"])
    m = rng.agg(F.map_from_entries(F.collect_list(F.struct(key, F.struct("n", "lo", "hi")))).alias("m")).scalar()
    at = long.withColumn("_m", m).withColumn("_r", F.col("_m")[key]).select("feature", "label", "value", "_r.n", "_r.lo", "_r.hi")
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    h = at.select("feature", "label", b.alias("bin"), "lo", "hi", "n", width.alias("w"))
    return h.groupBy("feature", "label", "bin").agg(
        F.count(F.lit(1)).alias("count"), F.first("lo").alias("lo"), F.first("w").alias("w"), F.first("n").alias("n")) \
        .select("feature", "label", "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"), "count",
                (F.col("count") / (F.col("n") * F.col("w"))).alias("density"))


def cold_start_coverage(snapshot: DataFrame, aggregates: DataFrame) -> DataFrame:
    """loans with payment aggregates, of those late (avg overdue 90d != 0) and on time, and cold start."""
    has = aggregates.select("application_id").distinct().withColumn("_agg", F.lit(1))
    j = snapshot.select("application_id", "avg_days_overdue_90d").join(has, "application_id", "left")
    total = F.count(F.lit(1))
    with_hist = F.count("_agg")
    late = F.count(F.when(F.col("avg_days_overdue_90d") != 0, 1))
    return j.agg(total.alias("total"), with_hist.alias("with_history"), late.alias("late"),
                 (with_hist - late).alias("on_time"), (total - with_hist).alias("cold_start"),
                 (with_hist / total).alias("history_share"), (late / total).alias("late_share"),
                 ((total - with_hist) / total).alias("cold_share"))
