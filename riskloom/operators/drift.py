"""Feature drift: windows, PSI, two-sample KS, the drift check, alerts.

All features go through one job: the feature table is unpivoted to
(feature, window, value) and every statistic is a grouped aggregation keyed by
feature; the reference deciles come from the distributed exact quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..session import materialise
from . import orderstat
from .tails import ks_exact_column


# ------------------------------------------------------------------- J1
def windows(df: DataFrame, date_col: str = "feature_date") -> DataFrame:
    """Reference and current windows from the min/max of ``date_col`` (one row)."""
    b = df.agg(F.min(date_col).alias("dmin"), F.max(date_col).alias("dmax"))
    span = F.greatest(F.datediff("dmax", "dmin"), F.lit(1))
    cur = F.greatest(F.least(F.floor(span / 6), F.lit(120)), F.least(F.lit(30), span)).cast("int")
    gap = F.greatest(F.floor(span / 10), F.lit(7)).cast("int")
    ref_end0 = F.date_sub("dmax", cur + gap)
    ref_end = F.when(ref_end0 <= F.col("dmin"), F.date_add("dmin", F.greatest(F.floor(span / 3), F.lit(1)).cast("int"))) \
        .otherwise(ref_end0)
    return b.where(F.col("dmin").isNotNull()).select(
        F.greatest(F.col("dmin"), F.date_sub(ref_end, cur)).alias("reference_start"),
        ref_end.alias("reference_end"),
        F.date_sub("dmax", cur).alias("current_start"),
        F.col("dmax").alias("current_end"),
    )


def window_values(df: DataFrame, win: DataFrame, features: Sequence[str], date_col: str = "feature_date") -> DataFrame:
    """(window, feature, value) for rows inside the reference or current window (non-null values).

    The four window bounds arrive as one struct-valued scalar subquery.
    """
    w = win.select(F.struct("reference_start", "reference_end", "current_start", "current_end").alias("w")).scalar()
    d = F.col(date_col)
    tagged = df.withColumn("_w", w).select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.explode(F.array_compact(F.array(
            F.when(d.between(F.col("_w.reference_start"), F.col("_w.reference_end")), F.lit("ref")),
            F.when(d.between(F.col("_w.current_start"), F.col("_w.current_end")), F.lit("cur")),
        ))).alias("window"))
    return tagged.unpivot(["window"], list(features), "feature", "value").where(F.col("value").isNotNull())


# ------------------------------------------------------------------- J2, J3
def window_sums(values: DataFrame, by: Sequence[str] = ("feature",), n_buckets: int | None = None) -> DataFrame:
    """Running 'ref' and 'cur' counts per distinct value: what PSI deciles, PSI bins and KS all read."""
    base = values.select(*by, F.col("value").alias("_v"),
                         (F.col("window") == "ref").cast("long").alias("r"),
                         (F.col("window") == "cur").cast("long").alias("c"))
    return orderstat.prefix_sums(base, "_v", ["r", "c"], by, n_buckets)


def psi(values: DataFrame, by: Sequence[str] = ("feature",), n_bins: int = K.PSI_BINS,
        variant: str = "monitor", sums: DataFrame | None = None) -> DataFrame:
    """Population stability index of the 'cur' window against the 'ref' window.

    ``values``: (by..., window in {'ref','cur'}, value).  ``monitor`` (J2): shares
    of the in-range counts, fewer than 10 values or fewer than 2 edges give 0.
    ``eda`` (J3): shares of all values, fewer than 50 values or 2 edges give NULL.

    Bins are numpy histogram bins over the reference deciles: [e_i, e_i+1), the last one closed.  A bin's count is
    the difference of the running counts at its edges, so the values are sorted once and never joined to the edges.
    """
    by = list(by)
    ps = materialise(window_sums(values, by), "drift-sums") if sums is None else sums  # read for the edges and for the bins
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = orderstat.edge_map(orderstat.quantiles_of_sums(ps, probs, by, "_v", "r"), by)
    e = F.col("_edges")[orderstat.group_key(by)]
    at = ps.withColumn("_edges", edges).withColumn("_e", e).drop("_edges")
    # counts below each edge (up to the last one inclusive); NULL where the group has fewer edges
    last = F.element_at("_e", -1)
    below = lambda i, c: F.max(F.when((F.col("_v") < F.get("_e", F.lit(i))) |
                                      ((F.col("_v") == last) & (F.get("_e", F.lit(i)) == last)), F.col(c)))
    g = at.groupBy(*by).agg(
        F.first("tot_r").alias("n_ref"), F.first("tot_c").alias("n_cur"), F.first("_e").alias("_e"),
        *[F.coalesce(below(i, f"cum_{c}"), F.lit(0)).alias(f"_{c}{i}") for c in ("r", "c") for i in range(n_bins + 1)])
    m = F.coalesce(F.size("_e"), F.lit(0))
    total = lambda c: F.get(F.array(*[F.col(f"_{c}{i}") for i in range(n_bins + 1)]), m - 1) - F.col(f"_{c}0")
    g = g.withColumn("in_ref", total("r")).withColumn("in_cur", total("c"))
    if variant == "eda":
        dr, dc = F.col("n_ref"), F.col("n_cur")
    else:
        dr, dc = F.greatest(F.col("in_ref"), F.lit(1)), F.greatest(F.col("in_cur"), F.lit(1))
    terms = F.lit(0.0)
    for i in range(n_bins):
        cr, cc = F.col(f"_r{i + 1}") - F.col(f"_r{i}"), F.col(f"_c{i + 1}") - F.col(f"_c{i}")
        rp = F.greatest(F.try_divide(cr, dr), F.lit(K.PSI_FLOOR))
        cp = F.greatest(F.try_divide(cc, dc), F.lit(K.PSI_FLOOR))
        terms = terms + F.when((m > i + 1) & (cr + cc > 0), (cp - rp) * F.log(cp / rp)).otherwise(0.0)
    enough = 50 if variant == "eda" else 10
    ok = (F.col("n_ref") >= enough) & (F.col("n_cur") >= enough) & (m >= 2)
    fallback = F.lit(None).cast("double") if variant == "eda" else F.lit(0.0)
    return g.select(*by, "n_ref", "n_cur", F.when(ok, terms).otherwise(fallback).alias("psi"))


def psi_level(p: Column, levels: Sequence[float] = K.PSI_EDA_LEVELS) -> Column:
    """J3 levels: > 0.25 HIGH, > 0.10 MODERATE, else LOW."""
    return F.when(p > levels[1], "HIGH").when(p > levels[0], "MODERATE").otherwise("LOW")


# ------------------------------------------------------------------- J4
def kolmogorov_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value Q(sqrt(n1 n2 / (n1 + n2)) * D) of the Kolmogorov
    distribution (series of ``terms`` terms; 1 below lambda 0.2 where Q = 1 to 1e-12)."""
    lam = F.sqrt(n1 * n2 / (n1 + n2)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * 2.0 * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(values: DataFrame, by: Sequence[str] = ("feature",), n_buckets: int | None = None,
                  sums: DataFrame | None = None, exact_up_to: int = 0) -> DataFrame:
    """Two-sample KS statistic (max ECDF gap of 'ref' vs 'cur') and its p-value: asymptotic, or exact where neither
    window has more than ``exact_up_to`` values (10,000 is the usual bound)."""
    by = list(by)
    ps = window_sums(values, by, n_buckets) if sums is None else sums
    g = ps.groupBy(*by).agg(
        F.first("tot_r").alias("n_ref"), F.first("tot_c").alias("n_cur"),
        F.max(F.abs(F.try_divide(F.col("cum_r"), F.col("tot_r")) - F.try_divide(F.col("cum_c"), F.col("tot_c")))).alias("_d"))
    ok = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    d = F.when(ok, F.col("_d"))
    p = F.when(ok, kolmogorov_pvalue(F.col("_d"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")))
    if exact_up_to:
        few = F.greatest("n_ref", "n_cur") <= exact_up_to
        size = lambda c: F.when(few, F.col(c))
        p = F.coalesce(ks_exact_column()(d, size("n_ref"), size("n_cur")), p)
    return g.select(*by, "n_ref", "n_cur", d.alias("ks_statistic"), p.alias("ks_pvalue"))


# ------------------------------------------------------------------- J5, J6
DRIFT_FEATURES = K.NUMERICAL_FEATURES + K.AGGREGATION_FEATURES


def check(df: DataFrame, win: DataFrame, features: Sequence[str] = DRIFT_FEATURES, check_date: str = "2001-08-01",
          date_col: str = "feature_date", min_rows: int = K.DRIFT_MIN_ROWS) -> DataFrame:
    """PSI and KS of every feature, current vs reference window, when both windows have
    at least ``min_rows`` rows; drifted above 0.15, warning above 0.10."""
    feats = [f for f in features if f in df.columns]
    vals = window_values(df, win, feats, date_col)
    # one sort of the values serves the deciles, the bins and the ECDFs; it is written once to the shared folder
    sums = materialise(window_sums(vals), "drift-sums")
    p = psi(vals, sums=sums)
    ks = ks_two_sample(vals, sums=sums)
    w = win.select(F.struct("reference_start", "reference_end", "current_start", "current_end").alias("w")).scalar()
    d = F.col(date_col)
    rows = df.withColumn("_w", w).agg(
        F.count(F.when(d.between(F.col("_w.reference_start"), F.col("_w.reference_end")), 1)).alias("rows_ref"),
        F.count(F.when(d.between(F.col("_w.current_start"), F.col("_w.current_end")), 1)).alias("rows_cur"),
        F.first(F.concat_ws("/", F.col("_w.reference_start").cast("string"), F.col("_w.reference_end").cast("string"))).alias("reference_period"),
        F.first(F.concat_ws("/", F.col("_w.current_start").cast("string"), F.col("_w.current_end").cast("string"))).alias("current_period"),
    )
    gate = rows.select(F.struct("rows_ref", "rows_cur", "reference_period", "current_period").alias("g")).scalar()
    res = p.join(ks.drop("n_ref", "n_cur"), "feature", "full").withColumn("_g", gate)
    res = res.where((F.col("_g.rows_ref") >= min_rows) & (F.col("_g.rows_cur") >= min_rows))
    psi_v = F.coalesce(F.col("psi"), F.lit(0.0))
    return res.select(
        F.col("feature").alias("feature_name"), F.to_date(F.lit(check_date)).alias("check_date"),
        psi_v.alias("psi_value"), "ks_statistic", "ks_pvalue",
        (psi_v > K.PSI_THRESHOLD).alias("is_drifted"),
        ((psi_v > K.PSI_WARNING) & ~(psi_v > K.PSI_THRESHOLD)).alias("is_warning"),
        F.col("_g.reference_period").alias("reference_period"), F.col("_g.current_period").alias("current_period"),
    )


def alerts(drift: DataFrame) -> DataFrame:
    """One pending alert message per drifted or warned feature."""
    cur = F.split(F.col("current_period"), "/")
    ref = F.split(F.col("reference_period"), "/")
    drifted = F.format_string(K.DRIFT_ALERT, F.col("feature_name"), F.col("psi_value"), F.lit(str(K.PSI_THRESHOLD)),
                              cur[0], cur[1], ref[0], ref[1])
    warned = F.format_string(K.DRIFT_WARNING, F.col("feature_name"), F.col("psi_value"), F.lit(str(K.PSI_WARNING)))
    msg = F.when(F.col("is_drifted"), drifted).otherwise(warned)
    return drift.where(F.col("is_drifted") | F.col("is_warning")).select(
        "feature_name", "check_date", F.substring(msg, 1, 4000).alias("message"), F.lit("pending").alias("status"),
        F.col("check_date").cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("sent_at"), F.lit(None).cast("string").alias("error"))


# ------------------------------------------------------------------- J7, J8
def prediction_health(preds: DataFrame, order_cols: Sequence[str] = ("predicted_at", "prediction_id"),
                      n_latest: int = 5000, p: str = "pd_calibrated") -> DataFrame:
    """Newest ``n_latest`` predictions (G4, a top-k); fewer than 10 is a skip, mean above
    0.5 or below 0.01 or std below 0.001 an error."""
    latest = preds.orderBy(*[F.col(c).desc() for c in order_cols]).limit(n_latest)
    s = latest.agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_pd"), F.stddev_samp(p).alias("std_pd"))
    status = (F.when(F.col("n") < 10, "skip")
              .when((F.col("mean_pd") > 0.5) | (F.col("mean_pd") < 0.01), "error")
              .when(F.col("std_pd") < 0.001, "error").otherwise("ok"))
    reason = (F.when(F.col("n") < 10, "too few predictions")
              .when((F.col("mean_pd") > 0.5) | (F.col("mean_pd") < 0.01), F.format_string("Suspicious mean PD: %.4f", F.col("mean_pd")))
              .when(F.col("std_pd") < 0.001, F.format_string("Model predictions degenerated (std=%.6f)", F.col("std_pd"))))
    return s.select("n", "mean_pd", "std_pd", status.alias("status"), reason.alias("reason"))


def drain(alerts_df: DataFrame, sent_at: str, batch: int = 50, delivered: Column | None = None) -> DataFrame:
    """Take the oldest ``batch`` pending alerts and mark them sent (or error when
    ``delivered`` is false); the rest of the queue is unchanged.  Returns the new queue."""
    key = ["alert_id"]
    pending = alerts_df.where(F.col("status") == "pending")
    w = pending.orderBy("created_at", "alert_id").limit(batch).select(*key)  # oldest first: a top-k
    ok = F.lit(True) if delivered is None else delivered
    taken = alerts_df.join(w, key, "left_semi")
    rest = alerts_df.join(w, key, "left_anti")
    updated = taken.withColumn("status", F.when(ok, "sent").otherwise("error")) \
        .withColumn("sent_at", F.when(ok, F.to_timestamp(F.lit(sent_at)))) \
        .withColumn("error", F.when(~ok, F.lit("delivery failed")))
    return rest.unionByName(updated)
