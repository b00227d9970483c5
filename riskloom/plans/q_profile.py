"""Queries for exploratory profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import round_doubles
from ..operators import clean
from ..operators import features as fe
from ..operators import profile as P
from ..sources import fixtures
from .catalog import register
from .oracle_views import with_ctes
from .q_clean import PARSED_SQL
from .q_drift import ERAS, _era_sql, era_label
from . import oracle_features as OF
from .q_features import TE_CUTOFF, features_snapshot_df

NUM_COLS = ["loan_amount", "income", "interest_rate", "employment_years", "dti_ratio", "credit_score",
            "num_open_accounts", "num_delinquencies", "total_credit_limit", "num_inquiries_6m", "loan_term"]
VIF_COLS = ["loan_amount", "income", "dti_ratio", "interest_rate", "credit_score", "num_open_accounts",
            "num_delinquencies", "total_credit_limit"]
MI_COLS = ["loan_amount", "income", "credit_score", "num_open_accounts", "num_delinquencies"]
DIST_COLS = ["credit_score", "interest_rate", "dti_ratio", "income", "loan_amount", "num_open_accounts"]
STABLE = ("1996-01-01", "1999-06-30")
Y = "CASE WHEN is_default THEN 1.0e0 ELSE 0.0e0 END"


def _apps(spark, sf_dir):
    return fixtures.load(spark, sf_dir).applications


@register("yearly_default", with_ctes(["applications_v"], [], f"""
SELECT CAST(year(application_date) AS INT) AS year, count(*) AS n_loans, round(avg({Y}), 6) AS default_rate,
  CAST(sum({Y}) AS BIGINT) AS n_defaults FROM applications_v GROUP BY 1"""))
def q_yearly(spark, sf_dir):
    """loans, default rate and defaults by year."""
    return round_doubles(P.yearly_default(_apps(spark, sf_dir)))


@register("quarterly_stability", with_ctes(["applications_v"], [("q", f"""
SELECT CAST(year(application_date) AS VARCHAR) || 'Q' || CAST(quarter(application_date) AS VARCHAR) AS quarter,
  count(*) AS n, avg({Y}) AS dr FROM applications_v
WHERE application_date BETWEEN DATE '{STABLE[0]}' AND DATE '{STABLE[1]}' GROUP BY 1""")], """
SELECT count(*) AS n_quarters, CAST(sum(n) AS BIGINT) AS n_loans, round(avg(dr), 6) AS mean_dr, round(stddev_samp(dr), 6) AS std_dr,
  round(stddev_samp(dr) / avg(dr), 6) AS cv FROM q"""))
def q_quarterly(spark, sf_dir):
    """coefficient of variation of quarterly default rates in the stable window."""
    return round_doubles(P.quarterly_stability(_apps(spark, sf_dir), *STABLE))


PARSED_COLS = ["external_id", "client_id", "application_date", "loan_amount", "loan_term", "interest_rate", "income",
               "employment_years", "home_ownership", "purpose", "dti_ratio", "credit_score", "num_open_accounts",
               "num_delinquencies", "revolving_balance", "revolving_utilization", "total_accounts",
               "pub_rec_bankruptcies", "grade", "total_credit_limit", "num_inquiries_6m", "is_default", "data_source"]


@register("missing_profile", with_ctes(["raw_loans_v"], [("parsed", PARSED_SQL)], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"round(CASE WHEN count(*) > 0 THEN (count(*) - count({c})) * 1.0e0 / count(*) ELSE 0.0e0 END, 6) AS missing_rate FROM parsed"
    for c in PARSED_COLS)))
def q_missing(spark, sf_dir):
    """NULL count and rate of every column of the parsed vendor table."""
    p = clean.parsed_fields(fixtures.load(spark, sf_dir).raw_loans)
    return round_doubles(P.missing_profile(p))


def _iqr_sql():
    parts = []
    for c in NUM_COLS:
        parts.append(f"""SELECT '{c}' AS feature, outliers, round(outliers * 1.0e0 / n_rows, 6) AS outlier_rate, round(mn, 6) AS min,
  round(mx, 6) AS max, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr FROM (
  SELECT count(*) AS n_rows, count({c}) AS n_values, min({c}) AS mn, max({c}) AS mx,
    quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM applications_v) s,
  LATERAL (SELECT count(*) AS outliers FROM applications_v
    WHERE {c} < s.q1 - 1.5e0 * (s.q3 - s.q1) OR {c} > s.q3 + 1.5e0 * (s.q3 - s.q1)) o WHERE n_values >= 0.5 * n_rows""")
    return with_ctes(["applications_v"], [], " UNION ALL ".join(parts))


@register("iqr_outliers", _iqr_sql())
def q_iqr(spark, sf_dir):
    """IQR outlier counts per numeric column (columns > 50% NULL skipped)."""
    return round_doubles(P.iqr_outliers(_apps(spark, sf_dir), NUM_COLS))


def _corr_sql():
    parts = []
    for i, a in enumerate(NUM_COLS):
        for b in NUM_COLS[i + 1:]:
            r = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({r}, 6) AS r, abs({r}) > 0.7 AS high, "
                         f"abs({r}) > 0.85 AS very_high FROM applications_v")
    return with_ctes(["applications_v"], [], " UNION ALL ".join(parts))


@register("correlation_matrix", _corr_sql())
def q_corr(spark, sf_dir):
    """pairwise Pearson correlations with the 0.7 / 0.85 flags."""
    return round_doubles(P.correlation_pairs(_apps(spark, sf_dir), NUM_COLS))


@register("vif")
def q_vif(spark, sf_dir):
    """variance inflation factors without intercept (Gram matrix job + k x k inverse)."""
    return round_doubles(P.vif(_apps(spark, sf_dir), VIF_COLS))


def _mi_sql():
    cols = ", ".join(MI_COLS)
    probs = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"
    return with_ctes(["applications_v"], [
        ("mi_full", f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MI_COLS)}, CAST(is_default AS INT) AS y FROM applications_v "
                 f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in MI_COLS)} AND is_default IS NOT NULL"),
        ("long", f"UNPIVOT mi_full ON {cols} INTO NAME feature VALUE value"),
        ("edges", f"SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs}))) AS edges FROM long GROUP BY feature"),
        ("binned", "SELECT l.feature, l.y, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x < l.value)) AS bin "
                   "FROM long l JOIN edges e ON e.feature = l.feature"),
        ("cell", "SELECT feature, bin, y, count(*) AS n_xy FROM binned GROUP BY 1, 2, 3"),
        ("nx", "SELECT feature, bin, sum(n_xy) AS n_x FROM cell GROUP BY 1, 2"),
        ("ny", "SELECT feature, y, sum(n_xy) AS n_y FROM cell GROUP BY 1, 2"),
        ("nt", "SELECT feature, sum(n_xy) AS n FROM cell GROUP BY 1"),
    ], """SELECT c.feature, round(sum((n_xy * 1.0e0 / n) * ln(n_xy * 1.0e0 * n / (n_x * n_y))), 6) AS mutual_information
FROM cell c JOIN nx USING (feature, bin) JOIN ny USING (feature, y) JOIN nt USING (feature) GROUP BY c.feature""")


@register("mutual_information", _mi_sql())
def q_mi(spark, sf_dir):
    """decile-binned plug-in mutual information of each feature with default."""
    return round_doubles(P.mutual_information(_apps(spark, sf_dir), MI_COLS))


@register("chi_square_eras", with_ctes(["applications_v"], [
    ("g", f"SELECT {_era_sql()} AS era, sum({Y}) AS n_def, count(*) - sum({Y}) AS n_non FROM applications_v "
          f"WHERE {_era_sql()} IS NOT NULL GROUP BY 1"),
    ("t", "SELECT sum(n_def) AS td, sum(n_non) AS tn, count(*) AS r FROM g"),
    ("x", """SELECT sum(power(greatest(abs(n_def - (n_def + n_non) * td / (td + tn)) - CASE WHEN r = 2 THEN 0.5 ELSE 0 END, 0), 2)
      / ((n_def + n_non) * td / (td + tn)) + power(greatest(abs(n_non - (n_def + n_non) * tn / (td + tn)) - CASE WHEN r = 2 THEN 0.5 ELSE 0 END, 0), 2)
      / ((n_def + n_non) * tn / (td + tn))) AS chi2, max(r) AS r FROM g, t"""),
], "SELECT round(chi2, 6) AS chi2, r - 1 AS dof, round(CASE WHEN r - 1 = 2 THEN exp(-chi2 / 2) END, 6) AS p_value FROM x"))
def q_chi_square(spark, sf_dir):
    """chi-squared test of default x era."""
    a = _apps(spark, sf_dir).withColumn("era", era_label())
    return round_doubles(P.chi_square(a, "era"))


def _dist_sql():
    cols = ", ".join(DIST_COLS)
    return with_ctes(["applications_v"], [
        ("long", f"SELECT * FROM (UNPIVOT (SELECT CAST(is_default AS INT) AS label, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in DIST_COLS)} "
                 f"FROM applications_v) ON {cols} INTO NAME feature VALUE value) u WHERE value IS NOT NULL"),
        ("rng", "SELECT feature, label, count(*) AS n, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo, "
                "CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM long GROUP BY 1, 2"),
        ("h", "SELECT l.feature, l.label, CAST(least(floor((l.value - r.lo) / ((r.hi - r.lo) / 40)), 39) AS INT) AS bin, r.lo, r.n, "
              "(r.hi - r.lo) / 40 AS w FROM long l JOIN rng r ON r.feature = l.feature AND r.label = l.label"),
    ], "SELECT feature, label, bin, round(max(lo) + bin * max(w), 6) AS bin_start, count(*) AS count, "
       "round(count(*) / (max(n) * max(w)), 6) AS density FROM h GROUP BY feature, label, bin")


@register("class_distributions", _dist_sql())
def q_class_dist(spark, sf_dir):
    """40-bin density histograms of key features per default class."""
    return round_doubles(P.class_distributions(_apps(spark, sf_dir), DIST_COLS))


@register("cold_start_coverage", with_ctes(["applications_v", "payments_v", "bureau_v"], OF.snapshot_blocks(TE_CUTOFF), """
SELECT total, with_history, late, with_history - late AS on_time, total - with_history AS cold_start,
  round(with_history * 1.0e0 / total, 6) AS history_share, round(late * 1.0e0 / total, 6) AS late_share,
  round((total - with_history) * 1.0e0 / total, 6) AS cold_share
FROM (SELECT count(*) AS total, count(a.application_id) AS with_history,
  count(CASE WHEN s.avg_days_overdue_90d <> 0 THEN 1 END) AS late FROM snapshot s LEFT JOIN agg a ON a.application_id = s.application_id) t"""))
def q_coverage(spark, sf_dir):
    """snapshot rows with payment aggregates, late, on time and cold start."""
    fx = fixtures.load(spark, sf_dir)
    agg = fe.payment_windows(fx.payments, fx.applications)
    return round_doubles(P.cold_start_coverage(features_snapshot_df(spark, sf_dir), agg))
