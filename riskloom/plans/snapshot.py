"""Raw tables to the feature snapshot as one lazy plan.

applications -> row features + target encodings (narrow, plus a tiny map
join), payments -> look-back windows (pre-aggregated per loan-day, then one
join and one grouping on the loan id), bureau -> as-of report; the three are
merged by loan id, critical features get their exact median, every feature
NULL/inf becomes 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..operators import features as fe


APP_COLUMNS = ["application_id", "client_id", "application_date", "loan_amount", "income", "loan_term", "interest_rate",
               "employment_years", "home_ownership", "purpose", "dti_ratio", "credit_score", "num_open_accounts",
               "num_delinquencies", "total_credit_limit", "num_inquiries_6m", "revolving_utilization", "total_accounts",
               "revolving_balance", "pub_rec_bankruptcies", "grade", "is_default"]


def snapshot(applications: DataFrame, payments: DataFrame, reports: DataFrame, cutoff: str,
             version: str = K.FEATURE_VERSION, bureau_strategy: str = "timeline",
             fill: str = "zero", materialize_inputs: bool = True) -> DataFrame:
    """Feature snapshot with the 36 stored columns (id, date, version, 30 features, 3 extras).

    The applications table feeds six branches (row features, encodings, windows,
    as-of join, medians, merge).  ``materialize_inputs`` writes its needed columns
    once to the shared checkpoint folder, so a derived view is computed once
    instead of once per branch (a stored table gains little from it).
    """
    if materialize_inputs:
        from ..session import cut_lineage
        applications = cut_lineage(applications.select(*[c for c in APP_COLUMNS if c in applications.columns]))
    enc, mean = fe.target_fit_fallback(applications, cutoff)
    num = fe.numerical(applications, keep=K.CATEGORICAL_FEATURES)
    num = fe.target_apply(num, enc, mean).drop(*K.CATEGORICAL_FEATURES)
    agg = fe.payment_windows(payments, applications).select("application_id", *K.AGGREGATION_FEATURES)
    bur = fe.bureau(applications, reports, bureau_strategy)
    merged = num.join(agg, "application_id", "left").join(bur, "application_id", "left")
    if fill == "median":
        merged = fe.fill_with(merged, fe.medians(merged, K.ALL_FEATURES), K.ALL_FEATURES)
    merged = fe.critical_fill(merged, median_source=fe.numerical(applications))
    return merged.select(
        "application_id", "feature_date", F.lit(version).alias("feature_version"),
        *K.ALL_FEATURES, *K.SNAPSHOT_EXTRA,
    )
