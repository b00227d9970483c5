"""Fixed values that must equal the reference's for equal results.

Everything in this module is a stated constant (feature lists, bounds, token
sets, labels, thresholds), written plainly and in natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
FEATURE_VERSION = "v1.0"
PAYMENT_WINDOWS = (30, 90, 180)

NUMERICAL_FEATURES = [
    "loan_to_income", "credit_utilization", "income_log", "loan_amount_log",
    "dti_ratio_clipped", "employment_years", "credit_score_norm",
    "num_open_accounts", "num_delinquencies", "interest_rate", "loan_term",
    "num_inquiries_6m", "revolving_utilization", "total_accounts_log",
    "revolving_balance_log", "has_bankruptcy", "grade",
    "loan_amount_x_dti", "income_x_credit_score",
]
CATEGORICAL_FEATURES = ["home_ownership", "purpose"]
TARGET_ENCODED_FEATURES = ["purpose_target_enc", "home_ownership_target_enc"]
AGGREGATION_FEATURES = [
    "avg_days_overdue_30d", "avg_days_overdue_90d", "avg_days_overdue_180d",
    "max_days_overdue_90d", "pct_late_payments_90d", "total_paid_90d",
    "payment_consistency_90d",
]
BUREAU_FEATURES = ["bureau_balance_to_income", "inquiries_per_account"]
ALL_FEATURES = NUMERICAL_FEATURES + TARGET_ENCODED_FEATURES + AGGREGATION_FEATURES + BUREAU_FEATURES
COLD_START_FEATURES = NUMERICAL_FEATURES + TARGET_ENCODED_FEATURES + BUREAU_FEATURES
CRITICAL_NO_NULL = ["loan_to_income", "credit_utilization", "income_log"]
SNAPSHOT_EXTRA = ["dti_bucket", "credit_score_bucket", "avg_account_age_months"]

# vendor file: header aliases (lower-cased header -> column name)
COLUMN_ALIASES = {
    "id": "external_id",
    "member_id": "client_id",
    "loan_amnt": "loan_amount",
    "loan_amount": "loan_amount",
    "funded_amnt": "loan_amount",
    "term": "loan_term",
    "loan_term": "loan_term",
    "int_rate": "interest_rate",
    "interest_rate": "interest_rate",
    "annual_inc": "income",
    "income": "income",
    "emp_length": "employment_years",
    "employment_years": "employment_years",
    "home_ownership": "home_ownership",
    "purpose": "purpose",
    "dti": "dti_ratio",
    "dti_ratio": "dti_ratio",
    "fico_range_low": "credit_score",
    "fico_range_high": "credit_score_high",
    "last_fico_range_low": "credit_score",
    "credit_score": "credit_score",
    "open_acc": "num_open_accounts",
    "num_open_accounts": "num_open_accounts",
    "delinq_2yrs": "num_delinquencies",
    "num_delinquencies": "num_delinquencies",
    "revol_bal": "revolving_balance",
    "revol_util": "revolving_utilization",
    "total_rev_hi_lim": "total_credit_limit",
    "total_bc_limit": "total_credit_limit",
    "total_acc": "total_accounts",
    "pub_rec_bankruptcies": "pub_rec_bankruptcies",
    "grade": "grade",
    "sub_grade": "sub_grade",
    "total_credit_limit": "total_credit_limit",
    "issue_d": "application_date",
    "application_date": "application_date",
    "loan_status": "loan_status",
    "is_default": "is_default",
    "client_id": "client_id",
    "inq_last_6mths": "num_inquiries_6m",
    "num_inquiries_6m": "num_inquiries_6m",
}

DEFAULT_STATUSES = [
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "Does not meet the credit policy. Status:Charged Off",
]
TRUE_TOKENS = ["1", "true", "yes", "y", "default"]
NULL_NUMERIC_TOKENS = ["", "nan", "None", "NULL"]
EMPLOYMENT_NULL_TOKENS = ["n/a", "na", "", "null", "none"]
HOME_OWNERSHIP_OTHER_TOKENS = ["NAN", "NONE", "ANY", "NULL"]
PURPOSE_OTHER_TOKENS = ["nan", "none", "null"]
GRADES = "ABCDEFG"  # A=1 .. G=7, unknown=3
DEFAULT_APPLICATION_DATE = "2016-06-01"

# vendor clip table: column -> (low, high)
CLIP_BOUNDS = {
    "loan_amount": (0.0, 1e7),
    "income": (0.0, 1e8),
    "interest_rate": (0.0, 100.0),
    "employment_years": (0.0, 80.0),
    "dti_ratio": (-100.0, 999.0),
    "credit_score": (0.0, 1000.0),
    "num_open_accounts": (0.0, 500.0),
    "num_delinquencies": (0.0, 200.0),
    "total_credit_limit": (0.0, 1e9),
}

# right-closed bucket edges and labels
DTI_BUCKET_EDGES = [10.0, 20.0, 35.0, 50.0]
DTI_BUCKET_LABELS = ["very_low", "low", "medium", "high", "very_high"]
CREDIT_SCORE_BUCKET_EDGES = [0.0, 580.0, 670.0, 740.0, 800.0, 900.0]
CREDIT_SCORE_BUCKET_LABELS = ["poor", "fair", "good", "very_good", "exceptional"]
NULL_BUCKET_LABEL = "nan"

# risk buckets: upper bounds (exclusive) and labels
RISK_BUCKET_BOUNDS = [0.05, 0.15, 0.30]
RISK_BUCKET_LABELS = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]

# target encoding
TE_SMOOTHING = 20
TE_MIN_SAMPLES = 10
TE_PRIOR = 0.15

# serving request rules
HOME_OWNERSHIP_ALLOWED = ["RENT", "OWN", "MORTGAGE", "OTHER"]
HISTORY_SIGNALS = AGGREGATION_FEATURES

# monitoring
PSI_THRESHOLD = 0.15
PSI_WARNING = 0.10
AUC_DROP_THRESHOLD = 0.03
MIN_PREDICTIONS_FOR_CHECK = 100
DRIFT_MIN_ROWS = 50
PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_EDA_LEVELS = (0.10, 0.25)

# feature selection: name patterns (substring, any case) and post-origination columns
EXCLUDE_NAME_PATTERNS = ["id", "url", "desc", "title", "emp_title", "addr_state", "zip_code"]
LEAKAGE_COLUMNS = [
    "out_prncp", "out_prncp_inv", "total_pymnt", "total_pymnt_inv",
    "total_rec_prncp", "total_rec_int", "total_rec_late_fee",
    "recoveries", "collection_recovery_fee", "last_pymnt_amnt",
    "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d",
    "last_fico_range_high", "last_fico_range_low",
]

# thresholds used by metric reports
REPORT_THRESHOLDS = [0.05, 0.15, 0.30]
COST_FP = 100.0
COST_FN = 5000.0
MIN_AUC_FOR_REGISTRATION = 0.70


# Alert texts (feature, PSI, threshold, periods)
DRIFT_ALERT = "🚨 Feature drift detected\nFeature: %s\nPSI: %.4f (threshold: %s)\nCurrent: %s → %s\nReference: %s → %s"
DRIFT_WARNING = "⚠️ Feature drift warning\nFeature: %s\nPSI: %.4f (warning: %s)"


# Buckets and features of the error analysis
BUCKET_LABELS = ["Very Low", "Low", "Medium", "High", "Very High"]
CREDIT_EDGES = [0.0, 600.0, 650.0, 700.0, 750.0, 900.0]
CREDIT_LABELS = ["Poor", "Fair", "Good", "Very Good", "Excellent"]
DTI_EDGES = [0.0, 20.0, 30.0, 40.0, 50.0, 100.0]
ERROR_FEATURES = ["loan_to_income", "credit_score", "dti_ratio", "interest_rate", "loan_amount", "income",
                  "employment_years", "num_open_accounts"]
