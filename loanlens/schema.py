"""Data model: column lists, declared types and the fixed parameters of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the domain definition) -------------------------
TARGET_COL = "default"
ID_COL = "application_id"
LEAKAGE_COLS = ["default_probability_true"]

NUMERIC_FEATURES = [
    "age", "annual_income", "employment_length_years", "loan_amount",
    "interest_rate", "loan_term_months", "num_open_accounts",
    "num_derog_records", "num_credit_inquiries", "credit_utilization_ratio",
    "debt_to_income", "months_since_last_delinq", "revolving_balance",
    "total_accounts",
]
CATEGORICAL_FEATURES = ["home_ownership", "loan_purpose", "grade", "verification_status"]
DERIVED_FEATURES = ["loan_to_income", "revolving_to_income", "derog_rate",
                    "open_account_rate", "rate_x_dti"]

# Enumerated domains of the request record.
HOME_OWNERSHIP = ["RENT", "OWN", "MORTGAGE", "OTHER"]
LOAN_PURPOSE = ["debt_consolidation", "credit_card", "home_improvement",
                "other", "major_purchase", "medical"]
GRADES = ["A", "B", "C", "D", "E", "F"]
VERIFICATION = ["Not Verified", "Source Verified", "Verified"]

# Defaults of the domain parameters.
WOE_SMOOTHING = 0.5
WOE_MAX_BINS = 10
WOE_MIN_BIN_PCT = 0.05
IV_THRESHOLD = 0.02
VIF_THRESHOLD = 10.0
TEST_SIZE = 0.20
VAL_SIZE = 0.10
SEED = 42
CV_FOLDS = 5
N_TRIALS = 50
SCORE_BASE = 600.0
SCORE_ODDS = 50.0
SCORE_PDO = 20.0
SCORE_MIN = 300
SCORE_MAX = 850
SCORE_APPROVE = 620
SCORE_DECLINE = 540
PROB_APPROVE = 0.30
PROB_DECLINE = 0.70
COST_FN = 5.0
COST_FP = 1.0
PSI_MONITOR = 0.10
PSI_ALERT = 0.20
PSI_EPSILON = 1e-4
# -----------------------------------------------------------------------------

ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

APPLICATION_SCHEMA = T.StructType(
    [T.StructField(ID_COL, T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in NUMERIC_FEATURES]
    + [T.StructField(c, T.StringType(), True) for c in CATEGORICAL_FEATURES]
    + [T.StructField(TARGET_COL, T.IntegerType(), True)]
)

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("application_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("default_prob", T.DoubleType(), False),
    T.StructField("risk_score", T.IntegerType(), False),
    T.StructField("decision", T.StringType(), False),
    T.StructField("confidence", T.DoubleType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("latency_ms", T.DoubleType(), False),
    T.StructField("features_json", T.StringType(), False),
    T.StructField("shap_json", T.StringType(), True),
])


def numeric_columns(df, exclude=()) -> list[str]:
    """Columns of numeric type, in frame order (the dtype rule of the domain)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def categorical_columns(df, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, T.NumericType) and f.name not in exclude]
