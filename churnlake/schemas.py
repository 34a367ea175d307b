"""Schemas and the fixed column lists shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results: raw column
# names, feature names and their order, service columns, category labels,
# registered model names, and thresholds.
# ---------------------------------------------------------------------------
RAW_COLUMNS = [
    "customerID", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
REQUIRED_RAW_COLUMNS = ["customerID", "Churn", "tenure", "MonthlyCharges", "TotalCharges"]
MIN_ROWS = 1000
HIGH_NULL_SHARE = 0.5

NUMERIC_FEATURES = [
    "tenure_months", "tenure_years", "monthly_charges", "total_charges",
    "avg_monthly_charge", "charge_per_tenure", "total_services", "risk_score",
]
BINARY_FEATURES = [
    "is_new_customer", "is_loyal_customer", "contract_month_to_month",
    "contract_one_year", "contract_two_year", "payment_electronic",
    "payment_auto", "has_internet", "has_fiber", "is_senior",
    "has_partner", "has_dependents", "paperless_billing",
    "has_security", "has_support", "has_streaming",
]
ALL_FEATURES = NUMERIC_FEATURES + BINARY_FEATURES
TARGET = "churn_label"
ID = "customerID"
FEATURE_TABLE_COLUMNS = [ID] + ALL_FEATURES + [TARGET, "feature_timestamp"]

SERVICE_COLUMNS = [
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
]
SERVICE_ON_VALUES = ["Yes", "DSL", "Fiber optic"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]

MODEL_PREFIX = "telco-churn-"
MODEL_KEYS = ["logistic_regression", "random_forest", "gradient_boosting"]
DEFAULT_AB_MODEL_A = "telco-churn-random_forest"
DEFAULT_AB_MODEL_B = "telco-churn-gradient_boosting"
DEFAULT_AB_WEIGHT_A = 0.8
DEFAULT_AB_WEIGHT_B = 0.2
RISK_HIGH = 0.7
RISK_MEDIUM = 0.4
DECISION_THRESHOLD = 0.5
PROMOTION_ACCURACY = 0.80
# ---------------------------------------------------------------------------

_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

RAW_SCHEMA = T.StructType(
    [T.StructField("customerID", _S), T.StructField("SeniorCitizen", _I)]
    + [T.StructField(c, _S) for c in ["Partner", "Dependents"]]
    + [T.StructField("tenure", _I)]
    + [T.StructField(c, _S) for c in RAW_COLUMNS[5:17]]
    + [T.StructField("MonthlyCharges", _D), T.StructField("TotalCharges", _S), T.StructField("Churn", _S)]
)

_INT_FEATURES = {"tenure_months", "total_services", "risk_score"}

FEATURE_SCHEMA = T.StructType(
    [T.StructField(ID, _S)]
    + [T.StructField(c, _I if c in _INT_FEATURES else _D) for c in NUMERIC_FEATURES]
    + [T.StructField(c, _I) for c in BINARY_FEATURES]
    + [T.StructField(TARGET, _I), T.StructField("feature_timestamp", T.TimestampNTZType())]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", _S),
        T.StructField("tenure_months", _D),
        T.StructField("monthly_charges", _D),
        T.StructField("total_charges", _D),
        T.StructField("contract_type", _S),
        T.StructField("payment_method", _S),
        T.StructField("internet_service", _S),
        T.StructField("has_phone", _B),
        T.StructField("has_partner", _B),
        T.StructField("has_dependents", _B),
        T.StructField("is_senior", _B),
        T.StructField("has_online_security", _B),
        T.StructField("has_tech_support", _B),
        T.StructField("has_streaming", _B),
        T.StructField("paperless_billing", _B),
    ]
)
REQUEST_REQUIRED = [
    "customer_id", "tenure_months", "monthly_charges", "total_charges",
    "contract_type", "payment_method", "internet_service",
]
REQUEST_NON_NEGATIVE = ["tenure_months", "monthly_charges", "total_charges"]
# Defaults of the optional request booleans (fixed values).
REQUEST_DEFAULTS = {
    "has_phone": True, "has_partner": False, "has_dependents": False, "is_senior": False,
    "has_online_security": False, "has_tech_support": False, "has_streaming": False,
    "paperless_billing": False,
}

PREDICTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("customer_id", _S),
        T.StructField("latency_ms", _D),
        T.StructField("endpoint", _S),
        T.StructField("model", _S),
        T.StructField("ab_group", _S),
    ]
)

MODEL_VERSION_SCHEMA = T.StructType(
    [T.StructField(c, _S) for c in ["name", "version", "run_id", "stage"]]
)

AB_CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("model_a", _S),
        T.StructField("model_b", _S),
        T.StructField("weight_a", _D),
        T.StructField("weight_b", _D),
        T.StructField("enabled", _B),
    ]
)
