"""Feature derivation (P1-P17): raw churn rows -> the 24-feature table.

Everything is one projection of built-in expressions: no shuffle, whole-stage
codegen, column pruning reaches the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.functions import flag_any_eq, flag_cmp, flag_eq, flag_icontains, flag_in, flag_ne, ntz_lit


def clean_total_charges(raw: DataFrame) -> Column:
    """P2 + P3: numeric TotalCharges, unparsable -> null -> MonthlyCharges."""
    return F.coalesce(F.col("TotalCharges").try_cast("double"), F.col("MonthlyCharges"))


def service_count(columns: list[str]) -> Column:
    """P10: how many service columns hold an 'on' value; absent columns skipped."""
    present = [c for c in S.SERVICE_COLUMNS if c in columns]
    if not present:
        return F.lit(0)
    total = None
    for c in present:
        e = flag_in(c, S.SERVICE_ON_VALUES)
        total = e if total is None else total + e
    return total


def risk_score(contract_m2m: Column, payment_electronic: Column, is_new: Column,
               has_support: Column, has_fiber: Column, is_loyal: Column) -> Column:
    """Weighted heuristic risk (weights are fixed values 3, 2, 2, 1, 1, -2)."""
    return (
        contract_m2m * 3
        + payment_electronic * 2
        + is_new * 2
        + (F.lit(1) - has_support) * 1
        + has_fiber * 1
        - is_loyal * 2
    )


def engineer_features(raw: DataFrame) -> DataFrame:
    """Raw table -> raw columns + churn_label + 24 features.

    Flags follow the reference's null semantics (see ``functions.flags``).
    ``tenure + 1`` divisions use ``try_divide`` so tenure = -1 gives null
    rather than failing the job under ANSI mode.
    """
    tenure = F.col("tenure")
    total = clean_total_charges(raw)
    base = raw.withColumn("TotalCharges", total)
    denom = tenure + 1
    flags = {
        "churn_label": flag_eq("Churn", "Yes"),  # P5
        "tenure_months": tenure,
        "tenure_years": tenure / 12,  # P9
        "is_new_customer": flag_cmp(tenure <= 6),  # P8
        "is_loyal_customer": flag_cmp(tenure >= 24),  # P8
        "monthly_charges": F.col("MonthlyCharges"),
        "total_charges": F.col("TotalCharges"),
        "avg_monthly_charge": F.try_divide(F.col("TotalCharges"), denom),  # P9
        "charge_per_tenure": F.try_divide(F.col("MonthlyCharges"), denom),  # P9
        "total_services": service_count(raw.columns),
        "contract_month_to_month": flag_eq("Contract", S.CONTRACTS[0]),
        "contract_one_year": flag_eq("Contract", S.CONTRACTS[1]),
        "contract_two_year": flag_eq("Contract", S.CONTRACTS[2]),
        "payment_electronic": flag_eq("PaymentMethod", "Electronic check"),  # P6
        "payment_auto": flag_icontains("PaymentMethod", "automatic"),  # P12
        "has_internet": flag_ne("InternetService", "No"),  # P7
        "has_fiber": flag_eq("InternetService", "Fiber optic"),  # P6
        "is_senior": F.col("SeniorCitizen"),
        "has_partner": flag_eq("Partner", "Yes"),  # P6
        "has_dependents": flag_eq("Dependents", "Yes"),  # P6
        "paperless_billing": flag_eq("PaperlessBilling", "Yes"),  # P6
        "has_security": flag_any_eq(["OnlineSecurity", "OnlineBackup", "DeviceProtection"], "Yes"),  # P13
        "has_support": flag_eq("TechSupport", "Yes"),  # P6
        "has_streaming": flag_any_eq(["StreamingTV", "StreamingMovies"], "Yes"),  # P13
    }
    out = base.select("*", *[e.alias(n) for n, e in flags.items()])
    score = risk_score(
        F.col("contract_month_to_month"), F.col("payment_electronic"), F.col("is_new_customer"),
        F.col("has_support"), F.col("has_fiber"), F.col("is_loyal_customer"),
    )
    return out.withColumn("risk_score", score)


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns added by a step (schema-only, no job)."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]


def select_features(engineered: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """P15 + P16: the canonical 27-column feature table, fixed order.

    ``run_ts`` is passed in, so re-running a snapshot gives identical rows.
    """
    ts = ntz_lit(run_ts).alias("feature_timestamp")
    return engineered.select(S.ID, *S.ALL_FEATURES, S.TARGET, ts)


def feature_table(raw: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """K2's core: raw -> 27-column feature table."""
    return select_features(engineer_features(raw), run_ts)


def fill_missing(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls in model inputs become 0."""
    return features.fillna(0, subset=columns or S.ALL_FEATURES)
