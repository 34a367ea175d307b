"""Request-side features and prediction presentation.

The serving path derives features differently from training (D3): five
service flags instead of nine, "contains electronic" instead of equality,
and security = online security only.  Both forms are kept as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Absent optional booleans take their declared defaults; absent text
    fields take the serving defaults (contract 'Month-to-month', payment '',
    internet 'No')."""
    cols = []
    for f in requests.columns:
        if f in S.REQUEST_DEFAULTS:
            cols.append(F.coalesce(F.col(f), F.lit(S.REQUEST_DEFAULTS[f])).alias(f))
        else:
            cols.append(F.col(f))
    out = requests.select(*cols)
    for f, v in S.REQUEST_DEFAULTS.items():
        if f not in out.columns:
            out = out.withColumn(f, F.lit(v))
    return out


def _contains(c: str, needle: str) -> Column:
    return F.coalesce(F.lower(F.col(c)).contains(needle), F.lit(False))


def request_risk_score() -> Column:
    """The branching form of the risk heuristic (fixed weights)."""
    tenure = F.coalesce(F.col("tenure_months"), F.lit(0.0))
    contract = F.col("contract_type").eqNullSafe("Month-to-month")
    return (
        F.when(contract, 3).otherwise(0)
        + F.when(_contains("payment_method", "electronic"), 2).otherwise(0)
        + F.when(tenure <= 6, 2).when(tenure >= 24, -2).otherwise(0)
        + F.when(~F.col("has_tech_support"), 1).otherwise(0)
        + F.when(F.col("internet_service").eqNullSafe("Fiber optic"), 1).otherwise(0)
    )


def request_features(requests: DataFrame, keep: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """Requests -> the 24 model features in canonical order."""
    r = with_request_defaults(requests)
    tenure = F.coalesce(F.col("tenure_months"), F.lit(0.0))
    monthly = F.coalesce(F.col("monthly_charges"), F.lit(0.0))
    total = F.coalesce(F.col("total_charges"), F.lit(0.0))
    contract = F.coalesce(F.col("contract_type"), F.lit("Month-to-month"))
    internet = F.coalesce(F.col("internet_service"), F.lit("No"))
    has_internet = internet != "No"

    def b(c: Column) -> Column:
        return c.cast("int")

    feats = {
        "tenure_months": tenure,
        "tenure_years": tenure / 12,
        "monthly_charges": monthly,
        "total_charges": total,
        "avg_monthly_charge": F.try_divide(total, tenure + 1),
        "charge_per_tenure": F.try_divide(monthly, tenure + 1),
        "total_services": (
            b(F.col("has_phone")) + b(F.col("has_online_security")) + b(F.col("has_tech_support"))
            + b(F.col("has_streaming")) + b(has_internet)
        ),
        "risk_score": request_risk_score(),
        "is_new_customer": b(tenure <= 6),
        "is_loyal_customer": b(tenure >= 24),
        "contract_month_to_month": b(contract == "Month-to-month"),
        "contract_one_year": b(contract == "One year"),
        "contract_two_year": b(contract == "Two year"),
        "payment_electronic": b(_contains("payment_method", "electronic")),
        "payment_auto": b(_contains("payment_method", "automatic")),
        "has_internet": b(has_internet),
        "has_fiber": b(internet == "Fiber optic"),
        "is_senior": b(F.col("is_senior")),
        "has_partner": b(F.col("has_partner")),
        "has_dependents": b(F.col("has_dependents")),
        "paperless_billing": b(F.col("paperless_billing")),
        "has_security": b(F.col("has_online_security")),
        "has_support": b(F.col("has_tech_support")),
        "has_streaming": b(F.col("has_streaming")),
    }
    return r.select(*keep, *[feats[n].alias(n) for n in S.ALL_FEATURES])


def risk_level(p: Column | str = "probability") -> Column:
    """P20: HIGH >= .7, MEDIUM >= .4, else LOW."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c >= F.lit(S.RISK_HIGH), "HIGH").when(c >= F.lit(S.RISK_MEDIUM), "MEDIUM").otherwise("LOW")


def decision(p: Column | str = "probability") -> Column:
    """Churn when p >= 0.5."""
    c = F.col(p) if isinstance(p, str) else p
    return c >= F.lit(S.DECISION_THRESHOLD)


def percent_text(p: Column | str = "probability") -> Column:
    """P25: probability as a percent with one decimal."""
    c = F.col(p) if isinstance(p, str) else p
    return F.format_string("%.1f%%", c * 100)


def decision_text(pred: Column | str = "churn_prediction") -> Column:
    """P26."""
    c = F.col(pred) if isinstance(pred, str) else pred
    return F.when(c, "WILL CHURN").otherwise("WILL STAY")


def present(predictions: DataFrame, p: str = "probability") -> DataFrame:
    """P20 + P21 + P25 + P26 on scored rows."""
    return predictions.select(
        "*",
        decision(p).alias("churn_prediction"),
        risk_level(p).alias("risk_level"),
        percent_text(p).alias("probability_text"),
        decision_text(decision(p)).alias("decision_text"),
    )
