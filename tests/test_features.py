"""Feature semantics: pandas-style nulls (D1/D2), worked example, one-hot properties."""

import datetime as dt

from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.operators import features as feat
from churnlake.operators import scoring as sco


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


BASE = dict(customerID="c1", SeniorCitizen=0, Partner="Yes", Dependents="No", tenure=12, PhoneService="Yes",
            MultipleLines="No", InternetService="Fiber optic", OnlineSecurity="No", OnlineBackup="Yes",
            DeviceProtection="No", TechSupport="No", StreamingTV="Yes", StreamingMovies="No",
            Contract="Month-to-month", PaperlessBilling="Yes", PaymentMethod="Electronic check",
            MonthlyCharges=70.0, TotalCharges="840.0", Churn="Yes")


def _row(**kw):
    d = dict(BASE)
    d.update(kw)
    return tuple(d[c] for c in S.RAW_COLUMNS)


def test_null_semantics_and_blank_total(spark):
    raw = _raw(spark, [_row(customerID="n", InternetService=None, OnlineSecurity=None, TotalCharges=" ",
                            PaymentMethod=None, Contract=None, Churn=None)])
    r = feat.engineer_features(raw).first()
    assert r.has_internet == 1          # != 'No' on null -> 1 (D1)
    assert r.has_fiber == 0             # == on null -> 0
    assert r.total_charges == 70.0      # blank -> null -> MonthlyCharges (D2)
    assert r.payment_auto == 0 and r.payment_electronic == 0  # D11: null -> 0
    assert (r.contract_month_to_month, r.contract_one_year, r.contract_two_year) == (0, 0, 0)
    assert r.churn_label == 0


def test_feature_values(spark):
    r = feat.engineer_features(_raw(spark, [_row()])).first()
    assert r.tenure_years == 1.0
    assert r.avg_monthly_charge == 840.0 / 13
    assert r.total_services == 4        # phone, internet(fiber), backup, streaming tv
    assert r.has_security == 1 and r.has_streaming == 1
    # 3 (m2m) + 2 (electronic) + 0 (tenure 12) + 1 (no support) + 1 (fiber) - 0
    assert r.risk_score == 7


def test_feature_table_shape(spark):
    ts = dt.datetime(2024, 2, 1)
    t = feat.feature_table(_raw(spark, [_row(), _row(customerID="c2", tenure=30)]), ts)
    assert t.columns == S.FEATURE_TABLE_COLUMNS
    assert len(S.ALL_FEATURES) == 24
    assert t.filter(F.col("contract_month_to_month") + F.col("contract_one_year") + F.col("contract_two_year") > 1).count() == 0


def test_missing_service_columns_skipped(spark):
    raw = _raw(spark, [_row()]).drop("StreamingTV", "StreamingMovies")
    r = raw.select(feat.service_count(raw.columns).alias("n")).first()
    assert r.n == 3


def test_worked_request_example(spark):
    """The serving example: avg = 959.88/13, 3 services, risk 3+2+1+1 = 7."""
    req = spark.createDataFrame(
        [("CUST001", 12.0, 79.99, 959.88, "Month-to-month", "Electronic check", "Fiber optic",
          True, False, False, False, False, False, True, True)], S.REQUEST_SCHEMA)
    r = sco.request_features(req).first()
    assert r.avg_monthly_charge == 959.88 / 13
    assert r.total_services == 3
    assert r.risk_score == 7
    assert r.is_new_customer == 0 and r.is_loyal_customer == 0
    assert r.payment_electronic == 1 and r.payment_auto == 0


def test_request_defaults(spark):
    req = spark.createDataFrame(
        [("x", 30.0, 10.0, 100.0, "Two year", "Credit card (automatic)", "No",
          None, None, None, None, None, None, None, None)], S.REQUEST_SCHEMA)
    r = sco.request_features(req).first()
    assert r.total_services == 1        # has_phone defaults to True
    assert r.risk_score == -2 + 1       # loyal, no support
    assert r.payment_auto == 1


def test_risk_level_and_decision(spark):
    df = spark.createDataFrame([(0.69999,), (0.7,), (0.4,), (0.39,), (0.5,)], "probability double")
    out = sco.present(df).collect()
    assert [r.risk_level for r in out] == ["MEDIUM", "HIGH", "MEDIUM", "LOW", "MEDIUM"]
    assert [r.churn_prediction for r in out] == [True, True, False, False, True]
    assert out[1].probability_text == "70.0%"
    assert out[1].decision_text == "WILL CHURN" and out[3].decision_text == "WILL STAY"
