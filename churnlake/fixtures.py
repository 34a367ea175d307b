"""Churn inputs derived from the driver tables (FIXTURES.md).

The reference has no test data; these relations give it the shapes it reads
(raw customers, scored predictions, requests, a prediction log, model
versions), derived row by row from ``customer``, ``orders`` and ``events``,
so that all work grows with those tables.

Scale notes: ``orders`` is reduced per ``o_custkey`` before the join (the
partial aggregate runs map-side, so a customer holding a third of all orders
is combined on every mapper first); the aggregate already comes out hash
partitioned on the key, so only ``customer`` moves for the join.  Everything
else is row-local (no shuffle).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.functions import ntz_lit, unit_hash

CHURN_CUTOFF = _dt.datetime(2000, 7, 1)
SPLIT_SALT = "split42"
FOLD_SALT = "fold42"
AB_SALT = "ab"
# Fixed values of the scored fixture: score strength per model.
SCORED_STRENGTH = [("logistic_regression", 0.6), ("random_forest", 0.8), ("gradient_boosting", 1.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod_lt(c: Column, m: int, k: int) -> Column:
    return (c % m) < k


def order_facts(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Per-customer order facts: count, spend (exact decimal), last order date; of ``orders`` (a micro-batch) if given."""
    return (
        (orders if orders is not None else table(spark, sf_dir, "orders"))
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"),
            F.max("o_orderdate").alias("last_order"),
        )
    )


def customer_base(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None,
                  facts: DataFrame | None = None) -> DataFrame:
    """``customer`` LEFT JOIN per-customer order facts, plus tenure ``t``.

    ``customers`` may be a subset of customer rows (a micro-batch), and
    ``facts`` an already written copy of ``order_facts``.
    """
    orders = facts if facts is not None else order_facts(spark, sf_dir)
    cust = (customers if customers is not None else table(spark, sf_dir, "customer")).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    b = cust.join(orders, cust.c_custkey == orders.o_custkey, "left").drop("o_custkey")
    t = ((F.col("c_custkey") * 31 + F.coalesce(F.col("n_orders"), F.lit(0)) * 7) % 73).cast("int")
    return b.withColumn("t", t)


def _yes_no(cond: Column) -> Column:
    return F.when(cond, "Yes").otherwise("No")


def _internet_dependent(k: Column, m: int, lt: int) -> Column:
    return F.when(k % 5 == 4, "No internet service").when(_mod_lt(k, m, lt), "Yes").otherwise("No")


def raw_columns(b: DataFrame) -> list[Column]:
    """The 20 raw columns as expressions over the base relation."""
    k = F.col("c_custkey")
    t = F.col("t")
    phone_absent = (k * 11) % 10 >= 9
    churn = (
        ((F.col("last_order").isNull() | (F.col("last_order") < ntz_lit(CHURN_CUTOFF))) & (k % 3 != 2))
        | ((k % 3 == 0) & (t <= 12))
    )
    return [
        F.col("c_name").alias("customerID"),
        F.when(F.col("c_nationkey") % 5 == 0, 1).otherwise(0).cast("int").alias("SeniorCitizen"),
        _yes_no((k * 3) % 10 < 5).alias("Partner"),
        _yes_no((k * 7) % 10 < 3).alias("Dependents"),
        t.alias("tenure"),
        _yes_no((k * 11) % 10 < 9).alias("PhoneService"),
        F.when(phone_absent, "No phone service").when(k % 4 < 2, "Yes").otherwise("No").alias("MultipleLines"),
        F.when(k % 29 == 0, F.lit(None).cast("string"))
        .when(k % 5 < 2, "DSL").when(k % 5 < 4, "Fiber optic").otherwise("No").alias("InternetService"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 4, "No internet service").when(k % 7 < 3, "Yes").otherwise("No").alias("OnlineSecurity"),
        _internet_dependent(k, 8, 3).alias("OnlineBackup"),
        _internet_dependent(k, 9, 3).alias("DeviceProtection"),
        _internet_dependent(k, 11, 4).alias("TechSupport"),
        _internet_dependent(k, 13, 6).alias("StreamingTV"),
        _internet_dependent(k, 16, 7).alias("StreamingMovies"),
        F.when(k % 3 == 0, "Month-to-month").when(k % 3 == 1, "One year").otherwise("Two year").alias("Contract"),
        _yes_no(k % 19 < 11).alias("PaperlessBilling"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Electronic check")
        .when(F.col("c_mktsegment") == "BUILDING", "Mailed check")
        .when(F.col("c_mktsegment") == "MACHINERY", "Bank transfer (automatic)")
        .otherwise("Credit card (Automatic)").alias("PaymentMethod"),
        (F.lit(18) + (F.col("c_acctbal") + 1000) / 110).alias("MonthlyCharges"),
        F.when(F.col("spend").isNull() | (t == 0), F.lit(" "))
        .otherwise(F.col("spend").cast("string")).alias("TotalCharges"),
        _yes_no(churn).alias("Churn"),
    ]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES §1: the 20-column raw churn table."""
    b = customer_base(spark, sf_dir)
    return b.select(*raw_columns(b))


def raw_customers_keyed(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None,
                        facts: DataFrame | None = None) -> DataFrame:
    """Raw columns plus ``c_custkey`` (used to derive requests)."""
    b = customer_base(spark, sf_dir, customers, facts)
    return b.select("c_custkey", *raw_columns(b))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES §4: (customerID, model, label, probability), three rows per customer.

    Models fan out with one ``explode`` of a fixed 3-element array: bounded,
    row-local, no join.
    """
    raw = raw_customers(spark, sf_dir)
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("s")) for m, s in SCORED_STRENGTH])
    long = raw.select(
        F.col("customerID"),
        F.col("Churn").eqNullSafe("Yes").cast("int").alias("label"),
        F.explode(models).alias("m"),
    ).select("customerID", F.col("m.model").alias("model"), "label", F.col("m.s").alias("s"))
    u = unit_hash(F.col("customerID"), F.col("model"))
    return long.select(
        "customerID", "model", "label",
        (F.lit(0.7) * u + (F.lit(0.3) * F.col("label")) * F.col("s")).alias("probability"),
    )


def requests(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None,
             facts: DataFrame | None = None) -> DataFrame:
    """FIXTURES §5: scoring requests derived from raw customers.

    ``monthly_charges`` is negated where ``c_custkey % 23 = 0`` and blank
    totals stay null, so validation has rows to reject; ``has_phone`` is
    left null where ``c_custkey % 13 = 0`` to exercise the defaults.
    """
    r = raw_customers_keyed(spark, sf_dir, customers, facts)
    k = F.col("c_custkey")
    return r.select(
        F.col("customerID").alias("customer_id"),
        F.col("tenure").cast("double").alias("tenure_months"),
        F.when(k % 23 == 0, -F.col("MonthlyCharges")).otherwise(F.col("MonthlyCharges")).alias("monthly_charges"),
        F.col("TotalCharges").try_cast("double").alias("total_charges"),
        F.col("Contract").alias("contract_type"),
        F.col("PaymentMethod").alias("payment_method"),
        F.col("InternetService").alias("internet_service"),
        F.when(k % 13 == 0, F.lit(None).cast("boolean")).otherwise(F.col("PhoneService").eqNullSafe("Yes")).alias("has_phone"),
        F.col("Partner").eqNullSafe("Yes").alias("has_partner"),
        F.col("Dependents").eqNullSafe("Yes").alias("has_dependents"),
        (F.col("SeniorCitizen") == 1).alias("is_senior"),
        F.col("OnlineSecurity").eqNullSafe("Yes").alias("has_online_security"),
        F.col("TechSupport").eqNullSafe("Yes").alias("has_tech_support"),
        (F.col("StreamingTV").eqNullSafe("Yes") | F.col("StreamingMovies").eqNullSafe("Yes")).alias("has_streaming"),
        F.col("PaperlessBilling").eqNullSafe("Yes").alias("paperless_billing"),
    )


def prediction_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """FIXTURES §6: one prediction-log row per event (works on a stream too)."""
    ev = events if events is not None else table(spark, sf_dir, "events")
    cid = F.col("user_id").cast("string")
    to_a = unit_hash(cid, AB_SALT) < F.lit(S.DEFAULT_AB_WEIGHT_A)
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        cid.alias("customer_id"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "view", "batch").otherwise("predict").alias("endpoint"),
        F.when(to_a, S.DEFAULT_AB_MODEL_A).otherwise(S.DEFAULT_AB_MODEL_B).alias("model"),
        F.when(to_a, "A").otherwise("B").alias("ab_group"),
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES §7: registry rows; ``version`` is a string on purpose."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    names = [S.MODEL_PREFIX + k for k in S.MODEL_KEYS]
    name = F.when(F.col("user_id") % 3 == 0, names[0]).when(F.col("user_id") % 3 == 1, names[1]).otherwise(names[2])
    eid = F.col("event_id")
    return ev.select(
        name.alias("name"),
        eid.cast("string").alias("version"),
        F.concat(F.lit("run-"), eid.cast("string")).alias("run_id"),
        F.when(eid % 97 == 0, "Production").when(eid % 7 == 0, "Archived").otherwise("None").alias("stage"),
    )
