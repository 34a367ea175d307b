"""The registered queries: one per operator of SURVEY §2.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the driver tables
(through ``churnlake.fixtures``), so its work grows with them.  The DuckDB
oracle for a query, where SQL can express it, sits beside it in ``ORACLE``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.operators import features as feat
from churnlake.plans import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

RUN_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- shared inputs -----------------------------------------------------------
def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.engineer_features(fx.raw_customers(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.select_features(engineered(spark, sf_dir), RUN_TS)


# --- 2.2 projections ---------------------------------------------------------
@register("feature_table", O.FEAT + "SELECT * EXCLUDE (Contract) FROM features")
def q_feature_table(spark, sf_dir):
    return features(spark, sf_dir)


@register(
    "total_charges_clean",
    O.RAW + """SELECT customerID, TotalCharges AS total_charges_raw,
  COALESCE(TRY_CAST(TotalCharges AS DOUBLE), MonthlyCharges) AS total_charges,
  CAST(TRY_CAST(TotalCharges AS DOUBLE) IS NULL AS BOOLEAN) AS was_blank
FROM raw""",
)
def q_total_charges_clean(spark, sf_dir):
    raw = fx.raw_customers(spark, sf_dir)
    return raw.select(
        "customerID",
        F.col("TotalCharges").alias("total_charges_raw"),
        feat.clean_total_charges(raw).alias("total_charges"),
        F.col("TotalCharges").try_cast("double").isNull().alias("was_blank"),
    )


@register(
    "service_count",
    O.FEAT + """SELECT total_services, COUNT(*) AS customers,
  CAST(SUM(churn_label) AS BIGINT) AS churned
FROM features GROUP BY total_services""",
)
def q_service_count(spark, sf_dir):
    e = engineered(spark, sf_dir)
    return e.groupBy("total_services").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("churn_label").cast("long").alias("churned")
    )


@register(
    "contract_onehot",
    O.FEAT + """SELECT Contract, contract_month_to_month, contract_one_year, contract_two_year,
  COUNT(*) AS customers
FROM features GROUP BY ALL""",
)
def q_contract_onehot(spark, sf_dir):
    e = engineered(spark, sf_dir)
    cols = ["Contract", "contract_month_to_month", "contract_one_year", "contract_two_year"]
    return e.groupBy(*cols).agg(F.count(F.lit(1)).alias("customers"))


@register(
    "risk_score",
    O.FEAT + """SELECT customerID, contract_month_to_month, payment_electronic, is_new_customer,
  has_support, has_fiber, is_loyal_customer, risk_score
FROM features""",
)
def q_risk_score(spark, sf_dir):
    e = engineered(spark, sf_dir)
    return e.select(
        "customerID", "contract_month_to_month", "payment_electronic", "is_new_customer",
        "has_support", "has_fiber", "is_loyal_customer", "risk_score",
    )


@register(
    "risk_by_contract",
    O.FEAT + """SELECT Contract, COUNT(*) AS customers, AVG(churn_label) AS churn_rate,
  AVG(risk_score) AS mean_risk
FROM features GROUP BY Contract""",
)
def q_risk_by_contract(spark, sf_dir):
    """The minimum slice: parquet -> fixture -> features -> aggregate."""
    e = engineered(spark, sf_dir)
    return e.groupBy("Contract").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("churn_label").alias("churn_rate"),
        F.avg("risk_score").alias("mean_risk"),
    )


# --- 2.3 data quality, 2.5 summaries ----------------------------------------
from churnlake.functions import unit_hash_sql  # noqa: E402
from churnlake.operators import auc as auc_ops  # noqa: E402
from churnlake.operators import metrics as met  # noqa: E402
from churnlake.operators import quality as qual  # noqa: E402
from churnlake.operators import scaling as scl  # noqa: E402
from churnlake.operators import split as spl  # noqa: E402

_NULL_UNION = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, AVG(CAST({c} IS NULL AS DOUBLE)) AS null_share FROM raw" for c in S.RAW_COLUMNS
)


@register(
    "null_profile",
    O.RAW + f"SELECT column_name, null_share, null_share > CAST(0.5 AS DOUBLE) AS high_null FROM ({_NULL_UNION}) x",
)
def q_null_profile(spark, sf_dir):
    return qual.null_profile(fx.raw_customers(spark, sf_dir))


@register("label_distribution", O.RAW + "SELECT Churn, COUNT(*) AS count FROM raw WHERE Churn IS NOT NULL GROUP BY Churn")
def q_label_distribution(spark, sf_dir):
    return qual.label_distribution(fx.raw_customers(spark, sf_dir))


@register(
    "dataset_summary",
    O.RAW + "SELECT COUNT(*) AS rows, 20 AS columns, '" + ",".join(S.RAW_COLUMNS) + """' AS column_names,
  'Churn' AS target, AVG(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END)::DOUBLE AS churn_rate,
  'customer+orders' AS source FROM raw""",
)
def q_dataset_summary(spark, sf_dir):
    s = qual.dataset_summary(fx.raw_customers(spark, sf_dir), source="customer+orders")
    return s.withColumn("column_names", F.array_join("column_names", ","))


# --- 2.7 split, weights, scaling --------------------------------------------
_SPLIT_SQL = f"CASE WHEN {unit_hash_sql('customerID', 'split42')} < CAST(0.8 AS DOUBLE) THEN 'train' ELSE 'test' END"


@register(
    "split_counts",
    O.FEAT + f"""SELECT split, churn_label, COUNT(*) AS rows,
  COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY split) AS share
FROM (SELECT {_SPLIT_SQL} AS split, churn_label FROM features) s GROUP BY split, churn_label""",
)
def q_split_counts(spark, sf_dir):
    return spl.split_counts(features(spark, sf_dir))


_CUT = "({n} + 4) // 5"


@register(
    "stratified_split",
    O.FEAT + f""", s AS (
  SELECT customerID, churn_label, COUNT(*) OVER (PARTITION BY churn_label) AS n,
    ROW_NUMBER() OVER (PARTITION BY churn_label ORDER BY {unit_hash_sql('customerID', 'split42')}, customerID) AS rn FROM features),
p AS (SELECT customerID, churn_label, CASE WHEN rn <= {_CUT.format(n='n')} THEN 'test' ELSE 'train' END AS split FROM s),
f AS (
  SELECT customerID, CAST((ROW_NUMBER() OVER (PARTITION BY churn_label ORDER BY {unit_hash_sql('customerID', 'fold42')}, customerID) - 1) * 5
    // COUNT(*) OVER (PARTITION BY churn_label) AS INT) AS fold
  FROM p WHERE split = 'train')
SELECT p.customerID, churn_label, split, fold FROM p LEFT JOIN f ON p.customerID = f.customerID""",
)
def q_stratified_split(spark, sf_dir):
    """M1 and M7's folds as training cuts them: exact class shares, the fold null in the test part."""
    f = features(spark, sf_dir).select(S.ID, S.TARGET)
    f = f.withColumn("split", spl.exact_split_column(f))
    train = f.filter(F.col("split") == "train")
    return f.withColumn("fold", F.when(F.col("split") == "train", spl.exact_fold_column(train)))


def train_part(spark, sf_dir):
    return spl.train_test(feat.fill_missing(features(spark, sf_dir)))[0]


@register(
    "class_weights",
    O.FEAT + f"""SELECT churn_label, COUNT(*) AS n_c,
  SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)) AS weight
FROM features WHERE {_SPLIT_SQL} = 'train' GROUP BY churn_label""",
)
def q_class_weights(spark, sf_dir):
    return scl.class_weights(train_part(spark, sf_dir))


def _round_cols(df: DataFrame, cols, digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


_STATS_UNION = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, AVG({c}) AS mean, STDDEV_POP({c}) AS std FROM tr" for c in S.NUMERIC_FEATURES
)


@register(
    "scaler_stats",
    O.FEAT + f""", tr AS (SELECT * FROM features WHERE {_SPLIT_SQL} = 'train')
SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std,
  round(CASE WHEN std = 0 THEN CAST(1 AS DOUBLE) ELSE std END, 6) AS scale
FROM ({_STATS_UNION}) x""".replace("WITH ", "WITH ", 1),
)
def q_scaler_stats(spark, sf_dir):
    return _round_cols(scl.scaler_stats(train_part(spark, sf_dir)), {"mean", "std", "scale"}, 6)


_STD_COLS = ",\n  ".join(
    f"round(({c} - st_{c}.mean) / CASE WHEN st_{c}.std = 0 THEN CAST(1 AS DOUBLE) ELSE st_{c}.std END, 6) AS {c}"
    for c in S.NUMERIC_FEATURES
)
_STD_JOINS = " ".join(
    f"CROSS JOIN (SELECT AVG({c}) AS mean, STDDEV_POP({c}) AS std FROM tr) st_{c}" for c in S.NUMERIC_FEATURES
)


@register(
    "standardized_features",
    O.FEAT + f""", tr AS (SELECT * FROM features WHERE {_SPLIT_SQL} = 'train')
SELECT customerID, {_STD_COLS}
FROM features {_STD_JOINS}""",
)
def q_standardized_features(spark, sf_dir):
    f = feat.fill_missing(features(spark, sf_dir))
    scaler = scl.FittedScaler.fit(spl.train_test(f)[0])
    out = scaler.transform(f.select(S.ID, *S.NUMERIC_FEATURES))
    return _round_cols(out, set(S.NUMERIC_FEATURES), 6)


# --- 2.5 metrics over the scored fixture -------------------------------------
def scored_long(spark, sf_dir):
    return fx.scored(spark, sf_dir).withColumn("prediction", met.predict_at("probability"))


_COUNTS_SQL = """, c AS (
  SELECT model,
    CAST(SUM(CASE WHEN label = 1 AND probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN label = 0 AND probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN label = 1 AND probability < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(SUM(CASE WHEN label = 0 AND probability < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM scored GROUP BY model)
"""


def _div0(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN CAST(0 AS DOUBLE) ELSE ({num}) / ({den}) END)"


@register(
    "confusion_matrix",
    O.SCORED + _COUNTS_SQL + """SELECT model, 'Actual_No' AS actual, tn AS Pred_No, fp AS Pred_Yes FROM c
UNION ALL SELECT model, 'Actual_Yes', fn, tp FROM c""",
)
def q_confusion_matrix(spark, sf_dir):
    return met.confusion_matrix(scored_long(spark, sf_dir))


_METRICS_SELECT = (
    "SELECT model, tp, fp, fn, tn, "
    + _div0("tp + tn", "tp + fp + fn + tn") + " AS accuracy, "
    + _div0("tp", "tp + fp") + " AS precision, "
    + _div0("tp", "tp + fn") + " AS recall, "
    + _div0("2 * tp", "2 * tp + fp + fn") + " AS f1_score FROM c"
)


@register("classification_metrics", O.SCORED + _COUNTS_SQL + _METRICS_SELECT)
def q_classification_metrics(spark, sf_dir):
    return met.classification_metrics(scored_long(spark, sf_dir))


@register(
    "classification_report",
    O.SCORED + _COUNTS_SQL + """, k AS (
  SELECT model,
    """ + _div0("tn", "tn + fn") + """ AS p0, """ + _div0("tn", "tn + fp") + """ AS r0,
    """ + _div0("2 * tn", "2 * tn + fn + fp") + """ AS f0, CAST(tn + fp AS DOUBLE) AS s0,
    """ + _div0("tp", "tp + fp") + """ AS p1, """ + _div0("tp", "tp + fn") + """ AS r1,
    """ + _div0("2 * tp", "2 * tp + fp + fn") + """ AS f1, CAST(tp + fn AS DOUBLE) AS s1
  FROM c)
SELECT model, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM k
UNION ALL SELECT model, '1', p1, r1, f1, s1 FROM k
UNION ALL SELECT model, 'accuracy', NULL, NULL, """ + _div0("CAST(tp + tn AS DOUBLE)", "s0 + s1") + """, s0 + s1
  FROM k JOIN c USING (model)
UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM k
UNION ALL SELECT model, 'weighted avg', """ + _div0("p0 * s0 + p1 * s1", "s0 + s1") + ", " + _div0(
        "r0 * s0 + r1 * s1", "s0 + s1") + ", " + _div0("f0 * s0 + f1 * s1", "s0 + s1") + """, s0 + s1 FROM k""",
)
def q_classification_report(spark, sf_dir):
    return met.classification_report(scored_long(spark, sf_dir))


@register(
    "roc_auc",
    O.SCORED + """, r AS (
  SELECT model, label,
    RANK() OVER (PARTITION BY model ORDER BY probability) AS rk,
    COUNT(*) OVER (PARTITION BY model, probability) AS tie
  FROM scored),
a AS (
  SELECT model, SUM(CASE WHEN label = 1 THEN 2 * rk + tie - 1 ELSE 0 END) AS r2,
    COUNT_IF(label = 1) AS p, COUNT_IF(label <> 1) AS n
  FROM r GROUP BY model)
SELECT model,
  CASE WHEN p = 0 OR n = 0 THEN NULL ELSE CAST(r2 - p * (p + 1) AS DOUBLE) / CAST(2 * p * n AS DOUBLE) END AS roc_auc,
  p AS positives, n AS negatives,
  CASE WHEN p = 0 OR n = 0 THEN 'one_class' ELSE 'ok' END AS status
FROM a""",
)
def q_roc_auc(spark, sf_dir):
    return auc_ops.roc_auc(scored_long(spark, sf_dir))


_FOLD_SQL = f"CAST(floor({unit_hash_sql('customerID', 'fold42')} * 5) AS INT)"


@register(
    "cv_summary",
    O.SCORED + f""", fc AS (
  SELECT model, {_FOLD_SQL} AS fold,
    SUM(CASE WHEN label = 1 AND probability >= 0.5 THEN 1 ELSE 0 END) AS tp,
    SUM(CASE WHEN label = 0 AND probability >= 0.5 THEN 1 ELSE 0 END) AS fp,
    SUM(CASE WHEN label = 1 AND probability < 0.5 THEN 1 ELSE 0 END) AS fn
  FROM scored GROUP BY ALL),
ff AS (SELECT model, fold, {_div0('2 * tp', '2 * tp + fp + fn')} AS f1 FROM fc)
SELECT model, round(AVG(f1), 9) AS cv_f1_mean, round(STDDEV_POP(f1), 9) AS cv_f1_std, COUNT(*) AS folds
FROM ff GROUP BY model""",
)
def q_cv_summary(spark, sf_dir):
    long = spl.with_folds(scored_long(spark, sf_dir))
    s = met.cv_summary(met.fold_f1(long))
    return _round_cols(s, {"cv_f1_mean", "cv_f1_std"}, 9)


_ORDER_SQL = "CASE model WHEN 'logistic_regression' THEN 0 WHEN 'random_forest' THEN 1 WHEN 'gradient_boosting' THEN 2 ELSE 3 END"


@register(
    "champion",
    O.SCORED + _COUNTS_SQL + f""", m AS ({_METRICS_SELECT})
SELECT model AS champion, f1_score FROM m ORDER BY f1_score DESC, {_ORDER_SQL} LIMIT 1""",
)
def q_champion(spark, sf_dir):
    m = met.classification_metrics(scored_long(spark, sf_dir))
    return met.champion(m, S.MODEL_KEYS)


@register(
    "model_rank",
    O.SCORED + _COUNTS_SQL + f""", m AS ({_METRICS_SELECT})
SELECT model, f1_score, roc_rank AS rank,
  CASE roc_rank WHEN 1 THEN 'champion' WHEN 2 THEN 'challenger' ELSE 'other' END AS role
FROM (SELECT model, f1_score, ROW_NUMBER() OVER (ORDER BY f1_score DESC, {_ORDER_SQL}) AS roc_rank FROM m) x""",
)
def q_model_rank(spark, sf_dir):
    m = met.classification_metrics(scored_long(spark, sf_dir)).select("model", "f1_score")
    return met.rank_models(m, S.MODEL_KEYS)


# --- 2.6 registry --------------------------------------------------------------
from churnlake.operators import abtest as ab  # noqa: E402
from churnlake.operators import explain as xpl  # noqa: E402
from churnlake.operators import registry as reg  # noqa: E402
from churnlake.operators import scoring as sco  # noqa: E402


@register(
    "latest_version",
    O.MV + """SELECT name, version, run_id, stage FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) AS rn FROM mv) x WHERE rn = 1""",
)
def q_latest_version(spark, sf_dir):
    return reg.latest_versions(fx.model_versions(spark, sf_dir))


@register(
    "serving_version",
    O.MV + """SELECT name, version, run_id, stage,
  CASE WHEN stage = 'Production' THEN 'Production' ELSE 'latest' END AS resolved_by FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name
    ORDER BY CASE WHEN stage = 'Production' THEN 1 ELSE 0 END DESC, CAST(version AS BIGINT) DESC) AS rn FROM mv) x
WHERE rn = 1""",
)
def q_serving_version(spark, sf_dir):
    return reg.serving_versions(fx.model_versions(spark, sf_dir))


_CHAMPION_SQL = _COUNTS_SQL + f""", m AS ({_METRICS_SELECT}),
champ AS (SELECT 'telco-churn-' || model AS name FROM m ORDER BY f1_score DESC, {_ORDER_SQL} LIMIT 1)
"""


def champion_names(spark, sf_dir) -> DataFrame:
    """The champion of the scored metrics as a one-row (name) table."""
    m = met.classification_metrics(scored_long(spark, sf_dir))
    return met.champion(m, S.MODEL_KEYS).select(reg.registered_name("champion").alias("name"))


@register(
    "promote_model",
    (O.with_ctes(O.CTE_RAW, O.CTE_SCORED, O.CTE_MODEL_VERSIONS).rstrip("\n") + _CHAMPION_SQL
                 + """, tgt AS (
  SELECT mv.name, max(CAST(mv.version AS BIGINT)) AS pv FROM mv JOIN champ ON mv.name = champ.name GROUP BY mv.name)
SELECT mv.name, mv.version, mv.run_id,
  CASE WHEN tgt.pv IS NOT NULL AND CAST(mv.version AS BIGINT) = tgt.pv THEN 'Production'
       WHEN tgt.pv IS NOT NULL AND mv.stage = 'Production' THEN 'Archived'
       ELSE mv.stage END AS stage
FROM mv LEFT JOIN tgt ON mv.name = tgt.name"""),
)
def q_promote_model(spark, sf_dir):
    return reg.promote_latest(fx.model_versions(spark, sf_dir), champion_names(spark, sf_dir))


# --- 2.8 A/B routing and stats -------------------------------------------------
@register(
    "ab_route",
    O.REQ + f"""SELECT customer_id,
  CASE WHEN {unit_hash_sql('customer_id', 'ab')} < CAST(0.8 AS DOUBLE) THEN 'telco-churn-random_forest'
       ELSE 'telco-churn-gradient_boosting' END AS model,
  CASE WHEN {unit_hash_sql('customer_id', 'ab')} < CAST(0.8 AS DOUBLE) THEN 'A' ELSE 'B' END AS ab_group
FROM requests""",
)
def q_ab_route(spark, sf_dir):
    return ab.route(fx.requests(spark, sf_dir).select("customer_id"), ab.ABConfig())


@register(
    "ab_route_disabled",
    O.REQ + "SELECT customer_id, 'telco-churn-random_forest' AS model, 'control' AS ab_group FROM requests",
)
def q_ab_route_disabled(spark, sf_dir):
    return ab.route(fx.requests(spark, sf_dir).select("customer_id"), ab.ABConfig().disable())


@register(
    "ab_stats",
    O.PLOG + """SELECT COUNT(*) AS total_requests,
  COUNT_IF(model = 'telco-churn-random_forest') AS model_a_requests,
  COUNT_IF(model = 'telco-churn-gradient_boosting') AS model_b_requests,
  round(COALESCE(AVG(CASE WHEN model = 'telco-churn-random_forest' THEN latency_ms END), 0), 6) AS model_a_avg_latency_ms,
  round(COALESCE(AVG(CASE WHEN model = 'telco-churn-gradient_boosting' THEN latency_ms END), 0), 6) AS model_b_avg_latency_ms,
  'telco-churn-random_forest' AS model_a_name, 'telco-churn-gradient_boosting' AS model_b_name,
  '{"telco-churn-random_forest":0.8,"telco-churn-gradient_boosting":0.2}' AS traffic_split
FROM plog WHERE endpoint = 'predict'""",
)
def q_ab_stats(spark, sf_dir):
    s = ab.ab_stats(fx.prediction_log(spark, sf_dir), ab.ABConfig()).withColumn("traffic_split", F.to_json("traffic_split"))
    return _round_cols(s, {"model_a_avg_latency_ms", "model_b_avg_latency_ms"}, 6)


@register(
    "batch_summary",
    O.PLOG + """SELECT COUNT(*) AS total_processed, round(COALESCE(AVG(latency_ms), 0), 6) AS avg_prediction_time_ms
FROM plog WHERE endpoint = 'batch'""",
)
def q_batch_summary(spark, sf_dir):
    return _round_cols(ab.batch_summary(fx.prediction_log(spark, sf_dir)), {"avg_prediction_time_ms"}, 6)


@register(
    "metric_lines",
    O.PLOG + """, st AS (SELECT model, COUNT(*) AS n, round(AVG(latency_ms), 6) AS lat FROM plog
  WHERE endpoint = 'predict' GROUP BY model)
SELECT model, 'requests_total' AS metric, printf('prediction_requests_total{model="%s"} %d', model, n) AS line FROM st
UNION ALL
SELECT model, 'latency_avg_ms', printf('prediction_latency_avg_ms{model="%s"} %.2f', model, lat) FROM st""",
)
def q_metric_lines(spark, sf_dir):
    st = ab.per_model_stats(fx.prediction_log(spark, sf_dir))
    return ab.metric_lines(st.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6)))


_RANKED_SQL = _COUNTS_SQL + f""", m AS ({_METRICS_SELECT}),
rk AS (SELECT 'telco-churn-' || model AS name, f1_score,
  ROW_NUMBER() OVER (ORDER BY f1_score DESC, {_ORDER_SQL}) AS rank FROM m),
w AS (
  SELECT MAX(CASE WHEN rank = 1 THEN name END) AS champion, MAX(CASE WHEN rank = 1 THEN f1_score END) AS champion_f1,
         MAX(CASE WHEN rank = 2 THEN name END) AS challenger, MAX(CASE WHEN rank = 2 THEN f1_score END) AS challenger_f1,
         COUNT(*) AS n_models
  FROM rk),
abw AS (
  SELECT champion, challenger, champion_f1, challenger_f1,
    CASE WHEN n_models >= 2 THEN champion_f1 - challenger_f1 END AS f1_gap,
    CASE WHEN n_models < 2 THEN NULL
         WHEN champion_f1 - challenger_f1 > CAST(0.1 AS DOUBLE) THEN CAST(0.9 AS DOUBLE)
         WHEN champion_f1 - challenger_f1 > CAST(0.05 AS DOUBLE) THEN CAST(0.8 AS DOUBLE)
         ELSE CAST(0.6 AS DOUBLE) END AS champion_weight,
    CASE WHEN n_models < 2 THEN NULL
         WHEN champion_f1 - challenger_f1 > CAST(0.1 AS DOUBLE) THEN CAST(0.1 AS DOUBLE)
         WHEN champion_f1 - challenger_f1 > CAST(0.05 AS DOUBLE) THEN CAST(0.2 AS DOUBLE)
         ELSE CAST(0.4 AS DOUBLE) END AS challenger_weight,
    CASE WHEN n_models = 0 THEN 'no_models' WHEN n_models < 2 THEN 'insufficient_models' ELSE 'updated' END AS status
  FROM w),
cfg AS (
  SELECT champion AS model_a, challenger AS model_b,
    CASE WHEN champion_weight + challenger_weight > 0 THEN champion_weight / (champion_weight + challenger_weight)
         ELSE champion_weight END AS weight_a,
    CASE WHEN champion_weight + challenger_weight > 0 THEN challenger_weight / (champion_weight + challenger_weight)
         ELSE challenger_weight END AS weight_b,
    status = 'updated' AS enabled
  FROM abw)
"""


def ranked_models(spark, sf_dir) -> DataFrame:
    m = met.classification_metrics(scored_long(spark, sf_dir)).select(
        "model", reg.registered_name("model").alias("name"), "f1_score", "accuracy", "precision", "recall"
    )
    return met.rank_models(m, S.MODEL_KEYS)


def derived_ab_weights(spark, sf_dir) -> DataFrame:
    return ab.derive_ab_weights(ranked_models(spark, sf_dir))


def derived_ab_config(spark, sf_dir) -> DataFrame:
    w = derived_ab_weights(spark, sf_dir)
    cfg = w.select(
        F.col("champion").alias("model_a"), F.col("challenger").alias("model_b"),
        F.col("champion_weight").alias("weight_a"), F.col("challenger_weight").alias("weight_b"),
        (F.col("status") == "updated").alias("enabled"),
    )
    return ab.normalise_config(cfg)


_SCORED_ALL = O.with_ctes(O.CTE_RAW, O.CTE_SCORED).rstrip("\n")


@register("ab_weights", _SCORED_ALL + _RANKED_SQL + "SELECT * FROM abw")
def q_ab_weights(spark, sf_dir):
    return derived_ab_weights(spark, sf_dir)


@register("ab_config", _SCORED_ALL + _RANKED_SQL + "SELECT * FROM cfg")
def q_ab_config(spark, sf_dir):
    return derived_ab_config(spark, sf_dir)


@register(
    "traffic_split",
    _SCORED_ALL + _RANKED_SQL + "SELECT model_a AS model, weight_a AS weight FROM cfg UNION ALL SELECT model_b, weight_b FROM cfg",
)
def q_traffic_split(spark, sf_dir):
    return ab.traffic_split(derived_ab_config(spark, sf_dir))


@register(
    "promotion_gate",
    _SCORED_ALL + _COUNTS_SQL + f""", m AS ({_METRICS_SELECT})
SELECT model, accuracy, CASE WHEN accuracy >= CAST(0.8 AS DOUBLE) THEN 'PROMOTE' ELSE 'REJECT' END AS decision FROM m""",
)
def q_promotion_gate(spark, sf_dir):
    m = met.classification_metrics(scored_long(spark, sf_dir)).select("model", "accuracy")
    return qual.promotion_gate(m)


# --- 2.2 request-side scoring expressions ---------------------------------------
def valid_requests(spark, sf_dir) -> DataFrame:
    return qual.split_valid(fx.requests(spark, sf_dir))[0]


@register("request_validation", O.REQ + "SELECT customer_id, reasons = '' AS is_valid, reasons FROM checked")
def q_request_validation(spark, sf_dir):
    v = qual.validate_requests(fx.requests(spark, sf_dir))
    return v.select("customer_id", "is_valid", F.array_join("reasons", ";").alias("reasons"))


@register("request_features", O.REQ + "SELECT * FROM rfeat")
def q_request_features(spark, sf_dir):
    return sco.request_features(valid_requests(spark, sf_dir))


@register("request_risk_score", O.REQ + "SELECT customer_id, risk_score, total_services FROM rfeat")
def q_request_risk_score(spark, sf_dir):
    return sco.request_features(valid_requests(spark, sf_dir)).select("customer_id", "risk_score", "total_services")


@register(
    "risk_level_counts",
    O.SCORED + """SELECT model, CASE WHEN probability >= CAST(0.7 AS DOUBLE) THEN 'HIGH'
  WHEN probability >= CAST(0.4 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, COUNT(*) AS count
FROM scored GROUP BY ALL""",
)
def q_risk_level_counts(spark, sf_dir):
    s = fx.scored(spark, sf_dir)
    return s.groupBy("model", sco.risk_level("probability").alias("risk_level")).agg(F.count(F.lit(1)).alias("count"))


@register(
    "prediction_display",
    O.SCORED + """SELECT customerID, model, probability, probability >= CAST(0.5 AS DOUBLE) AS churn_prediction,
  CASE WHEN probability >= CAST(0.7 AS DOUBLE) THEN 'HIGH' WHEN probability >= CAST(0.4 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  printf('%.1f%%', probability * 100) AS probability_text,
  CASE WHEN probability >= CAST(0.5 AS DOUBLE) THEN 'WILL CHURN' ELSE 'WILL STAY' END AS decision_text
FROM scored""",
)
def q_prediction_display(spark, sf_dir):
    return sco.present(fx.scored(spark, sf_dir).drop("label"))


_UNIFORM_TOP = "\nUNION ALL ".join(
    f"SELECT customer_id, {i + 1} AS rank, '{n}' AS feature, CAST({n} AS DOUBLE) AS value, "
    f"CAST(1 AS DOUBLE) / 24 AS importance, "
    f"CASE WHEN CAST({n} AS DOUBLE) > CAST(0.5 AS DOUBLE) THEN 'increases' ELSE 'decreases' END AS contribution FROM rfeat"
    for i, n in enumerate(S.ALL_FEATURES[:5])
)


@register("top_risk_factors", O.REQ + _UNIFORM_TOP)
def q_top_risk_factors(spark, sf_dir):
    """W6 for a model without importances (uniform branch of M9)."""
    f = sco.request_features(valid_requests(spark, sf_dir))
    return xpl.factors_long(xpl.with_top_factors(f, xpl.uniform_importances()), ["customer_id"])


@register(
    "model_lookup",
    O.with_ctes(O.CTE_RAW, O.CTE_REQUESTS, O.CTE_MODEL_VERSIONS) + f"""
, sv AS (SELECT name, version, run_id, stage FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name
    ORDER BY CASE WHEN stage = 'Production' THEN 1 ELSE 0 END DESC, CAST(version AS BIGINT) DESC) AS rn FROM mv) x
  WHERE rn = 1),
rt AS (SELECT customer_id,
  CASE WHEN {unit_hash_sql('customer_id', 'ab')} < CAST(0.8 AS DOUBLE) THEN 'telco-churn-random_forest'
       ELSE 'telco-churn-gradient_boosting' END AS model,
  CASE WHEN {unit_hash_sql('customer_id', 'ab')} < CAST(0.8 AS DOUBLE) THEN 'A' ELSE 'B' END AS ab_group
  FROM requests)
SELECT rt.customer_id, rt.model, rt.ab_group, r.model_name,
  COALESCE(d.version, 'unknown') AS model_version, COALESCE(d.stage, 'None') AS model_stage,
  COALESCE(d.run_id, 'unknown') AS model_run_id
FROM rt
JOIN (SELECT customer_id, CASE WHEN model IN ('telco-churn-random_forest', 'telco-churn-gradient_boosting',
        'telco-churn-logistic_regression') THEN model ELSE 'telco-churn-random_forest' END AS model_name FROM rt) r
  USING (customer_id)
LEFT JOIN sv d ON d.name = r.model_name""".replace(
        "\n, sv AS", ", sv AS", 1),
)
def q_model_lookup(spark, sf_dir):
    routed = ab.route(fx.requests(spark, sf_dir).select("customer_id"), ab.ABConfig())
    info = reg.serving_versions(fx.model_versions(spark, sf_dir))
    # The serving process loads the registered names, random forest first.
    loaded = [S.MODEL_PREFIX + k for k in ("random_forest", "gradient_boosting", "logistic_regression")]
    return xpl.lookup_model_info(routed, info, default_name=loaded[0], loaded=loaded)


# --- 2.4 J3: evaluation report ---------------------------------------------------
@register(
    "evaluation_report",
    O.with_ctes(O.CTE_RAW, O.CTE_SCORED, O.CTE_MODEL_VERSIONS).rstrip("\n") + _RANKED_SQL + """,
prod AS (SELECT name, version, run_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) AS rn
  FROM mv WHERE stage = 'Production') x WHERE rn = 1),
au AS (SELECT model, roc_auc FROM (
  SELECT model, CASE WHEN p = 0 OR n = 0 THEN NULL ELSE CAST(r2 - p * (p + 1) AS DOUBLE) / CAST(2 * p * n AS DOUBLE) END AS roc_auc
  FROM (SELECT model, SUM(CASE WHEN label = 1 THEN 2 * rk + tie - 1 ELSE 0 END) AS r2,
               COUNT_IF(label = 1) AS p, COUNT_IF(label <> 1) AS n
        FROM (SELECT model, label, RANK() OVER (PARTITION BY model ORDER BY probability) AS rk,
                     COUNT(*) OVER (PARTITION BY model, probability) AS tie FROM scored) r GROUP BY model) a) b)
SELECT prod.name, prod.version, prod.run_id, m.f1_score, au.roc_auc,
  CASE WHEN prod.name = abw.champion THEN 'champion' WHEN prod.name = abw.challenger THEN 'challenger' END AS role,
  CASE WHEN prod.name = abw.champion THEN abw.champion_weight WHEN prod.name = abw.challenger THEN abw.challenger_weight END AS weight,
  COUNT(*) OVER () AS total_models,
  (SELECT name FROM rk WHERE rank = 1) AS best_model
FROM prod
LEFT JOIN m ON prod.name = 'telco-churn-' || m.model
LEFT JOIN au ON prod.name = 'telco-churn-' || au.model
CROSS JOIN abw""",
)
def q_evaluation_report(spark, sf_dir):
    return evaluation_tables(spark, sf_dir)[0]


def evaluation_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """J3's report and the ranked models.  The scored rows are written once; one aggregate gives the counts and the ranking, one chain the AUC."""
    from churnlake.plans import reports
    from churnlake.session import write_shared

    long = write_shared(scored_long(spark, sf_dir), "scored")
    m = write_shared(met.classification_metrics(long).withColumn("name", reg.registered_name("model")), "metrics")  # one row per model
    ranked = met.rank_models(m.select("model", "name", "f1_score", "accuracy", "precision", "recall"), S.MODEL_KEYS)
    report = reports.evaluation_report(
        reg.production_versions(fx.model_versions(spark, sf_dir)), m.select("name", "f1_score"),
        auc_ops.roc_auc(long).select(reg.registered_name("model").alias("name"), "roc_auc"), ranked)
    return report, ranked


# --- 2.8 T1: streaming counters, checked against the batch SQL -------------------
@register(
    "stream_ab_stats",
    O.PLOG + """SELECT model, COUNT(*) AS requests, round(AVG(latency_ms), 6) AS avg_latency_ms
FROM plog WHERE endpoint = 'predict' GROUP BY model""",
)
def q_stream_ab_stats(spark, sf_dir):
    from churnlake.session import scratch_path
    from churnlake.streaming import ab_stats as sab

    out, cp = scratch_path(spark, "ab_counters"), scratch_path(spark, "ab_counters_cp")
    q = sab.start_counters(spark, sf_dir, out, cp, available_now=True)
    q.awaitTermination()
    return _round_cols(sab.read_counters(spark, out), {"avg_latency_ms"}, 6)


@register(
    "stream_ab_windows",
    O.PLOG + """SELECT date_trunc('hour', ts) AS window_start, model, COUNT(*) AS requests, round(AVG(latency_ms), 6) AS avg_latency_ms
FROM plog WHERE endpoint = 'predict' GROUP BY ALL""",
)
def q_stream_ab_windows(spark, sf_dir):
    """T1 by the hour of the request: intake, then watermarked windows, over all events."""
    from churnlake.session import scratch_path
    from churnlake.streaming import ab_windows as win

    out = scratch_path(spark, "ab_windows")
    win.start_intake(spark, sf_dir, out, scratch_path(spark, "ab_intake_cp")).awaitTermination()
    win.start_windows(spark, out, scratch_path(spark, "ab_windows_cp")).awaitTermination()
    return _round_cols(win.read_windows(spark, out), {"avg_latency_ms"}, 6)


@register("stream_request_features", O.REQ + "SELECT * FROM rfeat")
def q_stream_request_features(spark, sf_dir):
    """Orders streamed into the facts, then customers streamed into request features that read them."""
    from churnlake.session import scratch_path
    from churnlake.streaming import order_facts as of
    from churnlake.streaming import scoring as sscore

    facts, out = scratch_path(spark, "stream_facts"), scratch_path(spark, "stream_features")
    of.start_facts(spark, sf_dir, facts, scratch_path(spark, "stream_facts_cp")).awaitTermination()
    sscore.start_request_features(spark, sf_dir, of.facts_store(spark, facts), out, scratch_path(spark, "stream_features_cp")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# --- 2.7 Spark ML (rows-only: fitted models are not SQL-expressible) -------------
from churnlake.plans import trained  # noqa: E402


def _train_query(key):
    def q(spark, sf_dir):
        run = trained.models_for(spark, sf_dir, [key])
        data = trained.prepared(spark, sf_dir)
        from churnlake.plans import models as mdl

        return mdl.evaluate(mdl.long_predictions({key: run[key]}, data.test))

    return q


register("train_lr")(_train_query("logistic_regression"))
register("train_rf")(_train_query("random_forest"))
register("train_gbt")(_train_query("gradient_boosting"))


_ZEROS = ", ".join(f"('{c}')" for c in [*S.ALL_FEATURES, "intercept"])


@register("lr_gradient", f"SELECT feature, CAST(0 AS DOUBLE) AS gradient FROM (VALUES {_ZEROS}) v(feature)")
def q_lr_gradient(spark, sf_dir):
    """M4: at the optimum every component of the objective's gradient is zero (to 4 digits)."""
    from churnlake.plans import diagnostics

    m = trained.models_for(spark, sf_dir, ["logistic_regression"])["logistic_regression"]
    g = diagnostics.lr_gradient(m, trained.prepared(spark, sf_dir).train)
    return g.select("feature", F.abs(F.round("gradient", 4)).alias("gradient"))


_MODEL_ROWS = ", ".join(f"('{k}')" for k in S.MODEL_KEYS)


@register(
    "score_check",
    O.FEAT + f""", t AS (SELECT CAST(SUM({_CUT.format(n='n')}) AS BIGINT) AS rows FROM (SELECT COUNT(*) AS n FROM features GROUP BY churn_label) c)
SELECT model, rows, CAST(0 AS BIGINT) AS mismatches FROM t, (VALUES {_MODEL_ROWS}) v(model)""",
)
def q_score_check(spark, sf_dir):
    """The test part scored by the models' node tables and coefficients, against ``transform``."""
    from churnlake.plans import diagnostics

    models = trained.models_for(spark, sf_dir, list(S.MODEL_KEYS))
    return diagnostics.score_check(models, trained.prepared(spark, sf_dir).test)


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    from churnlake.plans import models as mdl

    data = trained.prepared(spark, sf_dir)
    return mdl.cross_validate_models(S.MODEL_KEYS, data).select("model", "cv_f1_mean", "cv_f1_std")


@register("model_importance")
def q_model_importance(spark, sf_dir):
    from churnlake.plans import models as mdl

    m = trained.models_for(spark, sf_dir, ["random_forest"])["random_forest"]
    t = xpl.importance_table(spark, "random_forest", mdl.importances(m))
    return xpl.sorted_importance(t)


@register("score_batch")
def q_score_batch(spark, sf_dir):
    from churnlake.plans import serving

    models = trained.registry_models(spark, sf_dir, ["random_forest", "gradient_boosting"])
    info = reg.serving_versions(fx.model_versions(spark, sf_dir))
    return serving.score_requests(fx.requests(spark, sf_dir), models, ab.ABConfig(), info)


@register("score_explain")
def q_score_explain(spark, sf_dir):
    from churnlake.plans import serving

    models = trained.registry_models(spark, sf_dir, ["random_forest", "gradient_boosting"])
    info = reg.serving_versions(fx.model_versions(spark, sf_dir))
    keys = ["customer_id", "churn_probability", "churn_prediction", "risk_level", "model", "ab_group", "model_version", "timestamp", "feature_importance"]
    ex = serving.explain_requests(fx.requests(spark, sf_dir), models, ab.ABConfig(), info, RUN_TS)
    return xpl.factors_long(ex.withColumn("feature_importance", F.to_json("feature_importance")).select(*keys, "top_risk_factors"), keys)


@register("stream_score")
def q_stream_score(spark, sf_dir):
    from churnlake.session import scratch_path
    from churnlake.streaming import scoring as sscore

    models = trained.registry_models(spark, sf_dir, ["random_forest", "gradient_boosting"])
    from churnlake.streaming import order_facts as of

    out, cp = scratch_path(spark, "stream_score"), scratch_path(spark, "stream_score_cp")
    facts = scratch_path(spark, "stream_facts")
    of.start_facts(spark, sf_dir, facts, scratch_path(spark, "stream_facts_cp")).awaitTermination()
    info = reg.serving_versions(fx.model_versions(spark, sf_dir))
    q = sscore.start_scoring(spark, sf_dir, models, ab.ABConfig(), out, cp, facts=of.facts_store(spark, facts), model_info=info)
    q.awaitTermination()
    return spark.read.parquet(out)


# --- A13 + P22: loaded models with display names and equal traffic shares -------
@register(
    "model_traffic",
    O.MV + """, sv AS (SELECT name, version, stage FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name
    ORDER BY CASE WHEN stage = 'Production' THEN 1 ELSE 0 END DESC, CAST(version AS BIGINT) DESC) AS rn FROM mv) x
  WHERE rn = 1)
SELECT name AS model_name,
  CASE WHEN starts_with(name, 'telco-churn-') THEN substr(name, 13) ELSE name END AS display_name,
  version AS model_version, stage,
  CAST(100 AS DOUBLE) / COUNT(*) OVER () AS traffic_percentage, true AS is_active
FROM sv""",
)
def q_model_traffic(spark, sf_dir):
    sv = reg.serving_versions(fx.model_versions(spark, sf_dir)).select(
        F.col("name").alias("model_name"), reg.display_name("name").alias("display_name"),
        F.col("version").alias("model_version"), "stage",
    )
    return ab.model_traffic(sv)


# --- 2.1 sinks and sources: written and read back -------------------------------
from churnlake.plans import roundtrips  # noqa: E402, F401
