"""Registered queries over sinks and sources: written to the shared folder, read back, checked by SQL.

Each one writes rows derived from the given tables through the sink of SURVEY §2.1 and
returns what the matching source reads, so the SQL checks the files' content.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.operators import abtest as ab
from churnlake.operators import quality as qual
from churnlake.operators import registry as reg
from churnlake.plans import catalog, serving
from churnlake.plans import oracle as O
from churnlake.plans.catalog import ORACLE, QUERIES, RUN_TS, register
from churnlake.session import scratch_path
from churnlake.sources import documents as docs
from churnlake.sources import files


@register("ingest_csv", O.RAW + "SELECT * FROM raw")
def q_ingest_csv(spark, sf_dir):
    """S2 then S1: a file of 21 columns, one of them unknown and second, bound by name."""
    raw = fx.raw_customers(spark, sf_dir)
    path = scratch_path(spark, "raw_csv")
    files.write_raw_csv(raw.select(S.RAW_COLUMNS[0], F.lit("Female").alias("gender"), *S.RAW_COLUMNS[1:]), path)
    return files.read_raw_csv(spark, path)


@register("snapshot_latest", O.RAW + "SELECT *, CAST(2 AS INT) AS revision FROM raw")
def q_snapshot_latest(spark, sf_dir):
    """Two complete snapshots and a newer one without its success mark."""
    raw = fx.raw_customers(spark, sf_dir)
    base = scratch_path(spark, "snapshots")
    for revision in (1, 2, 3):
        path = files.write_snapshot(raw.withColumn("revision", F.lit(revision)), base, RUN_TS + _dt.timedelta(days=revision))
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    return files.read_latest(spark, base)


@register(
    "feature_schema_doc",
    O.FEAT + f"""SELECT COUNT(*) AS total_records, AVG(churn_label) AS churn_rate, '{",".join(S.NUMERIC_FEATURES)}' AS numeric_features,
  '{",".join(S.BINARY_FEATURES)}' AS binary_features, '{S.TARGET}' AS target, '{S.ID}' AS id, {O.RUN_TS_SQL} AS created_at FROM features""",
)
def q_feature_schema_doc(spark, sf_dir):
    """S8."""
    path = scratch_path(spark, "feature_schema")
    files.write_json_record(files.feature_schema_record(catalog.features(spark, sf_dir), RUN_TS), path)
    c = "feature_columns."
    return files.read_feature_schema(spark, path).select(
        "total_records", "churn_rate", F.array_join(c + "numeric_features", ",").alias("numeric_features"),
        F.array_join(c + "binary_features", ",").alias("binary_features"), c + "target", c + "id", "created_at")


@register(
    "run_records",
    O.PLOG + """SELECT strftime(ts, '%Y-%m-%d') AS execution_date, endpoint AS stage, COUNT(*) AS requests FROM plog GROUP BY ALL""",
)
def q_run_records(spark, sf_dir):
    """Records appended per execution date, in two runs (one per endpoint), the second of them retried."""
    log = fx.prediction_log(spark, sf_dir)
    records = log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("execution_date"), F.col("endpoint").alias("stage")).agg(
        F.count(F.lit(1)).alias("requests"))
    path = scratch_path(spark, "run_records")
    for stage in ("predict", "batch", "batch"):
        files.append_run_record(records.where(F.col("stage") == stage), path, f"run-{stage}")
    return spark.read.schema("stage string, requests long, execution_date string, run string").json(path).drop("run")


@register("artifact_csv", ORACLE["confusion_matrix"])
def q_artifact_csv(spark, sf_dir):
    """The confusion matrix as a CSV artifact."""
    matrix = QUERIES["confusion_matrix"](spark, sf_dir)
    path = scratch_path(spark, "artifact")
    files.write_csv_artifact(matrix, path)
    return spark.read.schema(matrix.schema).option("header", True).csv(path)


@register(
    "ab_config_doc",
    f"""SELECT champion AS champion_name, champion_weight, challenger AS challenger_name, challenger_weight, status,
  {O.RUN_TS_SQL} AS updated_at FROM ({ORACLE["ab_weights"]}) w""",
)
def q_ab_config_doc(spark, sf_dir):
    """S12."""
    ranked = catalog.ranked_models(spark, sf_dir)
    doc = docs.ab_config_document(ab.derive_ab_weights(ranked), ranked.select("name", "f1_score"), RUN_TS)
    path = scratch_path(spark, "ab_config")
    docs.write_ab_config(doc, path)
    return spark.read.schema(doc.schema).json(path).select(
        F.col("champion.name").alias("champion_name"), F.col("champion.weight").alias("champion_weight"),
        F.col("challenger.name").alias("challenger_name"), F.col("challenger.weight").alias("challenger_weight"), "status", "updated_at")


@register("evaluation_report_doc", ORACLE["evaluation_report"])
def q_evaluation_report_doc(spark, sf_dir):
    """The nested document, its sections read back and laid out as J3's rows."""
    report, ranked = catalog.evaluation_tables(spark, sf_dir)
    weights = ab.derive_ab_weights(ranked).first().asDict()  # one row
    doc = docs.report_document(report, weights, [], RUN_TS)
    back = spark.read.schema(doc.schema).json(docs.write_report(doc, scratch_path(spark, "reports"), RUN_TS))
    rows = back.select(F.explode("production_models").alias("m"), "model_comparison", "ab_configuration", "summary")
    compared = F.get(F.filter("model_comparison", lambda x: x["name"] == F.col("m.name")), F.lit(0))
    role = F.when(F.col("m.name") == F.col("ab_configuration.champion.name"), "champion").when(
        F.col("m.name") == F.col("ab_configuration.challenger.name"), "challenger")
    weight = F.when(role == "champion", F.col("ab_configuration.champion.weight")).when(role == "challenger", F.col("ab_configuration.challenger.weight"))
    return rows.select("m.name", "m.version", "m.run_id", compared["f1_score"].alias("f1_score"), compared["roc_auc"].alias("roc_auc"),
                       role.alias("role"), weight.alias("weight"), "summary.total_models", "summary.best_model")


@register("metric_lines_text", f"SELECT line FROM ({ORACLE['metric_lines']}) l")
def q_metric_lines_text(spark, sf_dir):
    """P24's text sink, read back line by line."""
    path = scratch_path(spark, "metric_lines")
    ab.write_metric_lines(ab.per_model_stats(fx.prediction_log(spark, sf_dir)).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@register(
    "timestamp_keys",
    O.PLOG + """SELECT request_id, strftime(ts, '%Y%m%d_%H%M%S') AS snapshot_key, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM plog""",
)
def q_timestamp_keys(spark, sf_dir):
    """P23 for every row of the prediction log."""
    key, iso = files.snapshot_key_col("ts")
    return fx.prediction_log(spark, sf_dir).select("request_id", key.alias("snapshot_key"), iso.alias("iso"))


@register("post_write_check", O.RAW + "SELECT COUNT(*) AS source_rows, COUNT(*) AS written_rows FROM raw")
def q_post_write_check(spark, sf_dir):
    """V7: the source's own count against that of the snapshot read back."""
    raw = fx.raw_customers(spark, sf_dir)
    written = spark.read.parquet(files.write_snapshot(raw, scratch_path(spark, "post_write"), RUN_TS))
    source_rows = raw.count()
    qual.verify_written(written, source_rows)
    return written.agg(F.lit(source_rows).alias("source_rows"), F.count(F.lit(1)).alias("written_rows"))


@register(
    "score_batch_rows",
    f"""SELECT v.customer_id, v.is_valid, v.reasons, CASE WHEN v.is_valid THEN m.model END AS model,
  CASE WHEN v.is_valid THEN m.ab_group END AS ab_group, CASE WHEN v.is_valid THEN m.model_name END AS model_name,
  CASE WHEN v.is_valid THEN m.model_version END AS model_version
FROM ({ORACLE["request_validation"]}) v JOIN ({ORACLE["model_lookup"]}) m ON v.customer_id = m.customer_id""",
)
def q_score_batch_rows(spark, sf_dir):
    """K5 without the models: every request's validity, and the route of the valid ones."""
    requests = fx.requests(spark, sf_dir)
    info = reg.serving_versions(fx.model_versions(spark, sf_dir))
    loaded = [S.MODEL_PREFIX + k for k in ("random_forest", "gradient_boosting", "logistic_regression")]
    routed = serving.routed_requests(requests, ab.ABConfig(), info, loaded).select(
        "customer_id", F.lit(True).alias("is_valid"), F.lit("").alias("reasons"), "model", "ab_group", "model_name", "model_version")
    null = F.lit(None).cast("string")
    rejected = serving.rejected_requests(requests).select(
        "customer_id", F.lit(False).alias("is_valid"), F.array_join("reasons", ";").alias("reasons"),
        *[null.alias(c) for c in ("model", "ab_group", "model_name", "model_version")])
    return routed.unionByName(rejected)
