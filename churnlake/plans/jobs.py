"""User-level jobs (K1-K6): the reference's pipeline as Spark jobs.

Layout under one base folder (a shared cluster path)::

    raw/snapshot=<key>/            K1  raw rows as Parquet (written once)
    raw_meta/snapshot=<key>/       K1  dataset metadata (S7)
    raw_malformed/snapshot=<key>/  K1  rows with a field that is not of its type
    features/snapshot=<key>/       K2  27-column feature table (S6)
    feature_schema/snapshot=<key>/ K2  feature schema document (S8)
    models/<key>/<model>/          K3  one PipelineModel per model (M10)
    cv/<key>/                      K3  held-out predictions of finished CV fits (M7), read again by a rerun
    registry/state-<version>-*/    K3  model-version table after promotion (W1-W3), committed on its predecessor
    runs/{params,metrics,tags}/    K3  run tables (M11), a folder per run
    summaries/snapshot=<key>/      K3  training summary (S11)
    artifacts/<key>/...            K3  importance and confusion CSVs (S14), classification report (A7)
    ab_config/                     K4  current A/B config (S12), overwritten
    reports/snapshot=<key>/        K4  evaluation report (S13)
    predictions/snapshot=<key>/    K5  scored requests
    rejects/snapshot=<key>/        K5  rejected requests with their reasons (V4)
    prediction_log/snapshot=<key>/ K5  one row per scored request (input of T1)
    batch_summaries/snapshot=<key>/ K5 how many were scored, and their mean time (A12)
    status/                        K6  run status rows by run and execution date (S10)

Every snapshot is written once; "latest" is its manifest's entry (S4).
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.functions import ntz_lit
from churnlake.operators import abtest as ab
from churnlake.operators import explain as xpl
from churnlake.operators import features as feat
from churnlake.operators import metrics as met
from churnlake.operators import quality as qual
from churnlake.operators import registry as reg
from churnlake.operators import split as spl
from churnlake.plans import models as mdl
from churnlake.plans import reports, serving
from churnlake.session import DEFAULT_CONF
from churnlake.sources import commits, files
from churnlake.sources import documents as docs


def _p(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


# --- K1 -------------------------------------------------------------------------
def _observing_session(spark: SparkSession) -> SparkSession:
    """A session of its own for an observed write.

    An ``Observation`` leaves its session holding an object that cannot be serialised, and
    tasks that capture a fitted linear model reach the session they were made in.
    """
    own = spark.newSession()
    for k in [*DEFAULT_CONF, "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]:
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            own.conf.set(k, spark.conf.get(k))
    return own


def ingest(spark: SparkSession, raw_csv: str, base: str, run_ts: _dt.datetime,
           min_rows: int = S.MIN_ROWS, source: str = "", url: str = "") -> dict:
    """K1: S1 -> V1 -> S3 with its metrics observed (A1, A3, V2, V3) -> A2, S7, V7 -> committed.

    The CSV is parsed once, by the snapshot's write (besides the line of its header).  The
    counts come from that write, the labels and malformed fields from columns of the
    written Parquet.  A snapshot that fails V2 or V7 is deleted and was never visible.
    """
    own = _observing_session(spark)
    parsed = files.parse_raw_csv(own, raw_csv)
    columns = [c for c in parsed.columns if c != files.MALFORMED]
    qual.require_columns(parsed)                       # V1: schema only
    seen = Observation("ingest")
    snap = files.write_snapshot(parsed.observe(seen, *qual.ingest_metrics(columns)), _p(base, "raw"), run_ts, commit=False)
    stats = seen.get
    rows = int(stats["rows"])
    written = spark.read.parquet(snap)
    try:
        if rows < min_rows:                            # V2
            raise qual.ValidationError(f"dataset too small: {rows} records, fewer than {min_rows}")
        qual.verify_written(written, rows)             # V7: the rows that passed through the write
    except qual.ValidationError:
        path = spark._jvm.org.apache.hadoop.fs.Path(snap)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        raise
    labels = {r[0]: int(r[1]) for r in qual.label_distribution(written).collect()}  # one row per label; nulls dropped (A2)
    high_null = [c for c in columns if rows and stats[f"null__{c}"] / rows > S.HIGH_NULL_SHARE]
    malformed = spark.read.schema(files.MALFORMED_SCHEMA).json(
        files.write_snapshot(files.malformed_fields(written), _p(base, "raw_malformed"), run_ts, fmt="json")).count()
    rate = F.lit(stats["churn_rate"]).cast("double")
    meta = spark.range(1).select(
        *qual.summary_document(F.lit(rows).cast("long"), rate, columns, source=source),
        ntz_lit(run_ts).alias("ingestion_timestamp"), F.lit(url).alias("source_url"))
    files.write_snapshot(meta, _p(base, "raw_meta"), run_ts, fmt="json")
    files.commit_snapshot(spark, _p(base, "raw"), run_ts)
    return {
        "rows": rows, "columns": len(columns), "churn_rate": stats["churn_rate"],
        "label_distribution": labels,
        "high_null_columns": high_null, "malformed": malformed, "snapshot": snap,
    }


# --- K2 -------------------------------------------------------------------------
def build_features(spark: SparkSession, base: str, run_ts: _dt.datetime) -> dict:
    """K2: S4 -> P1-P16 -> S6 -> S8."""
    raw = files.read_latest(spark, _p(base, "raw")).drop(files.MALFORMED)
    engineered = feat.engineer_features(raw)
    added = feat.new_columns(raw, engineered)  # P17 (schema only)
    table = feat.select_features(engineered, run_ts)
    snap = files.write_snapshot(table, _p(base, "features"), run_ts)
    schema_doc = files.feature_schema_record(spark.read.parquet(snap), run_ts)
    files.write_snapshot(schema_doc, _p(base, "feature_schema"), run_ts, fmt="json")
    return {"snapshot": snap, "new_columns": len(added)}


# --- K3 -------------------------------------------------------------------------
@dataclass
class TrainResult:
    champion: str
    metrics: list[dict]
    cv: dict[str, tuple[float, float]] = field(default_factory=dict)
    model_paths: dict[str, str] = field(default_factory=dict)


def registry(spark: SparkSession, base: str) -> DataFrame:
    """The model-version table as last committed."""
    return commits.read_table(spark, _p(base, "registry"))


def _promoted(spark: SparkSession, current: DataFrame | None, names: list[str], run_key: str, champion: str) -> DataFrame:
    """The registry after a training run: a new version (highest of the name + 1) per name, the champion's promoted."""
    if current is None:
        current = spark.createDataFrame([], S.MODEL_VERSION_SCHEMA)
    new = spark.createDataFrame([(n, f"run-{run_key}-{n}") for n in names], "name string, run_id string")
    latest = reg.latest_versions(current).select("name", reg.version_number().alias("_v"))
    added = new.join(latest, "name", "left").select(
        "name", (F.coalesce(F.col("_v"), F.lit(0)) + 1).cast("string").alias("version"), "run_id",
        F.lit("None").alias("stage"),
    )
    return reg.promote_latest(current.unionByName(added), spark.createDataFrame([(champion,)], "name string"))


def train(spark: SparkSession, base: str, run_ts: _dt.datetime, keys: list[str] | None = None,
          with_cv: bool = True) -> TrainResult:
    """K3: S5 -> P4 -> M1 -> M3/A10 -> A9 -> M4-M7 -> M12 -> A14 -> W1/W3 -> M10, M11, S11, S14."""
    keys = keys or list(S.MODEL_KEYS)
    key = files.snapshot_key(run_ts)
    feats = files.read_latest(spark, _p(base, "features"))
    data = mdl.prepare(feats)  # the training part is cached once
    try:
        fitted = mdl.fit_all(keys, data)
        cv = {}
        if with_cv:  # one row per model (bounded)
            for r in mdl.cross_validate_models(keys, data, ledger=_p(base, "cv", key)).collect():
                cv[r["model"]] = (float(r["cv_f1_mean"]), float(r["cv_f1_std"]))
    finally:
        data.train.unpersist()
    # Written once: the metrics, AUC, reports and matrices below all read these rows.
    long = mdl.materialise(mdl.long_predictions(fitted, data.test), "predictions")
    metrics = mdl.evaluate(long, materialize=False)
    metrics_rows = [r.asDict() for r in metrics.collect()]  # one row per model (bounded)
    champion = met.champion(metrics, keys).first()["champion"]

    run_ids = {k: f"run-{key}-{S.MODEL_PREFIX}{k}" for k in keys}
    paths = {}
    for k, m in fitted.items():
        paths[k] = _p(base, "models", key, k)
        mdl.save(m, paths[k], feats.select(*S.ALL_FEATURES).schema.json())

    # On the version it was made from: of two runs that promote at once the later one starts from the earlier one's table.
    commits.update_table(spark, _p(base, "registry"), key,
                         lambda current: _promoted(spark, current, [S.MODEL_PREFIX + k for k in keys], key, S.MODEL_PREFIX + champion))

    run = mdl.TrainingRun(fitted, metrics, cv, run_ids, data.n_train, long.filter(F.col("model") == keys[0]).count())
    files.append_run(mdl.run_params(spark, run, data), _p(base, "runs", "params"), key)
    run_metrics = mdl.run_metrics(run)
    if cv:
        cv_rows = [(run_ids[k], n, float(v)) for k, (mu, sd) in cv.items() for n, v in
                   (("cv_f1_mean", mu), ("cv_f1_std", sd))]
        run_metrics = run_metrics.unionByName(spark.createDataFrame(cv_rows, "run_id string, key string, value double"))
    files.append_run(run_metrics, _p(base, "runs", "metrics"), key)
    tags = spark.createDataFrame([(run_ids[k], "model_name", k) for k in keys], "run_id string, key string, value string")
    files.append_run(tags, _p(base, "runs", "tags"), key)

    results = metrics.withColumn("run_id", F.create_map(
        *[x for k in keys for x in (F.lit(k), F.lit(run_ids[k]))])[F.col("model")])
    files.write_snapshot(docs.training_summary(results, keys, run_ts), _p(base, "summaries"), run_ts, fmt="json")
    for k, m in fitted.items():
        imp = xpl.importance_table(spark, k, mdl.importances(m))
        files.write_csv_artifact(xpl.sorted_importance(imp).select("feature", "importance"),
                                 _p(base, "artifacts", key, k, "feature_importance"))
    cm = met.confusion_matrix(long)
    report = met.classification_report(long)
    for k in keys:
        files.write_json_record(report.filter(F.col("model") == k).drop("model"),
                                _p(base, "artifacts", key, k, "classification_report"))
        files.write_csv_artifact(cm.filter(F.col("model") == k).drop("model"),
                                 _p(base, "artifacts", key, k, "confusion_matrix"))
    return TrainResult(champion, metrics_rows, cv, paths)


# --- K4 -------------------------------------------------------------------------
def evaluate(spark: SparkSession, base: str, run_ts: _dt.datetime) -> dict:
    """K4: V5 -> M12 (on M1's test part, D6) -> W4 -> R7 -> S12 -> J3 -> S13.

    A model that can't be loaded or scored is recorded in ``failed`` and in the report,
    which is also written when no production model is left.
    """
    try:
        versions = registry(spark, base)
    except FileNotFoundError:
        versions = spark.createDataFrame([], S.MODEL_VERSION_SCHEMA)
    prod = reg.production_versions(versions)
    prod_rows = prod.collect()  # one row per model name (bounded)
    models: dict[str, PipelineModel] = {}
    failed: list[tuple[str, str]] = []
    comparison = spark.createDataFrame([], mdl.METRICS)
    if prod_rows:
        feats = files.read_latest(spark, _p(base, "features"))
        for r in prod_rows:
            key = r["name"][len(S.MODEL_PREFIX):]
            try:
                models[key] = mdl.load(_p(base, "models", r["run_id"].split("-")[1], key), S.ALL_FEATURES, feats.schema)
            except Exception as e:  # noqa: BLE001 - recorded (M12)
                failed.append((key, f"{type(e).__name__}: {e}"))
        test = spl.evaluation_sample(feat.fill_missing(feats))  # M2 = M1's test part (D6)
        comparison, unscored = mdl.compare_production(models, test)
        failed += unscored
    named = comparison.withColumn("name", reg.registered_name("model"))
    ranked = met.rank_models(named, [k for k in S.MODEL_KEYS if k in models] + sorted(set(models) - set(S.MODEL_KEYS)))
    weights = ab.derive_ab_weights(ranked)
    w = weights.first()
    if w["status"] == "updated":  # else the stored configuration stays
        cfg_doc = docs.ab_config_document(weights, named.select("name", "f1_score", "roc_auc"), run_ts)
        docs.write_ab_config(cfg_doc, _p(base, "ab_config"))
    report = reports.evaluation_report(
        prod, named.select("name", "f1_score"), named.select("name", "roc_auc"), ranked
    )
    path = docs.write_report(docs.report_document(report, w.asDict(), failed, run_ts), _p(base, "reports"), run_ts)
    return {"status": w["status"], "champion": w["champion"], "challenger": w["challenger"],
            "report": path, "failed": failed}


def load_ab_config(spark: SparkSession, base: str) -> ab.ABConfig:
    """Serving reads the stored configuration (one small document)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_p(base, "ab_config"))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return ab.ABConfig()
    doc = spark.read.json(_p(base, "ab_config")).first()
    if doc is None or doc["status"] != "updated":
        return ab.ABConfig()
    return ab.ABConfig(doc["champion"]["name"], doc["challenger"]["name"],
                       float(doc["champion"]["weight"]), float(doc["challenger"]["weight"]), True).normalised()


# --- K5 -------------------------------------------------------------------------
def score(spark: SparkSession, base: str, requests: DataFrame, run_ts: _dt.datetime, explain: bool = False) -> dict:
    """K5: stored models and A/B config -> V4 -> R1 -> M13 (with ``explain`` M14) -> predictions, rejects, a prediction log and its summary.

    A name whose serving version cannot be loaded is recorded and its rows go to the first loaded model.
    """
    info = reg.serving_versions(registry(spark, base))
    models: dict[str, PipelineModel] = {}
    failed: list[tuple[str, str]] = []
    for r in sorted(info.collect(), key=lambda r: r["name"]):  # one row per model name (bounded)
        try:
            models[r["name"]] = mdl.load(_p(base, "models", r["run_id"].split("-")[1], r["name"][len(S.MODEL_PREFIX):]), S.ALL_FEATURES)
        except Exception as e:  # noqa: BLE001 - recorded
            failed.append((r["name"], f"{type(e).__name__}: {e}"))
    if not models:
        raise FileNotFoundError(f"no model of {base} can be loaded: {failed}")
    cfg = load_ab_config(spark, base)
    how = serving.explain_requests if explain else serving.score_requests
    predictions = files.write_snapshot(how(requests, models, cfg, info, run_ts), _p(base, "predictions"), run_ts)
    rejects = files.write_snapshot(serving.rejected_requests(requests), _p(base, "rejects"), run_ts)
    written = spark.read.parquet(predictions)
    log = written.select(
        F.xxhash64("customer_id", "timestamp").alias("request_id"), F.col("timestamp").alias("ts"), "customer_id",
        F.lit(None).cast("double").alias("latency_ms"), F.lit("explain" if explain else "batch").alias("endpoint"), "model", "ab_group")
    logged = spark.read.schema(log.schema).parquet(files.write_snapshot(log, _p(base, "prediction_log"), run_ts))
    summary = ab.batch_summary(logged, "explain" if explain else "batch")
    summary = spark.read.schema(summary.schema).json(files.write_snapshot(summary, _p(base, "batch_summaries"), run_ts, fmt="json")).first().asDict()
    return {"scored": summary["total_processed"], "summary": summary, "rejected": spark.read.parquet(rejects).count(), "models": list(models), "failed": failed,
            "predictions": predictions}


# --- K6 -------------------------------------------------------------------------
def full_run(spark: SparkSession, raw_csv: str, base: str, run_ts: _dt.datetime,
             keys: list[str] | None = None, with_cv: bool = True) -> dict:
    """K6: K1 -> K2 -> K3 -> K4 with one ``run_ts``; status rows appended."""
    date = run_ts.strftime("%Y-%m-%d")

    def status(stage: str, detail: dict) -> None:
        row = [(stage, json.dumps(detail, default=str), run_ts, date)]
        df = spark.createDataFrame(row, "stage string, detail string, run_ts timestamp_ntz, execution_date string")
        files.append_run_record(df, _p(base, "status"), f"{files.snapshot_key(run_ts)}-{stage}")

    status("started", {})
    out = {"ingest": ingest(spark, raw_csv, base, run_ts)}
    out["features"] = build_features(spark, base, run_ts)
    tr = train(spark, base, run_ts, keys, with_cv)
    out["train"] = {"champion": tr.champion, "metrics": tr.metrics, "cv": tr.cv}
    out["evaluate"] = evaluate(spark, base, run_ts)
    status("completed", {"champion": tr.champion})
    return out
