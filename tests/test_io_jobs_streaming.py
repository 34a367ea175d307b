"""Sources and sinks round trips, streaming equals batch, and the full run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.operators import abtest as ab
from churnlake.plans import catalog, jobs
from churnlake.sources import files
from conftest import SF_MID, SF_SMALL


def test_csv_round_trip_keeps_blank(spark, tmp_dir):
    raw = fx.raw_customers(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "raw.csv")
    files.write_raw_csv(raw, path)
    back = files.read_raw_csv(spark, path)
    assert back.schema == S.RAW_SCHEMA
    assert back.filter(F.col("TotalCharges") == " ").count() == raw.filter(F.col("TotalCharges") == " ").count()
    assert back.filter(F.col("InternetService").isNull()).count() == raw.filter(F.col("InternetService").isNull()).count()
    assert sorted(back.collect()) == sorted(raw.collect())


def test_snapshots_write_once_and_latest(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    df1 = spark.createDataFrame([(1,)], "x int")
    df2 = spark.createDataFrame([(2,)], "x int")
    files.write_snapshot(df1, base, dt.datetime(2024, 1, 1))
    files.write_snapshot(df2, base, dt.datetime(2024, 1, 2))
    with pytest.raises(Exception):
        files.write_snapshot(df2, base, dt.datetime(2024, 1, 2))
    assert [r.x for r in files.read_latest(spark, base).collect()] == [2]
    assert files.list_snapshots(spark, base) == ["20240101_000000", "20240102_000000"]


def test_feature_schema_doc(spark, tmp_dir):
    feats = catalog.features(spark, SF_SMALL)
    doc = files.feature_schema_record(feats, dt.datetime(2024, 1, 1))
    path = os.path.join(tmp_dir, "schema")
    files.write_json_record(doc, path)
    r = files.read_feature_schema(spark, path).first()
    assert r.feature_columns.numeric_features == S.NUMERIC_FEATURES
    assert r.total_records == feats.count()


def test_listing(spark):
    listing = files.list_objects(spark, SF_SMALL, "*.parquet")
    assert "content" not in listing.columns
    s = files.listing_summary(listing).first()
    assert s.objects == len([f for f in os.listdir(SF_SMALL) if f.endswith(".parquet")])


def test_stream_counters_equal_batch(spark):
    stream = catalog.QUERIES["stream_ab_stats"](spark, SF_SMALL)
    batch = ab.per_model_stats(fx.prediction_log(spark, SF_SMALL))
    got = {r.model: (r.requests, r.avg_latency_ms) for r in stream.collect()}
    exp = {r.model: (r.requests, round(r.avg_latency_ms, 6)) for r in batch.collect()}
    assert got.keys() == exp.keys()
    for k in got:
        assert got[k][0] == exp[k][0] and abs(got[k][1] - exp[k][1]) < 1e-6


@pytest.mark.slow
def test_full_run(spark, tmp_dir):
    raw = fx.raw_customers(spark, SF_MID)
    csv = os.path.join(tmp_dir, "in.csv")
    files.write_raw_csv(raw, csv)
    base = os.path.join(tmp_dir, "lake")
    out = jobs.full_run(spark, csv, base, dt.datetime(2024, 3, 1), keys=["logistic_regression", "random_forest"],
                        with_cv=False)
    assert out["ingest"]["rows"] == 1500
    assert out["features"]["new_columns"] == 25
    aucs = {m["model"]: m["roc_auc"] for m in out["train"]["metrics"]}
    assert all(a > 0.5 for a in aucs.values())
    # Only the champion's name is promoted, so a first run has one production
    # model: evaluation reports it and serving keeps the default config.
    assert out["evaluate"]["status"] == "insufficient_models"
    assert jobs.load_ab_config(spark, base) == ab.ABConfig()
    reg_tbl = jobs.registry(spark, base)
    assert reg_tbl.filter(F.col("stage") == "Production").count() == 1
    assert spark.read.json(os.path.join(base, "status")).count() == 2
    report = spark.read.json(out["evaluate"]["report"]).first()
    assert report.summary.total_models == 1 and report.summary.best_model == report.production_models[0].name
    assert report.ab_configuration.status == "insufficient_models" and len(report.model_comparison) == 1
    key = files.snapshot_key(dt.datetime(2024, 3, 1))
    text = spark.read.json(os.path.join(base, "artifacts", key, "random_forest", "classification_report"))
    assert {r["class"] for r in text.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    params = {r.value for r in spark.read.parquet(os.path.join(base, "runs", "params")).filter("key = 'test_samples'").collect()}
    assert len(params) == 1 and 0 < int(params.pop()) < 1500


def test_evaluation_without_models_writes_a_report(spark, tmp_dir):
    out = jobs.evaluate(spark, os.path.join(tmp_dir, "lake_none"), dt.datetime(2024, 3, 5))
    report = spark.read.json(out["report"]).first()
    assert out["status"] == report.ab_configuration.status == "no_models"
    assert report.summary.total_models == 0 and report.production_models == []


def test_a_failing_model_is_recorded_and_types_are_checked(spark, tmp_dir):
    from pyspark.sql import types as T

    from churnlake.plans import models as mdl
    from churnlake.plans import trained

    class Broken:
        def transform(self, df):
            return df.select(F.raise_error(F.lit("bad row")).cast("double").alias("probability"), "*")

    data = trained.prepared(spark, SF_SMALL)
    good = trained.models_for(spark, SF_SMALL, ["logistic_regression"])["logistic_regression"]
    table, failed = mdl.compare_production({"broken": Broken(), "logistic_regression": good}, data.test)
    assert [r.model for r in table.collect()] == ["logistic_regression"] and [n for n, _ in failed] == ["broken"]
    path = os.path.join(tmp_dir, "typed")
    schema = data.test.select(*S.ALL_FEATURES).schema
    mdl.save(good, path, schema.json())
    mdl.load(path, S.ALL_FEATURES, schema)
    other = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    with pytest.raises(ValueError, match="types differ"):
        mdl.load(path, S.ALL_FEATURES, other)


def test_stream_scoring_equals_batch(spark):
    from churnlake.plans import serving, trained

    models = trained.registry_models(spark, SF_SMALL, ["logistic_regression", "random_forest"])
    cfg = ab.ABConfig(model_a=S.MODEL_PREFIX + "logistic_regression", model_b=S.MODEL_PREFIX + "random_forest")
    from churnlake.session import scratch_path
    from churnlake.streaming import scoring as sscore

    out, cp = scratch_path(spark, "t_stream"), scratch_path(spark, "t_stream_cp")
    sscore.start_scoring(spark, SF_SMALL, models, cfg, out, cp).awaitTermination()
    streamed = spark.read.parquet(out).drop("batch_id")
    batch = serving.score_requests(fx.requests(spark, SF_SMALL), models, cfg)
    key = ["customer_id", "model", "ab_group", "risk_level", "churn_prediction"]
    assert sorted(streamed.select(*key).collect()) == sorted(batch.select(*key).collect())
    a = {r.customer_id: r.churn_probability for r in streamed.collect()}
    b = {r.customer_id: r.churn_probability for r in batch.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_routed_scoring_uses_each_rows_own_model(spark):
    """Brute force: score every request with every model, keep the routed one."""
    from churnlake.operators import quality as qual
    from churnlake.operators import scoring as sco
    from churnlake.plans import models as mdl
    from churnlake.plans import serving, trained

    models = trained.registry_models(spark, SF_SMALL, ["logistic_regression", "random_forest"])
    cfg = ab.ABConfig(model_a=S.MODEL_PREFIX + "logistic_regression", model_b=S.MODEL_PREFIX + "random_forest")
    got = {r.customer_id: (r.model, r.churn_probability)
           for r in serving.score_requests(fx.requests(spark, SF_SMALL), models, cfg).collect()}
    feats = ab.route(sco.request_features(qual.split_valid(fx.requests(spark, SF_SMALL))[0]), cfg.normalised())
    routes = {r.customer_id: r.model for r in feats.select("customer_id", "model").collect()}
    assert got.keys() == routes.keys() and len(got) > 0
    for name, m in models.items():
        probs = {r.customer_id: r.p for r in m.transform(feats).select("customer_id", mdl.p1().alias("p")).collect()}
        for cid, routed in routes.items():
            if routed == name:
                assert got[cid][0] == name and abs(got[cid][1] - probs[cid]) < 1e-12


def test_train_job_records_cv(spark, tmp_dir):
    raw = fx.raw_customers(spark, SF_SMALL)
    csv = os.path.join(tmp_dir, "small.csv")
    files.write_raw_csv(raw, csv)
    base = os.path.join(tmp_dir, "lake_cv")
    ts = dt.datetime(2024, 3, 2)
    jobs.ingest(spark, csv, base, ts, min_rows=100)
    jobs.build_features(spark, base, ts)
    res = jobs.train(spark, base, ts, keys=["logistic_regression"], with_cv=True)
    assert set(res.cv) == {"logistic_regression"}
    mean, std = res.cv["logistic_regression"]
    assert 0.0 <= mean <= 1.0 and std >= 0.0
    keys = {r.key for r in spark.read.parquet(os.path.join(base, "runs", "metrics")).collect()}
    assert {"cv_f1_mean", "cv_f1_std", "f1_score", "roc_auc"} <= keys


def test_batch_facts_are_those_of_its_customers(spark):
    from churnlake.streaming import scoring as sscore

    facts = fx.order_facts(spark, SF_SMALL)
    batch = fx.table(spark, SF_SMALL, "customer").filter(F.col("c_custkey") % 2 == 0)
    a = fx.requests(spark, SF_SMALL, customers=batch, facts=sscore.facts_for_batch(facts, batch)).collect()
    b = fx.requests(spark, SF_SMALL, customers=batch, facts=facts).collect()
    assert len(a) == batch.count() and sorted(a) == sorted(b)


def test_malformed_fields_are_recorded(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    spark.createDataFrame([("a", "x", "1.5"), ("b", "3", None), ("c", "1.5", "z")], "customerID string, tenure string, MonthlyCharges string").coalesce(1) \
        .write.option("header", True).csv(path)
    got = sorted(tuple(r) for r in files.malformed_fields(files.parse_raw_csv(spark, path)).collect())
    assert ("a", "tenure", "x") in got and ("c", "MonthlyCharges", "z") in got and not any(g[0] == "b" for g in got)


def test_scoring_job_follows_the_stored_config(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "k5.csv")
    files.write_raw_csv(fx.raw_customers(spark, SF_SMALL), csv)
    base = os.path.join(tmp_dir, "lake_k5")
    ts = dt.datetime(2024, 3, 3)
    jobs.ingest(spark, csv, base, ts, min_rows=100)
    jobs.build_features(spark, base, ts)
    jobs.train(spark, base, ts, keys=["logistic_regression"], with_cv=False)
    requests = fx.requests(spark, SF_SMALL)
    first = jobs.score(spark, base, requests, ts)
    assert first["scored"] + first["rejected"] == requests.count() and not first["failed"]
    seen = {r.model for r in spark.read.parquet(first["predictions"]).select("model").distinct().collect()}
    assert seen == {S.DEFAULT_AB_MODEL_A, S.DEFAULT_AB_MODEL_B}
    name = S.MODEL_PREFIX + "logistic_regression"
    spark.createDataFrame([((name, 1.0), (name, 0.0), "updated")], "champion struct<name:string,weight:double>, challenger struct<name:string,weight:double>, status string") \
        .coalesce(1).write.mode("overwrite").json(os.path.join(base, "ab_config"))
    second = jobs.score(spark, base, requests, ts + dt.timedelta(days=1))
    rows = spark.read.parquet(second["predictions"])
    assert rows.filter(F.col("model") != name).count() == 0 and rows.filter(F.col("model_version") != "1").count() == 0
    assert {"timestamp", "ab_group", "model_name"} <= set(rows.columns)
    assert files.read_latest(spark, os.path.join(base, "prediction_log")).count() == second["scored"]


def test_half_written_counters_are_not_read(spark, tmp_dir):
    from churnlake.streaming import ab_stats as sab

    out = os.path.join(tmp_dir, "counters")
    with pytest.raises(FileNotFoundError):
        sab.read_counters(spark, out)
    for batch, n in ((9, 1), (10, 2), (11, 3)):
        spark.createDataFrame([("m", n)], "model string, requests long").write.parquet(f"{out}/batch_id={batch}")
    os.remove(f"{out}/batch_id=11/_SUCCESS")
    got = sab.read_counters(spark, out)
    assert got.columns == ["model", "requests"] and [r.requests for r in got.collect()] == [2]


def test_changed_tables_are_fitted_anew(spark, tmp_dir):
    import shutil

    from churnlake.plans import trained

    folder = os.path.join(tmp_dir, "tables")
    os.mkdir(folder)
    for name in ("customer", "orders", "events"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", f"{folder}/{name}.parquet")
    first = trained.prepared(spark, folder)
    assert trained.prepared(spark, folder) is first
    kept = spark.read.parquet(f"{SF_SMALL}/customer.parquet").filter("c_custkey % 2 = 0").toArrow()
    import pyarrow.parquet as pq

    pq.write_table(kept, f"{folder}/customer.parquet")
    second = trained.prepared(spark, folder)
    assert second is not first and second.n_train < first.n_train


def test_explanations_are_those_of_each_rows_own_model(spark):
    from churnlake.plans import models as mdl
    from churnlake.plans import serving, trained

    models = trained.registry_models(spark, SF_SMALL, ["logistic_regression", "random_forest"])
    cfg = ab.ABConfig(S.MODEL_PREFIX + "logistic_regression", S.MODEL_PREFIX + "random_forest", 0.5, 0.5)
    info = spark.createDataFrame([(n, "3", "run-3", "Production") for n in models], S.MODEL_VERSION_SCHEMA)
    ts = dt.datetime(2024, 4, 1)
    # A collected map is a dict without the map's order.
    rows = serving.explain_requests(fx.requests(spark, SF_SMALL), models, cfg, info, ts).withColumn("entries", F.map_entries("feature_importance")).collect()
    scored = {r.customer_id: r for r in serving.score_requests(fx.requests(spark, SF_SMALL), models, cfg, info, ts).collect()}
    from churnlake.operators import quality as qual
    from churnlake.operators import scoring as sco

    values = {r.customer_id: r for r in sco.request_features(qual.split_valid(fx.requests(spark, SF_SMALL))[0]).collect()}
    assert {r.customer_id for r in rows} == scored.keys() and {r.ab_group for r in rows} == {"A", "B"}
    for r in rows:
        s = scored[r.customer_id]
        assert all(r[c] == s[c] for c in s.asDict())
        imps = mdl.importances(models[r.model])
        order = sorted(range(len(imps)), key=lambda i: (-imps[i], i))
        assert [tuple(e) for e in r.entries] == [(S.ALL_FEATURES[i], imps[i]) for i in order]
        assert [(f.feature, f.value, f.importance, f.contribution) for f in r.top_risk_factors] == [
            (n, float(v), imps[i], "increases" if v > 0.5 else "decreases") for i in order[:5] for n in [S.ALL_FEATURES[i]] for v in [values[r.customer_id][n]]]


def test_scoring_job_explains_and_sums_up(spark, tmp_dir):
    csv, base, ts = os.path.join(tmp_dir, "k5x.csv"), os.path.join(tmp_dir, "lake_k5x"), dt.datetime(2024, 3, 7)
    files.write_raw_csv(fx.raw_customers(spark, SF_SMALL), csv)
    jobs.ingest(spark, csv, base, ts, min_rows=100)
    jobs.build_features(spark, base, ts)
    jobs.train(spark, base, ts, keys=["logistic_regression"], with_cv=False)
    out = jobs.score(spark, base, fx.requests(spark, SF_SMALL), ts, explain=True)
    rows = spark.read.parquet(out["predictions"])
    assert {"feature_importance", "top_risk_factors", "model_version", "ab_group", "timestamp"} <= set(rows.columns)
    assert out["summary"] == {"total_processed": rows.count(), "avg_prediction_time_ms": 0.0}
    empty = jobs.score(spark, base, fx.requests(spark, SF_SMALL).limit(0), ts + dt.timedelta(days=1))
    assert empty["summary"]["total_processed"] == 0 and empty["rejected"] == 0


def test_signature_covers_outputs(spark, tmp_dir):
    import json

    from churnlake.plans import models as mdl
    from churnlake.plans import trained

    good = trained.models_for(spark, SF_SMALL, ["logistic_regression"])["logistic_regression"]
    schema = trained.prepared(spark, SF_SMALL).test.select(*S.ALL_FEATURES).schema
    path = os.path.join(tmp_dir, "signed")
    mdl.save(good, path, schema.json())
    sig = json.loads(spark.read.text(path + "_signature").first()[0])
    assert [f["name"] for f in sig["outputs"]["fields"]] == ["probability", "prediction"]
    sig["outputs"]["fields"][1]["type"] = "string"
    spark.createDataFrame([(json.dumps(sig),)], "s string").coalesce(1).write.mode("overwrite").text(path + "_signature")
    with pytest.raises(ValueError, match="its signature says"):
        mdl.load(path, S.ALL_FEATURES, schema)


def test_object_store_options_never_default_credentials():
    assert files.s3a_options() == {"spark.hadoop.fs.s3a.path.style.access": "true"}
    assert files.s3a_options("http://store:9000", "k", None) == {
        "spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.endpoint": "http://store:9000"}
    full = files.s3a_options("http://store:9000", "k", "s", path_style=False)
    assert full["spark.hadoop.fs.s3a.access.key"] == "k" and full["spark.hadoop.fs.s3a.secret.key"] == "s"
    assert full["spark.hadoop.fs.s3a.path.style.access"] == "false"


def test_traffic_split_of_equal_names_is_one_entry(spark):
    one = spark.range(1).select(ab.split_map(ab.ABConfig("m", "m", 3.0, 1.0)).alias("s")).first().s
    assert one == {"m": 1.0}
