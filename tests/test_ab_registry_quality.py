"""A/B config and routing, registry ordering, quality checks, split properties."""

import pytest
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.operators import abtest as ab
from churnlake.operators import quality as qual
from churnlake.operators import registry as reg
from churnlake.operators import scaling as scl
from churnlake.operators import split as spl


def test_config_normalisation():
    assert ab.ABConfig(weight_a=3, weight_b=1).normalised().weight_a == 0.75
    keep = ab.ABConfig(weight_a=0.0, weight_b=0.0).normalised()
    assert (keep.weight_a, keep.weight_b) == (0.0, 0.0)
    c = ab.ABConfig().update_weights(0, 0)
    assert (c.weight_a, c.weight_b) == (0.8, 0.2)          # R4: sum <= 0 keeps old
    c = ab.ABConfig().update_weights(1, 1)
    assert (c.weight_a, c.weight_b) == (0.5, 0.5)
    c = ab.ABConfig().set_models("x", "y").disable()
    assert (c.model_a, c.model_b, c.enabled) == ("x", "y", False)


def test_config_table_normalisation(spark):
    rows = [("a", "b", 0.8, 0.2, True), ("a", "b", 3.0, 1.0, True), ("a", "b", 0.0, 0.0, True), ("a", "b", 1.0, 1.0, False)]
    out = ab.normalise_config(spark.createDataFrame(rows, S.AB_CONFIG_SCHEMA)).collect()
    assert [(r.weight_a, r.weight_b) for r in out] == [(0.8, 0.2), (0.75, 0.25), (0.0, 0.0), (0.5, 0.5)]


def test_routing_sticky_and_disabled(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("customer_id"))
    r1 = ab.route(df, ab.ABConfig()).collect()
    r2 = ab.route(df, ab.ABConfig()).collect()
    assert r1 == r2
    share_a = sum(1 for r in r1 if r.ab_group == "A") / len(r1)
    assert 0.75 < share_a < 0.85
    off = ab.route(df, ab.ABConfig().disable()).select("model", "ab_group").distinct().collect()
    assert [(r.model, r.ab_group) for r in off] == [(S.DEFAULT_AB_MODEL_A, "control")]


def test_weights_from_gap(spark):
    df = spark.createDataFrame([(0.2,), (0.1,), (0.07,), (0.05,), (0.0,)], "gap double")
    w1, w2 = ab.weights_from_gap(F.col("gap"))
    out = [(r.a, r.b) for r in df.select(w1.alias("a"), w2.alias("b")).collect()]
    assert out == [(0.9, 0.1), (0.8, 0.2), (0.8, 0.2), (0.6, 0.4), (0.6, 0.4)]   # strict >


def test_derive_weights_insufficient(spark):
    one = spark.createDataFrame([("m", 0.5, 1)], "name string, f1_score double, rank int")
    r = ab.derive_ab_weights(one).first()
    assert r.status == "insufficient_models" and r.champion_weight is None


def test_ab_stats_zero_when_empty(spark):
    log = spark.createDataFrame([], S.PREDICTION_LOG_SCHEMA)
    r = ab.ab_stats(log, ab.ABConfig()).first()
    assert (r.total_requests, r.model_a_avg_latency_ms, r.model_b_avg_latency_ms) == (0, 0.0, 0.0)
    assert ab.batch_summary(log).first().avg_prediction_time_ms == 0.0


def test_versions_compare_as_int(spark):
    v = spark.createDataFrame([("m", "9", "r9", "None"), ("m", "10", "r10", "None"), ("m", "2", "r2", "Production")],
                              S.MODEL_VERSION_SCHEMA)
    assert reg.latest_versions(v).first().version == "10"
    s = reg.serving_versions(v).first()
    assert (s.version, s.resolved_by) == ("2", "Production")
    promoted = {r.version: r.stage for r in reg.promote(v, "m", "10").collect()}
    assert promoted == {"9": "None", "10": "Production", "2": "Archived"}


def test_promote_keeps_other_names(spark):
    v = spark.createDataFrame([("a", "1", "r", "Production"), ("b", "1", "r", "Production"), ("b", "2", "r", "None")],
                              S.MODEL_VERSION_SCHEMA)
    chosen = spark.createDataFrame([("b",)], "name string")
    out = {(r.name, r.version): r.stage for r in reg.promote_latest(v, chosen).collect()}
    assert out == {("a", "1"): "Production", ("b", "1"): "Archived", ("b", "2"): "Production"}  # D10


def test_quality_checks(spark):
    df = spark.createDataFrame([("x", None)], "customerID string, Churn string")
    with pytest.raises(qual.ValidationError):
        qual.require_columns(df)
    with pytest.raises(qual.ValidationError):
        qual.require_min_rows(df, 2)
    assert qual.has_min_rows(spark.range(5), 5)
    prof = {r.column_name: (r.null_share, r.high_null) for r in qual.null_profile(df).collect()}
    assert prof == {"customerID": (0.0, False), "Churn": (1.0, True)}
    assert qual.label_distribution(df, "Churn").count() == 0


def test_request_validation_reasons(spark):
    req = spark.createDataFrame(
        [("a", -1.0, 5.0, None, "One year", "x", "DSL", True, False, False, False, False, False, False, False)],
        S.REQUEST_SCHEMA)
    r = qual.validate_requests(req).first()
    assert r.reasons == ["missing:total_charges", "negative:tenure_months"] and not r.is_valid


def test_split_disjoint_complete(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("customerID"))
    tr, te = spl.train_test(df)
    assert tr.count() + te.count() == 5000
    assert tr.join(te, "customerID").count() == 0
    assert 0.17 < te.count() / 5000 < 0.23
    folds = spl.with_folds(df).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]


def test_class_weights_and_scaler(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (0, 5.0), (1, 7.0)], "churn_label int, x double")
    w = {r.churn_label: r.weight for r in scl.class_weights(df).collect()}
    assert w == {0: 4 / 6, 1: 2.0}
    s = scl.FittedScaler.fit(df, ["x"])
    assert s.means["x"] == 4.0 and abs(s.scales["x"] - 5 ** 0.5) < 1e-12   # population std
    const = scl.FittedScaler.fit(spark.createDataFrame([(2.0,), (2.0,)], "x double"), ["x"])
    assert const.scales["x"] == 1.0


def test_model_lookup_falls_back_to_first_loaded(spark):
    from churnlake.operators import explain as xpl

    rows = spark.createDataFrame([("c1", "m_b"), ("c2", "m_x")], "customer_id string, model string")
    info = spark.createDataFrame([("m_a", "3", "r3", "Production"), ("m_b", "7", "r7", "None")],
                                 S.MODEL_VERSION_SCHEMA)
    out = {r.customer_id: (r.model_name, r.model_version) for r in
           xpl.lookup_model_info(rows, info, default_name="m_a", loaded=["m_a", "m_b"]).collect()}
    assert out == {"c1": ("m_b", "7"), "c2": ("m_a", "3")}


def _max_by_reference(versions, key):
    """The direct formulation: one max_by over the whole table."""
    from pyspark.sql import functions as F

    row = F.struct("version", "run_id", "stage")
    return versions.groupBy("name").agg(F.max_by(row, key).alias("v")).select(
        "name", "v.version", "v.run_id", "v.stage")


def test_registry_argmax_equals_whole_table_max_by(spark):
    from pyspark.sql import functions as F

    rows = [
        ("a", "2", "r2", "None"), ("a", "10", "r10", "None"), ("a", "9", "r9", "Production"),
        ("a", "x", "rx", "Production"), ("a", "3", "r3", None),
        ("b", "1", "r1", "Archived"), ("b", "07", "r7", "None"), ("b", "zz", "rz", "Production"),
        ("c", "q", "rq", "None"), ("c", None, "rn", None),
        ("d", "5", "r5", None), ("d", "4", "r4", None),
        ("e", "8", "r8a", "Production"), ("e", "8", "r8b", "None"),
    ]
    versions = spark.createDataFrame(rows, "name string, version string, run_id string, stage string")
    v = reg.version_number()
    want = {r.name: tuple(r) for r in _max_by_reference(versions, v).collect()}
    got = {r.name: tuple(r) for r in reg.latest_versions(versions).collect()}
    # "e" ties on version 8: either row is a maximum.
    assert got.pop("e") in {("e", "8", "r8a", "Production"), ("e", "8", "r8b", "None")}
    want.pop("e")
    assert got == want and got["c"] == ("c", None, None, None)
    is_prod = (F.col("stage") == "Production").cast("int")
    want = {r.name: tuple(r) for r in _max_by_reference(versions, F.struct(is_prod, v)).collect()}
    got = {r.name: tuple(r)[:4] for r in reg.serving_versions(versions).collect()}
    assert got == want
    assert got["a"][1] == "9" and got["b"][1] == "zz" and got["d"][1] == "5" and got["e"][2] == "r8a"


def test_registry_reads_are_not_stale_after_overwrite(spark, tmp_dir):
    """Nothing is cached between calls."""
    import os

    path = os.path.join(tmp_dir, "versions")
    schema = "name string, version string, run_id string, stage string"
    spark.createDataFrame([("m", "1", "r1", "None")], schema).write.mode("overwrite").parquet(path)
    assert reg.latest_versions(spark.read.parquet(path)).first().version == "1"
    spark.createDataFrame([("m", "2", "r2", "None")], schema).write.mode("overwrite").parquet(path)
    assert reg.latest_versions(spark.read.parquet(path)).first().version == "2"


def test_traffic_split_of_null_and_equal_names(spark):
    rows = [("a", None, 0.8, 0.2, True), ("a", "a", 0.8, 0.2, True), ("a", "b", 0.8, 0.2, True)]
    got = [(r.model, r.weight) for r in ab.traffic_split(spark.createDataFrame(rows, S.AB_CONFIG_SCHEMA)).collect()]
    assert got == [("a", 0.8), ("a", 1.0), ("a", 0.8), ("b", 0.2)]


def test_a_cluster_needs_a_shared_folder():
    from churnlake.session import shared_dir

    class Fake:
        master = "spark://host:7077"
        sparkContext = conf = property(lambda self: self)

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *_):
            return None

    with pytest.raises(RuntimeError):
        shared_dir(Fake())
