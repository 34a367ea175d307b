"""Exact stratified cuts, the CV ledger, and fitted models checked from outside."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.operators import split as spl
from churnlake.plans import catalog, diagnostics, trained
from churnlake.plans import models as mdl
from conftest import SF_SMALL


@pytest.mark.parametrize("buckets", [1 << 16, 2, 1])
def test_cuts_match_a_sort(spark, monkeypatch, buckets):
    monkeypatch.setattr(spl, "HASH_BUCKETS", buckets)
    rng = random.Random(buckets)
    rows = [(f"c{i}", rng.choice([0, 0, 0, 1, None])) for i in range(233)] + [("only", 5), (None, 0)]
    df = spark.createDataFrame(rows, "customerID string, churn_label int")
    u = {r.customerID: r.u for r in df.withColumn("u", F.coalesce(spl.unit_hash("customerID", "split42"), F.lit(0.0))).collect()}
    for parts in (5, 3):
        got = {r.customerID: r.part for r in df.withColumn("part", spl.exact_parts(df, parts, "churn_label", "customerID", "split42")).collect()}
        for label in {y for _, y in rows}:
            ids = sorted((c for c, y in rows if y == label), key=lambda c: (u[c], c or ""))
            assert [got[c] for c in ids] == [i * parts // len(ids) for i in range(len(ids))]


def test_shares_are_exact_in_train_test_and_folds(spark):
    data = mdl.prepare(catalog.features(spark, SF_SMALL))
    try:
        folds = data.train.withColumn("fold", spl.exact_fold_column(data.train, 5)).groupBy("fold", S.TARGET).count().collect()
        per = collections.defaultdict(list)
        for r in folds:
            per[r[S.TARGET]].append(r["count"])
        n_test = {r[S.TARGET]: r["count"] for r in data.test.groupBy(S.TARGET).count().collect()}
        for label, counts in per.items():
            assert len(counts) == 5 and max(counts) - min(counts) <= 1
            assert abs(n_test[label] - (n_test[label] + sum(counts)) / 5) < 1
        assert data.train.join(data.test, S.ID, "left_semi").count() == 0
    finally:
        data.train.unpersist()


def test_no_rows_have_no_cuts(spark):
    df = spark.createDataFrame([], "customerID string, churn_label int")
    assert df.withColumn("split", spl.exact_split_column(df)).count() == 0


def test_a_second_run_fits_only_what_is_missing(spark, tmp_dir, monkeypatch):
    data = trained.prepared(spark, SF_SMALL)
    keys, fitted, real = ["logistic_regression"], [], mdl.estimator

    def estimator(key, n, weighted=True):
        fitted.append(key)
        if len(fitted) == 3:
            raise RuntimeError("lost")
        return real(key, n, weighted)

    monkeypatch.setattr(mdl, "estimator", estimator)
    with pytest.raises(RuntimeError, match="lost"):
        mdl.cross_validate_models(keys, data, k=4, parallelism=1, ledger=f"{tmp_dir}/cv")
    assert len(fitted) == 4  # the other folds go on and are kept
    first = mdl.cross_validate_models(keys, data, k=4, parallelism=1, ledger=f"{tmp_dir}/cv").first()
    assert len(fitted) == 4 + 1
    again = mdl.cross_validate_models(keys, data, k=4, parallelism=1, ledger=f"{tmp_dir}/cv").first()
    assert len(fitted) == 5 and again == first and first.folds == 4
    monkeypatch.setattr(mdl, "estimator", real)
    fresh = mdl.cross_validate_models(keys, data, k=4).first()
    assert abs(fresh.cv_f1_mean - first.cv_f1_mean) < 1e-12
    other = mdl.PreparedData(data.train.where("tenure_months > 3"), data.test, data.scaler, data.n_train, data.weights)
    mdl.cross_validate_models(keys, other, k=4, ledger=f"{tmp_dir}/cv")  # other rows: nothing of the ledger is used
    import os

    assert len(os.listdir(f"{tmp_dir}/cv")) == 2


def test_score_check_finds_a_wrong_node(spark, monkeypatch):
    models = trained.models_for(spark, SF_SMALL, ["logistic_regression", "random_forest"])
    test = trained.prepared(spark, SF_SMALL).test
    rows = test.count()
    assert sorted(tuple(r) for r in diagnostics.score_check(models, test).collect()) == [("logistic_regression", rows, 0), ("random_forest", rows, 0)]
    real = diagnostics.node_table
    monkeypatch.setattr(diagnostics, "node_table", lambda m, like: real(m, like).withColumn("value", F.when(F.col("key") > 5, F.col("value")).otherwise(F.col("value") + 1)))
    got = {r.model: r.mismatches for r in diagnostics.score_check(models, test).collect()}
    assert got["logistic_regression"] == 0 and got["random_forest"] > 0


def test_gradient_is_not_zero_away_from_the_optimum(spark):
    model = trained.models_for(spark, SF_SMALL, ["logistic_regression"])["logistic_regression"]
    train = trained.prepared(spark, SF_SMALL).train
    assert max(abs(r.gradient) for r in diagnostics.lr_gradient(model, train).collect()) < 5e-5
    part = train.where("tenure_months > 20")
    assert max(abs(r.gradient) for r in diagnostics.lr_gradient(model, part).collect()) > 1e-3
