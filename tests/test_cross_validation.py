"""CV (M7/A8): per-fold class weights and the fold-score summary."""

import pytest

from churnlake import schemas as S
from churnlake.operators import split as spl
from churnlake.plans import models as mdl

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    from churnlake.plans import catalog

    return mdl.prepare(catalog.features(spark, SF_SMALL))


def test_fold_weights_are_balanced_on_each_training_part(spark, data):
    folds = spl.with_folds(data.train.drop("class_weight"), k=5)
    pdf = folds.select("fold", S.TARGET).toPandas()
    got = mdl.fold_class_weights(folds, 5)
    for i in range(5):
        part = pdf[pdf["fold"] != i][S.TARGET]
        n, w = got[i]
        assert n == len(part)
        counts = part.value_counts()
        for c, n_c in counts.items():
            assert abs(w[int(c)] - len(part) / (len(counts) * n_c)) < 1e-12
        # balanced weights sum to n over the part's rows
        assert abs(sum(w[int(c)] * n_c for c, n_c in counts.items()) - len(part)) < 1e-9


def test_cv_summary_shape_and_range(spark, data):
    rows = mdl.cross_validate_models(["logistic_regression"], data, k=3, parallelism=3).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.model == "logistic_regression" and r.folds == 3
    assert 0.0 <= r.cv_f1_mean <= 1.0 and r.cv_f1_std >= 0.0


def test_cv_result_does_not_depend_on_pool_size(spark, data):
    one = mdl.cross_validate_models(["logistic_regression"], data, k=3, parallelism=1).first()
    three = mdl.cross_validate_models(["logistic_regression"], data, k=3, parallelism=3).first()
    assert abs(one.cv_f1_mean - three.cv_f1_mean) < 1e-12 and abs(one.cv_f1_std - three.cv_f1_std) < 1e-12
