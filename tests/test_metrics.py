"""Exact metrics: AUC vs brute force with ties, symmetry, edge cases."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlake.operators import auc as auc_ops
from churnlake.operators import metrics as met


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _df(spark, rows, model="m"):
    return spark.createDataFrame([(model, y, p) for y, p in rows], "model string, label int, probability double")


def test_auc_matches_all_pairs_with_ties(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), rng.choice([0.1, 0.2, 0.5, 0.5, 0.9]) if i % 3 else rng.random())
            for i in range(3000)]
    got = auc_ops.roc_auc(_df(spark, rows), n_buckets=16).first()
    assert abs(got.roc_auc - brute_auc(rows)) < 1e-12
    assert got.positives + got.negatives == 3000


def test_auc_symmetry(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(500)]
    a = auc_ops.roc_auc(_df(spark, rows)).first().roc_auc
    b = auc_ops.roc_auc(_df(spark, [(y, 1 - p) for y, p in rows])).first().roc_auc
    assert abs(a + b - 1) < 1e-12


def test_auc_one_class(spark):
    r = auc_ops.roc_auc(_df(spark, [(1, 0.3), (1, 0.9)])).first()
    assert r.roc_auc is None and r.status == "one_class"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0])), min_size=2, max_size=60))
def test_auc_property(spark, rows):
    got = auc_ops.roc_auc(_df(spark, rows), n_buckets=4).first()
    exp = brute_auc(rows)
    if exp is None:
        assert got.roc_auc is None
    else:
        assert abs(got.roc_auc - exp) < 1e-12


def test_metrics_zero_division_and_single_class(spark):
    df = spark.createDataFrame([("m", 0, 0), ("m", 0, 0)], "model string, label int, prediction int")
    m = met.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (1.0, 0.0, 0.0, 0.0)
    cm = {r.actual: (r.Pred_No, r.Pred_Yes) for r in met.confusion_matrix(df).collect()}
    assert cm == {"Actual_No": (2, 0), "Actual_Yes": (0, 0)}


def test_metrics_values(spark):
    rows = [("m", 1, 1), ("m", 1, 0), ("m", 0, 1), ("m", 0, 0), ("m", 1, 1)]
    df = spark.createDataFrame(rows, "model string, label int, prediction int")
    m = met.classification_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 1)
    assert m.accuracy == 3 / 5 and m.precision == 2 / 3 and m.recall == 2 / 3
    assert abs(m.f1_score - 2 / 3) < 1e-15
    rep = {r["class"]: r for r in met.classification_report(df).collect()}
    assert rep["accuracy"].f1_score == 3 / 5
    assert rep["1"].support == 3.0 and rep["0"].support == 2.0
    assert rep["macro avg"].precision == (rep["0"].precision + rep["1"].precision) / 2


def test_empty_metrics(spark):
    df = spark.createDataFrame([], "model string, label int, prediction int")
    assert met.classification_metrics(df).count() == 0


def test_champion_ties_first_declared_wins(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "model string, f1_score double")
    assert met.champion(df, ["a", "b", "c"]).first().champion == "a"
    assert met.champion(df, ["b", "a", "c"]).first().champion == "b"
    ranks = {r.model: (r.rank, r.role) for r in met.rank_models(df, ["b", "a", "c"]).collect()}
    assert ranks == {"b": (1, "champion"), "a": (2, "challenger"), "c": (3, "other")}


def test_cv_summary_population_std(spark):
    df = spark.createDataFrame([("m", 0.5), ("m", 0.7)], "model string, f1_score double")
    r = met.cv_summary(df).first()
    assert abs(r.cv_f1_mean - 0.6) < 1e-12 and abs(r.cv_f1_std - 0.1) < 1e-12


def test_auc_reports_rows_without_a_score(spark):
    from churnlake.operators import auc

    rows = [("m", 1, 0.9), ("m", 0, 0.1), ("m", 0, float("nan")), ("m", 1, None), ("m", None, 0.5), ("k", 1, 0.9), ("k", 0, 0.1)]
    got = {r.model: (r.roc_auc, r.positives, r.negatives, r.status) for r in auc.roc_auc(
        spark.createDataFrame(rows, "model string, label int, probability double")).collect()}
    assert got == {"m": (1.0, 1, 1, "invalid_rows"), "k": (1.0, 1, 1, "ok")}
