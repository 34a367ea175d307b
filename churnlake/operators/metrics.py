"""Exact classification metrics over long predictions.

Input is one row per (model, example): ``model``, ``label`` (0/1) and
``prediction`` (0/1).  Every model is measured in one ``groupBy(model)``
pass with conditional counts, so the work is one scan and a shuffle of a
few counters per model; ratios follow the metric library's 0/0 -> 0 rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake import schemas as S


def predict_at(probability: str = "probability", threshold: float = S.DECISION_THRESHOLD) -> Column:
    """Class 1 when ``p >= threshold``."""
    return (F.col(probability) >= F.lit(threshold)).cast("int")


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def confusion_counts(long: DataFrame, group: Sequence[str] = ("model",), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """tp/fp/fn/tn per group from one conditional-count aggregate."""
    y, p = F.col(label), F.col(prediction)
    return long.groupBy(*group).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def confusion_matrix(long: DataFrame, group: Sequence[str] = ("model",), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """A4: two named rows per group (Actual_No, Actual_Yes) x (Pred_No, Pred_Yes).

    Both rows exist even when a class is absent (counts 0).
    """
    c = confusion_counts(long, group, label, prediction)
    rows = F.array(
        F.struct(F.lit("Actual_No").alias("actual"), F.col("tn").alias("Pred_No"), F.col("fp").alias("Pred_Yes")),
        F.struct(F.lit("Actual_Yes").alias("actual"), F.col("fn").alias("Pred_No"), F.col("tp").alias("Pred_Yes")),
    )
    return c.select(*group, F.inline(rows))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """A5 from tp/fp/fn/tn: accuracy, precision, recall, F1 (0/0 -> 0)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return counts.select(
        "*",
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def classification_metrics(long: DataFrame, group: Sequence[str] = ("model",), label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """A5: per-group metrics in one aggregate."""
    return metrics_from_counts(confusion_counts(long, group, label, prediction))


def classification_report(long: DataFrame, group: Sequence[str] = ("model",), label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' per group.

    Columns: precision, recall, f1_score, support (the accuracy row carries
    its value in f1_score, as the text report prints it).
    """
    c = confusion_counts(long, group, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    # class 1 and class 0 views of the same counts
    p1, r1, f1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s0 + s1
    scored = c.select(
        *group,
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        _ratio((tp + tn).cast("double"), n).alias("acc"), n.alias("n"),
    )

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.alias("support"))

    P0, R0, F0, S0 = F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")
    P1, R1, F1, S1 = F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")
    N = F.col("n")
    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", P0, R0, F0, S0),
        row("1", P1, R1, F1, S1),
        row("accuracy", none, none, F.col("acc"), N),
        row("macro avg", (P0 + P1) / 2, (R0 + R1) / 2, (F0 + F1) / 2, N),
        row("weighted avg", _ratio(P0 * S0 + P1 * S1, N), _ratio(R0 * S0 + R1 * S1, N),
            _ratio(F0 * S0 + F1 * S1, N), N),
    )
    return scored.select(*group, F.inline(rows))


def fold_f1(long: DataFrame, group: Sequence[str] = ("model",), fold: str = "fold", label: str = "label",
            prediction: str = "prediction") -> DataFrame:
    """F1 of class 1 per (group, fold)."""
    return classification_metrics(long, [*group, fold], label, prediction).select(*group, fold, "f1_score")


def cv_summary(fold_scores: DataFrame, group: Sequence[str] = ("model",), score: str = "f1_score") -> DataFrame:
    """Mean and population std of the fold scores."""
    return fold_scores.groupBy(*group).agg(
        F.avg(score).alias("cv_f1_mean"), F.stddev_pop(score).alias("cv_f1_std"), F.count(F.lit(1)).alias("folds")
    )


def with_ordinal(metrics: DataFrame, order: Sequence[str], col: str = "model") -> DataFrame:
    """Ordinal of each model in the declared order (ties break toward the first)."""
    expr = F.lit(len(order))
    for i, name in reversed(list(enumerate(order))):
        expr = F.when(F.col(col) == name, F.lit(i)).otherwise(expr)
    return metrics.withColumn("ordinal", expr)


def champion(metrics: DataFrame, order: Sequence[str], score: str = "f1_score", col: str = "model") -> DataFrame:
    """Argmax of ``score`` (null -> 0), first declared model wins ties."""
    m = with_ordinal(metrics, order, col)
    key = F.struct(F.coalesce(F.col(score), F.lit(0.0)), -F.col("ordinal"))
    return m.agg(F.max_by(F.col(col), key).alias("champion"), F.max(F.coalesce(F.col(score), F.lit(0.0))).alias(score))


def rank_models(metrics: DataFrame, order: Sequence[str], score: str = "f1_score", col: str = "model") -> DataFrame:
    """Rank by ``score`` descending, ordinal as tiebreak; champion/challenger roles.

    The metrics table has one row per model, so the global window is bounded.
    """
    m = with_ordinal(metrics, order, col)
    w = Window.orderBy(F.desc(F.coalesce(F.col(score), F.lit(0.0))), F.asc("ordinal"))
    ranked = m.withColumn("rank", F.row_number().over(w))
    role = F.when(F.col("rank") == 1, "champion").when(F.col("rank") == 2, "challenger").otherwise("other")
    return ranked.withColumn("role", role).drop("ordinal")
