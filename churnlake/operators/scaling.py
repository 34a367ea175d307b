"""Class weights (A9, J4) and standardisation (A10, M3).

Both fit with one aggregate whose result is a handful of numbers; those
enter the row plan as literals (like a fitted Spark ML model), so applying
them is a narrow projection with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S


def class_weights(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """Balanced weights n / (k * n_c) per class present."""
    from pyspark.sql import Window as W

    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    # At most one row per class: the un-partitioned window is bounded.
    whole = W.partitionBy()
    return counts.select(
        label,
        "n_c",
        (F.sum("n_c").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n_c"))).alias("weight"),
    )


def with_class_weight(df: DataFrame, weights: DataFrame, label: str = S.TARGET,
                      out: str = "weight") -> DataFrame:
    """Attach each row's class weight (``weights`` has one row per class)."""
    w = weights.select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")


def scaler_stats(df: DataFrame, columns: Sequence[str] = S.NUMERIC_FEATURES) -> DataFrame:
    """A10: mean and population std per column; ``scale`` is std, or 1 when std is 0."""
    wide = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    )
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in columns)
    long = wide.selectExpr(f"stack({len(columns)}, {stack}) AS (feature, mean, std)")
    return long.withColumn("scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


class FittedScaler:
    """Means and scales of the numeric features, fitted on the training part."""

    def __init__(self, means: dict[str, float], scales: dict[str, float], n: int = 0):
        self.means = means
        self.scales = scales
        self.n = n

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] = S.NUMERIC_FEATURES) -> FittedScaler:
        """One aggregate pass: mean, population std and the row count.

        The result is two numbers per column plus the count (bounded).
        """
        row = df.agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.avg(c).alias(f"{c}__mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
        ).first()
        means = {c: row[f"{c}__mean"] for c in columns}
        scales = {c: (1.0 if row[f"{c}__std"] == 0 else row[f"{c}__std"]) for c in columns}
        return cls(means, scales, int(row["__n"]))

    def transform(self, df: DataFrame) -> DataFrame:
        """M3: (x - mean) / scale for fitted columns, others unchanged."""
        cols = []
        for c in df.columns:
            if c in self.means:
                mean, scale = self.means[c], self.scales[c]
                if mean is None:
                    cols.append(F.col(c).cast("double").alias(c))
                else:
                    cols.append(((F.col(c) - F.lit(mean)) / F.lit(scale)).alias(c))
            else:
                cols.append(F.col(c))
        return df.select(*cols)
