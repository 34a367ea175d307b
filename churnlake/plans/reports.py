"""Report assembly (J3, S13 content).

Every input is a per-model table (one row per model name); they are joined
on ``name``, and the planner broadcasts them at runtime (AQE).  Champion
and challenger weights come from a window over the ranked table (one row
per model, bounded), so no constant-key or cross join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.operators.abtest import weights_from_gap


def roles_and_weights(ranked: DataFrame, score: str = "f1_score") -> DataFrame:
    """Per model: role (champion/challenger) and R7 weight, plus the champion name."""
    allw = Window.partitionBy()
    first = F.max(F.when(F.col("rank") == 1, F.col(score))).over(allw)
    second = F.max(F.when(F.col("rank") == 2, F.col(score))).over(allw)
    n = F.count(F.lit(1)).over(allw)
    w1, w2 = weights_from_gap(first - second)
    return ranked.select(
        "name",
        F.when(F.col("rank") == 1, "champion").when(F.col("rank") == 2, "challenger").alias("role"),
        F.when(n < 2, F.lit(None).cast("double"))
        .when(F.col("rank") == 1, w1).when(F.col("rank") == 2, w2).alias("weight"),
        F.max(F.when(F.col("rank") == 1, F.col("name"))).over(allw).alias("best_model"),
    )


def evaluation_report(production: DataFrame, f1: DataFrame, auc: DataFrame, ranked: DataFrame) -> DataFrame:
    """Production models + comparison metrics + A/B roles and weights + summary."""
    rw = roles_and_weights(ranked)
    rep = (
        production.select("name", "version", "run_id")
        .join(f1, "name", "left")
        .join(auc, "name", "left")
        .join(rw, "name", "left")
    )
    allw = Window.partitionBy()  # one row per production model: bounded
    return rep.select(
        "name", "version", "run_id", "f1_score", "roc_auc", "role", "weight",
        F.count(F.lit(1)).over(allw).alias("total_models"),
        F.max("best_model").over(allw).alias("best_model"),
    )
