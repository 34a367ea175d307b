"""Importance tables and per-row explanations (J1, J2, W5, W6, M9 output).

Importances are per model (24 numbers), so their order is found once per
model; the per-row explanation is then a fixed projection — an array of
five structs built from columns — with no explode and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake import schemas as S


def importance_table(spark: SparkSession, model: str, importances: Sequence[float],
                     features: Sequence[str] = S.ALL_FEATURES) -> DataFrame:
    """Zip feature names with importances; ``position`` keeps the input order."""
    rows = [(model, i, f, float(v)) for i, (f, v) in enumerate(zip(features, importances))]
    return spark.createDataFrame(rows, "model string, position int, feature string, importance double")


def uniform_importances(n: int = len(S.ALL_FEATURES)) -> list[float]:
    """M9's last branch: a model without importances or coefficients."""
    return [1.0 / n] * n


def sorted_importance(table: DataFrame) -> DataFrame:
    """Rank within model by importance descending, stable on position."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("position"))
    return table.withColumn("rank", F.row_number().over(w))


def top_names(importances: Sequence[float], features: Sequence[str] = S.ALL_FEATURES, k: int = 5) -> list[tuple[str, float]]:
    """The k most important features of one model, stable order (24 numbers, driver-side)."""
    order = sorted(range(len(features)), key=lambda i: (-importances[i], i))
    return [(features[i], float(importances[i])) for i in order[:k]]


def top_factors_column(top: Sequence[tuple[str, float]]) -> Column:
    """array<struct<feature, value, importance, contribution>> from the row's own values."""
    items = []
    for name, imp in top:
        v = F.col(name).cast("double")
        items.append(
            F.struct(
                F.lit(name).alias("feature"), v.alias("value"), F.lit(imp).alias("importance"),
                F.when(v > 0.5, "increases").otherwise("decreases").alias("contribution"),
            )
        )
    return F.array(*items)


def with_top_factors(features: DataFrame, importances: Sequence[float], k: int = 5,
                     out: str = "top_risk_factors") -> DataFrame:
    return features.withColumn(out, top_factors_column(top_names(importances, k=k)))


def factors_long(df: DataFrame, keys: Sequence[str], col: str = "top_risk_factors") -> DataFrame:
    """The explanation array as rows (rank, feature, value, importance, contribution)."""
    return df.select(*keys, F.posexplode(col).alias("pos", "f")).select(
        *keys, (F.col("pos") + 1).alias("rank"), "f.feature", "f.value", "f.importance", "f.contribution"
    )


def lookup_model_info(rows: DataFrame, info: DataFrame, default_name: str, loaded: Sequence[str],
                      name_col: str = "model") -> DataFrame:
    """Attach version/stage/run of each row's model; a model that is not
    among ``loaded`` falls back to ``default_name`` (the first loaded model).

    The fallback is a literal membership test, so one left join on the
    resolved name suffices.  Every resolved name is one of ``loaded`` (a
    literal list), so ``info`` (one row per model name) is cut to those names
    first: at most ``len(loaded)`` rows, broadcast.  The rows are never
    shuffled on the model name, which one model may hold most of.
    """
    names = list(dict.fromkeys([*loaded, default_name]))
    resolved = rows.withColumn(
        "model_name", F.when(F.col(name_col).isin(list(loaded)), F.col(name_col)).otherwise(F.lit(default_name))
    )
    inf = info.filter(F.col("name").isin(names)).select(
        F.col("name").alias("_n"), F.col("version").alias("_v"), F.col("stage").alias("_s"),
        F.col("run_id").alias("_r"))
    joined = resolved.join(F.broadcast(inf), resolved["model_name"] == inf["_n"], "left")
    return joined.select(
        *resolved.columns,
        F.coalesce(F.col("_v"), F.lit("unknown")).alias("model_version"),
        F.coalesce(F.col("_s"), F.lit("None")).alias("model_stage"),
        F.coalesce(F.col("_r"), F.lit("unknown")).alias("model_run_id"),
    )
