"""Nested JSON documents (S11, S12, S13) built as one-row frames.

Each document is assembled with ``struct`` / ``map_from_entries`` over a
per-model table (one row per model: bounded), then written as JSON.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions import ntz_lit
from churnlake.sources.files import write_json_record


def training_summary(results: DataFrame, order: list[str], run_ts: _dt.datetime,
                     experiment: str = "telco-customer-churn", score: str = "f1_score") -> DataFrame:
    """{timestamp, experiment, champion_model, results: {model: {run_id, metrics}}}.

    ``results`` has one row per model: model, run_id, and metric columns.
    The champion (A14: best ``score``, first declared model on ties) comes
    from the same single aggregate, so no join is needed.
    """
    metric_cols = [c for c in results.columns if c not in ("model", "run_id")]
    entry = F.struct(
        F.col("model"),
        F.struct(F.col("run_id"), F.struct(*[F.col(c) for c in metric_cols]).alias("metrics")),
    )
    ordinal = F.lit(len(order))
    for i, name in reversed(list(enumerate(order))):
        ordinal = F.when(F.col("model") == name, F.lit(i)).otherwise(ordinal)
    key = F.struct(F.coalesce(F.col(score), F.lit(0.0)), -ordinal)
    return results.agg(
        F.max_by(F.col("model"), key).alias("champion_model"),
        F.map_from_entries(F.collect_list(entry)).alias("results"),
    ).select(
        ntz_lit(run_ts).alias("timestamp"), F.lit(experiment).alias("experiment"),
        "champion_model", "results",
    )


def ab_config_document(weights: DataFrame, metrics: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """{champion: {name, weight, metrics}, challenger: {...}, updated_at}.

    ``weights`` is R7's one-row output; ``metrics`` one row per model
    (name + metric columns).
    """
    mcols = [c for c in metrics.columns if c != "name"]
    m = metrics.select("name", F.struct(*mcols).alias("metrics"))
    mc = m.select(F.col("name").alias("champion"), F.col("metrics").alias("champion_metrics"))
    mh = m.select(F.col("name").alias("challenger"), F.col("metrics").alias("challenger_metrics"))
    w = weights.join(mc, "champion", "left").join(mh, "challenger", "left")
    return w.select(
        F.struct(F.col("champion").alias("name"), F.col("champion_weight").alias("weight"),
                 F.col("champion_metrics").alias("metrics")).alias("champion"),
        F.struct(F.col("challenger").alias("name"), F.col("challenger_weight").alias("weight"),
                 F.col("challenger_metrics").alias("metrics")).alias("challenger"),
        F.col("status"),
        ntz_lit(run_ts).alias("updated_at"),
    )


def write_ab_config(doc: DataFrame, path: str) -> None:
    """Overwrite the current configuration document."""
    write_json_record(doc, path, "overwrite")


def report_document(report: DataFrame, ab_weights: dict, failed: list[tuple[str, str]], run_ts: _dt.datetime) -> DataFrame:
    """{generated_at, production_models, model_comparison, ab_configuration, failed_models, summary}, one row.

    ``report`` is J3's table (one row per production model, perhaps none), ``ab_weights``
    R7's one row, ``failed`` the models that could not be compared and why.
    """
    w = {k: F.lit(ab_weights[k]) for k in ("status", "champion", "champion_weight", "challenger", "challenger_weight")}
    compared = F.when(F.col("f1_score").isNotNull(), F.struct("name", "f1_score", "roc_auc"))
    return report.agg(
        F.sort_array(F.collect_list(F.struct("name", "version", "run_id"))).alias("production_models"),
        F.sort_array(F.collect_list(compared)).alias("model_comparison"),
        F.struct(F.count(F.lit(1)).alias("total_models"), F.max("best_model").alias("best_model")).alias("summary"),
    ).select(
        ntz_lit(run_ts).alias("generated_at"), "production_models", "model_comparison",
        F.struct(w["status"].alias("status"),
                 F.struct(w["champion"].cast("string").alias("name"), w["champion_weight"].cast("double").alias("weight")).alias("champion"),
                 F.struct(w["challenger"].cast("string").alias("name"), w["challenger_weight"].cast("double").alias("weight")).alias("challenger"),
                 ).alias("ab_configuration"),
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(e).alias("error")) for n, e in failed])
        .cast("array<struct<name:string,error:string>>").alias("failed_models"),
        "summary",
    )


def write_report(doc: DataFrame, base: str, run_ts: _dt.datetime) -> str:
    """The evaluation report under its own ``snapshot=`` folder (write once)."""
    from churnlake.sources.files import snapshot_key

    path = f"{base.rstrip('/')}/snapshot={snapshot_key(run_ts)}"
    doc.coalesce(1).write.mode("errorifexists").json(path)
    return path
