"""Batch scoring with routing and explanations (K5 core: M13, M14, J2).

Requests are validated (V4), turned into serving features (P18), routed per
customer by hash (R1), and each routed branch is scored by its own fitted
pipeline; the branches are stacked with ``unionByName``.  Every step is a
narrow projection or filter: the only data movement is the scan itself.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import ntz_lit
from churnlake.operators import abtest as ab
from churnlake.operators import explain as xpl
from churnlake.operators import quality as qual
from churnlake.operators import scoring as sco
from churnlake.plans import models as mdl


def _score_routed(routed: DataFrame, models: dict[str, PipelineModel], names: list[str], keep: list[str],
                  default: str, explain: Callable[[DataFrame, PipelineModel], DataFrame] | None = None) -> DataFrame:
    """Probability of each row under the model it was routed to.

    One branch per routed model: the branch keeps its own rows (a filter on
    the row-local route column) and only they pass through that pipeline, so
    every row is scored by exactly one model.  The branches share their
    upstream plan; Spark reuses its exchanges (the order-facts shuffle runs
    once), and only the narrow columnar scan is repeated per branch.
    """
    out = None
    for name in names:
        model = models.get(name) or models[default]
        part = routed.filter(F.col("model") == name)
        part = part if explain is None else explain(part, model)
        scored = model.transform(part).select(*keep, "model", "ab_group", mdl.p1().alias("probability"))
        out = scored if out is None else out.unionByName(scored)
    return out


def score_requests(requests: DataFrame, models: dict[str, PipelineModel], cfg: ab.ABConfig,
                   model_info: DataFrame | None = None, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Valid requests -> routed, scored, presented predictions (with ``timestamp`` if ``run_ts`` is given).

    ``models`` maps registry names to fitted pipelines; a routed name that is
    not loaded falls back to the first loaded model (as the reference does).
    """
    return _present(requests, models, cfg, model_info, run_ts)


def _present(requests: DataFrame, models: dict[str, PipelineModel], cfg: ab.ABConfig, model_info: DataFrame | None,
             run_ts: _dt.datetime | None, more: Sequence[str] = (), explain: Callable[[DataFrame, PipelineModel], DataFrame] | None = None) -> DataFrame:
    """The valid requests' routed scores as the reference shows them, with the columns ``more`` that ``explain`` adds to a branch."""
    valid, _rejected = qual.split_valid(requests)
    feats = sco.request_features(valid)
    cfg = cfg.normalised()
    routed = ab.route(feats, cfg)
    default = next(iter(models))
    names = [cfg.model_a] if not cfg.enabled else [cfg.model_a, cfg.model_b]
    scored = _score_routed(routed, models, list(dict.fromkeys(names)), ["customer_id", *more], default, explain)
    out = scored.select(
        "customer_id",
        F.col("probability").alias("churn_probability"),
        sco.decision("probability").alias("churn_prediction"),
        sco.risk_level("probability").alias("risk_level"),
        "model", "ab_group", *more,
    )
    if model_info is not None:
        out = xpl.lookup_model_info(out, model_info, default_name=default, loaded=list(models))
    return out if run_ts is None else out.withColumn("timestamp", ntz_lit(run_ts))


def routed_requests(requests: DataFrame, cfg: ab.ABConfig, model_info: DataFrame, loaded: list[str]) -> DataFrame:
    """R1 + J2 of the valid requests: route, and the version that serves each row."""
    valid, _ = qual.split_valid(requests)
    routed = ab.route(valid.select("customer_id"), cfg)
    return xpl.lookup_model_info(routed, model_info, default_name=loaded[0], loaded=loaded)


def rejected_requests(requests: DataFrame) -> DataFrame:
    """V4's other half: rejected requests with their reasons."""
    return qual.split_valid(requests)[1].select("customer_id", "reasons")


def importance_map(importances: list[float]) -> Column:
    """A model's feature -> importance, most important first, as one literal map (24 entries)."""
    ordered = xpl.top_names(importances, k=len(importances))
    return F.map_from_arrays(F.array(*[F.lit(n) for n, _ in ordered]), F.array(*[F.lit(v) for _, v in ordered]))


def explain_requests(requests: DataFrame, models: dict[str, PipelineModel], cfg: ab.ABConfig, model_info: DataFrame | None = None,
                     run_ts: _dt.datetime | None = None, k: int = 5) -> DataFrame:
    """Valid requests -> routed (R1), scored by their own model, and explained by it.

    Besides ``score_requests``' columns: ``feature_importance`` (W7, the map of the model that
    scored the row) and ``top_risk_factors`` (W6, its ``k`` most important features with
    the row's values).  Both are literals and projections of a branch: no join, no shuffle.
    """
    def explained(part: DataFrame, model: PipelineModel) -> DataFrame:
        imps = mdl.importances(model)
        return xpl.with_top_factors(part, imps, k=k).withColumn("feature_importance", importance_map(imps))

    return _present(requests, models, cfg, model_info, run_ts, ["feature_importance", "top_risk_factors"], explained)
