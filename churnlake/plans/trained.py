"""Fitted pipelines shared by the registered model queries.

Fitting is the expensive part of the model queries, so one fit per
(session, state of the data folder, model) is kept for the life of the session; a new
session (e.g. after a driver restart) or a changed table fits again, and what was kept
for the older state of the folder is released.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from churnlake import schemas as S
from churnlake.plans import models as mdl

# (application, folder) -> (state of the folder, prepared data, fitted models)
_KEPT: dict[tuple[str, str], tuple[tuple, mdl.PreparedData, dict[str, PipelineModel]]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, length and time of every entry of the folder (one per table)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def _kept(spark: SparkSession, sf_dir: str) -> tuple[tuple, mdl.PreparedData, dict[str, PipelineModel]]:
    from churnlake.plans import catalog

    key, state = (spark.sparkContext.applicationId, sf_dir), _state(spark, sf_dir)
    old = _KEPT.get(key)
    if old is None or old[0] != state:
        if old is not None:
            old[1].train.unpersist()
        _KEPT[key] = (state, mdl.prepare(catalog.features(spark, sf_dir)), {})
    return _KEPT[key]


def prepared(spark: SparkSession, sf_dir: str) -> mdl.PreparedData:
    return _kept(spark, sf_dir)[1]


def models_for(spark: SparkSession, sf_dir: str, keys: list[str]) -> dict[str, PipelineModel]:
    _, data, models = _kept(spark, sf_dir)
    models |= mdl.fit_all([k for k in keys if k not in models], data)
    return {k: models[k] for k in keys}


def registry_models(spark: SparkSession, sf_dir: str, keys: list[str]) -> dict[str, PipelineModel]:
    """Fitted pipelines keyed by registry name (prefix + key), in ``keys`` order."""
    return {S.MODEL_PREFIX + k: m for k, m in models_for(spark, sf_dir, keys).items()}
