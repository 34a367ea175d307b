"""Model-version table operators.

The version table (name, version, run_id, stage) stands in for the model
registry.  ``version`` is a string and is compared as an integer.

Per-name argmax (W1, W2) is one ``max_by`` aggregate: one scan, combined map-side, so a
name that holds a third of all versions costs one partial row per mapper.  Equal versions
of a name fall to the greater (run_id, stage).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S


def version_number(col: str = "version") -> Column:
    return F.col(col).try_cast("long")


def registered_name(key: Column | str, prefix: str = S.MODEL_PREFIX) -> Column:
    """Registry name from a model key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), k)


def display_name(name: Column | str, prefix: str = S.MODEL_PREFIX) -> Column:
    """Strip the registry prefix for display."""
    n = F.col(name) if isinstance(name, str) else name
    return F.when(n.startswith(prefix), F.substring(n, F.lit(len(prefix) + 1), F.length(n))).otherwise(n)


_ROW = ("version", "run_id", "stage")


def _argmax(versions: DataFrame, *key: Column) -> DataFrame:
    """Per name the row of the greatest key; rows whose whole key is null do not count."""
    order = F.struct(*key, F.col("run_id"), F.col("stage"))
    order = F.when(F.coalesce(*[k.cast("string") for k in key]).isNotNull(), order)
    return versions.groupBy("name").agg(F.max_by(F.struct(*_ROW), order).alias("r")).select("name", *[f"r.{c}" for c in _ROW])


def latest_versions(versions: DataFrame) -> DataFrame:
    """The highest version per name, compared as int.

    Rows whose version is not a number are ignored; a name with no numeric
    version gives one row of nulls.
    """
    return _argmax(versions, version_number())


def serving_versions(versions: DataFrame) -> DataFrame:
    """Per name, the highest Production version, else the highest version.

    The order is (is Production, version as int), nulls lowest.
    """
    is_prod = (F.col("stage") == "Production").cast("int")
    return _argmax(versions, F.coalesce(is_prod, F.lit(-1)), version_number()).withColumn(
        "resolved_by", F.when(F.col("stage") == "Production", "Production").otherwise("latest"))


def production_versions(versions: DataFrame) -> DataFrame:
    """V5 then one row per name: the highest Production version."""
    prod = versions.filter(F.col("stage") == "Production")
    return latest_versions(prod)


def promote(versions: DataFrame, name: str, version: str) -> DataFrame:
    """``name``/``version`` -> Production; other Production versions of
    the same name -> Archived.  Other names are untouched (D10).  Row-local.
    """
    same = F.col("name") == F.lit(name)
    chosen = same & (F.col("version") == F.lit(version))
    stage = (
        F.when(chosen, "Production")
        .when(same & (F.col("stage") == "Production"), "Archived")
        .otherwise(F.col("stage"))
    )
    return versions.withColumn("stage", stage)


def promote_latest(versions: DataFrame, chosen_names: DataFrame) -> DataFrame:
    """W3 driven by data: promote the latest version of each name in
    ``chosen_names`` (one row per chosen name, e.g. the champion).

    The chosen versions are a per-name aggregate joined back on ``name``; no
    value passes through the driver.  The joins carry no hint: the planner
    broadcasts the short side by its measured size, and AQE splits a hot name.
    """
    names = chosen_names.select("name").distinct()
    latest = latest_versions(versions.join(names, "name", "left_semi"))
    target = latest.select("name", F.col("version").alias("_promote_version"))
    joined = versions.join(target, "name", "left")
    chosen = F.col("_promote_version").isNotNull()
    stage = (
        F.when(chosen & (F.col("version") == F.col("_promote_version")), "Production")
        .when(chosen & (F.col("stage") == "Production"), "Archived")
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("stage", stage).drop("_promote_version")
