"""Spark ML training, evaluation and scoring.

* Scaling lives inside the saved ``PipelineModel`` (an ``SQLTransformer``
  holding the train-part means and population stds as literals), so the
  model is always scored on the data it was trained on (fixes D5).
* Class weights (``class_weight='balanced'``) are a ``weightCol`` attached
  by a broadcast join of a two-row table (one row per class: bounded).
* The split and the CV folds are cuts of a per-row hash at exact class shares; the fold
  fits of all models run concurrently, are kept in a ledger and measured in one aggregate.
* All models are measured in one pass over long predictions (U1 + A5 + A6).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlake import schemas as S
from churnlake.operators import auc as auc_ops
from churnlake.operators import metrics as met
from churnlake.operators import scaling as scl
from churnlake.operators import split as spl
from churnlake.operators.features import fill_missing

SCALED_PREFIX = "z_"
METRICS = "model string, accuracy double, precision double, recall double, f1_score double, roc_auc double"


def scaling_stage(scaler: scl.FittedScaler, numeric: Sequence[str] = S.NUMERIC_FEATURES,
                  binary: Sequence[str] = S.BINARY_FEATURES) -> SQLTransformer:
    """M3 as a pipeline stage: nulls -> 0 (P4), numerics standardised."""
    parts = []
    for c in numeric:
        mean = scaler.means.get(c) or 0.0
        scale = scaler.scales.get(c) or 1.0
        parts.append(f"(CAST(COALESCE(`{c}`, 0) AS DOUBLE) - ({mean!r})) / ({scale!r}) AS `{SCALED_PREFIX}{c}`")
    for c in binary:
        parts.append(f"CAST(COALESCE(`{c}`, 0) AS DOUBLE) AS `{SCALED_PREFIX}{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def assembler(features: Sequence[str] = S.ALL_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=[SCALED_PREFIX + c for c in features], outputCol="features",
                           handleInvalid="keep")


def estimator(key: str, n_train: int, weighted: bool = True):
    """M4-M6 with the reference's settings mapped to Spark ML."""
    w = {"weightCol": "class_weight"} if weighted else {}
    if key == "logistic_regression":
        # L2, C=1 over weighted samples == regParam 1/n with weights summing to n.
        return LogisticRegression(featuresCol="features", labelCol=S.TARGET, maxIter=1000,
                                  regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                  standardization=False, **w)
    if key == "random_forest":
        # No min-split of 5 in Spark; with two rows a child, the nearest, a split node has four.
        # cacheNodeIds keeps each row's node per tree between levels instead of
        # walking 100 depth-10 trees again at every level (same model, about
        # half the time); the cached ids are checkpointed every 10 levels into
        # the shared folder, so the lineage stays short.
        return RandomForestClassifier(featuresCol="features", labelCol=S.TARGET, numTrees=100, maxDepth=10,
                                      featureSubsetStrategy="sqrt", seed=42, cacheNodeIds=True,
                                      checkpointInterval=10, minInstancesPerNode=2, **w)
    if key == "gradient_boosting":
        return GBTClassifier(featuresCol="features", labelCol=S.TARGET, maxIter=100, maxDepth=5,
                             stepSize=0.1, seed=42)
    raise ValueError(f"unknown model {key}")


MODEL_WEIGHTED = {"logistic_regression": True, "random_forest": True, "gradient_boosting": False}
# Relative fit cost, used only to start the slowest fits first.
_FIT_COST = {"gradient_boosting": 3, "random_forest": 2, "logistic_regression": 1}


@dataclass
class PreparedData:
    train: DataFrame
    test: DataFrame
    scaler: scl.FittedScaler
    n_train: int
    weights: DataFrame


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in the shared folder and read it back.

    Cuts the lineage before iterative fits (each L-BFGS step, tree level,
    boosting round and CV fold re-reads a compact columnar table instead of
    re-running the feature plan), and a lost executor recomputes from the
    table, not from the raw inputs.
    """
    from churnlake.session import write_shared

    return write_shared(df, name)


def prepare(features: DataFrame, materialize: bool = True) -> PreparedData:
    """P4 + M1 + A10 + A9 + J4: split, fit the scaler, attach class weights.

    A fit passes over its rows some 500 times, so its tasks are counted by rows and cores:
    the table is written again with its split column in that many partitions, and the
    cached training part has as many.  A small table stays in the partitions it has.
    """
    from churnlake.session import spread, task_count

    f = fill_missing(features).select(S.ID, *S.ALL_FEATURES, S.TARGET)
    if materialize:
        f = materialise(f, "prepared")
    f = f.withColumn("split", spl.exact_split_column(f))
    if materialize:
        tasks = task_count(f.sparkSession, f.count())
        f = f if tasks == 1 else materialise(spread(f, tasks, S.ID), "split")
    train = f.filter(F.col("split") == "train").drop("split")
    test = f.filter(F.col("split") == "test").drop("split")
    scaler = scl.FittedScaler.fit(train)
    weights = scl.class_weights(train)
    # Every fit and CV fold re-reads the training part many times (each
    # L-BFGS step, tree level, boosting round): keep it cached once.  Its
    # lineage starts at the written table, so a lost block is re-read, not
    # re-derived from the raw inputs.
    train_w = scl.with_class_weight(train, weights, out="class_weight")
    train_w = spread(train_w, task_count(train.sparkSession, scaler.n), S.ID).persist(StorageLevel.MEMORY_AND_DISK)
    return PreparedData(train_w, test, scaler, scaler.n, weights)


def pipeline(key: str, data: PreparedData) -> Pipeline:
    return Pipeline(stages=[scaling_stage(data.scaler), assembler(),
                            estimator(key, data.n_train, MODEL_WEIGHTED[key])])


def fit(key: str, data: PreparedData) -> PipelineModel:
    """M4/M5/M6."""
    return pipeline(key, data).fit(data.train)


def fit_all(keys: Sequence[str], data: PreparedData, parallelism: int = 3) -> dict[str, PipelineModel]:
    """M4-M6 together: independent fits from a thread pool, slowest first.

    Each fit is a chain of small Spark jobs; running them side by side keeps
    the executors busy between one fit's jobs.  Returned in ``keys`` order.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    keys = list(keys)
    if len(keys) <= 1 or parallelism <= 1:
        return {k: fit(k, data) for k in keys}
    order = sorted(keys, key=lambda m: -_FIT_COST.get(m, 0))
    run = inheritable_thread_target(data.train.sparkSession)(lambda k: fit(k, data))
    with ThreadPoolExecutor(min(parallelism, len(keys))) as pool:
        fitted = dict(zip(order, pool.map(run, order)))
    return {k: fitted[k] for k in keys}


def p1(probability: str = "probability"):
    """Probability of class 1 from the ML vector column."""
    return vector_to_array(F.col(probability))[1]


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (S.ID,)) -> DataFrame:
    """M8: probability of churn and the model's own class."""
    out = model.transform(df)
    return out.select(*keep, p1().alias("probability"), F.col("prediction").cast("int").alias("prediction"))


def importances(model: PipelineModel) -> list[float]:
    """M9: tree importances, else |coefficients|, else uniform."""
    m = model.stages[-1]
    if hasattr(m, "featureImportances"):
        return [float(x) for x in m.featureImportances.toArray()]
    if hasattr(m, "coefficients"):
        return [abs(float(x)) for x in m.coefficients.toArray()]
    n = len(S.ALL_FEATURES)
    return [1.0 / n] * n


def long_predictions(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """(id, model, label, probability, prediction) for every model, stacked."""
    parts = []
    for key, m in models.items():
        s = score(m, test, keep=(S.ID, S.TARGET)).withColumn("model", F.lit(key))
        parts.append(s.select(S.ID, "model", F.col(S.TARGET).alias("label"), "probability", "prediction"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate(long: DataFrame, materialize: bool = True) -> DataFrame:
    """A5 + A6 for all models: one conditional-count pass and one AUC pass.

    The long predictions are written once to the shared folder first (five
    narrow columns), so model inference (100 trees per row for the forests)
    runs once, not once for the quantile sketch, once for the counts and once
    for the AUC.
    """
    if materialize:
        long = materialise(long, "predictions")
    m = met.classification_metrics(long)
    a = auc_ops.roc_auc(long).select("model", "roc_auc")
    return m.join(a, "model", "left").select("model", "accuracy", "precision", "recall", "f1_score", "roc_auc")


def fold_class_weights(folds: DataFrame, k: int,
                       label: str = S.TARGET) -> dict[int, tuple[int, dict[int, float]]]:
    """Rows and balanced weights of each fold's training part (all folds but one).

    One aggregate of at most ``k x classes`` rows (bounded), so each CV fit
    weighs its classes as a refit on that part would (n / (classes * n_c)).
    """
    counts: dict[int, dict[int, int]] = {}
    for r in folds.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(int(r["fold"]), {})[int(r[label])] = int(r["n"])
    total: dict[int, int] = {}
    for per in counts.values():
        for c, n in per.items():
            total[c] = total.get(c, 0) + n
    out = {}
    for i in range(k):
        part = {c: n - counts.get(i, {}).get(c, 0) for c, n in total.items()}
        part = {c: n for c, n in part.items() if n > 0}
        n_all = sum(part.values())
        out[i] = (n_all, {c: n_all / (len(part) * n) for c, n in part.items()})
    return out


def _fold_key(folds: DataFrame, data: PreparedData, k: int) -> str:
    """Name of what the fold fits depend on: fold and class counts, scaling, the number of folds."""
    counts = sorted(tuple(r) for r in folds.groupBy("fold", S.TARGET).agg(F.count(F.lit(1))).collect())  # at most k x classes rows
    state = (k, data.n_train, counts, sorted(data.scaler.means.items()), sorted(data.scaler.scales.items()))
    return hashlib.sha256(repr(state).encode()).hexdigest()[:16]


# Bytes that the fits of a session may hold in caches at once, and what the widest (a forest: bag counts of 100 trees
# and two node ids a tree) holds a row.
HELD_BYTES, FIT_ROW_BYTES = 12 << 30, 1500


def fits_at_once(parallelism: int, tasks: int, rows: int) -> int:
    """Concurrent fits of ``rows`` rows: as asked, as long as what they cache stays within HELD_BYTES."""
    return max(1, min(parallelism, tasks, HELD_BYTES // (FIT_ROW_BYTES * max(rows, 1))))


def cross_validate_models(keys: Sequence[str], data: PreparedData, k: int = 5,
                          parallelism: int = 8, ledger: str | None = None) -> DataFrame:
    """K-fold F1 of class 1 on the train part, for several models at once.

    Folds hold equal shares of each class (``exact_fold_column``).  Every
    (model, fold) fit is an independent Spark job chain, so they run
    ``parallelism`` at a time from a thread pool (``CrossValidator`` runs
    folds one after another and parallelises only over a param grid).  The
    pool size bounds how many fold copies the fits persist at once; with many rows
    fewer run at once (``fits_at_once``), each over more tasks.  Rows are scaled and
    assembled once, for all fits.  Each fit gets its fold's own class weights and, for
    logistic regression, its own ``1/n``.  Scaling keeps the whole-train statistics (D17).

    A fit's held-out predictions are written to ``ledger`` (a folder in shared storage; a
    fresh one by default), under a key of the data and the folds.  A second call with the
    same ledger, after a failure or a lost driver, fits only what is not there.
    All predictions are then measured in one ``groupBy(model, fold)`` aggregate.
    Returns (model, cv_f1_mean, cv_f1_std, folds) with the population std.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    from churnlake.session import path_exists, scratch_path, spread, task_count

    spark = data.train.sparkSession
    train = data.train.drop("class_weight")
    at_once = fits_at_once(parallelism, k * len(keys), data.n_train)
    train = spread(train, task_count(spark, data.n_train, at_once), S.ID)
    assembled = assembler().transform(scaling_stage(data.scaler).transform(train)).withColumn("fold", spl.exact_fold_column(train, k))
    folds = assembled.select("features", S.TARGET, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = fold_class_weights(folds, k)
        y = F.col(S.TARGET)
        root = f"{(ledger or scratch_path(spark, 'cv')).rstrip('/')}/{_fold_key(folds, data, k)}"

        def fit_fold(task: tuple[str, int]) -> None:
            key, i = task
            path = f"{root}/model={key}/fold={i}"
            if path_exists(spark, f"{path}/_SUCCESS"):
                return
            n_fold, w = weights[i]
            part = folds.filter(F.col("fold") != i)
            if MODEL_WEIGHTED[key]:
                wcol = F.lit(0.0)
                for c, v in sorted(w.items()):
                    wcol = F.when(y == c, F.lit(v)).otherwise(wcol)
                part = part.withColumn("class_weight", wcol)
            model = estimator(key, n_fold, MODEL_WEIGHTED[key]).fit(part)
            held = model.transform(folds.filter(F.col("fold") == i))
            held.select(F.col(S.TARGET).alias("label"), F.col("prediction").cast("int").alias("prediction")).write.mode("overwrite").parquet(path)

        # Slowest models first, so the pool's tail is short.
        order = sorted(keys, key=lambda m: -_FIT_COST.get(m, 0))
        tasks = [(key, i) for key in order for i in range(k)]
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(inheritable_thread_target(spark)(fit_fold), tasks))
    finally:
        folds.unpersist()
    long = spark.read.schema("label int, prediction int, model string, fold int").parquet(root).filter(F.col("model").isin(list(keys)))
    return met.cv_summary(met.fold_f1(long))


def output_schema(model: PipelineModel, inputs: StructType) -> StructType:
    """What the model returns for rows of ``inputs``: probability and class, from an empty table (no job)."""
    return score(model, SparkSession.getActiveSession().createDataFrame([], inputs), keep=()).schema


def save(model: PipelineModel, path: str, input_schema_json: str) -> None:
    """One artifact with scaling + model, and the signature (inputs and outputs) beside it."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    inputs = StructType.fromJson(json.loads(input_schema_json))
    signature = json.dumps({"inputs": inputs.jsonValue(), "outputs": output_schema(model, inputs).jsonValue()})
    spark.createDataFrame([(signature,)], "signature string").coalesce(1).write.mode("overwrite").text(
        path.rstrip("/") + "_signature"
    )


def load(path: str, expect_columns: Sequence[str] | None = None, expect_schema: StructType | None = None) -> PipelineModel:
    """Load and check the saved signature against the expected inputs (their names and, with a schema, their types) and what the loaded model returns."""
    spark = SparkSession.getActiveSession()
    row = spark.read.text(path.rstrip("/") + "_signature").first()
    sig = json.loads(row[0]) if row is not None else None
    if sig is not None and expect_columns is not None:
        signed = {f.name: f.dataType.simpleString() for f in StructType.fromJson(sig["inputs"]).fields}
        missing = [c for c in expect_columns if c not in signed]
        if missing:
            raise ValueError(f"model signature lacks {missing}")
        given = {f.name: f.dataType.simpleString() for f in expect_schema.fields} if expect_schema is not None else {}
        other = {c: (signed[c], given[c]) for c in expect_columns if c in given and given[c] != signed[c]}
        if other:
            raise ValueError(f"types differ from the model signature: {other}")
    model = PipelineModel.load(path)
    if sig is not None:
        returns, signed_out = ([(f.name, f.dataType.simpleString()) for f in x.fields] for x in (
            output_schema(model, StructType.fromJson(sig["inputs"])), StructType.fromJson(sig["outputs"])))
        if returns != signed_out:
            raise ValueError(f"the model returns {returns}, its signature says {signed_out}")
    return model


@dataclass
class TrainingRun:
    """Everything one training run produced (K3)."""

    models: dict[str, PipelineModel]
    metrics: DataFrame
    cv: dict[str, tuple[float, float]] = field(default_factory=dict)
    run_ids: dict[str, str] = field(default_factory=dict)
    n_train: int = 0
    n_test: int = 0


def run_params(spark: SparkSession, run: TrainingRun, data: PreparedData) -> DataFrame:
    """Scalar params per run as a long table (run_id, key, value)."""
    rows = []
    for key, model in run.models.items():
        rid = run.run_ids.get(key, key)
        rows += [(rid, "model_type", key), (rid, "n_features", str(len(S.ALL_FEATURES))),
                 (rid, "train_samples", str(data.n_train)), (rid, "test_samples", str(run.n_test))]
        est = model.stages[-1]
        for p, v in est.extractParamMap().items():
            if isinstance(v, (int, float, str, bool)):
                rows.append((rid, p.name, str(v)))
    return spark.createDataFrame(rows, "run_id string, key string, value string")


def run_metrics(run: TrainingRun) -> DataFrame:
    """Metrics per run as a long table (run_id, key, value)."""
    ids = F.create_map(*[x for k, v in run.run_ids.items() for x in (F.lit(k), F.lit(v))]) if run.run_ids else None
    rid = ids[F.col("model")] if ids is not None else F.col("model")
    stack = "stack(5, 'accuracy', accuracy, 'precision', precision, 'recall', recall, 'f1_score', f1_score, 'roc_auc', roc_auc)"
    return run.metrics.select(rid.alias("run_id"), F.expr(f"{stack} AS (key, value)"))


def compare_production(models: dict[str, PipelineModel], test: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Evaluate every loadable production model on one test table.

    Each model's predictions are written once.  A model that fails on any row is left out
    of the comparison and recorded as (name, error); with no model left it is empty.
    """
    written: DataFrame | None = None
    failed: list[tuple[str, str]] = []
    for name, m in models.items():
        try:
            part = materialise(long_predictions({name: m}, test), "predictions")
        except Exception as e:  # noqa: BLE001 - recorded, not hidden
            failed.append((name, f"{type(e).__name__}: {e}"))
            continue
        written = part if written is None else written.unionByName(part)
    if written is None:
        return test.sparkSession.createDataFrame([], METRICS), failed
    return evaluate(written, materialize=False), failed
