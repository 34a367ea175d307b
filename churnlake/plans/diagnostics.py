"""Checks of fitted models that do not trust the library that fitted them.

* ``lr_gradient`` (M4): the gradient of the weighted, L2-penalised log-loss at the fitted
  coefficients, one distributed aggregate over the train part.  At the optimum it is zero.
* ``node_table`` / ``walk_trees`` (M8, M12, M13): a fitted forest as a relation of its
  nodes; every row walks every tree of every model over one scan.
* ``score_check``: that walk, and the linear model's own formula, against ``transform``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.plans import models as mdl
from churnlake.session import scratch_path

NODE_BITS = 32  # a node's key is its tree's number, then so many bits of node id
TOLERANCE = 1e-9


def _sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _linear(model, feature: list[Column]) -> Column:
    """Margin of a fitted linear model over its feature columns."""
    margin = F.lit(float(model.intercept))
    for w, x in zip(model.coefficients.toArray(), feature):
        margin = margin + F.lit(float(w)) * x
    return margin


def lr_gradient(model: PipelineModel, train: DataFrame, weight: str = "class_weight") -> DataFrame:
    """``feature, gradient``: a row per feature, and one named ``intercept`` (which carries no penalty)."""
    fitted = model.stages[-1]
    z = model.stages[0].transform(train)
    columns = [F.col(mdl.SCALED_PREFIX + c) for c in S.ALL_FEATURES]
    pull = F.col(weight) * (_sigmoid(_linear(fitted, columns)) - F.col(S.TARGET))
    sums = z.select(pull.alias("pull"), F.col(weight).alias("w"), *columns).agg(
        F.sum("w").alias("w"), F.sum("pull").alias("intercept"), *[F.sum(F.col("pull") * x).alias(c) for c, x in zip(S.ALL_FEATURES, columns)])
    penalty = float(fitted.getOrDefault("regParam"))
    rows = [F.struct(F.lit(c).alias("feature"), (F.col(c) / F.col("w") + F.lit(penalty * float(b))).alias("gradient"))
            for c, b in zip(S.ALL_FEATURES, fitted.coefficients.toArray())]
    rows.append(F.struct(F.lit("intercept").alias("feature"), (F.col("intercept") / F.col("w")).alias("gradient")))
    return sums.select(F.inline(F.array(*rows)))


def node_table(models: dict[str, PipelineModel], like: DataFrame) -> DataFrame:
    """``key, feature, cut, left, right, value`` of every node of the tree models, read from their saved node data.

    ``key`` numbers trees over all models in ``tree_numbers`` order; a leaf is its own child.
    ``value`` is a leaf's weighted share of the model's score.
    """
    out = None
    for name, numbers in tree_numbers(models).items():
        stage = models[name].stages[-1]
        path = scratch_path(like.sparkSession, "nodes")
        stage.write().save(path)
        nodes = like.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
        base = F.shiftleft((F.col("treeID") + numbers[0]).cast("long"), NODE_BITS)
        leaf = F.col("leftChild") < 0
        if hasattr(stage, "numClasses") and stage.getOrDefault("impurity") == "gini":
            stats = F.col("impurityStats")
            value = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) / len(numbers)
        else:
            value = F.col("prediction") * F.get(F.array(*[F.lit(float(w)) for w in stage.treeWeights]), F.col("treeID"))
        part = nodes.select(
            (base + F.col("id")).alias("key"), F.when(leaf, 0).otherwise(F.col("split.featureIndex")).alias("feature"),
            F.when(leaf, 0.0).otherwise(F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("cut"),
            F.when(leaf, base + F.col("id")).otherwise(base + F.col("leftChild")).alias("left"),
            F.when(leaf, base + F.col("id")).otherwise(base + F.col("rightChild")).alias("right"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def tree_numbers(models: dict[str, PipelineModel]) -> dict[str, range]:
    """The numbers of each tree model's trees, counted over all models."""
    out, at = {}, 0
    for name, m in models.items():
        if hasattr(m.stages[-1], "treeWeights"):
            n = m.stages[-1].getNumTrees
            out[name] = range(at, at + n)
            at += n
    return out


def walk_trees(rows: DataFrame, nodes: DataFrame, trees: dict[str, range], depth: int) -> DataFrame:
    """``rows(features, ...)`` once per model: ``model`` and ``score``, the sum of the leaves reached.

    A row becomes one state per tree and takes one broadcast lookup a level, all in the
    scan's stage.  The node table is bounded by the models' parameters (trees x 2^(depth+1)
    nodes, some ten MB for a hundred trees of depth ten), whatever the number of rows.
    A row's states are neighbours, so the final sum is combined before it is shuffled.
    """
    start = F.array(*[F.struct(F.lit(name).alias("model"), F.shiftleft(F.lit(t).cast("long"), NODE_BITS).alias("key")) for name, r in trees.items() for t in r])
    keep = [c for c in rows.columns if c != "features"]
    state = rows.withColumn("t", F.explode(start)).select(*keep, "features", "t.*")
    lookup = F.broadcast(nodes)
    for _ in range(depth):
        # ML sends a value at most the cut to the left, anything else (also NaN) to the right.
        down = F.when(F.get("features", "feature") <= F.col("cut"), F.col("left")).otherwise(F.col("right"))
        state = state.join(lookup, "key").select(*keep, "features", "model", down.alias("key"))
    return state.join(lookup, "key").groupBy(*keep, "model").agg(F.sum("value").alias("score"))


def score_check(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``model, rows, mismatches``: rows whose probability or class by the node table (by the formula, for
    the linear model) is not that of ``model.transform``.

    ``df`` has distinct ids.  Probabilities are sums in another order, so they may differ by TOLERANCE;
    the class is compared where the probability is further than that from one half.
    """
    rows, features = df, None
    for k, (name, m) in enumerate(models.items()):
        scored = m.transform(rows)
        features = vector_to_array(F.col("features"))
        said = F.struct(F.lit(name).alias("model"), mdl.p1().alias("p"), F.col("prediction").cast("int").alias("c"))
        rows = scored.select(*df.columns, *[f"said{i}" for i in range(k)], said.alias(f"said{k}"), features.alias("features_")).withColumn("features", F.col("features_"))
        if k + 1 < len(models):
            rows = rows.drop("features", "features_")
    rows = rows.select(S.ID, F.array(*[f"said{i}" for i in range(len(models))]).alias("said"), "features")
    rows = mdl.materialise(rows, "score_check")
    trees = tree_numbers(models)
    walked = None
    if trees:
        depth = max(t.depth for name in trees for t in models[name].stages[-1].trees)
        walked = walk_trees(rows, node_table(models, df), trees, depth)
    for name, m in models.items():
        if name not in trees:
            x = [F.get("features", F.lit(i)) for i in range(len(S.ALL_FEATURES))]
            part = rows.select(S.ID, "said", F.lit(name).alias("model"), _linear(m.stages[-1], x).alias("score"))
            walked = part if walked is None else walked.unionByName(part)
    score, probability = F.col("score"), None
    for name, m in models.items():
        p = score if m.stages[-1].__class__.__name__.startswith("RandomForest") else _sigmoid(score * (2 if name in trees else 1))
        probability = p if probability is None else F.when(F.col("model") == name, p).otherwise(probability)
    own = walked.select("model", probability.alias("own"), F.get(F.filter("said", lambda s: s["model"] == F.col("model")), F.lit(0)).alias("said"))
    off = F.abs(F.col("own") - F.col("said.p")) > TOLERANCE
    other = (F.abs(F.col("own") - 0.5) > TOLERANCE) & ((F.col("own") > 0.5).cast("int") != F.col("said.c"))
    return own.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(off | other, F.lit(True))).alias("mismatches"))
