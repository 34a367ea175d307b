"""A/B routing and traffic statistics.

Routing is a per-row hash of (id, salt): sticky per customer, repeatable on
reruns, and computed where the row lives (no shuffle, no driver state).  A
configuration is a small value object; it enters plans as literals.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.functions import unit_hash

AB_SALT = "ab"


@dataclass(frozen=True)
class ABConfig:
    """champion/challenger names, weights and the enabled flag."""

    model_a: str = S.DEFAULT_AB_MODEL_A
    model_b: str = S.DEFAULT_AB_MODEL_B
    weight_a: float = S.DEFAULT_AB_WEIGHT_A
    weight_b: float = S.DEFAULT_AB_WEIGHT_B
    enabled: bool = True

    def normalised(self) -> ABConfig:
        """Weights scaled to sum 1 when the sum is positive, else kept."""
        total = self.weight_a + self.weight_b
        if total > 0:
            return replace(self, weight_a=self.weight_a / total, weight_b=self.weight_b / total)
        return self

    def update_weights(self, weight_a: float, weight_b: float) -> ABConfig:
        """New weights, normalised; a non-positive sum keeps the old ones."""
        total = weight_a + weight_b
        if total > 0:
            return replace(self, weight_a=weight_a / total, weight_b=weight_b / total)
        return self

    def set_models(self, model_a: str, model_b: str) -> ABConfig:
        """R5."""
        return replace(self, model_a=model_a, model_b=model_b)

    def enable(self) -> ABConfig:
        return replace(self, enabled=True)

    def disable(self) -> ABConfig:
        return replace(self, enabled=False)


def normalise_config(configs: DataFrame) -> DataFrame:
    """R3/R4 over a table of configurations (model_a, model_b, weight_a, weight_b, enabled)."""
    total = F.col("weight_a") + F.col("weight_b")
    pos = total > 0
    return configs.select(
        "model_a", "model_b",
        F.when(pos, F.col("weight_a") / total).otherwise(F.col("weight_a")).alias("weight_a"),
        F.when(pos, F.col("weight_b") / total).otherwise(F.col("weight_b")).alias("weight_b"),
        "enabled",
    )


def route_columns(id_col: str | Column, cfg: ABConfig, salt: str = AB_SALT) -> tuple[Column, Column]:
    """R1 + R2: (model, ab_group) for each row."""
    to_a = unit_hash(id_col, salt) < F.lit(cfg.weight_a)
    if not cfg.enabled:
        return F.lit(cfg.model_a), F.lit("control")
    return (F.when(to_a, cfg.model_a).otherwise(cfg.model_b), F.when(to_a, "A").otherwise("B"))


def route(df: DataFrame, cfg: ABConfig, id_col: str = "customer_id", salt: str = AB_SALT) -> DataFrame:
    model, group = route_columns(id_col, cfg.normalised(), salt)
    return df.withColumn("model", model).withColumn("ab_group", group)


def traffic_split(cfg_df: DataFrame) -> DataFrame:
    """Map model -> weight per config row, and its rows."""
    same = F.col("model_a") == F.col("model_b")
    one = F.array(F.struct(F.col("model_a").alias("model"), (F.col("weight_a") + F.col("weight_b")).alias("weight")))
    two = F.array(F.struct(F.col("model_a").alias("model"), F.col("weight_a").alias("weight")),
                  F.struct(F.col("model_b").alias("model"), F.col("weight_b").alias("weight")))
    rows = F.filter(F.when(same, one).otherwise(two), lambda r: r["model"].isNotNull())
    return cfg_df.select(F.inline(rows))


def weights_from_gap(gap: Column) -> tuple[Column, Column]:
    """R7's rule (fixed values): gap > .1 -> .9/.1, > .05 -> .8/.2, else .6/.4 (strict)."""
    champ = F.when(gap > F.lit(0.1), F.lit(0.9)).when(gap > F.lit(0.05), F.lit(0.8)).otherwise(F.lit(0.6))
    chall = F.when(gap > F.lit(0.1), F.lit(0.1)).when(gap > F.lit(0.05), F.lit(0.2)).otherwise(F.lit(0.4))
    return champ, chall


def derive_ab_weights(ranked: DataFrame, name: str = "name", score: str = "f1_score") -> DataFrame:
    """R7 over ranked model metrics (``rank`` from W4): one row with
    champion, challenger, gap, weights and a status.

    The ranked table has one row per model; the pivot is one aggregate.
    """
    def at(rank: int, c: str) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col(c)))

    one = ranked.agg(
        at(1, name).alias("champion"), at(1, score).alias("champion_f1"),
        at(2, name).alias("challenger"), at(2, score).alias("challenger_f1"),
        F.count(F.lit(1)).alias("n_models"),
    )
    gap = F.col("champion_f1") - F.col("challenger_f1")
    w1, w2 = weights_from_gap(gap)
    enough = F.col("n_models") >= 2
    status = F.when(F.col("n_models") == 0, "no_models").when(~enough, "insufficient_models").otherwise("updated")
    return one.select(
        "champion", "challenger", "champion_f1", "challenger_f1",
        F.when(enough, gap).alias("f1_gap"),
        F.when(enough, w1).alias("champion_weight"),
        F.when(enough, w2).alias("challenger_weight"),
        status.alias("status"),
    )


def split_map(cfg: ABConfig) -> Column:
    """R6 of a configuration: model name -> share of the traffic (one entry, the sum, if both names are equal)."""
    c = cfg.normalised()
    shares: dict[str, float] = {}
    for name, w in ((c.model_a, c.weight_a), (c.model_b, c.weight_b)):
        shares[name] = shares.get(name, 0.0) + w
    return F.create_map(*[x for name, w in shares.items() for x in (F.lit(name), F.lit(float(w)))])


def write_metric_lines(stats: DataFrame, path: str) -> None:
    """P24's text sink: the exposition lines of ``per_model_stats``, one file (two lines per model)."""
    metric_lines(stats).select("line").coalesce(1).write.mode("overwrite").text(path)


def ab_stats(log: DataFrame, cfg: ABConfig, endpoint: str = "predict") -> DataFrame:
    """Request counts and mean latency of model A and B (0 when none).

    Only ``endpoint`` rows count (the reference counts /predict only, D7).
    One conditional aggregate: partial sums map-side, no hot group.
    """
    lg = log.filter(F.col("endpoint") == endpoint)
    is_a, is_b = F.col("model") == cfg.model_a, F.col("model") == cfg.model_b
    out = lg.agg(
        F.count_if(is_a).alias("model_a_requests"),
        F.count_if(is_b).alias("model_b_requests"),
        F.avg(F.when(is_a, F.col("latency_ms"))).alias("a_lat"),
        F.avg(F.when(is_b, F.col("latency_ms"))).alias("b_lat"),
    )
    return out.select(
        (F.col("model_a_requests") + F.col("model_b_requests")).alias("total_requests"),
        "model_a_requests", "model_b_requests",
        F.coalesce("a_lat", F.lit(0.0)).alias("model_a_avg_latency_ms"),
        F.coalesce("b_lat", F.lit(0.0)).alias("model_b_avg_latency_ms"),
        F.lit(cfg.model_a).alias("model_a_name"),
        F.lit(cfg.model_b).alias("model_b_name"),
        split_map(cfg).alias("traffic_split"),
    )


def per_model_stats(log: DataFrame, endpoint: str | None = "predict") -> DataFrame:
    """T1/A11 per model: requests and mean latency."""
    lg = log if endpoint is None else log.filter(F.col("endpoint") == endpoint)
    return lg.groupBy("model").agg(
        F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("avg_latency_ms")
    )


def metric_lines(stats: DataFrame) -> DataFrame:
    """Exposition lines per model (counter, and mean latency with 2 decimals)."""
    total = F.format_string('prediction_requests_total{model="%s"} %d', F.col("model"), F.col("requests"))
    lat = F.format_string('prediction_latency_avg_ms{model="%s"} %.2f', F.col("model"), F.col("avg_latency_ms"))
    lines = F.array(
        F.struct(F.lit("requests_total").alias("metric"), total.alias("line")),
        F.struct(F.lit("latency_avg_ms").alias("metric"), lat.alias("line")),
    )
    has_lat = F.col("avg_latency_ms").isNotNull()
    return stats.select("model", F.inline(lines), has_lat.alias("_has_lat")).filter(
        (F.col("metric") == "requests_total") | F.col("_has_lat")
    ).drop("_has_lat")


def batch_summary(log: DataFrame, endpoint: str = "batch") -> DataFrame:
    """Processed count and mean time (0 when empty)."""
    lg = log.filter(F.col("endpoint") == endpoint)
    return lg.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_prediction_time_ms"),
    )


def model_traffic(models: DataFrame) -> DataFrame:
    """Each loaded model with traffic share 100/n (a bounded window:
    one row per loaded model)."""
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return models.withColumn("traffic_percentage", F.lit(100.0) / n).withColumn("is_active", F.lit(True))
