"""Online scoring of arriving customers.

Customer rows arrive as files; each row is joined with the per-customer
order facts, turned into a request, validated, routed and scored with
fixed, already-fitted pipelines and a fixed A/B configuration.

* Given the store that the stream of orders fills (``order_facts``), each
  micro-batch reads its newest version, so a later order counts in the next batch.
  Without one the facts are aggregated once, when the stream starts, and written to
  the shared folder; either way no trigger aggregates all orders again.
* A micro-batch's facts are those of its customers (a semi join that the planner
  broadcasts by the keys' measured size); ``maxFilesPerTrigger`` bounds a batch.
* A micro-batch's requests are cached in partitions counted by rows and cores, since a
  row costs a hundred trees however few bytes it has.
* Each micro-batch is scored by the batch code (``foreachBatch``) and written
  under ``batch_id=<n>`` with overwrite, so a replayed batch replaces its own
  output instead of duplicating it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake import fixtures as fx
from churnlake.operators import abtest as ab
from churnlake.operators import quality as qual
from churnlake.operators import scoring as sco
from churnlake.plans import serving
from churnlake.streaming.store import BatchStore

MAX_FILES = 1000  # files that one trigger admits


def customer_stream(spark: SparkSession, folder: str, glob: str = "customer.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def facts_for_batch(facts: DataFrame, batch: DataFrame) -> DataFrame:
    """The order-facts rows of the batch's customers."""
    return facts.join(batch.select(F.col("c_custkey").alias("o_custkey")).distinct(), "o_custkey", "left_semi")


def _start_requests(spark: SparkSession, folder: str, facts: BatchStore | None, handle: Callable[[DataFrame, int], None], checkpoint: str,
                    available_now: bool, max_files_per_trigger: int, glob: str) -> StreamingQuery:
    """Customer stream -> requests of each micro-batch -> ``handle(requests, batch_id)``."""
    from churnlake.session import spread, task_count, write_shared

    frozen = write_shared(fx.order_facts(spark, folder), "order_facts") if facts is None else None
    customers = customer_stream(spark, folder, glob, max_files_per_trigger=max_files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for its keys and for scoring
        requests = None
        try:
            now = frozen if facts is None else facts.read()
            requests = fx.requests(spark, folder, customers=batch, facts=facts_for_batch(now, batch))
            # joined once for both models' branches and the rejects, over as many tasks as the rows are worth
            requests = spread(requests, task_count(spark, batch.count()), "customer_id").persist(StorageLevel.MEMORY_AND_DISK)
            handle(requests, batch_id)
        finally:
            if requests is not None:
                requests.unpersist()
            batch.unpersist()

    w = customers.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_scoring(spark: SparkSession, folder: str, models: dict[str, PipelineModel], cfg: ab.ABConfig,
                  out_path: str, checkpoint: str, available_now: bool = True,
                  max_files_per_trigger: int = MAX_FILES, facts: BatchStore | None = None,
                  model_info: DataFrame | None = None, glob: str = "customer.parquet") -> StreamingQuery:
    """Customer stream -> requests -> V4 -> P18 -> R1 -> M8 -> sink; rejects go to ``<out_path>-rejects``.

    With ``facts`` (``order_facts.facts_store``) each micro-batch reads their newest
    version; else they are taken once, at the start.  With ``model_info`` (W2) a
    prediction carries the version that served it.  ``timestamp`` is the batch's time, in UTC.
    """
    path = out_path.rstrip("/")

    def handle(requests: DataFrame, batch_id: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        serving.score_requests(requests, models, cfg, model_info, now).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        serving.rejected_requests(requests).write.mode("overwrite").parquet(f"{path}-rejects/batch_id={batch_id}")

    return _start_requests(spark, folder, facts, handle, checkpoint, available_now, max_files_per_trigger, glob)


def start_request_features(spark: SparkSession, folder: str, facts: BatchStore, out_path: str, checkpoint: str, available_now: bool = True,
                           max_files_per_trigger: int = MAX_FILES, glob: str = "customer.parquet") -> StreamingQuery:
    """The stream's features (V4, P18) without the models: what a feature log or a shadow model reads."""
    def handle(requests: DataFrame, batch_id: int) -> None:
        valid, _ = qual.split_valid(requests)
        sco.request_features(valid).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    return _start_requests(spark, folder, facts, handle, checkpoint, available_now, max_files_per_trigger, glob)
