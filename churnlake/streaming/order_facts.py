"""Order facts that follow the stream of orders.

Arriving orders are reduced per customer within their micro-batch (the batch's own rows are
all that is shuffled) and added to a versioned table; counts and sums add up and dates take
their maximum, so any split of the orders into batches gives the facts of the batch job.
Stream scoring reads the newest version in each of its micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake import fixtures as fx
from churnlake.streaming.ab_stats import REFRESH, event_stream
from churnlake.streaming.store import COMPACT_EVERY, BatchStore

FACTS_SCHEMA = "o_custkey long, n_orders long, spend decimal(28,2), last_order timestamp_ntz"
MAX_FILES = 1000  # files that one trigger admits


def merge_facts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("o_custkey").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("spend").cast("decimal(28,2)").alias("spend"), F.max("last_order").alias("last_order"))


def facts_store(spark: SparkSession, path: str, compact_every: int = COMPACT_EVERY) -> BatchStore:
    return BatchStore(spark, path, FACTS_SCHEMA, merge_facts, compact_every)


def start_facts(spark: SparkSession, folder: str, path: str, checkpoint: str, glob: str = "orders.parquet", available_now: bool = True,
                max_files_per_trigger: int = MAX_FILES, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Add every arriving order of ``folder`` to the facts under ``path``."""
    store = facts_store(spark, path, compact_every)
    orders = event_stream(spark, folder, glob, max_files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.write(fx.order_facts(spark, folder, orders=batch).select("o_custkey", "n_orders", F.col("spend").cast("decimal(28,2)"), "last_order"), batch_id)

    w = orders.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=REFRESH)
    return w.start()
