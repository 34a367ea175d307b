"""Event-time windows of the prediction log: a labelled extension of T1.

Two queries run one after the other over the log:

1. ``start_intake`` parts arriving rows into those that a window can still take and late
   ones, which are kept in a folder of their own instead of being dropped unseen.
   A row is late if its window ended before the watermark: the greatest time of the batches
   before its own, less the allowed delay (Structured Streaming's own rule).
2. ``start_windows`` counts the first kind per tumbling window and model with Structured
   Streaming's watermark and window, so the state of a closed window is evicted.  It never
   sees a row that its own watermark, which lags behind the first, would drop.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.session import path_exists
from churnlake.streaming.ab_stats import REFRESH, event_stream
from churnlake.streaming.store import COMPACT_EVERY, BatchStore

WINDOW, DELAY = "1 hour", "30 minutes"
MARK_SCHEMA = "one int, newest timestamp_ntz"
WINDOW_SCHEMA = "window_start timestamp_ntz, model string, requests long, latency_sum double, latency_n long, batch long"


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=REFRESH)


def _marks(spark: SparkSession, out_path: str) -> BatchStore:
    """One row: the greatest time of all batches so far."""
    return BatchStore(spark, f"{out_path}/marks", MARK_SCHEMA, lambda rows: rows.groupBy("one").agg(F.max("newest").alias("newest")))


def start_intake(spark: SparkSession, folder: str, out_path: str, checkpoint: str, glob: str = "events.parquet", window: str = WINDOW,
                 delay: str = DELAY, endpoint: str = "predict", available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Rows of the log for ``endpoint``, into ``<out_path>/ontime`` and ``<out_path>/late`` (also rows without a time), a folder per batch."""
    log = fx.prediction_log(spark, folder, events=event_stream(spark, folder, glob, max_files_per_trigger)).where(F.col("endpoint") == endpoint)
    marks = _marks(spark, out_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch holds the same rows: what is complete is not written again, as it may have been read.
        if path_exists(spark, f"{out_path}/marks/delta={batch_id}/_SUCCESS"):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = marks.read().first()  # one row
            late = F.col("ts").isNull()
            if before is not None and before["newest"] is not None:
                end = F.window(F.col("ts").cast("timestamp"), window)["end"]
                late = F.coalesce(end <= F.lit(before["newest"]).cast("timestamp_ntz").cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(True))
            marked = batch.withColumn("late", late)
            for name, rows in (("ontime", marked.where(~F.col("late"))), ("late", marked.where("late"))):
                if not path_exists(spark, f"{out_path}/{name}/batch_id={batch_id}/_SUCCESS"):
                    rows.drop("late").write.mode("overwrite").parquet(f"{out_path}/{name}/batch_id={batch_id}")
            marks.write(batch.agg(F.max("ts").alias("newest")).select(F.lit(1).alias("one"), F.col("newest").cast("timestamp_ntz")), batch_id)
        finally:
            batch.unpersist()

    return _trigger(log.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), available_now).start()


def _newest(rows: DataFrame) -> DataFrame:
    """Of each window and model the row of the newest batch (its counts are whole, not increments)."""
    values = ["requests", "latency_sum", "latency_n", "batch"]
    return rows.groupBy("window_start", "model").agg(F.max_by(F.struct(*values), "batch").alias("r")).select("window_start", "model", *[f"r.{v}" for v in values])


def windows_store(spark: SparkSession, out_path: str, compact_every: int = COMPACT_EVERY) -> BatchStore:
    return BatchStore(spark, f"{out_path}/windows", WINDOW_SCHEMA, _newest, compact_every)


def start_windows(spark: SparkSession, out_path: str, checkpoint: str, window: str = WINDOW, delay: str = DELAY, available_now: bool = True,
                  max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Counts per tumbling window and model of the rows under ``<out_path>/ontime``; ``read_windows`` gives them at any time."""
    rows = (spark.readStream.schema(S.PREDICTION_LOG_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(f"{out_path}/ontime"))
    counts = (rows.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay).groupBy(F.window("at", window).alias("w"), "model")
              .agg(F.count(F.lit(1)).alias("requests"), F.sum("latency_ms").alias("latency_sum"), F.count("latency_ms").alias("latency_n")))
    store = windows_store(spark, out_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.write(batch.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "model", "requests", "latency_sum", "latency_n",
                                 F.lit(batch_id).cast("long").alias("batch")), batch_id)

    return _trigger(counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint), available_now).start()


def read_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """``window_start, model, requests, avg_latency_ms`` (null without a latency) as of the newest batch."""
    w = windows_store(spark, out_path).read()
    return w.select("window_start", "model", "requests", F.try_divide("latency_sum", F.col("latency_n")).alias("avg_latency_ms"))


def read_late(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(S.PREDICTION_LOG_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out_path}/late")
