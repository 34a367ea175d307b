"""Running A/B counters over the prediction log as a stream.

The reference keeps per-process counters and an unbounded latency list per
model.  Here the prediction log is a file stream; a ``groupBy(model)``
aggregate keeps two numbers per model in the checkpointed state store
(count and sum), so it survives restarts and executor loss and its state
does not grow with traffic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake import fixtures as fx
from churnlake.operators import abtest as ab

REFRESH = "10 seconds"  # T2: the dashboard's refresh period
BATCH = "batch_id="
KEEP_BATCHES = 10


def event_stream(spark: SparkSession, folder: str, glob: str = "events.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the ``events`` files of ``folder`` (schema read from metadata)."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def ab_counters(log_stream: DataFrame, endpoint: str = "predict") -> DataFrame:
    """Per-model request count and mean latency (streaming aggregate)."""
    return ab.per_model_stats(log_stream, endpoint)


def start_counters(spark: SparkSession, folder: str, out_path: str, checkpoint: str,
                   available_now: bool = True, glob: str = "events.parquet") -> StreamingQuery:
    """Run T1; ``read_counters`` gives the current counters at any time.

    ``complete`` mode re-emits the (tiny, one row per model) result each
    trigger.  Each micro-batch writes a folder of its own, so a reader never
    meets a half-written table and a replayed batch writes the same rows again
    (idempotent).  The last ``KEEP_BATCHES`` folders stay.
    """
    log = fx.prediction_log(spark, folder, events=event_stream(spark, folder, glob))
    counters = ab_counters(log)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/{BATCH}{batch_id}")
        fs, root = _folder(spark, out_path)
        for old in _batches(spark, out_path):
            if old <= batch_id - KEEP_BATCHES:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"{BATCH}{old}"), True)

    w = counters.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=REFRESH)
    return w.start()


def _folder(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the completely written batches (``KEEP_BATCHES`` or so)."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    done = [n for n in names if n.startswith(BATCH) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(root, f"{n}/_SUCCESS"))]
    return sorted(int(n[len(BATCH):]) for n in done)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete counters that ``start_counters`` wrote under ``path``."""
    done = _batches(spark, path)
    if not done:
        raise FileNotFoundError(f"no complete counters under {path}")
    return spark.read.parquet(f"{path}/{BATCH}{done[-1]}")
