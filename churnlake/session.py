"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on: ANSI semantics, UTC
# timestamps, AQE for runtime coalescing and skew splitting.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark otherwise records the Python call site of every Column call
    # (four extra JVM round trips each); plans are built from hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoint files (size-check snapshots, tree/boosting checkpoints) are
    # deleted once nothing references them, so the shared folder stays small.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "churnlake") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHURNLAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a folder of
    our own is created and registered, so that lineage cuts and written
    intermediate tables always land in one shared place.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="churnlake-shared-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one written table."""
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Fewer rows than the first are not worth a task of their own; no partition is meant to hold more than the second.
ROWS_A_TASK, MOST_ROWS_A_TASK = 100_000, 400_000


def task_count(spark: SparkSession, rows: int, at_once: int = 1) -> int:
    """Partitions for ``rows`` rows that are costly each (model fits, tree scoring).

    As many as there are cores, fewer for small tables, and whole rounds of the cores for
    large ones.  Adaptive coalescing goes by bytes and gives such narrow rows too few tasks.
    Several jobs ``at_once`` share the cores: two tasks a core for all of them together.
    """
    cores = max(1, spark.sparkContext.defaultParallelism)
    cores = cores if at_once <= 1 else min(cores, -(-2 * cores // at_once))
    few = min(-(-rows // ROWS_A_TASK), cores)
    many = -(-rows // MOST_ROWS_A_TASK)
    return max(1, few if many <= few else -(-many // cores) * cores)


def spread(df, tasks: int, key: str):
    """``df`` in ``tasks`` partitions by the hash of ``key``, each in the order of all its columns; unchanged for one task.

    The order makes sampling by position (a forest's bags) the same in every run.
    """
    return df if tasks <= 1 else df.repartition(tasks, key).sortWithinPartitions(key, *[c for c in df.columns if c != key])


def write_shared(df, name: str):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The lineage of the result starts at the written table: later passes (and
    recomputation after a lost executor) read it instead of re-deriving it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
