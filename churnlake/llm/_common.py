"""Helpers shared by the operators: written tables in the shared folder, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import churnlake
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.session import shared_dir

# Folders written and not released, per application.
_written: dict[str, list[str]] = {}


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package (once per application), wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(churnlake.__file__)
    archive = os.path.join(tempfile.mkdtemp(prefix="churnlake-code-"), "churnlake-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, remembered for ``release``."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (a lineage cut)."""
    ship_code(df.sparkSession)
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Arrow batches of few rows for what is run inside: whole texts, whose batches else take tens of MB in both processes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(spark: SparkSession) -> list[str]:
    """The folders of this application that are not released."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables; call when what was computed from them is written."""
    own = _written.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path in own:
            delete_folder(spark, path)
            own.remove(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once.  An expression inside a lambda is evaluated once per element, its variables are not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(values: Column) -> Column:
    """Sums of an array's first 1, 2, ... elements, by doubling: log2(n) passes of ``transform``, and no array that grows by one."""
    passes = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")

    def add(a: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(a, lambda x, i: x + F.when(i >= back, F.get(a, i - back)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), passes), values, add)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of a text column; sizes chunks and buckets."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of every vertex of ``edges(a, b)`` (longs): rows ``(id, component)``, the least id reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round is a
    min per vertex (combined map-side) and a join that AQE can split at a hot centre, and
    leaves one edge per vertex at most in the end.  Nothing is collected; each round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    cur = materialise(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    last = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        nxt = materialise(small.select("e.*").where(F.col("u") != F.col("v")).distinct(), "cc")
        state = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        state = (state[0], state[1])
        cur = nxt
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(roots)
