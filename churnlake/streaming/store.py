"""A table that a stream's micro-batches add to and other jobs read while it grows.

Each micro-batch writes its rows under ``delta=<batch id>``; every ``compact_every``
batches the whole table is written once under ``base=<batch id>``.  A reader takes the
newest complete base and the complete deltas after it, and merges them.

* A replayed batch replaces its own delta, so nothing is counted twice.
* A folder counts once it has ``_SUCCESS``: readers never meet half-written rows.
* A batch costs its own rows, not the table's; a read costs the base and at most
  ``compact_every`` deltas, however long the stream has run.
* Folders that a newer base covers stay for one more compaction, for readers that have
  listed them already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlake.session import path_exists

COMPACT_EVERY = 20
DELTA, BASE = "delta=", "base="


class BatchStore:
    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], compact_every: int = COMPACT_EVERY):
        """``merge`` makes one row per key of rows of several batches, in the same schema; merging in steps must not matter."""
        self.spark, self.path, self.schema, self.merge, self.compact_every = spark, path.rstrip("/"), schema, merge, compact_every

    def _ids(self, kind: str) -> list[int]:
        """Ids of the complete folders of a kind (two compactions' worth at most)."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[len(kind):]) for n in names if n.startswith(kind) and path_exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _folders(self) -> list[str]:
        bases = self._ids(BASE)
        newest = bases[-1] if bases else -1
        return [f"{self.path}/{BASE}{newest}"] * bool(bases) + [f"{self.path}/{DELTA}{i}" for i in self._ids(DELTA) if i > newest]

    def version(self) -> int:
        """Id of the newest batch that a read would see; -1 before the first."""
        return max([*self._ids(BASE), *self._ids(DELTA)], default=-1)

    def read(self) -> DataFrame:
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.merge(self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(*folders))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{DELTA}{batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            old = self._ids(BASE)
            self.read().write.mode("overwrite").parquet(f"{self.path}/{BASE}{batch_id}")
            covered = max([b for b in old if b < batch_id], default=-1)
            for kind, ids in ((DELTA, [i for i in self._ids(DELTA) if i <= covered]), (BASE, [b for b in old if b < covered])):
                for i in ids:
                    p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}{i}")
                    p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
