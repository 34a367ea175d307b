"""A commit log beside a table: what readers see changes by one atomic step.

``<base>/_log/<version>.json`` holds one small entry per commit, created only if absent, so of
two writers that build on one version a single one wins and the other starts again from
the winner's result.  ``<base>/_log/_hint`` names a version not far from the newest: a
reader opens it, looks for the versions after it and reads one entry, whatever the length
of the history.  (Spark's readers skip names that begin with an underscore.)

On file systems with an atomic rename that refuses an existing target (local, HDFS) the
protocol holds for any number of writers.  Object stores without one need a store-side
condition on the log's objects.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlake.session import path_exists

KEPT_RUNS = 200  # run keys that an entry remembers


class CommitConflict(RuntimeError):
    """Other writers kept winning."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Hadoop's rename that refuses an existing target."""
    jvm = spark._jvm
    _, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(src), context.makeQualified(dst), options)
    except Exception as e:  # noqa: BLE001 - only the refusal is expected
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, unless there is one already."""
    temporary = f"{path.rsplit('/', 1)[0]}/_tmp-{uuid.uuid4().hex}"
    _write_text(spark, temporary, text)
    fs, p = _fs(spark, temporary)
    try:
        if fs.getUri().getScheme() == "file":
            local = p.toUri().getPath()
            target = _fs(spark, path)[1].toUri().getPath()
            try:
                os.link(local, target)  # atomic, and fails on an existing name
            except FileExistsError:
                return False
            return True
        return _rename_if_absent(spark, temporary, path)
    finally:
        if fs.exists(p):
            fs.delete(p, False)


def _entry(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/_log/{version:012d}.json"


def _listed(spark: SparkSession, base: str) -> list[int]:
    fs, p = _fs(spark, f"{base.rstrip('/')}/_log")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, base: str) -> tuple[int, dict | None]:
    """The newest version and its entry; (0, None) before the first commit."""
    try:
        version = int(read_text(spark, f"{base.rstrip('/')}/_log/_hint"))
    except Exception:  # noqa: BLE001 - no hint, or one that is being written
        version = max(_listed(spark, base), default=0)
    while path_exists(spark, _entry(base, version + 1)):
        version += 1
    return (version, json.loads(read_text(spark, _entry(base, version)))) if version else (0, None)


def try_commit(spark: SparkSession, base: str, version: int, entry: dict) -> bool:
    """Commit ``entry`` as ``version``; False if that version exists."""
    if not put_if_absent(spark, _entry(base, version), json.dumps(entry)):
        return False
    _write_text(spark, f"{base.rstrip('/')}/_log/_hint", str(version))
    return True


def commit(spark: SparkSession, base: str, make: Callable[[dict | None], dict], attempts: int = 50) -> dict:
    """Commit ``make(newest entry)``, made anew after each lost race."""
    for _ in range(attempts):
        version, entry = latest(spark, base)
        new = make(entry)
        if try_commit(spark, base, version + 1, new):
            return new
    raise CommitConflict(f"{attempts} commits to {base} lost their race")


def update_table(spark: SparkSession, base: str, run: str, change: Callable[[DataFrame | None], DataFrame], attempts: int = 10) -> str:
    """Replace the table under ``base`` by ``change(its newest state)`` (None before the first); returns the new state's folder.

    The new state is written beside the old one and committed on the version it was made
    from.  If another writer came first it is made again from that writer's state, so no
    change is lost.  A ``run`` that is committed already (a retried job) changes nothing.
    """
    for _ in range(attempts):
        version, entry = latest(spark, base)
        if entry and run in entry["runs"]:
            return f"{base.rstrip('/')}/{entry['runs'][run]}"
        folder = f"state-{version + 1:012d}-{uuid.uuid4().hex[:8]}"
        path = f"{base.rstrip('/')}/{folder}"
        current = spark.read.parquet(f"{base.rstrip('/')}/{entry['folder']}") if entry else None
        change(current).write.mode("errorifexists").parquet(path)
        runs = dict([*(entry["runs"].items() if entry else ()), (run, folder)][-KEPT_RUNS:])
        if try_commit(spark, base, version + 1, {"folder": folder, "runs": runs}):
            return path
        fs, p = _fs(spark, path)
        fs.delete(p, True)  # nobody has seen it
    raise CommitConflict(f"{attempts} updates of {base} lost their race")


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """The newest committed state of a table that ``update_table`` keeps."""
    _, entry = latest(spark, base)
    if entry is None:
        raise FileNotFoundError(f"no committed state under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/{entry['folder']}")
