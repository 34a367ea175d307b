"""Scans and sinks.

Raw data is CSV with an explicit schema (no inference pass); features and
snapshots are Parquet under ``snapshot=<yyyyMMdd_HHmmss>`` partitions.  A manifest entry
(``commits``) written after a snapshot names the newest one, so "latest" costs the same
however many there are, and no second copy is kept.  Snapshots are written once
and never overwritten: a rerun with the same ``run_ts`` fails loudly instead of mixing
files.  Run tables are appended in a folder per run, which a rerun replaces.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake import schemas as S
from churnlake.functions import ntz_lit
from churnlake.session import path_exists
from churnlake.sources import commits

SNAPSHOT_FORMAT = "%Y%m%d_%H%M%S"


def snapshot_key(run_ts: _dt.datetime) -> str:
    """The ``yyyyMMdd_HHmmss`` key of a run."""
    return run_ts.strftime(SNAPSHOT_FORMAT)


def snapshot_key_col(ts: str = "ts"):
    """P23 as a column: the same key for each row's timestamp, and its ISO form."""
    c = F.col(ts)
    return F.date_format(c, "yyyyMMdd_HHmmss"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# --- S1 / S2 -----------------------------------------------------------------
MALFORMED = "_malformed"
MALFORMED_SCHEMA = "customerID string, field string, value string"


def parse_raw_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """S1 with the fields that are not of their type: ``read_raw_csv``'s columns and ``_malformed``, an array of (field, value)."""
    raw = (
        spark.read
        .option("header", True)
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    fields = [f for f in schema.fields if f.name in raw.columns]
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                  F.struct(F.lit(f.name).alias("field"), F.col(f"`{f.name}`").alias("value"))) for f in fields if not isinstance(f.dataType, T.StringType)]
    nothing = F.array().cast("array<struct<field:string,value:string>>")
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields], (F.array_compact(F.array(*bad)) if bad else nothing).alias(MALFORMED))


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Header CSV, its columns bound by name and cast to the schema's types.

    Columns that the schema lacks are ignored; a column that the file lacks is absent
    from the result, so V1 fails on it.  A field that is not of its type is null.
    Empty fields are null; a single space is kept as text (D15), so the
    blank TotalCharges survives to the numeric coercion of P2.
    """
    return parse_raw_csv(spark, path, schema).drop(MALFORMED)


def malformed_fields(parsed: DataFrame) -> DataFrame:
    """S1's null fields that held text: (customerID, field, value), one row per such field of ``parse_raw_csv``'s rows."""
    return parsed.select("customerID", F.inline(MALFORMED))


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Overwrite the 'latest' raw copy."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# --- S3 / S4 / S5 / S6 ---------------------------------------------------------
def write_snapshot(df: DataFrame, base: str, run_ts: _dt.datetime, fmt: str = "parquet", commit: bool = True) -> str:
    """Write ``df`` once under ``base/snapshot=<key>``; returns the path.

    Readers see it once it is committed: at once, or by ``commit_snapshot`` after the caller's checks.
    """
    path = f"{base.rstrip('/')}/snapshot={snapshot_key(run_ts)}"
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").csv(path)
    else:
        w.format(fmt).save(path)
    if commit:
        commit_snapshot(df.sparkSession, base, run_ts)
    return path


def commit_snapshot(spark: SparkSession, base: str, run_ts: _dt.datetime) -> None:
    """Add a written snapshot to the manifest; the greatest key is the latest (a backfill stays behind)."""
    key = snapshot_key(run_ts)
    commits.commit(spark, base, lambda entry: {"snapshot": key, "latest": max(key, entry["latest"] if entry else "")})


def expire_snapshots(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Retention: delete all but the newest ``keep`` complete snapshots, and the manifest entries before the last ``keep``; returns the deleted keys."""
    keys = list_snapshots(spark, base)
    gone = keys[: max(0, len(keys) - max(1, keep))]
    root = base.rstrip("/")
    version, _ = commits.latest(spark, base)
    for path in [*(f"{root}/snapshot={k}" for k in gone), *(f"{root}/_log/{v:012d}.json" for v in commits._listed(spark, base) if v <= version - max(1, keep))]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return gone


def list_snapshots(spark: SparkSession, base: str) -> list[str]:
    """Keys of the complete snapshots (with ``_SUCCESS``) under ``base``, from directory listings only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    keys = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("snapshot=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            keys.append(name.split("=", 1)[1])
    return sorted(keys)


def latest_snapshot(spark: SparkSession, base: str) -> str | None:
    """Key of the newest snapshot by the manifest; folders are listed only without one, or if its snapshot is incomplete."""
    _, entry = commits.latest(spark, base)
    if entry and path_exists(spark, f"{base.rstrip('/')}/snapshot={entry['latest']}/_SUCCESS"):
        return entry["latest"]
    return max(list_snapshots(spark, base), default=None)


def read_latest(spark: SparkSession, base: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The newest snapshot; only its folder is listed and loaded, however many there are."""
    key = latest_snapshot(spark, base)
    if key is None:
        raise FileNotFoundError(f"no snapshot under {base}")
    reader = spark.read.format(fmt).option("basePath", base)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{base.rstrip('/')}/snapshot={key}").drop("snapshot")


# --- S7 / S8 / S10 -------------------------------------------------------------
def write_json_record(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One small document (a one-row or few-row frame) as JSON."""
    df.coalesce(1).write.mode(mode).json(path)


def feature_schema_record(features: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """S8 content: feature lists, id, target, record count and churn rate."""
    cols = F.struct(
        F.array(*[F.lit(c) for c in S.NUMERIC_FEATURES]).alias("numeric_features"),
        F.array(*[F.lit(c) for c in S.BINARY_FEATURES]).alias("binary_features"),
        F.lit(S.TARGET).alias("target"),
        F.lit(S.ID).alias("id"),
    )
    return features.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg(F.col(S.TARGET).cast("double")).alias("churn_rate"),
    ).select(
        cols.alias("feature_columns"), "total_records",
        ntz_lit(run_ts).alias("created_at"), "churn_rate",
    )


FEATURE_SCHEMA_DOC = T.StructType(
    [
        T.StructField("feature_columns", T.StructType([
            T.StructField("numeric_features", T.ArrayType(T.StringType())),
            T.StructField("binary_features", T.ArrayType(T.StringType())),
            T.StructField("target", T.StringType()),
            T.StructField("id", T.StringType()),
        ])),
        T.StructField("total_records", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("churn_rate", T.DoubleType()),
    ]
)


def read_feature_schema(spark: SparkSession, path: str) -> DataFrame:
    """S8 scan with an explicit schema."""
    return spark.read.schema(FEATURE_SCHEMA_DOC).json(path)


def append_run_record(df: DataFrame, path: str, run: str) -> None:
    """One record per execution date, partitioned by date, in a folder of the run (a retried run replaces its own)."""
    df.write.mode("overwrite").partitionBy("execution_date").json(f"{path.rstrip('/')}/run={run}")


def append_run(df: DataFrame, path: str, run: str) -> None:
    """A run's rows of a run table, in a folder of the run (a retried run replaces its own)."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


# --- S9 --------------------------------------------------------------------------
def list_objects(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """(path, length) of every file under ``prefix``; content is not read
    (only ``path`` and ``length`` are selected, so the scan prunes content)."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .load(prefix).select("path", "length")
    )


def listing_summary(listing: DataFrame) -> DataFrame:
    """Object count and total size."""
    return listing.agg(F.count(F.lit(1)).alias("objects"), F.sum("length").alias("total_bytes"))


# --- S14 -------------------------------------------------------------------------
def write_csv_artifact(df: DataFrame, path: str) -> None:
    """A small artifact table (importances, confusion matrix) as CSV with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# --- S15 -------------------------------------------------------------------------
def s3a_options(endpoint: str | None = None, access_key: str | None = None, secret_key: str | None = None,
                path_style: bool = True) -> dict[str, str]:
    """Spark settings for an S3-compatible object store.

    Credentials are never defaulted in code: without keys, the standard
    credential provider chain of the cluster applies.
    """
    opts = {"spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}
    if endpoint:
        opts["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        opts["spark.hadoop.fs.s3a.access.key"] = access_key
        opts["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return opts
