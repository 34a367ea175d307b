"""Data-quality checks (V1-V7) and dataset summaries (A1-A3, S7 content)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schemas as S


class ValidationError(ValueError):
    """A check failed; the job must stop before writing anything."""


def require_columns(df: DataFrame, required: Sequence[str] = S.REQUIRED_RAW_COLUMNS) -> None:
    """V1: schema-only check, runs no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(f"missing required columns: {missing}")


def has_min_rows(df: DataFrame, min_rows: int = S.MIN_ROWS) -> bool:
    """V2 predicate: ``limit`` lets Spark stop scanning once ``min_rows`` are seen."""
    return df.limit(min_rows).count() >= min_rows


def require_min_rows(df: DataFrame, min_rows: int = S.MIN_ROWS) -> None:
    """V2: fail on fewer than ``min_rows`` rows."""
    if not has_min_rows(df, min_rows):
        raise ValidationError(f"dataset too small: fewer than {min_rows} records")


def null_profile(df: DataFrame, threshold: float = S.HIGH_NULL_SHARE) -> DataFrame:
    """V3: share of nulls per column, with the ``> threshold`` flag.

    One aggregate over all columns (a single scan with map-side partial
    sums), then an unpivot of the one-row result.
    """
    cols = df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "null_share")
    return long.withColumn("high_null", F.col("null_share") > F.lit(threshold))


def label_distribution(df: DataFrame, label: str = "Churn") -> DataFrame:
    """A2: value counts of the label, nulls dropped, most frequent first."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(label))
    )


def churn_rate_expr(label: str = "Churn") -> Column:
    """A3 over the raw table: share of ``label == 'Yes'`` (null counts as No)."""
    return F.avg(F.col(label).eqNullSafe("Yes").cast("double"))


def summary_document(rows: Column, churn_rate: Column, columns: Sequence[str], label: str = "Churn", source: str = "") -> list[Column]:
    """S7's fields, from counts that are known or aggregated."""
    return [
        rows.alias("rows"),
        F.lit(len(columns)).alias("columns"),
        F.array(*[F.lit(c) for c in columns]).alias("column_names"),
        F.lit(label).alias("target"),
        churn_rate.alias("churn_rate"),
        F.lit(source).alias("source"),
    ]


def dataset_summary(df: DataFrame, label: str = "Churn", source: str = "") -> DataFrame:
    """A1 + A3 + S7 content: one row of counts, names, target, rate."""
    return df.agg(*summary_document(F.count(F.lit(1)), churn_rate_expr(label), df.columns, label, source))


def ingest_metrics(columns: Sequence[str], label: str = "Churn") -> list[Column]:
    """A1, A3, V2 and V3's counts as aggregates that a write can observe: no pass of their own."""
    return [
        F.count(F.lit(1)).alias("rows"), churn_rate_expr(label).alias("churn_rate"),
        *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in columns],
    ]


def request_reasons(df: DataFrame) -> Column:
    """V4: array of rejection reasons, in field order; empty when valid."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in S.REQUEST_REQUIRED]
    nan = {c: F.isnan(F.col(c).cast("double")) for c in S.REQUEST_NON_NEGATIVE}
    checks += [F.when(nan[c], F.lit(f"not_a_number:{c}")).when(F.col(c) < 0, F.lit(f"negative:{c}")) for c in S.REQUEST_NON_NEGATIVE]
    return F.array_compact(F.array(*checks))


def validate_requests(df: DataFrame) -> DataFrame:
    """V4: every request with ``is_valid`` and its ``reasons``."""
    return df.withColumn("reasons", request_reasons(df)).withColumn("is_valid", F.size("reasons") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V4: (valid rows, rejected rows with reasons) from one definition."""
    checked = validate_requests(df)
    return checked.filter("is_valid").drop("reasons", "is_valid"), checked.filter("NOT is_valid")


def promotion_gate(metrics: DataFrame, threshold: float = S.PROMOTION_ACCURACY, strict: bool = False) -> DataFrame:
    """V6: PROMOTE when accuracy >= threshold (``strict``: the older ``>``)."""
    acc = F.col("accuracy")
    ok = acc > F.lit(threshold) if strict else acc >= F.lit(threshold)
    return metrics.withColumn("decision", F.when(ok, "PROMOTE").otherwise("REJECT"))


def verify_written(written: DataFrame, expected_rows: int) -> None:
    """V7: re-read a written snapshot and compare its count with the record."""
    got = written.count()
    if got != expected_rows:
        raise ValidationError(f"post-write check failed: {got} rows read, {expected_rows} recorded")
