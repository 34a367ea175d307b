"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Every stage takes the documents its predecessor kept and returns a DataFrame that is
written before the next stage begins; all but the last return the columns of
``documents``.  A stage deletes what the stage before it wrote for itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm._common import new_folder, release, written
from churnlake.llm.decontaminate import contaminated
from churnlake.llm.line_dedup import dedup_lines
from churnlake.llm.minhash_dedup import near_duplicates
from churnlake.llm.packing import pack_documents
from churnlake.llm.queries import table, tokenizer_json
from churnlake.llm.toxicity import drop_toxic, fit_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_scratch: dict[str, list[str]] = {}


def _stage(f: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        release(spark, _scratch.pop(app, []))
        before = written(spark)
        out = f(spark, docs, sf_dir)
        _scratch[app] = [p for p in written(spark) if p not in before]
        return out

    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not call toxic (score below 0.5)."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    names = docs.columns
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*names)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies (five words, 0.8)."""
    gone = near_duplicates(docs, size=5, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified passage of a benchmark item."""
    gone = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_json())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

# Models, similarity joins and tokenisers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder and reread."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = new_folder(spark, f"stage-{name}")
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            release(spark, [last])
        last = path
    release(spark, _scratch.pop(spark.sparkContext.applicationId, []))
    return docs
