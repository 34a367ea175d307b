"""Physical-plan properties the scale design relies on."""

import re

import pytest

from churnlake.plans import catalog
from conftest import SF_SMALL

MODEL_QUERIES = {"train_lr", "train_rf", "train_gbt", "cross_validate", "model_importance", "score_batch",
                 "score_explain", "stream_score", "stream_ab_stats", "stream_ab_windows", "stream_request_features",
                 "lr_gradient", "score_check"}


def _plan(spark, name):
    return catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_used_columns(spark):
    plan = _plan(spark, "feature_table")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    cols = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert cols == {"c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                    "o_custkey", "o_totalprice", "o_orderdate"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - MODEL_QUERIES))
def test_no_python_udf(spark, name):
    plan = _plan(spark, name)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_model_lookup_never_shuffles_rows_on_model_name(spark):
    plan = _plan(spark, "model_lookup")
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"Exchange hashpartitioning\(model_name", plan)


@pytest.mark.parametrize(("name", "scans"), [("latest_version", 1), ("serving_version", 1)])
def test_registry_queries_scan_once(spark, name, scans):
    assert _plan(spark, name).count("FileScan parquet") == scans


def test_auc_has_no_single_partition_step(spark):
    assert "Exchange SinglePartition" not in _plan(spark, "roc_auc")
