"""Commits on a base version, the snapshot manifest, appends by run, and K1 in one pass."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.operators import quality as qual
from churnlake.plans import jobs
from churnlake.sources import commits, files
from conftest import SF_SMALL

DAY = dt.datetime(2024, 6, 1)


def test_one_of_many_writers_gets_a_version(spark, tmp_dir):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: commits.try_commit(spark, tmp_dir, 1, {"writer": i}), range(16)))
    assert sum(won) == 1
    assert commits.latest(spark, tmp_dir) == (1, {"writer": won.index(True)})
    assert not any(n.startswith("_tmp") for n in os.listdir(f"{tmp_dir}/_log"))


def test_rename_of_other_file_systems_refuses_an_existing_target(spark, tmp_dir):
    for name in ("a", "b"):
        commits._write_text(spark, f"{tmp_dir}/{name}", name)
    assert commits._rename_if_absent(spark, f"{tmp_dir}/a", f"{tmp_dir}/c")
    assert not commits._rename_if_absent(spark, f"{tmp_dir}/b", f"{tmp_dir}/c")
    assert commits.read_text(spark, f"{tmp_dir}/c") == "a"


def test_hint_may_lag_or_be_lost(spark, tmp_dir):
    for v in range(1, 8):
        assert commits.try_commit(spark, tmp_dir, v, {"v": v})
    for hint in ("3", "", None):
        os.remove(f"{tmp_dir}/_log/_hint")
        if hint is not None:
            commits._write_text(spark, f"{tmp_dir}/_log/_hint", hint)
        assert commits.latest(spark, tmp_dir) == (7, {"v": 7})
        commits._write_text(spark, f"{tmp_dir}/_log/_hint", "7")


def test_concurrent_promotions_are_both_kept(spark, tmp_dir):
    names = [S.MODEL_PREFIX + k for k in S.MODEL_KEYS]

    def promote(i):
        commits.update_table(spark, tmp_dir, f"run{i}", lambda current: jobs._promoted(spark, current, names[:2], f"2024{i}", names[i % 2]))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(promote, range(4)))
    promote(2)  # a retried run
    rows = commits.read_table(spark, tmp_dir).collect()
    assert sorted((r.name, int(r.version)) for r in rows) == sorted((n, v) for n in names[:2] for v in range(1, 5))
    assert len({r.run_id for r in rows}) == 8
    assert sorted(r.name for r in rows if r.stage == "Production") == sorted(names[:2])
    assert sum(r.stage == "Archived" for r in rows) == 2
    states = glob.glob(f"{tmp_dir}/state-*")
    assert len(states) == 4  # what lost a race is deleted


def test_lost_races_end(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(commits, "try_commit", lambda *a: False)
    with pytest.raises(commits.CommitConflict):
        commits.update_table(spark, tmp_dir, "r", lambda c: spark.range(1), attempts=2)
    assert not glob.glob(f"{tmp_dir}/state-*")


def test_latest_snapshot_is_found_without_listing(spark, tmp_dir, monkeypatch):
    for k in range(1000):
        os.makedirs(f"{tmp_dir}/snapshot={files.snapshot_key(DAY + dt.timedelta(minutes=k))}")
        open(f"{tmp_dir}/snapshot={files.snapshot_key(DAY + dt.timedelta(minutes=k))}/_SUCCESS", "w").close()
        if k % 100 == 0:
            files.commit_snapshot(spark, tmp_dir, DAY + dt.timedelta(minutes=k))
    files.write_snapshot(spark.range(3), tmp_dir, DAY + dt.timedelta(days=2))
    files.write_snapshot(spark.range(5), tmp_dir, DAY - dt.timedelta(days=2))  # a backfill is not the latest

    def no_listing(*_):
        raise AssertionError("listed")

    real = files.list_snapshots
    monkeypatch.setattr(files, "list_snapshots", no_listing)
    monkeypatch.setattr(commits, "_listed", no_listing)
    assert files.read_latest(spark, tmp_dir).count() == 3
    monkeypatch.undo()
    gone = files.expire_snapshots(spark, tmp_dir, keep=2)
    assert len(gone) == 1000 and len(real(spark, tmp_dir)) == 2
    assert files.read_latest(spark, tmp_dir).count() == 3 and len(commits._listed(spark, tmp_dir)) == 2


def test_uncommitted_snapshots_are_not_read(spark, tmp_dir):
    files.write_snapshot(spark.range(3), tmp_dir, DAY)
    files.write_snapshot(spark.range(4), tmp_dir, DAY + dt.timedelta(days=1), commit=False)
    assert files.read_latest(spark, tmp_dir).count() == 3


def test_appends_of_a_retried_run_replace_its_rows(spark, tmp_dir):
    for run, n in (("a", 2), ("b", 3), ("b", 4)):
        files.append_run(spark.range(n).select(F.lit("k").alias("key")), f"{tmp_dir}/runs", run)
    assert {r.run: r["count"] for r in spark.read.parquet(f"{tmp_dir}/runs").groupBy("run").count().collect()} == {"a": 2, "b": 4}


def test_small_data_leaves_no_snapshot(spark, tmp_dir):
    csv = f"{tmp_dir}/in"
    files.write_raw_csv(fx.raw_customers(spark, SF_SMALL).limit(20), csv)
    with pytest.raises(qual.ValidationError, match="too small"):
        jobs.ingest(spark, csv, f"{tmp_dir}/lake", DAY, min_rows=21)
    with pytest.raises(FileNotFoundError):
        files.read_latest(spark, f"{tmp_dir}/lake/raw")
    assert jobs.ingest(spark, csv, f"{tmp_dir}/lake", DAY, min_rows=20)["rows"] == 20


_ONE_PASS = """
import sys, datetime as dt
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from churnlake.session import DEFAULT_CONF, shared_dir
b = SparkSession.builder.master("local[2]").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[3])
b = b.config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
for k, v in DEFAULT_CONF.items():
    b = b.config(k, v)
spark = b.getOrCreate()
shared_dir(spark)
from churnlake.plans import jobs
out = jobs.ingest(spark, sys.argv[2], sys.argv[3] + "/lake", dt.datetime(2024, 6, 1), min_rows=3, url="https://example.org/raw.csv")
import json
meta = spark.read.json(sys.argv[3] + "/lake/raw_meta").first().asDict()
print("OUT" + json.dumps([out, meta], default=str))
spark.stop()
"""


def test_ingest_scans_the_csv_once(tmp_dir):
    csv, log = f"{tmp_dir}/in.csv", f"{tmp_dir}/log"
    os.mkdir(log)
    rows = [",".join(S.RAW_COLUMNS)]
    for i in range(5):
        churn = ["Yes", "No", "", "No", "No"][i]
        rows.append(",".join([f"c{i}", "x" if i == 1 else "0", *["Yes"] * 2, "5", *["No"] * 12, "20.5", " ", churn]))
    with open(csv, "w") as f:
        f.write("\n".join(rows) + "\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", _ONE_PASS, repo, csv, log], capture_output=True, text=True, timeout=240)
    assert "OUT" in run.stdout, run.stderr[-2000:]
    out, meta = json.loads(run.stdout.split("OUT")[1])
    assert out["rows"] == 5 and out["columns"] == 20 and out["malformed"] == 1 and out["label_distribution"] == {"No": 3, "Yes": 1}
    assert meta["rows"] == 5 and meta["churn_rate"] == 0.2 and meta["column_names"] == S.RAW_COLUMNS
    assert meta["source_url"] == "https://example.org/raw.csv" and str(meta["ingestion_timestamp"]).startswith("2024-06-01")
    scans = set()
    for path in glob.glob(f"{log}/local-*"):
        for line in open(path):
            e = json.loads(line)
            if e["Event"].endswith("SparkListenerSQLExecutionStart") and "FileScan csv" in e["physicalPlanDescription"] + json.dumps(e["sparkPlanInfo"]):
                scans.add(e["executionId"])
            elif "sparkPlanInfo" in e and "Scan csv" in json.dumps(e["sparkPlanInfo"]):
                scans.add(e["executionId"])
    assert len(scans) == 1
