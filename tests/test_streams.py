"""Streams that other jobs read while they grow: order facts, event-time windows, the batch store."""

import datetime as dt
import os

from pyspark.sql import functions as F

from churnlake import fixtures as fx
from churnlake import schemas as S
from churnlake.operators import abtest as ab
from churnlake.streaming import ab_windows as win
from churnlake.streaming import order_facts as of
from churnlake.streaming import scoring as sscore
from churnlake.streaming.store import BatchStore
from conftest import SF_SMALL


def _put(df, path):
    """One Parquet file, visible at once."""
    df.toPandas().to_parquet(path + ".tmp", coerce_timestamps="us", index=False)
    os.rename(path + ".tmp", path)


def test_store_merges_compacts_and_ignores_half_written_batches(spark, tmp_dir):
    store = BatchStore(spark, f"{tmp_dir}/s", "k int, n long", lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), compact_every=3)
    assert store.version() == -1 and store.read().count() == 0
    for i in range(8):
        store.write(spark.createDataFrame([(i % 2, 1), (7, 10)], "k int, n long"), i)
        store.write(spark.createDataFrame([(i % 2, 1), (7, 10)], "k int, n long"), i)  # a replay
        assert store.version() == i
        assert {r.k: r.n for r in store.read().collect()} == {7: 10 * (i + 1)} | {j: (i + 2 - j) // 2 for j in (0, 1) if i >= j}
    kept = {n for n in os.listdir(f"{tmp_dir}/s") if "=" in n}
    assert kept == {"base=2", "base=5", "delta=3", "delta=4", "delta=5", "delta=6", "delta=7"}
    os.remove(f"{tmp_dir}/s/delta=7/_SUCCESS")
    assert store.version() == 6 and {r.k: r.n for r in store.read().collect()}[7] == 70


def _facts_run(spark, folder, store_path, **more):
    of.start_facts(spark, folder, store_path, f"{store_path}-cp", glob="orders*.parquet", **more).awaitTermination()


def test_facts_of_any_batches_are_those_of_the_batch_job(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    os.mkdir(f"{tmp_dir}/in")
    for k in range(5):
        _put(orders.where(F.col("o_orderkey") % 5 == k), f"{tmp_dir}/in/orders{k}.parquet")
    _facts_run(spark, f"{tmp_dir}/in", f"{tmp_dir}/facts", max_files_per_trigger=1, compact_every=2)
    want = fx.order_facts(spark, SF_SMALL).select("o_custkey", "n_orders", F.col("spend").cast("decimal(28,2)"), "last_order")
    store = of.facts_store(spark, f"{tmp_dir}/facts", 2)
    assert store.version() == 4 and sorted(store.read().collect()) == sorted(want.collect())


def test_a_later_order_changes_the_next_batch(spark, tmp_dir):
    from churnlake.plans import trained

    folder = f"{tmp_dir}/in"
    os.mkdir(folder)
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet").where("c_custkey < 40")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    early = orders.where("o_orderkey % 2 = 0")
    _put(customers, f"{folder}/customer1.parquet")
    _put(early, f"{folder}/orders1.parquet")
    store = of.facts_store(spark, f"{tmp_dir}/facts")
    models = trained.registry_models(spark, SF_SMALL, ["logistic_regression"])
    cfg = ab.ABConfig(S.MODEL_PREFIX + "logistic_regression", S.MODEL_PREFIX + "logistic_regression")
    info = spark.createDataFrame([(S.MODEL_PREFIX + "logistic_regression", "7", "run-1", "Production")], S.MODEL_VERSION_SCHEMA)

    def run():
        _facts_run(spark, folder, f"{tmp_dir}/facts")
        sscore.start_request_features(spark, folder, store, f"{tmp_dir}/features", f"{tmp_dir}/features-cp", glob="customer*.parquet").awaitTermination()
        sscore.start_scoring(spark, folder, models, cfg, f"{tmp_dir}/scores", f"{tmp_dir}/scores-cp", facts=store, model_info=info,
                             glob="customer*.parquet").awaitTermination()

    run()
    _put(customers, f"{folder}/customer2.parquet")  # the same customers ask again, after more orders
    _put(orders.where("o_orderkey % 2 = 1"), f"{folder}/orders2.parquet")
    run()
    features, scores = spark.read.parquet(f"{tmp_dir}/features"), spark.read.parquet(f"{tmp_dir}/scores")
    totals = {b: {r.customer_id: r.total_charges for r in features.where(F.col("batch_id") == b).collect()} for b in (0, 1)}
    said = {b: {r.customer_id: r.churn_probability for r in scores.where(F.col("batch_id") == b).collect()} for b in (0, 1)}
    from churnlake.operators import quality as qual
    from churnlake.operators import scoring as sco

    for b, seen in ((0, early), (1, orders)):
        batch = fx.requests(spark, SF_SMALL, customers=customers, facts=fx.order_facts(spark, SF_SMALL, orders=seen))
        want = {r.customer_id: r.total_charges for r in sco.request_features(qual.split_valid(batch)[0]).collect()}
        assert totals[b] == want and said[b].keys() == want.keys() and want
    assert any(said[0][c] != said[1][c] for c in said[0].keys() & said[1].keys())
    assert {r.model_version for r in scores.collect()} == {"7"} and scores.where("timestamp is null").count() == 0


def test_windows_count_on_time_rows_and_keep_late_ones(spark, tmp_dir):
    folder, out, day = f"{tmp_dir}/in", f"{tmp_dir}/out", dt.datetime(2024, 5, 1)

    def rows(first, *times):
        data = [(first + i, day + dt.timedelta(hours=h), 11 + i % 4, "click", float(i)) for i, h in enumerate(times)]
        return spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")

    os.mkdir(folder)
    removed, seen = 0, []
    parts = [rows(0, 10.1, 10.5, 11.2, 12.0), rows(10, 12.9, 15.0, 13.1), rows(20, 10.5, 14.75, 15.2, 12.95), rows(30, 16.0, 9.0)]
    for k, part in enumerate(parts):
        _put(part, f"{folder}/events{k}.parquet")
        win.start_intake(spark, folder, out, f"{tmp_dir}/cp1", glob="events*.parquet").awaitTermination()
        q = win.start_windows(spark, out, f"{tmp_dir}/cp2")
        q.awaitTermination()
        removed += sum(s["numRowsRemoved"] for p in q.recentProgress for s in p["stateOperators"])
        seen += part.collect()
    late = {r.request_id for r in win.read_late(spark, out).collect()}
    assert late == {20, 23, 31}  # 10.5 and 12.95 after a row of 15.0, and 9.0
    want = {}
    for r in seen:
        if r.event_id not in late:
            key = r.ts.replace(minute=0, second=0, microsecond=0)
            want.setdefault(key, []).append(r.value)
    got = {}
    for r in win.read_windows(spark, out).collect():
        n, total = got.get(r.window_start, (0, 0.0))
        got[r.window_start] = (n + r.requests, total + r.avg_latency_ms * r.requests)
    assert got == {k: (len(v), sum(v)) for k, v in want.items()}
    assert removed > 0  # closed windows left the state


def test_intake_replays_write_the_same_rows(spark, tmp_dir):
    folder, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.mkdir(folder)
    _put(spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(50), f"{folder}/events.parquet")
    for cp in ("a", "b"):  # a lost checkpoint: batch 0 comes again
        win.start_intake(spark, folder, out, f"{tmp_dir}/{cp}").awaitTermination()
    kept = spark.read.schema(S.PREDICTION_LOG_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out}/ontime")
    assert kept.count() == fx.prediction_log(spark, folder).where("endpoint = 'predict'").count()
