"""Costly rows are dealt over the cores by their number, however few bytes and files they have."""

import pytest
from pyspark.sql import functions as F

from churnlake import schemas as S
from churnlake.plans import models as mdl
from churnlake.session import spread, task_count

ROWS = 250_000


def features(spark, rows):
    k = F.col("id")
    cols = [(k * (j + 3) % 97).cast("double").alias(c) if c in S.NUMERIC_FEATURES else (k % (j + 2) == 0).cast("int").alias(c)
            for j, c in enumerate(S.ALL_FEATURES)]
    return spark.range(0, rows, 1, 1).select(k.cast("string").alias(S.ID), *cols, (k % 4 == 0).cast("int").alias(S.TARGET))


def test_task_count_goes_by_rows_and_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert task_count(spark, 0) == task_count(spark, 100_000) == 1
    assert task_count(spark, 100_001) == min(2, cores)
    assert task_count(spark, 400_000 * cores) == cores
    assert task_count(spark, 400_000 * cores + 1) == 2 * cores
    assert task_count(spark, 400_000, at_once=8) == min(4, -(-2 * cores // 8), cores)  # eight fits share the cores


def test_training_rows_of_one_file_are_dealt_over_the_cores(spark):
    if spark.sparkContext.defaultParallelism < 2:
        pytest.skip("one core")
    data = mdl.prepare(features(spark, ROWS))
    try:
        per = [n for n in data.train.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
        assert len(per) >= 2 and max(per) < 0.6 * sum(per)
        assert sum(per) == data.n_train == ROWS * 4 // 5 and data.test.count() == ROWS // 5
        assert data.train.select(S.ID).union(data.test.select(S.ID)).distinct().count() == ROWS
    finally:
        data.train.unpersist()


def test_rows_are_in_the_same_places_in_every_run(spark):
    df = features(spark, 2000).repartition(7).unionByName(features(spark, 300))  # with equal rows
    one, two = ([[tuple(r) for r in p] for p in spread(x, 3, S.ID).rdd.glom().collect()] for x in (df, df.repartition(5)))
    assert one == two and len(one) == 3 and sum(map(len, one)) == 2300
    assert spread(df, 1, S.ID) is df


def test_a_batch_of_one_row_group_is_scored_by_many_tasks(spark, tmp_dir):
    import os

    from churnlake import fixtures as fx
    from churnlake.operators import quality as qual
    from churnlake.operators import scoring as sco
    from churnlake.streaming import order_facts as of
    from churnlake.streaming import scoring as sscore

    if spark.sparkContext.defaultParallelism < 2:
        pytest.skip("one core")
    k = F.col("id")
    (spark.range(0, ROWS, 1, 1).select(k.alias("c_custkey"), F.concat(F.lit("c"), k).alias("c_name"), (k % 25).cast("int").alias("c_nationkey"),
                                       (k % 9000).cast("double").alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"))
     .write.parquet(f"{tmp_dir}/w"))
    spark.range(0, ROWS, 1, 1).select(k.alias("o_custkey"), F.lit(1.5).alias("o_totalprice"), F.lit("2000-01-01").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{tmp_dir}/o")
    os.makedirs(f"{tmp_dir}/in")
    for a, b in (("w", "customer"), ("o", "orders")):
        part = next(x for x in os.listdir(f"{tmp_dir}/{a}") if x.endswith(".parquet") and not x.startswith("."))
        with open(f"{tmp_dir}/{a}/{part}", "rb") as f, open(f"{tmp_dir}/in/{b}.parquet", "wb") as g:
            g.write(f.read())
    of.start_facts(spark, f"{tmp_dir}/in", f"{tmp_dir}/facts", f"{tmp_dir}/cp1").awaitTermination()
    sscore.start_request_features(spark, f"{tmp_dir}/in", of.facts_store(spark, f"{tmp_dir}/facts"), f"{tmp_dir}/out", f"{tmp_dir}/cp2").awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    files = out.groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 2 and max(r["count"] for r in files) < 0.6 * out.count()
    valid, _ = qual.split_valid(fx.requests(spark, f"{tmp_dir}/in"))
    assert out.drop("batch_id").exceptAll(sco.request_features(valid)).count() == 0 and out.count() == valid.count()


def test_fits_that_run_at_once_are_bounded_by_what_they_cache():
    assert mdl.fits_at_once(8, 15, 10_000) == 8 and mdl.fits_at_once(8, 3, 0) == 3 and mdl.fits_at_once(1, 15, 10) == 1
    rows = 3_456_000
    assert 1 <= mdl.fits_at_once(8, 15, rows) <= mdl.HELD_BYTES // (rows * mdl.FIT_ROW_BYTES)
    assert mdl.fits_at_once(8, 15, 10**9) == 1
