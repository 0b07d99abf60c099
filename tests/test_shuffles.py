"""What queries shuffle once, and what they leave of it on disk."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from spanfan.llm.common import shared_buckets, stored
from spanfan.plans import workloads
from spanfan.plans.increment import rebuild_changed
from spanfan.session import SHUFFLE_CLEANUP


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def orders(spark, tmp_path) -> str:
    """Two copies of each of 60 orders, of ten customers and one without a key."""
    day = dt.datetime(1997, 1, 5)
    rows = [(i, None if i == 59 else i % 10, "OFP"[i % 3], 10.5 * i, day + dt.timedelta(days=i), f"{i % 2}-P") for i in range(60)]
    df = spark.createDataFrame(rows * 2, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    df.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_a_commit_is_made_once_for_keys_and_rows(spark, tmp_path):
    sf = orders(spark, tmp_path)
    log, keys = workloads._changed(spark, sf)
    assert plan_of(log).count("Aggregate") == plan_of(keys).count("Aggregate") == 0  # both versions are not compared again
    want = workloads.orders_log(spark, sf)
    assert log.dtypes == want.dtypes and log.exceptAll(want).count() == want.exceptAll(log).count() == 0
    assert {r[0] for r in log.select("_change_type").distinct().collect()} >= {"insert", "update_preimage", "update_postimage"}
    found = workloads.changed_keys(want, start_version=2)
    assert sorted(keys.collect()) == sorted(found.collect()) and keys.count() > 0
    curve = workloads.stored_curve(spark, sf)
    got, direct = workloads.q_rebuild_changed(spark, sf), rebuild_changed(workloads.as_of(want, 2, found), curve, found, as_of=workloads.AS_OF)
    assert got.count() == direct.count() > 0 and got.exceptAll(direct).count() == 0
    gone = workloads.q_retracted_rows(spark, sf)
    assert gone.count() > 0 and gone.join(direct, ["point_of_delivery_ean", "profile_category_code", "supply_start_date_time_utc"]).count() == 0


def test_a_stored_table_leaves_nothing_shuffled(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    sf = orders(spark, tmp_path)
    for write in (lambda: stored(df.groupBy("k").count(), "kept"), lambda: workloads._changed(spark, sf)):
        spark._jvm.System.gc()  # what earlier tests left may go now
        time.sleep(1)
        before, set_before = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
        write()
        for _ in range(50):
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.1)
        assert shuffle_files(spark) <= before
        assert spark.conf.get(SHUFFLE_CLEANUP, None) == set_before
    assert stored(df.groupBy("k").count(), "kept").count() == 7


def test_rows_dealt_by_bucket_are_shuffled_once(spark):
    rows = spark.range(20_000).select((F.col("id") % 900).alias("node"), (F.col("id") * 7 % 5000).alias("bucket"))
    rows = rows.unionByName(spark.createDataFrame([(1, -1), (2, -2), (3, -2), (3, -2)], "node long, bucket long"))
    both = rows.distinct().groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    many = shared_buckets(rows)
    assert {tuple(r) for r in many.collect()} == {tuple(r) for r in rows.join(both, "bucket").select("bucket", "node").collect()}
    assert "ReusedExchange" in many._jdf.queryExecution().executedPlan().toString()
