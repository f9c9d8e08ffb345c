"""Skew: one key, shard or unit holding a large share of all rows."""

import glob

from pyspark.sql import functions as F

from tidesync.operators import load as L
from tidesync.operators import profile as P
from tidesync.plans.commit import TableStore


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dominant_unit_is_written_by_many_tasks(spark, scratch):
    # nearly every row in shard 1 (as with 1e9 ids per shard): the rebalance splits it
    root = scratch("dominant")
    st = TableStore(spark, root)
    df = spark.range(0, 200_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"),
                                        F.when(F.col("id") < 1000, F.lit(2)).otherwise(F.lit(1)).cast("long")
                                        .alias("partition_num"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        st.commit(df, cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    local = root[len("file:"):] if root.startswith("file:") else root
    big = glob.glob(f"{local}/ver=1-*/partition_num=1/bucket=0/*.parquet")
    small = glob.glob(f"{local}/ver=1-*/partition_num=2/bucket=0/*.parquet")
    assert len(big) > 1 and len(small) == 1
    assert st.read().count() == 200_000


def test_hot_key_dedupe_and_profile_aggregate_partially(spark):
    # a third of the changes on one key collapse map-side before the shuffle
    n = 30_000
    ch = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("seq"))
    latest = L.latest_per_key(ch, ["k"], ["seq"], unique_order=True)
    plan = _plan(latest)
    assert "partial_max_by" in plan
    got = {r["k"]: r["seq"] for r in latest.collect()}
    # id 7 itself also maps to key 7, so the hot key adds no key of its own
    assert got[7] == max(i for i in range(n) if i % 3 == 0) and len(got) == n - n // 3
    prof = P.shard_profile(ch.withColumn("partition_num", F.lit(1)), "k")
    assert "partial_min" in _plan(prof) or "partial_count" in _plan(prof)
