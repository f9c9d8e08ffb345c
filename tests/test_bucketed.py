"""Bucketed target: the upsert's plan and results, over several versions."""

import re

import pytest
from pyspark.sql import functions as F

from tidesync.plans.commit import CommitConflict
from tidesync.sources.bucketed import BucketedTarget


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"), F.lit(v * 10).alias("kept"))


def exchanges_over(plan: str, scan: str) -> int:
    """Shuffles on the way from the scan whose line holds ``scan`` up to the root of a printed plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, found = re.search(r"\w", lines[at]).start(), 0
    for line in reversed(lines[:at]):
        here = re.search(r"\w", line)
        if here and here.start() < depth:
            depth = here.start()
            found += "Exchange" in line
    return found


def test_target_is_not_shuffled(spark, scratch, no_broadcast):
    t = BucketedTarget(spark, scratch("bucketed"), ["k"], 6)
    t.upsert(rows(spark, 0, 5000, 1))
    changes = rows(spark, 4000, 6000, 2).unionByName(rows(spark, 5500, 6000, 3))
    out = t.upserted(changes, order=["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 1 and exchanges_over(plan, "Bucketed: true") == 0
    assert plan.count("Exchange hashpartitioning") <= 2       # the changes, once for each side of the union
    t.upsert(changes, order=["v"])
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert got == {k: 1 if k < 4000 else 2 if k < 5500 else 3 for k in range(6000)}
    again = t.read().groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in again                            # what was written lies in buckets too


def test_versions_keep_columns_and_refuse_a_lost_race(spark, scratch):
    root = scratch("versions")
    t = BucketedTarget(spark, root, ["k"], 4)
    t.upsert(rows(spark, 0, 10, 1), watermark={"last_id": 9})
    t.upsert(rows(spark, 5, 15, 2), keep=["kept"])
    same = BucketedTarget(spark, root)
    assert (same.keys, same.buckets, same.state()["watermark"]) == (["k"], 4, {"last_id": 9})
    got = {r["k"]: (r["v"], r["kept"]) for r in same.read().collect()}
    assert got == {k: (1, 10) if k < 5 else (2, 10) if k < 10 else (2, 20) for k in range(15)}
    with pytest.raises(CommitConflict):
        t.load(t.read(), expected_version=1)
    t.upsert(rows(spark, 0, 1, 3).withColumn("added", F.lit("x")))
    assert {r["k"]: r["added"] for r in same.read().collect()} == {k: "x" if k == 0 else None for k in range(15)}
    with pytest.raises(ValueError):
        BucketedTarget(spark, scratch("none"))
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("bucketed_")]
