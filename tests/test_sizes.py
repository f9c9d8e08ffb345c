"""What a list, a log or a unit takes of the driver and of one task."""

from pyspark.sql import functions as F

from tidesync.operators import retention as R
from tidesync.plans.commit import TableStore


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_lists_of_unknown_or_large_size_are_not_broadcast(spark):
    source = spark.range(0, 500).select(F.col("id").alias("k"))
    entries = source.groupBy(F.call_function("div", "k", F.lit(10)).alias("house_keeping_id")).agg(
        F.collect_list(F.col("k").cast("string")).alias("ids")).withColumns(
        {"source_db": F.lit("a"), "source_table": F.lit("b"), "load_version": F.lit(1)}).filter("house_keeping_id < 20")
    few = R.retention_delete(source, entries, "k", ids_rows=200)
    assert few.count() == 300 and "BroadcastHashJoin" in _plan(few)
    for rows in (None, 9_000_000):
        kept = R.retention_delete(source, entries, "k", ids_rows=rows)
        assert kept.count() == 300 and "BroadcastExchange" not in _plan(kept)


def test_a_small_write_does_not_draw_the_steps_before_into_its_task(spark, scratch):
    st = TableStore(spark, scratch("small"))
    st.commit(spark.range(0, 1000, 1, 8).withColumn("task", F.spark_partition_id()), small=True)
    assert st.read().select("task").distinct().count() == 8 and len(st.read().inputFiles()) == 1


def test_a_unit_is_dealt_to_tasks_of_bounded_size(spark, scratch, monkeypatch):
    from tidesync.plans import commit
    monkeypatch.setattr(commit, "LARGEST_TASK", 1 << 18)
    before = spark.conf.get(commit.ADVISORY)
    st = TableStore(spark, scratch("bounded"))
    st.commit(spark.range(0, 300_000, 1, 16).withColumn("v", F.sha2(F.col("id").cast("string"), 256)), cluster_by=["id"])
    assert len(st.units()) == 1 and len(st.read().inputFiles()) > 4 and st.read().count() == 300_000
    assert spark.conf.get(commit.ADVISORY) == before


def test_folders_are_listed_by_few_tasks(spark, scratch):
    st = TableStore(spark, scratch("folders"))
    st.commit(spark.range(0, 300).withColumn("partition_num", F.col("id")))
    sc = spark.sparkContext
    sc.setJobGroup("listing", "")
    try:
        assert st.read().count() == 300
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert max(s.numTasks for s in stages if s) < 100
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
