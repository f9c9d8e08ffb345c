"""What a load must not lose: misfits, NULL keys and late rejects in every path; reads that an index saves."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.operators import extract as X
from tidesync.operators.schema_ops import align, reject_reason
from tidesync.plans.commit import TableStore
from tidesync.plans.run import _commit_rejects, house_keeping, run_procedure_task, run_task
from tidesync.schema import SyncTask
from tidesync.streaming.stream import rejected_rows, sync_batch


def task(etl_type=1, **more):
    base = dict(source_table_id=1, source_db="s", source_table="t", target_db="d", target_table="t", etl_type=etl_type,
                sync_field="id, v", pk_field="id", id_field_name="id", timestamp_field_name=None, batch_size=100,
                max_loop_count=100, partition_size=1000)
    return SyncTask(**{**base, **more})


def sp_task(etl_type=1, **more):
    return {"source_table_id": 1, "source_db": "s", "source_table": "t", "source_sp": "p", "etl_type": etl_type, "arg_counts": 2,
            "target_db": "d", "target_table": "t", "pk_field": "id", "sync_field": "id, v", "max_loop_count": 10, "batch_size": 100,
            "id_field_name_1": "id", "last_id_sync_record_1": 0, "id_field_name_2": None, "last_id_sync_record_2": None,
            "timestamp_field_name": None, "last_timestamp_sync_record": None, **more}


def test_align_fails_on_a_lossy_cast(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    schema = T.StructType([T.StructField("v", T.LongType())])
    with pytest.raises(PySparkException, match="does not fit"):
        align(df, schema).collect()
    assert align(df.filter("v = '1'"), schema).first()["v"] == 1
    assert [r[0] for r in df.select(reject_reason(df, [], schema)).collect()] == [None, "v"]


def test_reason_names_the_first_null_key(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(reject_reason(df, ["a", "b"])).collect()] == ["a", "b", None]


@pytest.mark.parametrize("path", ["task", "procedure", "stream", "procedure_full"])
def test_retyped_column_and_null_keys(spark, scratch, path):
    store, bad = TableStore(spark, scratch("data")), TableStore(spark, scratch("bad"))
    first = spark.createDataFrame([(1, 10), (2, 20)], "id long, v long")
    second = spark.createDataFrame([(3, "30"), (4, "abc"), (None, "50"), (None, "50")], "id long, v string")

    def load(df, epoch):
        if path == "task":
            return run_task(spark, task(), df, store, reject_store=bad, audit_col=None).rejected
        if path.startswith("procedure"):
            return run_procedure_task(spark, sp_task(4 if path.endswith("full") else 1), df, store, reject_store=bad).rejected
        before = rejected_rows(store)
        sync_batch(df, epoch, store, ["id"], "id", 1000, reject_store=bad, query_id="q")
        return rejected_rows(store) - before

    assert load(first, 0) == 0
    for epoch in (1, 2):                       # the second time the reject table already has them
        assert load(second, epoch) >= 2
        assert sorted((r["id"], r["v"]) for r in store.read().select("id", "v").collect()) == [(1, 10), (2, 20), (3, 30)]
        found = sorted((r["id"] or "", r["v"]) for r in bad.read().select("id", "v").collect())
        assert found == [("", "50"), ("", "50"), ("4", "abc")]
    assert all("None" not in u for u in store.units())


def test_counts_without_a_reject_table(spark, scratch):
    store = TableStore(spark, scratch("data"))
    run_task(spark, task(), spark.createDataFrame([(1, 10)], "id long, v long"), store, audit_col=None)
    res = run_task(spark, task(), spark.createDataFrame([(2, "x"), (3, "5")], "id long, v string"), store, audit_col=None)
    assert (res.rows, res.rejected) == (1, 1)
    stream = TableStore(spark, scratch("stream"))
    sync_batch(spark.createDataFrame([(1, 1), (None, 2)], "id long, v long"), 0, stream, ["id"], "id", 1000)
    assert rejected_rows(stream) == 1


def test_capped_run_passes_a_batch_of_misfits(spark, scratch):
    """A batch whose rows are all rejected moves the watermark, so the run after it reads on."""
    store = TableStore(spark, scratch("data"))
    run_task(spark, task(), spark.createDataFrame([(1, 10)], "id long, v long"), store, audit_col=None)
    rows = spark.createDataFrame([(i, "bad" if i < 6 else str(i)) for i in range(2, 9)], "id long, v string")
    small = lambda: task(batch_size=2, max_loop_count=2)
    assert [run_task(spark, small(), rows, store, audit_col=None).rows for _ in range(3)] == [0, 3, 0]
    assert {r["id"] for r in store.read().collect()} == {1, 6, 7, 8}


def test_full_reload_keeps_the_targets_types(spark, scratch):
    store, bad = TableStore(spark, scratch("data")), TableStore(spark, scratch("bad"))
    full = lambda: task(4, pk_field="id")
    run_task(spark, full(), spark.createDataFrame([(1, 10)], "id long, v long"), store, audit_col=None)
    res = run_task(spark, full(), spark.createDataFrame([(1, "11"), (2, "x")], "id long, v string"), store, audit_col=None, reject_store=bad)
    assert (res.rows, res.rejected) == (1, 1)
    assert [(r["id"], r["v"]) for r in store.read().collect()] == [(1, 11)] and bad.read().first()["v"] == "x"


def test_reject_table_counts_equal_rows(spark, scratch):
    bad = TableStore(spark, scratch("bad"))
    rows = lambda n: spark.createDataFrame([(None, "a", "key")] * n + [(1, b"\xff\x00".hex(), "v")], "id long, v string, reject_column string")
    for n in (2, 2, 5, 1):
        _commit_rejects(bad, rows(n), datetime(2024, 1, 1))
    assert bad.read().filter("v = 'a'").count() == 5 and bad.read().count() == 6
    wider = rows(1).withColumn("more", F.lit(None).cast("string"))         # a column added at the source
    _commit_rejects(bad, wider, datetime(2024, 1, 1))
    assert bad.read().count() == 6


def test_cut_key_of_a_capped_read(spark):
    """The cut key from the tail equals the cut of a plain sort, also where the cap ends with a range."""
    df = spark.range(0, 4000).select((F.col("id") % 800).alias("a"), (F.col("id") / 800).cast("int").alias("b"))
    for keys in (["a"], ["a", "b"]):
        for cap in (1, 250, 499, 500, 501, 2000, 3999, 4000, 5000):
            got = X.capped_with_ties(df, keys, cap, topk_limit=40, buckets=8)
            rows = sorted(tuple(r[k] for k in keys) for r in df.collect())
            cut = rows[min(cap, 4000) - 1]
            assert got.count() == sum(r <= cut for r in rows), (keys, cap)


def test_house_keeping_reads_what_can_match(spark, scratch):
    """Without and with an index the same rows stay; with it the gate and the delete open few files."""
    day = datetime(2024, 1, 1)
    rows = spark.range(0, 4000).select(F.col("id"), (F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(
        days=F.floor(F.col("id") / 100).cast("int"))).alias("ts"), F.lit(1).cast("long").alias("partition_num"))
    left = []
    for more in ({}, {"zones": ["ts", "id"], "key": "id"}):
        source, target, ledger = (TableStore(spark, scratch(n), **(more if n == "source" else {})) for n in ("source", "target", "ledger"))
        for month in range(4):
            source.commit(rows.filter(f"id div 1000 = {month}"), bucket=F.lit(month), cluster_by=["ts"])
        t = lambda: task(2, sync_field="id, ts", timestamp_field_name="ts", if_need_house_keeping=1)
        # the first 1,500 rows were copied
        run_task(spark, t(), source.read().filter("id < 1500").drop("partition_num"), target, None, ledger, as_of=day + timedelta(days=20))
        done = house_keeping(spark, t(), source, ledger, day + timedelta(days=60), target_store=target)
        assert done["shards"] == ["1/0", "1/1"] and done["ids"] == 1500
        left.append(sorted(r["id"] for r in source.read().select("id").collect()))
        if more:
            recent = source.read_where({"ts": (day + timedelta(days=35), None)})
            assert 0 < len(recent.inputFiles()) < len(source.read().inputFiles())
    assert left[0] == left[1] == list(range(1500, 4000))
