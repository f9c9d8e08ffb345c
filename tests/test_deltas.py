"""Merge-on-read deltas of a table store against a dict, their folding, and the bytes that runs write."""

import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidesync.plans.commit import BUCKET, SHARD, TableStore
from tidesync.plans.run import run_task
from tidesync.plans.zones import units_with_keys
from tidesync.functions.bitmaps import pack_keys
from tidesync.schema import SyncTask

KEYS = [SHARD, BUCKET, "k"]


def framed(spark, rows):
    return (spark.createDataFrame(rows, "k int, v int, first int")
            .withColumns({SHARD: (F.col("k") / 20).cast("long") + 1, BUCKET: (F.col("k") % 2).cast("long")}))


def content(store):
    return {r["k"]: (r["v"], r["first"]) for r in store.read().collect()}


step = st.one_of(st.tuples(st.just("delta"), st.lists(st.tuples(st.integers(0, 59), st.integers(0, 9)), min_size=1, max_size=15)),
                 st.tuples(st.just("fold"), st.integers(2, 3)), st.tuples(st.just("rewrite"), st.integers(0, 1)), st.tuples(st.just("vacuum"), st.just(1)))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps=st.lists(step, min_size=3, max_size=6))
def test_deltas_equal_dict_model(spark, scratch, steps):
    store, model = TableStore(spark, scratch("model")), {}
    store.commit(framed(spark, [(k, 0, -1) for k in range(0, 40)]))
    model = {k: (0, -1) for k in range(40)}
    for n, (kind, arg) in enumerate(steps):
        if kind == "delta":
            last = dict(arg)
            store.commit_delta(framed(spark, [(k, v, n) for k, v in last.items()]), ["k"], ["first"])
            for k, v in last.items():
                model[k] = (v, model[k][1] if k in model else n)
        elif kind == "fold":
            store.fold_deltas(arg)
        elif kind == "rewrite":
            units = [u for u in store.units() if u.endswith(f"/{arg}")]
            store.commit(store.read(units=units, keep_unit=True), touched=units)
        else:
            store.vacuum(keep=1)
        assert content(store) == model
    one = store.units()[0]
    assert {r["k"] for r in store.read(units=[one]).collect()} == {k for k in model if f"{k // 20 + 1}/{k % 2}" == one}


def test_tiers(spark, scratch):
    """Four small deltas become one; a large one is written into its unit, and only there."""
    store = TableStore(spark, scratch("tiers"))
    store.commit(framed(spark, [(k, 0, -1) for k in range(0, 20, 2)] + [(k, 0, -1) for k in range(20, 40, 2)]))
    for n in range(4):
        assert store.fold_deltas() == {"merged": 0, "rewritten": 0}
        store.commit_delta(framed(spark, [(0, n, n)]), ["k"], ["first"])
    assert [len(t) for t in store.state()["deltas"].values()] == [4]
    assert store.fold_deltas() == {"merged": 0, "rewritten": 1}        # 4 rows are over a fourth of the unit's 10
    assert store.state()["deltas"] == {} and content(store)[0] == (3, -1)
    wide = TableStore(spark, scratch("wide"))
    wide.commit(spark.range(0, 1000, 2).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"), F.lit(-1).alias("first"),
                                               F.lit(1).cast("long").alias(SHARD), F.lit(0).cast("long").alias(BUCKET)))
    one = lambda n: spark.createDataFrame([(0, n, n, 1, 0)], f"k int, v int, first int, {SHARD} long, {BUCKET} long")
    for n in range(4):
        wide.commit_delta(one(n), ["k"], ["first"])
    assert wide.fold_deltas() == {"merged": 1, "rewritten": 0}
    assert [len(t) for t in wide.state()["deltas"].values()] == [1]
    assert content(wide)[0] == (3, -1) and len(content(wide)) == 500
    with pytest.raises(ValueError):
        wide.commit_delta(one(1).drop("v"), ["k"])


def test_indexes_see_deltas(spark, scratch):
    store = TableStore(spark, scratch("indexed"), zones=["v"], key="k")
    store.commit(framed(spark, [(k, k, -1) for k in range(0, 60)]))
    store.commit_delta(framed(spark, [(1, 500, 0), (61, 600, 0)]), ["k"], ["first"])
    got = lambda lo, hi: {r["k"] for r in store.read_where({"v": (lo, hi)}).filter(f"v BETWEEN {lo} AND {hi}").collect()}
    assert got(1, 1) == set() and got(500, 700) == {1, 61} and got(40, 42) == {40, 41, 42}
    sets = pack_keys(spark.createDataFrame([(61,)], "k int"), [], "k")
    assert units_with_keys(store, sets) == ["4/1"]


def written(root):
    local = root[len("file:"):] if root.startswith("file:") else root
    return sum(os.path.getsize(f) for f in glob.glob(f"{local}/ver=*/**/*.parquet", recursive=True))


def test_runs_with_deltas_write_less(spark, scratch):
    base = spark.range(0, 60_000).select(F.col("id"), F.xxhash64("id").alias("v"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    day = lambda n: F.lit(f"2024-01-{n:02d}").cast("timestamp_ntz")
    sizes, results = [], []
    for deltas in (False, True):
        root = scratch(f"bytes{deltas}")
        store = TableStore(spark, root)
        source = base
        for n in range(2, 9):
            run_task(spark, SyncTask(source_table_id=1, source_db="s", source_table="t", target_db="d", target_table="t", etl_type=2,
                                     sync_field="id, v, ts", pk_field="id", id_field_name="id", timestamp_field_name="ts", batch_size=10_000,
                                     max_loop_count=100, partition_size=1_000_000_000), source, store, as_of=f"2024-02-{n:02d}", deltas=deltas)
            if n == 2:
                start = written(root)
            source = source.withColumns({"v": F.when(F.col("id") % 1000 == n, n).otherwise(F.col("v")),
                                         "ts": F.when(F.col("id") % 1000 == n, day(n)).otherwise(F.col("ts"))})
        sizes.append(written(root) - start)
        results.append(sorted(tuple(r) for r in store.read().select("id", "v", "etl_update_time").collect()))
    assert results[0] == results[1] and len(results[0]) == 60_000
    assert sizes[1] * 10 < sizes[0]
