"""Loads (E1-E6) and schema operators."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.operators import load as L
from tidesync.operators import schema_ops as S


def _sorted(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_last_row_wins_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    changes = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], "k int, v string, seq int")
    out = L.upsert(target, changes, ["k"], order=["seq"])
    assert _sorted(out, "k", "v") == [(1, "a"), (2, "b2"), (3, "c")]


def test_upsert_keeps_columns_absent_from_changes(spark):
    target = spark.createDataFrame([(1, "a", "keep")], "k int, v string, extra string")
    changes = spark.createDataFrame([(1, "a2"), (2, "b")], "k int, v string")
    out = L.upsert(target, changes, ["k"])
    assert _sorted(out, "k", "v", "extra") == [(1, "a2", "keep"), (2, "b", None)]


def test_upsert_adds_new_columns(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    changes = spark.createDataFrame([(2, "b", 9)], "k int, v string, n int")
    out = L.upsert(target, changes, ["k"])
    assert out.columns == ["k", "v", "n"]
    assert _sorted(out, "k", "n") == [(1, None), (2, 9)]


def test_upsert_keep_config_columns(spark):
    target = spark.createDataFrame([(1, "cfg", 100), (2, "cfg", None)], "k int, cfg string, wm int")
    changes = spark.createDataFrame([(1, "cfg2", 0), (2, "cfg2", 5), (3, "new", 7)], "k int, cfg string, wm int")
    out = L.upsert_keep(target, changes, ["k"], keep=["wm"])
    assert _sorted(out, "k", "cfg", "wm") == [(1, "cfg2", 100), (2, "cfg2", None), (3, "new", 7)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 15), st.integers(0, 99)), min_size=1, max_size=40),
       cuts=st.lists(st.integers(1, 39), max_size=4))
def test_increments_equal_one_load(spark, rows, cuts):
    # rows arrive in order (seq); cutting them into increments and upserting each in turn gives the
    # same table as one upsert of everything
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    schema = "k int, v int, seq int"
    bounds = sorted({c for c in cuts if c < len(data)}) + [len(data)]
    target, lo = spark.createDataFrame([], schema), 0
    for hi in bounds:
        target = L.upsert(target, spark.createDataFrame(data[lo:hi], schema), ["k"], order=["seq"])
        lo = hi
    once = L.upsert(spark.createDataFrame([], schema), spark.createDataFrame(data, schema), ["k"], order=["seq"])
    assert _sorted(target, "k", "v") == _sorted(once, "k", "v")


def test_full_reload_empty_source_keeps_target(spark):
    target = spark.createDataFrame([(1,)], "k int")
    assert L.full_reload(target, spark.createDataFrame([], "k int")).count() == 1
    assert _sorted(L.full_reload(target, spark.createDataFrame([(5,), (6,)], "k int")), "k") == [(5,), (6,)]


def test_load_dispositions(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    target = spark.createDataFrame([(1, "x")], schema)
    df = spark.createDataFrame([(2,)], "a int")
    assert L.load(df, target, "WRITE_APPEND").count() == 2
    assert L.load(df, target, "WRITE_TRUNCATE").count() == 1
    with pytest.raises(ValueError):
        L.load(df, target, "WRITE_EMPTY")
    assert L.load(df, spark.createDataFrame([], schema), "WRITE_EMPTY").schema == schema
    with pytest.raises(ValueError):
        L.load(spark.createDataFrame([(1, 2)], "a int, zz int"), target)


def test_split_rejects_keeps_null_shards(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "k int, partition_num long")
    good, bad = L.split_rejects(df)
    assert good.count() == 1 and bad.count() == 1


def test_evolve_is_add_only(spark):
    t = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    s = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("c", T.DateType())])
    e = S.evolve_schema(t, s)
    assert [f.name for f in e.fields] == ["a", "b", "c"] and e["b"].dataType == T.StringType()
    assert S.added_columns(t, s) == ["c"]


def test_conform_and_rejects(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "x"), ("a", "2024-01-02", "y")], "n string, d string, `ignore` string")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("ignore", T.StringType())])
    good = S.conform(df, schema, "etl_update_time", "2024-02-01 00:00:00")
    assert good.columns == ["n", "d", "etl_update_time"] and good.count() == 1
    bad = S.rejects(df, schema).collect()
    assert len(bad) == 1 and bad[0]["reject_column"] == "n"


def test_duplicate_keys_and_assert_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert _sorted(S.duplicate_keys(df, ["a", "b"]), "a", "b", "n_rows") == [(1, 1, 2)]
    with pytest.raises(ValueError):
        S.assert_unique(df, ["a", "b"])
    S.assert_unique(df.distinct(), ["a", "b"])


def test_upsert_broadcasts_keys_only_by_a_bound_of_bytes(spark):
    numbers = spark.range(3).withColumn("v", F.lit(1))
    texts = numbers.withColumn("id", F.col("id").cast("string"))
    hinted = lambda df, rows: "broadcast" in L._maybe_broadcast(df.select("id"), rows)._jdf.queryExecution().logical().toString().lower()
    assert hinted(numbers, L.BROADCAST_BYTES // 16)
    assert not hinted(numbers, L.BROADCAST_BYTES // 16 + 1)
    assert not hinted(numbers, None)
    assert not hinted(texts, 3)
