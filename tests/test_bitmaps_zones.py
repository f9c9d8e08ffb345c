"""Bitmap key sets, and zone maps and key sets of a table store."""

import random

import pytest
from pyspark.sql import functions as F

from tidesync.functions import bitmaps as B
from tidesync.operators.extract import extract_by_ts
from tidesync.plans import zones
from tidesync.plans.commit import TableStore


def keyed(spark, groups):
    return spark.createDataFrame([(g, k) for g, ks in groups.items() for k in ks] + [("none", None)], "g string, k long").repartition(5)


def unpacked(sets):
    out = {}
    for r in B.unpack_keys(sets, ["g"], "k").collect():
        out.setdefault(r["g"], []).append(r["k"])
    return {g: sorted(ks) for g, ks in out.items()}


SPARSE = {"a": [-(1 << 62), -40_000, -32_768, -1, 0, 1, 32_768, 32_769, 65_536, 1 << 40, (1 << 63) - 1], "b": [5, 5, 5]}
DENSE = {"a": [*range(-3000, 40_000)], "b": [*range(0, 70_000, 7), *range(30_000, 33_000)], "c": [*range(1_000_000, 1_040_000)]}


@pytest.mark.parametrize("groups", [SPARSE, DENSE])
def test_pack_and_unpack(spark, groups):
    sets = B.pack_keys(keyed(spark, groups), ["g"], "k").cache()
    assert unpacked(sets) == {g: sorted(set(ks)) for g, ks in groups.items()}
    dense = sets.filter("bits IS NOT NULL").count()
    assert dense == (sets.count() if groups is DENSE else 0)
    n = sets.groupBy("g").agg(F.sum(B.set_size()).alias("n")).collect()
    assert {r["g"]: r["n"] for r in n} == {g: len(set(ks)) for g, ks in groups.items()}


def test_holds(spark):
    for groups in (SPARSE, DENSE):
        sets = B.pack_keys(keyed(spark, {"a": groups["a"]}), [], "k")
        rng = random.Random(2)
        probes = sorted(set(groups["a"][:50]) | {rng.randrange(-50_000, 80_000) for _ in range(500)})
        df = spark.createDataFrame([(p,) for p in probes], "p long").withColumn("cell", B.cell_of(F.col("p")))
        got = df.join(sets, "cell", "left").select("p", B.holds(F.col("bits"), F.col("spots"), B.spot_of(F.col("p"))).alias("h")).collect()
        assert {r["p"] for r in got if r["h"]} == set(probes) & set(groups["a"])


def test_union(spark):
    """Bitmaps with bitmaps, lists with lists, and lists that meet a bitmap in its cell."""
    more = {"a": [39_999, 40_001, 1 << 45], "z": [7]}
    sets = B.pack_keys(keyed(spark, DENSE), ["g"], "k").unionByName(B.pack_keys(keyed(spark, more), ["g"], "k")) \
        .unionByName(B.pack_keys(keyed(spark, {"c": range(1_039_000, 1_050_000), "z": [7, 9]}), ["g"], "k"))
    got = unpacked(B.union_sets(sets, ["g"]))
    expected = {g: set(ks) for g, ks in DENSE.items()}
    for extra in (more, {"c": range(1_039_000, 1_050_000), "z": [7, 9]}):
        for g, ks in extra.items():
            expected.setdefault(g, set()).update(ks)
    assert got == {g: sorted(ks) for g, ks in expected.items()}


@pytest.fixture()
def loads(spark, scratch):
    """A table of four loads, each a month: (k, ts, v), keys 0 to 3999."""
    store = TableStore(spark, scratch("zones"), zones=["ts", "k"], key="k")
    for month in range(4):
        rows = spark.range(1000).select((F.col("id") + 1000 * month).alias("k"), F.expr(
            f"timestamp_ntz'2024-0{month + 1}-01' + make_dt_interval(0, 0, cast(id as int))").alias("ts"), F.lit(month).alias("v"))
        store.commit(rows.withColumn("partition_num", F.lit(1).cast("long")), bucket=F.lit(month), cluster_by=["ts"])
    return store


def test_zones_prune_files(spark, loads):
    everything = loads.read()
    assert len(everything.inputFiles()) >= 4
    late = loads.read_where({"ts": ("2024-03-01 00:00:00", None)})
    assert 0 < len(late.inputFiles()) <= len(everything.inputFiles()) // 2
    got = extract_by_ts(late, "ts", "k", "2024-03-01 10:00:00", 0).select("k").collect()
    assert {r["k"] for r in got} == {r["k"] for r in extract_by_ts(everything, "ts", "k", "2024-03-01 10:00:00", 0).select("k").collect()}
    one = loads.read_where({"ts": ("2024-02-01 00:00:00", "2024-02-20 00:00:00"), "k": (None, 1500)})
    assert {r["v"] for r in one.select("v").distinct().collect()} == {1}
    assert loads.read_where({"k": (10_000, None)}).count() == 0
    # a column without zones prunes nothing
    assert loads.read_where({"v": (3, 3)}).count() == 4000


def test_zones_follow_rewrites(spark, loads):
    """Rewritten units have the zones of their new files; those of old ones are not read, nor kept by vacuum."""
    kept = loads.read(units=["1/3"], keep_unit=True).filter("k % 2 = 0").withColumn("k", F.col("k") + 100_000)
    loads.commit(kept, touched=["1/3"])
    assert loads.read_where({"k": (3000, 3999)}).count() == 0
    assert loads.read_where({"k": (100_000, None)}).count() == 500
    loads.vacuum(keep=1)
    assert loads.read_where({"k": (100_000, None)}).count() == 500 and loads.read().count() == 3500


def test_files_with_nulls(spark, loads):
    rows = spark.createDataFrame([(None, 9)], "k long, v int").select("k", F.lit("2024-09-01").cast("timestamp_ntz").alias("ts"), "v")
    loads.commit(rows.withColumn("partition_num", F.lit(1).cast("long")), bucket=F.lit(9))
    found = zones.files_with_nulls(loads, ["ts", "k"])
    assert found.filter("k IS NULL").count() == 1 and found.count() == 1


@pytest.mark.parametrize("keys, units", [([5, 1007], ["1/0", "1/1"]), ([*range(2000, 2600)], ["1/2"]), ([9_999], []), ([*range(0, 4000, 3)], ["1/0", "1/1", "1/2", "1/3"])])
def test_units_with_keys(spark, loads, keys, units):
    sets = B.pack_keys(spark.createDataFrame([(k,) for k in keys], "k long"), [], "k")
    assert zones.units_with_keys(loads, sets) == units


def test_units_with_keys_of_other_forms(spark, scratch):
    """Lists against bitmaps, both ways."""
    store = TableStore(spark, scratch("forms"), key="k")
    store.commit(spark.createDataFrame([(k, 1) for k in (3, 70_000)], "k long, partition_num long"))
    store.commit(spark.range(60_000, 90_000).select(F.col("id").alias("k"), F.lit(2).cast("long").alias("partition_num")))
    dense = B.pack_keys(spark.range(69_000, 75_000).toDF("k"), [], "k")
    assert zones.units_with_keys(store, dense) == ["1/0", "2/0"]
    few = B.pack_keys(spark.createDataFrame([(60_001,), (500_000,)], "k long"), [], "k")
    assert zones.units_with_keys(store, few) == ["2/0"]
    plain = TableStore(spark, scratch("plain"))
    plain.commit(spark.createDataFrame([(1, 1)], "k long, partition_num long"))
    assert zones.units_with_keys(plain, few) is None
