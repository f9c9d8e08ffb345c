"""Z-order compaction, the streaming shard log and the settle lag in event time."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from tidesync.operators.layout import interleave, z_value
from tidesync.plans.commit import TableStore
from tidesync.streaming.lagged import lagged_batch, stream_lagged
from tidesync.streaming.shard_log import stream_shard_log

DAY0 = "timestamp_ntz'2024-01-01'"


def test_interleave(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    got = {(r["a"], r["b"]): r["z"] for r in df.select("a", "b", interleave([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    expected = {(a, b): int("".join(f"{x}{y}" for x, y in zip(f"{a:03b}", f"{b:03b}", strict=True)), 2) for a in range(8) for b in range(8)}
    assert got == expected


def test_z_value_of_extreme_and_null_columns(spark):
    df = spark.createDataFrame([(-(1 << 63), None), ((1 << 63) - 1, 7), (0, 7), (None, 5)], "a long, b int")
    zs = [r[0] for r in df.select(z_value(df, ["a", "b"])).collect()]
    assert all(0 <= z < 1 << 60 for z in zs) and zs[1] > zs[2] > zs[0]
    empty = df.limit(0)
    assert empty.select(z_value(empty, ["a", "b"])).collect() == []


def scattered(spark, n=40_000):
    """Dates and keys that do not go together."""
    return spark.range(n).select(F.col("id"), F.expr(f"{DAY0} + make_dt_interval(cast(pmod(xxhash64(id), 1000) as int))").alias("ts"),
                                 F.lit(1).cast("long").alias("partition_num"))


def opened(store, ranges):
    return len(store.read_where(ranges).inputFiles())


def test_compaction_narrows_both_columns(spark, scratch):
    """As many files as a sort by the key, but reads by date open fewer of them, and reads by key still few."""
    store = TableStore(spark, scratch("z"), zones=["ts", "id"])
    store.commit(scattered(spark))
    store.commit(store.read(keep_unit=True).repartitionByRange(64, "id"), touched=store.units(), cluster_by=["id"])
    by_key = store.read()
    before = store.version()
    ids = sorted(r["id"] for r in by_key.select("id").collect())
    assert store.compact(["ts", "id"], file_rows=40_000 // 64) == before + 1
    assert sorted(r["id"] for r in store.read().select("id").collect()) == ids
    n = len(store.read().inputFiles())
    recent, some = {"ts": ("2026-09-01 00:00:00", None)}, {"id": (100, 700)}
    assert n >= 48 and opened(store, recent) <= n // 4 and opened(store, some) <= n // 4
    exact = store.read_where(recent).filter("ts >= timestamp_ntz'2026-09-01'").count()
    assert exact == scattered(spark).filter("ts >= timestamp_ntz'2026-09-01'").count() > 0


def test_compaction_takes_deltas_in(spark, scratch):
    store = TableStore(spark, scratch("zd"))
    row = lambda k, v: spark.createDataFrame([(k, v, 1, 0)], "k long, v long, partition_num long, bucket long")
    store.commit(row(1, 1).unionByName(row(2, 1)))
    store.commit_delta(row(1, 9), ["k"])
    store.compact(["k", "v"])
    assert store.state()["deltas"] == {} and {(r["k"], r["v"]) for r in store.read().collect()} == {(1, 9), (2, 1)}
    assert TableStore(spark, scratch("none")).compact(["k"]) is None


def test_stream_log_is_the_batch_profile(spark, scratch):
    """Files come one by one, with NULL ids and a replay from an older checkpoint's point of view; the log stays exact."""
    rng = random.Random(5)
    rows = [(None if rng.random() < 0.05 else rng.randrange(5000), f"2024-01-{rng.randrange(1, 28):02d} 00:00:00") for _ in range(2000)]
    df = spark.createDataFrame(rows, "id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    root = scratch("log")
    log = TableStore(spark, f"{root}/log")
    for part in df.randomSplit([1.0, 2.0, 1.0], 3):
        part.repartition(2).write.mode("append").parquet(f"{root}/in")
        stream_shard_log(spark, f"{root}/in", df.schema, log, f"{root}/ckpt", "id", "ts", 1000, "t", "db", "src")
    stream_shard_log(spark, f"{root}/in", df.schema, log, f"{root}/ckpt", "id", "ts", 1000, "t", "db", "src")       # nothing new
    got = {r["shard_id"]: (r["min_id"], r["max_id"], r["n_rows"]) for r in log.read().collect()}
    expected = {}
    for i, _ in rows:
        if i is not None:
            lo, hi, n = expected.get(i // 1000 + 1, (i, i, 0))
            expected[i // 1000 + 1] = (min(lo, i), max(hi, i), n + 1)
    assert got == expected
    # the same files through a new checkpoint: absolute rows, so the log does not count twice
    stream_shard_log(spark, f"{root}/in", df.schema, log, f"{root}/ckpt2", "id", "ts", 1000, "t", "db", "src")
    assert {r["shard_id"]: (r["min_id"], r["max_id"], r["n_rows"]) for r in log.read().collect()} == expected


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def lagged(spark, root, batches, schema="id long, ts timestamp_ntz, v long"):
    """Feed ``batches`` one by one; (loaded rows, late rows, stores)."""
    store, late, bad = (TableStore(spark, f"{root}/{n}") for n in ("out", "late", "bad"))
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream_lagged(spark, f"{root}/in", df.schema, store, late, f"{root}/ckpt", ["id"], "id", "ts", 1000, reject_store=bad)
    held = {(r["id"], r["ts"], r["v"]) for r in store.read().collect()}
    gone = sorted(((r["id"], r["v"], r["reject_column"]) for r in late.read().collect()), key=str) if late.version() else []
    return held, gone, (store, late, bad)


def test_lagged_stream_keeps_late_rows_and_drops_copies(spark, scratch):
    held, gone, (_, _, bad) = lagged(spark, scratch("lagged"), [
        [(1, at(10), 1), (2, at(10), 1), (2, at(10), 1)],             # a copy in one batch
        [(1, at(10), 1), (3, at(20), 1), (None, at(20), 4)],          # a copy in a later one; a row without a key is rejected
        [(2, at(19), 2), (3, at(18, 12), 9), (4, at(18, 12), 1)],     # in time: a newer version, an older one, a new key
        [(5, at(1), 1), (1, at(10), 1), (2, at(12), 7), (5, at(1), 1), (6, None, 1), (None, at(1), 5)],
    ])
    assert held == {(1, at(10), 1), (2, at(19), 2), (3, at(20), 1), (4, at(18, 12), 1)}
    # late: a key the target lacks, once; not a copy, not a version that a newer one has replaced
    assert gone == [("5", "1", "late"), ("6", "1", "ts"), (None, "5", "late")]          # sorted as text
    assert [r["v"] for r in bad.read().collect()] == ["4"]


def test_lagged_batch_replayed(spark, scratch):
    """A batch that comes again after a crash adds nothing, neither loaded nor late."""
    root = scratch("replay")
    store, late = TableStore(spark, f"{root}/out"), TableStore(spark, f"{root}/late")
    first = spark.createDataFrame([(1, at(20), 1, False), (1, at(20), 1, True), (2, at(1), 5, False)],
                                  "id long, ts timestamp_ntz, v long, _passed boolean")
    for _ in range(2):
        lagged_batch(first, 0, store, late, ["id"], "id", "ts", 1000, query_id="q")
    assert [r["v"] for r in store.read().collect()] == [1] and [r["v"] for r in late.read().collect()] == ["5"]
    lagged_batch(first.limit(0), 1, store, late, ["id"], "id", "ts", 1000, query_id="q")          # an empty batch
    assert store.read().count() == 1 and late.read().count() == 1


def test_lagged_random_batches_lose_nothing(spark, scratch):
    """Every version read is loaded, replaced by a newer one, or late; the target holds the newest of those loaded."""
    rng = random.Random(11)
    batches = [[(rng.randrange(60), at(max(1, min(28, 5 * b + rng.randrange(-9, 5))), rng.randrange(24)), rng.randrange(1000))
                for _ in range(60)] for b in range(1, 5)]
    batches = [list({(i, t): (i, t, v) for i, t, v in rows}.values()) for rows in batches]        # one value a version
    seen = {}
    for rows in batches:
        for k, row in enumerate(rows):
            rows[k] = (row[0], row[1], seen.setdefault(row[:2], row[2]))
    held, gone, _ = lagged(spark, scratch("random"), batches)
    newest = {i: (t, v) for i, t, v in held}
    assert len(newest) == len(held)
    late = {(int(i), int(v)) for i, v, _ in gone}
    for (i, t), v in seen.items():
        assert i in newest and newest[i][0] >= t or (i, v) in late
    assert gone and all((i, t) in seen and seen[(i, t)] == v for i, t, v in held)
