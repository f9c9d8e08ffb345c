"""Shard profile, log, watermark (F) and retention (G)."""

import zlib
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidesync.operators import profile as P
from tidesync.operators import retention as R


def _log(spark, rows):
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, partition_num long")
    prof = P.shard_profile(df, "id", "ts")
    return P.shard_log_rows(prof, "t", "db", "src", "id", "ts", None, ["id", "ts"], "2024-01-01 00:00:00")


def _key(df):
    return sorted((r["sharding_table_name"], r["min_id"], r["max_id"], r["min_timestamp"], r["max_timestamp"])
                  for r in df.collect())


row = st.tuples(st.integers(0, 50), st.integers(1, 28), st.integers(1, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(row, min_size=1, max_size=8), b=st.lists(row, min_size=1, max_size=8),
       c=st.lists(row, min_size=1, max_size=8))
def test_log_merge_is_associative_and_equals_one_profile(spark, a, b, c):
    mk = lambda rs: [(i, datetime(2024, 1, d), p) for i, d, p in rs]
    la, lb, lc = _log(spark, mk(a)), _log(spark, mk(b)), _log(spark, mk(c))
    left = P.shard_log_merge(P.shard_log_merge(la, lb), lc)
    right = P.shard_log_merge(la, P.shard_log_merge(lb, lc))
    whole = _log(spark, mk(a + b + c))
    assert _key(left) == _key(right) == _key(whole)


def test_real_id_zero_is_kept(spark):
    old = _log(spark, [(0, datetime(2024, 1, 1), 1)])
    new = _log(spark, [(5, datetime(2024, 1, 2), 1)])
    assert P.shard_log_merge(old, new).first()["min_id"] == 0
    legacy = P.import_legacy_log(old)
    assert legacy.first()["min_id"] is None


def test_ts_guard_on_min_max(spark):
    df = spark.createDataFrame([(1, datetime(1980, 1, 1), 1), (2, datetime(2020, 1, 1), 1),
                                (3, datetime(1, 1, 1), 2)], "id long, ts timestamp_ntz, partition_num long")
    r = {x["partition_num"]: x for x in P.shard_profile(df, "id", "ts").collect()}
    assert r[1]["min_timestamp"] is None and r[1]["max_timestamp"] == datetime(2020, 1, 1)
    assert r[2]["min_timestamp"] is None and r[2]["max_timestamp"] is None


def test_next_watermark_types(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2)), (9, datetime(2024, 1, 1))], "id long, ts timestamp_ntz")
    assert P.next_watermark(df, 1, "id").first()["last_id"] == 9
    w = P.next_watermark(df, 2, "id", "ts").first()
    assert (w["last_id"], w["last_timestamp"]) == (1, datetime(2024, 1, 2))
    w4 = P.next_watermark(df, 4, as_of="2024-03-01 10:00:00").first()
    assert w4["last_timestamp"] == datetime(2024, 3, 1, 10)


def test_ledger_pack_bounded_and_sorted(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "k")
    led = R.ledger_pack(df, "k", "2024-01-05 13:00:00", "db", "t", batch_size=1000)
    rows = sorted(led.collect(), key=lambda r: r["house_keeping_id"])
    assert [len(r["ids"]) for r in rows] == [1000, 1000, 500]
    assert rows[0]["ids"][:3] == ["0", "1", "2"] and rows[0]["etl_update_date"] == datetime(2024, 1, 5)
    assert R.ledger_unpack(led).count() == 2500


def test_log_of_text_ids(spark, scratch):
    """Text ids have their range, numeric ones NULLs there, in one log, also one written before ranges were kept."""
    from tidesync.plans.commit import TableStore
    from tidesync.streaming.shard_log import stream_shard_log
    assert "min_key" not in _log(spark, [(1, None, 1)]).columns
    root = scratch("text_log")
    log = TableStore(spark, f"{root}/log")
    log.commit(_log(spark, [(1, None, 1)]).withColumn("partition_num", F.lit(0).cast("long")), small=True)
    for ids in (["b", "\u00e9", None], ["B", "a10", "a9"]):
        df = spark.createDataFrame([(i,) for i in ids], "id string")
        df.write.mode("append").parquet(f"{root}/in")
        stream_shard_log(spark, f"{root}/in", df.schema, log, f"{root}/ckpt", "id", None, 10_000_000_000, "words", "db", "src")
    got = {r["sharding_table_name"]: (r["min_id"], r["min_key"], r["max_key"]) for r in log.read().collect()}
    assert got.pop("words_1") == (None, "B", "\u00e9") and all(v[1:] == (None, None) for v in got.values()) and got


def test_legacy_blob_import(spark):
    blobs = [(1, zlib.compress(b"1,2,3")), (2, zlib.compress(b"'a','b'")), (3, b"not zlib"), (4, zlib.compress(b"'a, b' , 'O'Neil'")),
             (5, zlib.compress(b"")), (6, None), (7, zlib.compress(b" 7 , 8 "))]
    df = spark.createDataFrame(blobs, "house_keeping_id long, ids_compress binary")
    out = {r["house_keeping_id"]: r["ids"] for r in R.unpack_legacy_blobs(df).collect()}
    assert out == {1: ["1", "2", "3"], 2: ["a", "b"], 3: None, 4: ["a, b", "O'Neil"], 5: [], 6: None, 7: ["7", "8"]}


def _ledger(spark, entries):
    return spark.createDataFrame(
        [(0, hk, d, "db", "t", ids, done) for hk, d, ids, done in entries],
        "load_version long, house_keeping_id long, etl_update_date timestamp_ntz, source_db string, source_table string, "
        "ids array<string>, is_source_delete int")


def test_gate_window_purge_delete_mark(spark):
    led = _ledger(spark, [(1, datetime(2024, 1, 1), ["1", "2"], 0), (2, datetime(2024, 1, 2), ["3", "4"], 0),
                          (3, datetime(2023, 12, 1), ["5"], 1), (4, datetime(2024, 1, 3), ["6"], 0)])
    src = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, None), (3, datetime(2024, 1, 1)),
                                 (4, datetime(2024, 1, 25)), (6, datetime(2024, 1, 2))], "id long, ts timestamp_ntz")
    as_of = "2024-01-30 00:00:00"
    assert sorted(r["house_keeping_id"] for r in R.ledger_purge(led, as_of).collect()) == [1, 2, 4]
    win = R.ledger_window(led, as_of, 60, 14, "db", "t")
    assert sorted(r["house_keeping_id"] for r in win.collect()) == [1, 2, 4]
    ok = R.expiry_gate(win, src, "id", "ts", as_of)
    # entry 2 is blocked by id 4 (2024-01-25 >= 2024-01-16); NULL ts and a vanished id do not block
    assert sorted(r["house_keeping_id"] for r in ok.collect()) == [1, 4]
    kept = R.retention_delete(src, ok, "id", ids_rows=R.ledger_id_count(ok))
    assert sorted(r["id"] for r in kept.collect()) == [3, 4]
    marked = {r["house_keeping_id"]: r["is_source_delete"] for r in R.ledger_mark(led, ok).collect()}
    assert marked == {1: 1, 2: 0, 3: 1, 4: 1}


def test_compact_same_rows(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("partition_num"))
    out = R.compact(df, ["k"], 4)
    assert out.rdd.getNumPartitions() == 4 and sorted(out.collect()) == sorted(df.collect())


def test_ledger_of_composite_and_text_keys(spark):
    df = spark.createDataFrame([(i // 3, f"line {i % 3}") for i in range(900)] * 2 + [(1, None)], "k long, n string")
    led = R.ledger_pack(df, ["k", "n"], "2024-01-05 13:00:00", "db", "t", batch_size=100)
    rows = led.collect()
    assert sum(len(r["ids"]) for r in rows) == 900 and max(len(r["ids"]) for r in rows) <= 100
    one = R.ledger_pack(df.filter("k = 1 and n = 'line 2'"), ["k", "n"], "2024-01-05 13:00:00", "db", "t")
    kept = R.retention_delete(df, one, ["k", "n"], ids_rows=1)
    assert kept.count() == df.count() - 2 and kept.filter("k = 1 and n = 'line 2'").isEmpty()
    text = R.ledger_pack(df, "n", "2024-01-05 13:00:00", "db", "t")
    assert sorted(r["id"] for r in R.ledger_unpack(text).collect()) == ["line 0", "line 1", "line 2"]


def test_gate_by_composite_key(spark):
    src = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (1, "b", datetime(2024, 1, 29))], "k long, n string, ts timestamp_ntz")
    as_of = "2024-01-30 00:00:00"
    old, new = (R.ledger_pack(src.filter(f"n = '{n}'"), ["k", "n"], as_of, "db", "t") for n in "ab")
    assert R.expiry_gate(old, src, ["k", "n"], "ts", as_of).count() == 1
    assert R.expiry_gate(new, src, ["k", "n"], "ts", as_of).count() == 0
