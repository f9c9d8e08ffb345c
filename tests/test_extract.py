"""Keyset extraction and the exact run cap."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidesync.operators import extract as X
from tidesync.schema import SyncTask


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_keyset_predicate_is_lexicographic(spark):
    df = spark.createDataFrame([(1, 10), (2, 3), (2, 4), (3, 1)], "ts int, id int")
    out = X.extract_batch(df, ["ts", "id"], [2, 3], None)
    assert _rows(out, "ts", "id") == [(2, 4), (3, 1)]


def test_type2_pair_watermark_loses_no_row(spark):
    # rows (1,10) (2,3) (2,4) in batches of 2: the next watermark is the last row read as a pair,
    # (2,3), so (2,4) is read next (separate maxima would give (2,10) and skip it)
    from tidesync.operators.profile import next_watermark
    df = spark.createDataFrame([(1, 10), (2, 3), (2, 4)], "ts int, id int")
    first = X.extract_batch(df, ["ts", "id"], None, 2)
    wm = next_watermark(first, 2, "id", "ts").first()
    assert (wm["last_timestamp"], wm["last_id"]) == (2, 3)
    second = X.extract_batch(df, ["ts", "id"], [wm["last_timestamp"], wm["last_id"]], 2)
    assert _rows(second, "ts", "id") == [(2, 4)]


def test_type3_composite_keyset_reads_every_row(spark):
    rows = [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 9)]
    df = spark.createDataFrame([(datetime(2024, 1, d), i) for d, i in rows], "ts timestamp_ntz, id int")
    seen, wm = [], None
    while True:
        b = X.extract_lagged(df, "ts", "id", wm[0] if wm else "1970-01-01 00:00:00", wm[1] if wm else 0,
                             as_of="2024-01-10 00:00:00", lag_days=3, batch_size=2)
        got = _rows(b, "ts", "id")
        if not got:
            break
        seen += got
        wm = got[-1]
    assert [(t.day, i) for t, i in seen] == rows


def test_lag_excludes_recent_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d, 12), d) for d in range(1, 11)], "ts timestamp_ntz, id int")
    out = X.extract_lagged(df, "ts", "id", "2024-01-01 00:00:00", 0, as_of="2024-01-10 08:00:00", lag_days=3)
    assert max(r["id"] for r in out.collect()) == 6      # ts < 2024-01-07 00:00


def test_inclusive_rereads_rows_at_watermark(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 5), (datetime(2024, 1, 1), 7), (datetime(2024, 1, 2), 1)],
                               "ts timestamp_ntz, id int")
    out = X.extract_lagged(df, "ts", "id", "2024-01-01 00:00:00", 7, as_of="2024-02-01 00:00:00",
                           inclusive=True)
    assert sorted(r["id"] for r in out.collect()) == [1, 5, 7]


def test_microseconds_kept_in_watermark(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 5), 1), (datetime(2024, 1, 1, 0, 0, 0, 9), 2)],
                               "ts timestamp_ntz, id int")
    out = X.extract_by_ts(df, "ts", "id", "2024-01-01 00:00:00.000005", 1)
    assert _rows(out, "id") == [(2,)]


def test_string_ids_keep_string_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert _rows(X.extract_by_id(df, "id", "a"), "id") == [("b",), ("c",)]


def test_rowversion_round_trip(spark):
    from tidesync.functions.rules import bytes_to_unsigned, unsigned_to_bytes
    df = spark.range(0, 1000).select(F.col("id").alias("v"))
    out = df.select("v", bytes_to_unsigned(unsigned_to_bytes("v")).alias("d"))
    assert out.filter(F.col("d") != F.col("v")).count() == 0
    ones = spark.createDataFrame([(bytes([255] * 8),)], "b binary").select(bytes_to_unsigned("b").alias("d"))
    assert str(ones.first()["d"]) == "18446744073709551615"


def test_project_sync_fields_trims_and_drops_ignore(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `ignore` int")
    assert X.project_sync_fields(df, " a ,b , `ignore`").columns == ["a", "b"]


def _brute(df, keys, cap, wm):
    base = df if wm is None else df.filter(X.after(df, keys, wm))
    return sorted(_rows(base.orderBy(*keys).limit(cap), *df.columns))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5), st.integers(0, 1000)), min_size=1,
                     max_size=120, unique_by=lambda t: (t[0], t[1], t[2])),
       cap=st.integers(1, 150), buckets=st.integers(2, 9))
def test_capped_extract_equals_order_by_limit(spark, data, cap, buckets):
    df = spark.createDataFrame(data, "a int, b int, c int")
    got = X.capped_extract(df, ["a", "b", "c"], cap, watermark=[3, 1, 0], topk_limit=3, buckets=buckets)
    assert sorted(_rows(got, "a", "b", "c")) == _brute(df, ["a", "b", "c"], cap, [3, 1, 0])


def test_capped_extract_hot_key(spark):
    # one leading value holds most rows: the search steps to the next key column
    data = [(7, i) for i in range(300)] + [(i, 0) for i in range(20)]
    df = spark.createDataFrame(data, "a int, b int")
    got = X.capped_extract(df, ["a", "b"], 150, topk_limit=10, buckets=4)
    assert sorted(_rows(got, "a", "b")) == _brute(df, ["a", "b"], 150, None)


def test_capped_extract_timestamp_and_text_keys(spark):
    data = [(datetime(2024, 1, 1 + i % 9, i % 5), f"k{i:04d}") for i in range(200)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string")
    got = X.capped_extract(df, ["ts", "k"], 77, topk_limit=5, buckets=3)
    assert sorted(_rows(got, "ts", "k")) == _brute(df, ["ts", "k"], 77, None)
    got2 = X.capped_extract(df, ["k", "ts"], 120, topk_limit=5)      # text leading key: rank cut
    assert sorted(_rows(got2, "ts", "k")) == sorted(_rows(df.orderBy("k", "ts").limit(120), "ts", "k"))


def test_increment_types(spark):
    o = spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 20), f"n{i}") for i in range(100)],
                              "id long, ts timestamp_ntz, name string")
    base = dict(source_table_id=1, source_db="s", source_table="t", target_db="d", target_table="t",
                sync_field="id, ts, name", id_field_name="id", timestamp_field_name="ts",
                batch_size=10, max_loop_count=3, partition_size=50)
    t1 = SyncTask(etl_type=1, last_id_sync_record=10, **base)
    r1 = X.increment(o, t1)
    assert sorted(r["id"] for r in r1.collect()) == list(range(11, 41))
    assert {r["partition_num"] for r in r1.collect()} == {1}
    t4 = SyncTask(etl_type=4, **base)
    r4 = X.increment(o, t4)
    assert r4.count() == 100 and {r["partition_num"] for r in r4.collect()} == {0}
    t3 = SyncTask(etl_type=3, last_timestamp_sync_record=datetime(2024, 1, 10), **base)
    r3 = X.increment(o, t3, as_of=datetime(2024, 1, 15))
    assert all(datetime(2024, 1, 10) <= r["ts"] < datetime(2024, 1, 12) for r in r3.collect())


def test_capped_extract_large_ordinals(spark):
    # ids near 2^60 and microsecond timestamps over centuries: bucket edges must be exact
    big = 2 ** 60
    data = [(big + i * 1_000_003, datetime(1900 + i % 200, 1 + i % 12, 1, i % 24, 0, 0, i)) for i in range(400)]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    got = X.capped_extract(df, ["id"], 173, topk_limit=7, buckets=5)
    assert sorted(_rows(got, "id")) == sorted(_rows(df.orderBy("id").limit(173), "id"))
    got_ts = X.capped_extract(df, ["ts", "id"], 211, topk_limit=7, buckets=6)
    assert sorted(_rows(got_ts, "ts", "id")) == sorted(_rows(df.orderBy("ts", "id").limit(211), "ts", "id"))


def test_capped_extract_text_keys_histogram(spark):
    # uuid-like ids: the 7-byte prefix resolves them; plus a hot shared prefix that needs the slice cut
    import hashlib
    data = [(hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(300)]
    data += [("hotprefix-" + f"{i:04d}", 1000 + i) for i in range(120)]
    data += [("a", 5000), ("ab", 5001), ("", 5002)]
    df = spark.createDataFrame(data, "k string, v int")
    for cap in (50, 157, 299, 380):
        got = X.capped_extract(df, ["k"], cap, topk_limit=9, buckets=7)
        assert sorted(_rows(got, "k")) == sorted(_rows(df.orderBy("k").limit(cap), "k")), cap
    got = X.capped_extract(df, ["k"], 200, watermark=["7"], topk_limit=9, buckets=5)
    assert sorted(_rows(got, "k")) == _brute(df.select("k"), ["k"], 200, ["7"])


def test_capped_extract_long_shared_text_prefix(spark):
    # a third of the rows share a 30-byte prefix, and some texts repeat (tie broken by the 2nd key)
    hot = "customer-account-reference-xx-"
    data = [(f"{hot}{i:05d}", i) for i in range(150)] + [(f"{hot}00007", 1000 + i) for i in range(40)]
    data += [(f"k{i:04d}", i) for i in range(250)]
    df = spark.createDataFrame(data, "k string, n int")
    for cap in (120, 260, 330, 430):
        got = X.capped_extract(df, ["k", "n"], cap, topk_limit=6, buckets=5)
        assert sorted(_rows(got, "k", "n")) == sorted(_rows(df.orderBy("k", "n").limit(cap), "k", "n")), cap


def test_capped_extract_float_key_uses_rank_cut(spark):
    data = [(float(i % 37) / 3.0, i) for i in range(300)]
    df = spark.createDataFrame(data, "x double, id int")
    got = X.capped_extract(df, ["x", "id"], 140, topk_limit=5)
    assert sorted(_rows(got, "x", "id")) == sorted(_rows(df.orderBy("x", "id").limit(140), "x", "id"))


def test_capped_extract_decimal_key(spark):
    from decimal import Decimal
    data = [(Decimal(f"{(i * 7919) % 1000}.{i % 100:02d}"), i) for i in range(400)]
    df = spark.createDataFrame(data, "amount decimal(12,2), id int")
    for cap in (97, 250):
        got = X.capped_extract(df, ["amount", "id"], cap, topk_limit=5, buckets=6)
        assert sorted(_rows(got, "amount", "id")) == sorted(_rows(df.orderBy("amount", "id").limit(cap), "amount", "id"))


def test_rowversion_bounds_reach_the_scan_and_keep_the_order(spark, scratch):
    """Unsigned 64-bit values over the whole range, the highest bit set in half of them."""
    import random

    from tidesync.operators.extract import capped_extract, capped_with_ties, extract_by_rowversion, rowversion_bytes
    rng = random.Random(4)
    values = sorted({0, 1, (1 << 63) - 1, 1 << 63, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(3000)), *range(1 << 40, (1 << 40) + 500)})
    path = scratch("rv")
    df = spark.createDataFrame([(i, bytearray(rowversion_bytes(v))) for i, v in enumerate(values)], "i int, rv binary")
    df.repartitionByRange(6, "rv").sortWithinPartitions("rv").write.parquet(path)
    rows = spark.read.parquet(path)
    for cap in (1, 700, 1750, len(values) - 1, len(values) + 5):
        got = capped_extract(rows, ["rv"], cap, [rowversion_bytes(0)], topk_limit=50, buckets=16)
        assert sorted(r["i"] for r in got.collect()) == list(range(1, min(cap, len(values) - 1) + 1))
        assert capped_with_ties(rows, ["rv"], cap, topk_limit=50, buckets=16).count() == min(cap, len(values))
    after = extract_by_rowversion(rows, "rv", 1 << 63)
    assert [int(r["rowversion"]) for r in after.collect()] == [v for v in values if v > 1 << 63]
    plan = after._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(rv" in plan and "GreaterThan(rv" in plan
    search = capped_extract(rows, ["rv"], 1000, [rowversion_bytes(0)], topk_limit=50, buckets=16)._jdf.queryExecution().toString()
    assert "LessThan(rv" in search


def test_cap_over_the_whole_range_of_long_keys(spark):
    from tidesync.operators.extract import capped_extract
    import random
    rng = random.Random(8)
    ks = sorted({-(1 << 63), (1 << 63) - 1, *(rng.randrange(-(1 << 63), 1 << 63) for _ in range(2000))})
    df = spark.createDataFrame([(k,) for k in ks], "k long")
    assert sorted(r["k"] for r in capped_extract(df, ["k"], 777, topk_limit=20, buckets=16).collect()) == ks[:777]
