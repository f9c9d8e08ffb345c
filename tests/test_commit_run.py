"""Versioned commit (E7), whole runs, house-keeping, the stream front (G9), config sources (A4, A5)."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from tidesync.plans.commit import CommitConflict, TableStore
from tidesync.plans.derived import table
from tidesync.plans.e2e import orders_task
from tidesync.plans.run import house_keeping, run_task
from tidesync.schema import SyncTask, TaskError, validate_sp_task, validate_task
from tidesync.streaming.stream import stream_sync
from tidesync.sources.config import read_rules, read_sp_tasks_csv, read_tasks_csv


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_commit_versions_and_touched_shards(spark, scratch):
    st = TableStore(spark, scratch("store"))
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, partition_num long")
    assert st.commit(df, watermark={"last_id": 2}) == 1
    st.commit(spark.createDataFrame([(2, "b2", 2)], "k int, v string, partition_num long"), touched=["2/0"])
    assert sorted((r["k"], r["v"]) for r in st.read().collect()) == [(1, "a"), (2, "b2")]
    assert {u: t.split("-")[0] for u, t in st.state()["units"].items()} == {"1/0": "1", "2/0": "2"}
    assert st.watermark() == {"last_id": 2}
    # a touched shard that ends up empty disappears
    st.commit(spark.createDataFrame([], "k int, v string, partition_num long"), touched=["1/0"])
    assert [r["k"] for r in st.read().collect()] == [2]


def test_units_split_a_shard_and_rewrite_only_touched(spark, scratch):
    from tidesync.plans.commit import bucket_expr
    from pyspark.sql import types as T
    st = TableStore(spark, scratch("units"))
    size = 64_000_000                     # one shard, 64 buckets of 1e6 keys
    df = spark.range(0, 5_000_000, 250_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("partition_num"))
    st.commit(df, bucket=bucket_expr("k", T.LongType(), size))
    assert len(st.units()) == 5
    ver_before = dict(st.state()["units"])
    change = spark.createDataFrame([(1_250_000, 1)], "k long, partition_num long")
    st.commit(change.unionByName(st.read(units=["1/1"]).filter(F.col("k") != 1_250_000)),
              touched=["1/1"], bucket=bucket_expr("k", T.LongType(), size))
    after = st.state()["units"]
    assert after["1/1"].startswith("2-") and all(after[u] == ver_before[u] for u in ver_before if u != "1/1")
    assert st.read().count() == 20


def test_crash_before_state_rename_keeps_old_data_and_watermark(spark, scratch):
    root = scratch("crash")
    st = TableStore(spark, root)
    st.commit(spark.createDataFrame([(1, 1)], "k int, partition_num long"), watermark={"last_id": 1})
    st._fs.write_new = lambda rel, text: (_ for _ in ()).throw(RuntimeError("crash"))
    with pytest.raises(RuntimeError):
        st.commit(spark.createDataFrame([(9, 1)], "k int, partition_num long"), watermark={"last_id": 9})
    fresh = TableStore(spark, root)
    assert [r["k"] for r in fresh.read().collect()] == [1] and fresh.watermark() == {"last_id": 1}


def test_commit_conflict(spark, scratch):
    st = TableStore(spark, scratch("conflict"))
    df = spark.createDataFrame([(1, 1)], "k int, partition_num long")
    st.commit(df)
    with pytest.raises(CommitConflict):
        st.commit(df, expected_version=0)
    st._fs.write_new("_state/00000009.json", "{}")
    with pytest.raises(CommitConflict):
        st._fs.write_new("_state/00000009.json", "{}")


def test_run_is_incremental_and_idempotent(spark, scratch):
    orders = table(spark, SF_SMOKE, "orders")
    root = scratch("run")
    store, log, ledger = (TableStore(spark, f"{root}/{n}") for n in ("d", "l", "g"))
    total = orders.count()
    task = orders_task(batch_size=100, loops=5, housekeeping=1)
    r1 = run_task(spark, task, orders, store, log, ledger, as_of="2001-08-10 00:00:00")
    assert r1.rows == 500
    while run_task(spark, orders_task(batch_size=100, loops=5, housekeeping=1), orders, store, log, ledger,
                   as_of="2001-08-10 00:00:00").rows:
        pass
    data = store.read()
    assert data.count() == total and data.select("o_orderkey").distinct().count() == total
    lg = log.read().collect()
    assert sum(1 for _ in lg) == data.select("partition_num").distinct().count()
    assert min(r["min_id"] for r in lg) == orders.agg(F.min("o_orderkey")).first()[0]
    assert ledger.read().select(F.explode("ids")).count() == total
    again = run_task(spark, orders_task(batch_size=100, loops=5, housekeeping=1), orders, store, log, ledger,
                     as_of="2001-08-12 00:00:00")
    assert again.rows == 0 and store.read().count() == total


def test_full_reload_run_and_empty_source(spark, scratch):
    c = table(spark, SF_SMOKE, "orders")
    store = TableStore(spark, scratch("full"))
    run_task(spark, orders_task(4), c, store, as_of="2001-08-10 00:00:00")
    empty = run_task(spark, orders_task(4), c.limit(0), store, as_of="2001-08-11 00:00:00")
    assert empty.rows == 0 and store.read().count() == c.count()


def test_house_keeping_end_to_end(spark, scratch):
    import __spark_entry__ as E
    got = E.queries()["housekeeping_run"](spark, SF_SMOKE)
    q = E.queries()["retention_delete"](spark, SF_SMOKE)
    assert sorted(r["o_orderkey"] for r in got.collect()) == sorted(r["o_orderkey"] for r in q.collect())


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    got = E.queries()["stream_sync"](spark, SF_SMOKE)
    ev = table(spark, SF_SMOKE, "events")
    assert got.count() == ev.count()
    assert sorted(r["event_id"] for r in got.collect()) == sorted(r["event_id"] for r in ev.collect())


def test_stream_replay_is_skipped(spark, scratch):
    from tidesync.streaming.stream import sync_batch
    st = TableStore(spark, scratch("replay"))
    b = spark.createDataFrame([(1, "a")], "id long, v string")
    sync_batch(b, 0, st, ["id"], "id", 100)
    sync_batch(spark.createDataFrame([(1, "changed")], "id long, v string"), 0, st, ["id"], "id", 100)
    assert [r["v"] for r in st.read().collect()] == ["a"]


TASK_CSV = """source_table_id,airflow_task_id,is_active,source_username,source_password,source_host,source_db,source_table,target_username,target_password,target_host,target_db,target_table,pk_field,sync_field,etl_type,max_loop_count,batch_size,partition_size,id_field_name,last_id_sync_record,last_id_house_keeping_record,timestamp_field_name,last_timestamp_sync_record,last_timestamp_house_keeping_record,source_write_username,source_write_password,if_need_house_keeping,event_date_field_name
1,0,1,u1,secret,h1,db1,t1,u2,secret,h2,db2,tt1,id,"id, name",1,20,1000,1000000000,id,0,0,,1970-01-01 0:00:01,1970-01-01 0:00:01,w1,secret,0,
2,0,1,u1,secret,h1,db1,t2,u2,secret,h2,db2,tt2,id,"id, ts, name",2,1500,10000,1000000000,id,0,0,ts,2024-01-05 13:45:00,1970-01-01 0:00:01,w1,secret,1,ts
"""

SP_CSV = """source_table_id,airflow_task_id,is_active,source_username,source_password,source_host,source_db,source_table,source_sp,etl_type,arg_counts,target_username,target_password,target_host,target_db,target_table,pk_field,sync_field,max_loop_count,batch_size,id_field_name_1,last_id_sync_record_1,id_field_name_2,last_id_sync_record_2,timestamp_field_name,last_timestamp_sync_record
1,0,1,u,secret,h,db,t,sp1,1,3,u,secret,h,db2,tt,"a, b","a, b, c",20,1000,a,0,b,0,,
"""


def test_read_tasks_csv(spark, tmp_path):
    p = tmp_path / "tasks.csv"
    p.write_text(TASK_CSV)
    rows = [r.asDict() for r in read_tasks_csv(spark, str(p)).orderBy("source_table_id").collect()]
    assert rows[0]["sync_field"] == "id, name" and rows[0]["source"] == "u1@h1"
    assert rows[0]["timestamp_field_name"] is None
    assert rows[0]["last_timestamp_sync_record"] == datetime(1970, 1, 1, 0, 0, 1)
    assert rows[1]["last_timestamp_sync_record"] == datetime(2024, 1, 5, 13, 45)
    assert "secret" not in json.dumps(rows, default=str)
    tasks = [validate_task(SyncTask.from_row(r)) for r in rows]
    assert tasks[1].row_cap == 15_000_000 and tasks[1].keys == ["id"]
    sp = read_sp_tasks_csv(spark, str(_write(tmp_path, "sp.csv", SP_CSV))).first().asDict()
    assert validate_sp_task(sp)["pk_field"] == "a, b"


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return p


def test_task_checks():
    base = dict(source_table_id=1, source_db="s", source_table="t", target_db="d", target_table="t",
                sync_field="id, ts", id_field_name="id")
    with pytest.raises(TaskError):      # house-keeping without a timestamp field
        validate_task(SyncTask(etl_type=1, pk_field="id", if_need_house_keeping=1, **base))
    with pytest.raises(TaskError):      # type 2 without a timestamp field
        validate_task(SyncTask(etl_type=2, pk_field="id", **base))
    t = validate_task(SyncTask(etl_type=1, pk_field="id, ts", **base))
    assert t.keys == ["id", "ts"]       # a composite key is a key list
    with pytest.raises(TaskError):      # a blank size in the control row
        validate_task(SyncTask(etl_type=1, pk_field="id", partition_size=None, **base))
    with pytest.raises(TaskError):      # procedure type 2 takes 2 arguments only
        validate_sp_task({"source_table_id": 3, "etl_type": 2, "arg_counts": 3})


def test_read_rules(spark, tmp_path):
    p = _write(tmp_path, "rules.json", json.dumps([
        {"target_db": "d", "target_table": "t", "column_name": "c", "original_data_type": "Boolean",
         "covert_data_type": "bit"}], indent=2))
    r = read_rules(spark, str(p)).collect()
    assert len(r) == 1 and r[0]["covert_data_type"] == "bit"


def test_spark_type_map():
    from pyspark.sql import types as T
    from tidesync.schema import spark_type
    assert spark_type("decimal(12,2)") == T.DecimalType(12, 2)
    assert spark_type("bigint unsigned") == T.DecimalType(20, 0)
    assert spark_type("varchar(64)") == T.StringType() and spark_type("datetime") == T.TimestampNTZType()
    with pytest.raises(ValueError):
        spark_type("decimal(65,2)")
    with pytest.raises(ValueError):
        spark_type("geometry")


def test_sync_then_house_keeping_deletes_only_copied_and_expired(spark, scratch):
    from tidesync.functions.routing import with_partition_num
    orders = table(spark, SF_SMOKE, "orders")
    root = scratch("life")
    source = TableStore(spark, f"{root}/source")
    source.commit(with_partition_num(orders, "o_orderkey", 1000))
    target, ledger = TableStore(spark, f"{root}/target"), TableStore(spark, f"{root}/ledger")
    # copy the orders up to 2000 only (the source's later rows stay uncopied): type-3 lag cutoff
    task = orders_task(3, batch_size=10_000, loops=10, housekeeping=1)
    run_task(spark, task, source.read(), target, None, ledger, as_of="2000-01-04 00:00:00")
    copied = target.read().count()
    assert 0 < copied < orders.count()
    # 30 days later everything copied is older than 14 days: all copied rows go, nothing else
    res = house_keeping(spark, orders_task(3, housekeeping=1), source, ledger, "2000-02-03 00:00:00",
                        start_days=60, end_days=14)
    assert res["ids"] == copied
    left = source.read()
    assert left.count() == orders.count() - copied
    assert left.agg(F.min("o_orderdate")).first()[0] >= datetime(1999, 12, 31)
    assert target.read().count() == copied                   # the target keeps its rows
    marked = ledger.read().agg(F.min("is_source_delete")).first()[0]
    assert marked == 1
    # a second pass finds nothing left to delete
    again = house_keeping(spark, orders_task(3, housekeeping=1), source, ledger, "2000-02-03 00:00:00",
                          start_days=60, end_days=14)
    assert again["ids"] == 0 and source.read().count() == orders.count() - copied


def test_store_schema_is_add_only_across_commits(spark, scratch):
    st = TableStore(spark, scratch("evolve"))
    st.commit(spark.createDataFrame([(1, "a", 1)], "k int, v string, partition_num long"))
    st.commit(spark.createDataFrame([(2, "b", 7, 2)], "k int, v string, n int, partition_num long"))
    rows = sorted((r["k"], r["v"], r["n"]) for r in st.read().collect())
    assert rows == [(1, "a", None), (2, "b", 7)]
    # a later commit without the column keeps it in the table (NULL in the new rows)
    st.commit(spark.createDataFrame([(3, "c", 3)], "k int, v string, partition_num long"))
    assert st.read().columns == ["k", "v", "partition_num", "n"]     # added columns go last
    assert sorted((r["k"], r["n"]) for r in st.read().collect()) == [(1, None), (2, 7), (3, None)]


def test_read_table_formats_and_views(spark, tmp_path):
    from tidesync.sources.tables import read_query, read_table, register_views
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for fmt in ("csv", "json", "orc", "parquet"):
        p = str(tmp_path / fmt)
        w = df.write.mode("overwrite").format(fmt)
        (w.option("header", True) if fmt == "csv" else w).save(p)
        spec = {"format": fmt, "path": p, "schema": df.schema, "columns": ["v"],
                "options": {"header": "true"} if fmt == "csv" else {}}
        assert sorted(r["v"] for r in read_table(spark, spec).collect()) == ["a", "b"]
    views = register_views(spark, SF_SMOKE, ["nation", "region"])
    got = read_query(spark, "SELECT count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").first()
    assert got["n"] == views["nation"].count()


def test_vacuum_keeps_what_recent_commits_reference(spark, scratch):
    st = TableStore(spark, scratch("vacuum"))
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string, partition_num long")
    st.commit(mk([(1, "a", 1), (2, "b", 2)]))
    st.commit(mk([(1, "a2", 1)]), touched=["1/0"])           # unit 1/0 rewritten: its v1 is garbage later
    st.commit(mk([(1, "a3", 1)]), touched=["1/0"])
    before = sorted((r["k"], r["v"]) for r in st.read().collect())
    res = st.vacuum(keep=1)
    assert res == {"states": 2, "folders": 2}                # unit 1/0 at v1 and v2
    assert sorted((r["k"], r["v"]) for r in st.read().collect()) == before
    assert st.vacuum(keep=1) == {"states": 0, "folders": 0}


def test_type3_runs_progress_when_one_timestamp_exceeds_the_cap(spark, scratch):
    # 12 rows share one timestamp and the run cap is 5: every run must still move forward, and a
    # late row at the watermark's timestamp (lower id) is still picked up
    ts = datetime(2024, 1, 1)
    rows = [(i, ts) for i in range(1, 13)] + [(20, datetime(2024, 1, 2))]
    src = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    store = TableStore(spark, scratch("stall"))
    task = lambda: SyncTask(source_table_id=9, source_db="s", source_table="t", target_db="d",
                            target_table="t", etl_type=3, sync_field="id, ts", pk_field="id", id_field_name="id",
                            timestamp_field_name="ts", batch_size=5, max_loop_count=1, partition_size=1000)
    counts = []
    for _ in range(3):
        run_task(spark, task(), src, store, as_of="2024-02-01 00:00:00")
        counts.append(store.read().count())
    assert counts == [5, 10, 13]
    # a row arriving late at the watermark's timestamp (2024-01-02) with a lower id than the last read
    late = src.unionByName(spark.createDataFrame([(15, datetime(2024, 1, 2))], "id long, ts timestamp_ntz"))
    run_task(spark, task(), late, store, as_of="2024-02-01 00:00:00")
    assert store.read().count() == 14


def test_failed_attempt_files_never_leak_into_the_retry(spark, scratch):
    # the first attempt writes its data folders, then dies before the state file; the retry takes
    # the same version number and must not pick up the dead attempt's files
    root = scratch("retry")
    st = TableStore(spark, root)
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string, partition_num long")
    st.commit(mk([(1, "a", 1)]))
    real = st._fs.write_new
    st._fs.write_new = lambda rel, text: (_ for _ in ()).throw(RuntimeError("driver lost"))
    with pytest.raises(RuntimeError):
        st.commit(mk([(2, "dead", 1)]), touched=["1/0"])
    st._fs.write_new = real
    st.commit(mk([(1, "a", 1), (3, "retry", 1)]), touched=["1/0"])
    assert sorted((r["k"], r["v"]) for r in st.read().collect()) == [(1, "a"), (3, "retry")]
    assert st.vacuum(keep=1)["folders"] == 2          # the first version and the dead attempt
    assert sorted((r["k"], r["v"]) for r in st.read().collect()) == [(1, "a"), (3, "retry")]


def test_log_and_ledger_published_after_a_crash_following_the_data_commit(spark, scratch):
    orders = table(spark, SF_SMOKE, "orders")
    root = scratch("pending")
    store, log, ledger = (TableStore(spark, f"{root}/{n}") for n in ("d", "l", "g"))
    real = ledger.publish
    ledger.publish = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost"))
    with pytest.raises(RuntimeError):
        run_task(spark, orders_task(housekeeping=1), orders, store, log, ledger, as_of="2001-08-10 00:00:00")
    assert store.read().count() == orders.count() and ledger.version() == 0   # data in, ledger not yet
    ledger.publish = real
    again = run_task(spark, orders_task(housekeeping=1), orders, store, log, ledger, as_of="2001-08-11 00:00:00")
    assert again.rows == 0                                                     # nothing new to read...
    assert ledger.read().select(F.explode("ids")).count() == orders.count()    # ...but the ledger is complete
    assert log.read().count() == store.read().select("partition_num").distinct().count()


def test_stream_later_files_update_earlier_keys(spark, scratch):
    import time as _time
    root = scratch("stream_upd")
    schema = "id long, v string, ts timestamp_ntz"
    first = spark.createDataFrame([(i, "v1", datetime(2024, 1, 1)) for i in range(10)], schema)
    second = spark.createDataFrame([(i, "v2", datetime(2024, 1, 2)) for i in range(5, 15)], schema)
    first.coalesce(1).write.parquet(f"{root}/in/a")
    _time.sleep(1.1)                      # the file source orders files by modification time
    second.coalesce(1).write.mode("append").parquet(f"{root}/in/a")
    store = TableStore(spark, f"{root}/out")
    stream_sync(spark, f"{root}/in/a", first.schema, store, f"{root}/ckpt", keys=["id"], id_col="id",
                partition_size=1000, order=["ts"], max_files_per_trigger=1)
    got = {r["id"]: r["v"] for r in store.read().collect()}
    assert got == {**{i: "v1" for i in range(5)}, **{i: "v2" for i in range(5, 15)}}
    assert list(store.state()["extra"]["epochs"].values()) == [1]          # two micro-batches


def test_audit_time_set_on_insert_and_kept_on_update(spark, scratch):
    schema = "id long, ts timestamp_ntz, v string"
    v1 = spark.createDataFrame([(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 2), "b")], schema)
    store = TableStore(spark, scratch("audit"))
    task = lambda: SyncTask(source_table_id=5, source_db="s", source_table="t", target_db="d",
                            target_table="t", etl_type=2, sync_field="id, ts, v", pk_field="id", id_field_name="id",
                            timestamp_field_name="ts", partition_size=1000)
    run_task(spark, task(), v1, store, as_of="2024-01-10 00:00:00")
    # row 1 changes (newer ts), row 3 is new
    v2 = spark.createDataFrame([(1, datetime(2024, 1, 5), "a2"), (2, datetime(2024, 1, 2), "b"),
                                (3, datetime(2024, 1, 6), "c")], schema)
    r = run_task(spark, task(), v2, store, as_of="2024-01-20 00:00:00")
    assert r.rows == 2
    got = {x["id"]: (x["v"], x["etl_update_time"]) for x in store.read().collect()}
    assert got == {1: ("a2", datetime(2024, 1, 10)), 2: ("b", datetime(2024, 1, 10)),
                   3: ("c", datetime(2024, 1, 20))}


def test_procedure_type4_reads_the_whole_table_each_run(spark, scratch):
    from tidesync.plans.e2e import procedure_source, procedure_task
    from tidesync.plans.run import run_procedure_task
    orders = table(spark, SF_SMOKE, "orders")
    src, n = procedure_source(orders), orders.count()
    store = TableStore(spark, scratch("sp4"))
    task = {**procedure_task(4, 2), "batch_size": 100, "max_loop_count": 3}
    for day in ("2001-08-10 00:00:00", "2001-08-11 00:00:00"):
        run = run_procedure_task(spark, task, src, store, (), as_of=day, source_host="h")
        assert run.rows == n and run.watermark == {}
    rows = store.read().collect()
    assert len(rows) == n and {r["inserttime"] for r in rows} == {datetime(2001, 8, 11)}      # every column set again


def test_cap_at_the_edge_of_the_key_type(spark):
    from tidesync.operators.extract import capped_extract, capped_with_ties
    top = 2**31 - 1
    df = spark.createDataFrame([(top - i // 2,) for i in range(400)], "k int")
    got = [r["k"] for r in capped_extract(df, ["k"], 390, topk_limit=5, buckets=4).collect()]
    assert sorted(got) == sorted(r["k"] for r in df.collect())[:390]
    assert capped_with_ties(df, ["k"], 389).count() == 390


def test_replay_after_vacuum_keeps_later_marks(spark, scratch):
    root = scratch("replay")
    store, source, ledger = (TableStore(spark, f"{root}/{n}") for n in ("data", "source", "ledger"))
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1), "a") for i in range(1, 21)], "id long, ts timestamp_ntz, v string")
    source.commit(rows.withColumn("partition_num", F.lit(1).cast("long")))
    job = lambda: SyncTask(source_table_id=1, source_db="s", source_table="t", target_db="d", target_table="t",
                           etl_type=2, sync_field="id, ts, v", pk_field="id", id_field_name="id",
                           timestamp_field_name="ts", batch_size=10, max_loop_count=10, partition_size=1000,
                           if_need_house_keeping=1)
    run_task(spark, job(), rows, store, None, ledger, as_of="2024-01-10 00:00:00")
    house_keeping(spark, job(), source, ledger, "2024-02-10 00:00:00", target_store=store)
    ledger.vacuum(keep=1)
    run_task(spark, job(), rows, store, None, ledger, as_of="2024-02-11 00:00:00")
    assert {r["is_source_delete"] for r in ledger.read().collect()} == {1}
    assert source.read().count() == 0


def test_rules_from_json_file_apply(spark, tmp_path):
    from tidesync.functions.rules import apply_rules, unsigned_to_bytes
    p = _write(tmp_path, "rules2.json", json.dumps([
        {"target_db": "dw", "target_table": "t", "column_name": "flag", "original_data_type": "Boolean",
         "covert_data_type": "bit"},
        {"target_db": "dw", "target_table": "t", "column_name": "rv", "original_data_type": "timestamp",
         "covert_data_type": "bigint"}]))
    df = spark.range(3).select(F.col("id"), (F.col("id") == 1).alias("flag"), unsigned_to_bytes("id").alias("rv"))
    out = {r["id"]: (r["flag"], int(r["rv"])) for r in apply_rules(df, read_rules(spark, str(p)), "dw", "t").collect()}
    assert out == {0: (0, 0), 1: (1, 1), 2: (0, 2)}


def test_stream_keeps_the_shard_log(spark, scratch):
    root = scratch("stream_log")
    ev = table(spark, SF_SMOKE, "events")
    ev.repartition(3, "event_id").write.parquet(f"{root}/in")
    store, log = TableStore(spark, f"{root}/out"), TableStore(spark, f"{root}/log")
    stream_sync(spark, f"{root}/in", ev.schema, store, f"{root}/ckpt", keys=["event_id"], id_col="event_id",
                partition_size=100, order=["ts"], log_store=log, ts_col="ts")
    lg = {r["shard_id"]: r for r in log.read().collect()}
    want = {r["p"]: r for r in ev.groupBy(((F.col("event_id") / 100).cast("long") + 1).alias("p"))
            .agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"), F.min("ts").alias("t0")).collect()}
    assert set(lg) == set(want)
    assert all(lg[p]["min_id"] == want[p]["lo"] and lg[p]["max_id"] == want[p]["hi"]
               and lg[p]["min_timestamp"] == want[p]["t0"] for p in want)


@pytest.mark.parametrize("orders", [15, 17])                 # odd lines end at a run's cap; within a run
def test_copied_and_expired_goes_on_past_the_cap_of_a_run(spark, monkeypatch, orders):
    from tidesync.plans import e2e
    monkeypatch.setattr(e2e, "SyncTask", lambda **task: SyncTask(**{**task, "batch_size": 5, "max_loop_count": 2}))
    lines = [(k, n, datetime(2000, 1, 1 + n)) for k in range(orders) for n in range(1, 5)]
    source = spark.createDataFrame(lines, "k long, n int, ts timestamp_ntz")
    store, kept = e2e.copied_and_expired(spark, "capped_lines", source, ["k", "n"], source.filter("n % 2 = 1"))
    assert sorted(tuple(r) for r in store.read().select("k", "n", "ts").collect()) == [r for r in lines if r[1] % 2]
    assert sorted(tuple(r) for r in kept.read().select("k", "n", "ts").collect()) == [r for r in lines if not r[1] % 2]


def test_copied_and_expired_text_keys_past_the_cap(spark, monkeypatch):
    from tidesync.plans import e2e
    monkeypatch.setattr(e2e, "SyncTask", lambda **task: SyncTask(**{**task, "batch_size": 5, "max_loop_count": 2}))
    day = datetime(2000, 1, 1)
    names = [f"name {i // 2:03d}" for i in range(35)] + [None]          # twice each: ties go with their run's last key
    people = spark.createDataFrame([(n, day) for n in names], "name string, ts timestamp_ntz")
    store, kept = e2e.copied_and_expired(spark, "capped_names", people, ["name"], people)
    assert sorted(r["name"] for r in store.read().collect()) == sorted({n for n in names if n})
    assert [r["name"] for r in kept.read().collect()] == [None]
