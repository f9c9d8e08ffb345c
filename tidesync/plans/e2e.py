"""End-to-end queries: whole sync runs, house-keeping and the streaming front, each writing its
tables to a fresh folder under the shared checkpoint folder and returning what it committed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SyncTask
from ..session import scratch_path
from ..streaming.stream import stream_sync
from . import derived as D
from .catalog import _CRC32_NAMES, _GATE_SQL, register
from .commit import TableStore
from .run import house_keeping, run_task

# A run cap of a third of the rows, so that three runs read any table to its end.
def third(df) -> int:
    return -(-df.count() // 3)


# Times of three runs; the oracles tell the first run from the later ones.
DAYS = ("2001-08-10 00:00:00", "2001-08-11 00:00:00", "2001-08-11 00:00:00")

_ORD5 = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


def orders_task(etl_type: int = 2, batch_size: int = 1000, loops: int = 5, housekeeping: int = 0) -> SyncTask:
    return SyncTask(source_table_id=1, source_db="src_db", source_table="orders", target_db="dw",
                    target_table="orders_t", etl_type=etl_type, sync_field=_ORD5, pk_field="o_orderkey",
                    id_field_name="o_orderkey", timestamp_field_name="o_orderdate", batch_size=batch_size,
                    max_loop_count=loops, partition_size=1000, if_need_house_keeping=housekeeping)


@register("sync_run", f"""
SELECT {_ORD5}, o_orderkey // 1000 + 1 AS partition_num,
       CASE WHEN rn <= (SELECT ceil(count(*) / 3) FROM orders) THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS etl_update_time
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""")
def q_sync_run(spark, sf):
    """Three type-2 runs of a task capped at a third of the rows, with log and ledger: each continues at the watermark."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "sync_run")
    store, log, ledger = (TableStore(spark, f"{root}/{n}") for n in ("data", "log", "ledger"))
    cap = third(orders)
    for day in DAYS:
        run_task(spark, orders_task(batch_size=cap, loops=1, housekeeping=1), orders, store, log, ledger, as_of=day)
    return store.read()


@register("sync_run_full", f"""
SELECT {_ORD5}, CAST(0 AS BIGINT) AS partition_num, TIMESTAMP '2001-08-11' AS etl_update_time FROM orders""")
def q_sync_run_full(spark, sf):
    """Type 4: truncate and load, run twice (the second run replaces the first's rows)."""
    orders = D.table(spark, sf, "orders")
    store = TableStore(spark, scratch_path(spark, "sync_full"))
    run_task(spark, orders_task(4), orders.filter(F.col("o_orderstatus") == "F"), store, as_of="2001-08-10 00:00:00")
    run_task(spark, orders_task(4), orders, store, as_of="2001-08-11 00:00:00")
    return store.read()


@register("housekeeping_run", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_orderkey // 1000 + 1 AS partition_num FROM orders
WHERE o_orderstatus <> 'F' AND o_orderkey // 10 NOT IN ({_GATE_SQL})""")
def q_housekeeping_run(spark, sf):
    """Retention end to end: ledger window -> expiry gate -> delete (commit) -> mark ledger."""
    from ..functions.routing import with_partition_num
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "housekeeping")
    source, ledger = TableStore(spark, f"{root}/source"), TableStore(spark, f"{root}/ledger")
    source.commit(with_partition_num(D.retention_source(orders), "o_orderkey", 1000))
    ledger.commit(D.ledger(orders).withColumn("partition_num", F.col("load_version")))
    house_keeping(spark, orders_task(housekeeping=1), source, ledger, D.ORDERS_AS_OF, start_days=60, end_days=0)
    return source.read()


def dated_source(orders, root, spark):
    """orders as six loads by year into a table that keeps zones of (date, key) and the key sets of its units."""
    store = TableStore(spark, root, zones=["o_orderdate", "o_orderkey"], key="o_orderkey")
    year = F.year("o_orderdate")
    for y in range(1995, 2001):
        part = orders.filter(year == y) if y < 2000 else orders.filter(year >= y)
        store.commit(part.withColumn("partition_num", F.lit(1).cast("long")), bucket=F.lit(y), cluster_by=["o_orderdate", "o_orderkey"])
    return store


@register("zone_pruned_extract", f"""
SELECT {_ORD5} FROM orders WHERE (o_orderdate > TIMESTAMP '1999-06-01' OR (o_orderdate = TIMESTAMP '1999-06-01' AND o_orderkey > 700))
  AND o_orderdate < TIMESTAMP '2001-07-29'""")
def q_zone_pruned_extract(spark, sf):
    """B3 from a table with zones: files that end before the watermark or begin after the lag are not opened."""
    from ..operators import extract as X
    store = dated_source(D.table(spark, sf, "orders"), scratch_path(spark, "zones"), spark)
    src = store.read_where({"o_orderdate": ("1999-06-01 00:00:00", X.lag_cutoff("2001-08-01 12:00:00"))})
    if len(src.inputFiles()) >= len(store.read().inputFiles()):
        raise RuntimeError("the zones pruned no file")
    return X.extract_lagged(src, "o_orderdate", "o_orderkey", "1999-06-01 00:00:00", 700, as_of="2001-08-01 12:00:00").select(
        *_ORD5.split(", "))


@register("sync_run_zones", f"""
SELECT {_ORD5}, o_orderkey // 1000000000 + 1 AS partition_num,
       CASE WHEN rn <= (SELECT ceil(count(*) / 3) FROM orders) THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS etl_update_time
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""")
def q_sync_run_zones(spark, sf):
    """Three capped runs from a table with zones: each opens only the files from its watermark on."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "sync_zones")
    source, store = dated_source(orders, f"{root}/source", spark), TableStore(spark, f"{root}/data")
    for day in DAYS:
        task = production_task(housekeeping=0)
        task.batch_size, task.max_loop_count = third(orders), 1
        run_task(spark, task, source, store, as_of=day)
    return store.read()


@register("filtered_delete", f"""
SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
WHERE o_orderstatus <> 'F' AND o_orderkey // 10 NOT IN ({_GATE_SQL})""")
def q_filtered_delete(spark, sf):
    """House-keeping on a source with zones and key sets: the gate opens files with recent rows only, the delete the
    units whose key set meets the deleted keys."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "filtered_delete")
    source = dated_source(D.retention_source(orders), f"{root}/source", spark)
    ledger = TableStore(spark, f"{root}/ledger")
    ledger.commit(D.ledger(orders).withColumn("partition_num", F.col("load_version")))
    house_keeping(spark, orders_task(housekeeping=1), source, ledger, D.ORDERS_AS_OF, start_days=60, end_days=0)
    return source.read().select("o_orderkey", "o_orderdate", "o_orderstatus")


@register("housekeeping_compacted", f"""
SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
WHERE o_orderstatus <> 'F' AND o_orderkey // 10 NOT IN ({_GATE_SQL})""")
def q_housekeeping_compacted(spark, sf):
    """House-keeping that compacts what it rewrote, clustered on date and key; twice, the second time over the
    compacted units."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "housekeeping_compacted")
    source = dated_source(D.retention_source(orders), f"{root}/source", spark)
    ledger = TableStore(spark, f"{root}/ledger")
    ledger.commit(D.ledger(orders).withColumn("partition_num", F.col("load_version")))
    for _ in range(2):
        house_keeping(spark, orders_task(housekeeping=1), source, ledger, D.ORDERS_AS_OF, start_days=60, end_days=0, compact=True)
    return source.read().select("o_orderkey", "o_orderdate", "o_orderstatus")


@register("stream_shard_log", """
SELECT 'events_t_' || (event_id // 1000 + 1) AS sharding_table_name, min(event_id) AS min_id, max(event_id) AS max_id,
       min(ts) AS min_timestamp, max(ts) AS max_timestamp, count(*) AS n_rows FROM events GROUP BY 1""")
def q_stream_shard_log(spark, sf):
    """The shard log as a streaming aggregate with its own state, stopped in the middle and started again."""
    from ..streaming.shard_log import stream_shard_log
    events = D.table(spark, sf, "events")
    root = scratch_path(spark, "stream_log")
    log = TableStore(spark, f"{root}/log")
    early = F.col("ts") < D.ts_literal(D.EVENTS_WATERMARK)
    for part in (events.filter(early), events.filter(~early)):
        part.repartition(3, "event_id").write.mode("append").parquet(f"{root}/in")
        stream_shard_log(spark, f"{root}/in", events.schema, log, f"{root}/ckpt", "event_id", "ts", 1000, "events_t", "src_db", "events")
    return log.read().select("sharding_table_name", "min_id", "max_id", "min_timestamp", "max_timestamp", "n_rows")


# Events come in four parts, by week. Ids of the first week that 7 divides come with the last part only, long past the lag, and
# all ids of that week that 11 divides once more. Ids of a week's last two days that 3 divides are sent again with the next part,
# at their old time and, 13 hours on, with a new value.
WEEKS = ["2024-01-08", "2024-01-15", "2024-01-22"]
_LAGGED = f"""
SELECT *, NOT renewed AND ts < TIMESTAMP '{WEEKS[0]}' AND event_id % 7 = 0 AS late FROM (
    SELECT event_id, ts, value, event_id % 3 = 0 AND ({" OR ".join(
        f"ts >= TIMESTAMP '{w}' - INTERVAL '2' DAY AND ts < TIMESTAMP '{w}'" for w in WEEKS)}) AS renewed FROM events)"""


@register("stream_lagged", f"""
SELECT event_id, CASE WHEN renewed THEN ts + INTERVAL '13' HOUR ELSE ts END AS ts, CASE WHEN renewed THEN -1.0 ELSE value END AS value,
       CASE WHEN late THEN 'late' ELSE 'loaded' END AS how FROM ({_LAGGED})""")
def q_stream_lagged(spark, sf):
    """A stream with a settle lag of three days in event time, stopped and started again after each part: rows that come
    later go to the late table, copies nowhere, newer versions replace older ones; loaded and late rows are the source."""
    from ..streaming.lagged import stream_lagged
    root = scratch_path(spark, "stream_lagged")
    week = sum((F.col("ts") >= D.ts_literal(f"{w} 00:00:00")).cast("int") for w in WEEKS)
    ends = F.array(*[D.ts_literal(f"{w} 00:00:00") for w in WEEKS])
    renewed = (F.col("event_id") % 3 == 0) & (F.col("week") < 3) & (F.col("ts") >= F.get(ends, F.col("week")) - F.expr("interval 2 days"))
    rows = (D.table(spark, sf, "events").select("event_id", "ts", "value").withColumn("week", week)
            .withColumn("renewed", F.coalesce(renewed, F.lit(False)))
            .withColumn("late", ~F.col("renewed") & (F.col("week") == 0) & (F.col("event_id") % 7 == 0)))
    store, late = TableStore(spark, f"{root}/out"), TableStore(spark, f"{root}/late")
    for part in range(4):
        again = rows.filter(F.col("renewed") & (F.col("week") == part - 1))
        sent = [rows.filter((F.col("week") == part) & ~F.col("late")), again,
                again.withColumns({"ts": F.col("ts") + F.expr("interval 13 hours"), "value": F.lit(-1.0)})]
        if part == 3:
            sent += [rows.filter("late"), rows.filter("week = 0 AND event_id % 11 = 0")]
        reduce(DataFrame.unionByName, sent).select("event_id", "ts", "value").write.mode("append").parquet(f"{root}/in")
        stream_lagged(spark, f"{root}/in", rows.select("event_id", "ts", "value").schema, store, late, f"{root}/ckpt", ["event_id"],
                      "event_id", "ts", 1_000_000_000, max_files_per_trigger=1_000_000)
    came_late = late.read().select(F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                                   F.col("value").cast("double").alias("value"), F.col("reject_column").alias("how"))
    return store.read().select("event_id", "ts", "value", F.lit("loaded").alias("how")).unionByName(came_late)


@register("housekeeping_bitmap", f"""
SELECT {_ORD5} FROM orders WHERE o_orderkey // 600 IN (SELECT o_orderkey // 600 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-27')""")
def q_housekeeping_bitmap(spark, sf):
    """Sync with a ledger of bitmaps, then house-keeping by it, end to end: entries of 600 keys, all or nothing."""
    orders = D.table(spark, sf, "orders").select(*_ORD5.split(", "))
    root = scratch_path(spark, "housekeeping_bitmap")
    source = dated_source(orders, f"{root}/source", spark)
    store, ledger = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/ledger")
    task = lambda: orders_task(batch_size=600, loops=1_000_000, housekeeping=1)
    run_task(spark, task(), source, store, None, ledger, as_of="2001-07-20 00:00:00", bitmap_ledger=True)
    house_keeping(spark, task(), source, ledger, "2001-08-10 00:00:00", target_store=store)
    return source.read().select(*_ORD5.split(", "))


@register("stream_sync", """
SELECT event_id, ts, user_id, event_type, value, props, event_id // 1000 + 1 AS partition_num FROM events""")
def q_stream_sync(spark, sf):
    """events arrive as four files; an availableNow stream loads one file per micro-batch."""
    events = D.table(spark, sf, "events")
    root = scratch_path(spark, "stream")
    events.repartition(4, "event_id").write.parquet(f"{root}/in")
    store = TableStore(spark, f"{root}/out")
    stream_sync(spark, f"{root}/in", events.schema, store, f"{root}/_ckpt", keys=["event_id"], id_col="event_id",
                partition_size=1000, order=["ts"], max_files_per_trigger=1)
    return store.read()


def production_task(etl_type: int = 2, housekeeping: int = 1) -> SyncTask:
    """The production shape of a table-sync task: 10,000 rows x 1,500 loops, 1e9 ids per shard."""
    task = orders_task(etl_type, batch_size=10_000, loops=1_500, housekeeping=housekeeping)
    task.partition_size = 1_000_000_000
    return task


@register("sync_run_production", f"""
SELECT {_ORD5}, o_orderkey // 1000000000 + 1 AS partition_num,
       CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END
         AS etl_update_time FROM orders""")
def q_sync_run_production(spark, sf):
    """Initial load of the orders before 2000, then an incremental run that adds the rest."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "sync_prod")
    store, log, ledger = (TableStore(spark, f"{root}/{n}") for n in ("data", "log", "ledger"))
    run_task(spark, production_task(), orders.filter(F.col("o_orderdate") < D.ts_literal("2000-01-01 00:00:00")),
             store, log, ledger, as_of="2001-08-10 00:00:00")
    run_task(spark, production_task(), orders, store, log, ledger, as_of="2001-08-11 00:00:00")
    return store.read()


@register("sync_run_deltas", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 10 YEAR ELSE o_orderdate END AS o_orderdate,
       o_orderkey // 1000000000 + 1 AS partition_num,
       CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS etl_update_time
FROM orders""")
def q_sync_run_deltas(spark, sf):
    """Production runs that write deltas: the first loads, the second adds rows, the third updates a part of all; the
    table reads as if every run had rewritten its units."""
    orders = D.table(spark, sf, "orders")
    later = orders.filter("o_orderstatus = 'F'").withColumns({
        "o_totalprice": F.col("o_totalprice") + 1, "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 10 YEAR")})
    root = scratch_path(spark, "sync_deltas")
    store, log, ledger = (TableStore(spark, f"{root}/{n}") for n in ("data", "log", "ledger"))
    for day, rows in (("2001-08-10 00:00:00", orders.filter(F.col("o_orderdate") < D.ts_literal("2000-01-01 00:00:00"))),
                      ("2001-08-11 00:00:00", orders), ("2001-08-12 00:00:00", orders.unionByName(later))):
        run_task(spark, production_task(), rows, store, log, ledger, as_of=day, deltas=True)
    if not store.state()["deltas"]:
        raise RuntimeError("no delta was written")
    return store.read()


def procedure_source(orders):
    """A procedure result derived from orders: a zero-padded code, 'Null' tokens, a boolean flag
    and an 8-byte rowversion."""
    from ..functions.rules import unsigned_to_bytes
    return orders.select(
        "o_orderkey", "o_custkey",
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("cust_code"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Null")).otherwise(F.col("o_orderpriority")).alias("priority"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
        unsigned_to_bytes("o_orderkey").alias("rv"))


def procedure_task(etl_type: int = 1, arg_counts: int = 2) -> dict:
    return {"source_table_id": 1, "source_db": "src_db", "source_table": "orders", "source_sp": "sp_orders",
            "etl_type": etl_type, "arg_counts": arg_counts, "target_db": "dw", "target_table": "orders_sp",
            "pk_field": "o_orderkey", "sync_field": "o_orderkey, o_custkey, cust_code, priority, is_urgent, rv",
            "max_loop_count": 5, "batch_size": 1000, "id_field_name_1": "o_orderkey", "last_id_sync_record_1": 0,
            "id_field_name_2": None, "last_id_sync_record_2": None, "timestamp_field_name": "rv",
            "last_timestamp_sync_record": None}


# Fixed rule list of the procedure check: a bit rule and a rowversion rule for dw.orders_sp.
PROCEDURE_RULES = [
    {"target_db": "dw", "target_table": "orders_sp", "column_name": "is_urgent", "original_data_type": "Boolean",
     "covert_data_type": "bit"},
    {"target_db": "dw", "target_table": "orders_sp", "column_name": "rv", "original_data_type": "timestamp",
     "covert_data_type": "bigint"},
]

_SP_ROWS = """
SELECT o_orderkey, o_custkey, CASE WHEN ltrim(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), '0') = '' THEN '0'
         ELSE ltrim(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), '0') END AS cust_code,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_urgent,
       CAST(o_orderkey AS DECIMAL(20,0)) AS rv, 'src-host' AS SourceHost, 'src_db' AS SourceDB"""


@register("procedure_sync_run", f"""
SELECT *, CASE WHEN rn <= (SELECT ceil(count(*) / 3) FROM orders) THEN TIMESTAMP '2001-08-10 00:00:00' ELSE TIMESTAMP '2001-08-11 00:00:00' END
          AS inserttime, o_orderkey // 1000000000 + 1 AS partition_num
FROM ({_SP_ROWS}, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)""".replace(
    "SELECT *,", "SELECT o_orderkey, o_custkey, cust_code, priority, is_urgent, rv, SourceHost, SourceDB,"))
def q_procedure_sync_run(spark, sf):
    """Three procedure-sync runs (type 1, one id, a third of the rows each) with rules and clean-up."""
    from .run import run_procedure_task
    src = procedure_source(D.table(spark, sf, "orders"))
    store = TableStore(spark, scratch_path(spark, "procedure"))
    task = {**procedure_task(), "batch_size": third(src), "max_loop_count": 1}
    for day in DAYS:
        run_procedure_task(spark, task, src, store, PROCEDURE_RULES, as_of=day, source_host="src-host")
    return store.read()


@register("sync_run_by_id", """
SELECT event_id, ts, user_id, event_type, value, event_id // 1000 + 1 AS partition_num,
       TIMESTAMP '2024-02-01' AS etl_update_time FROM events""")
def q_sync_run_by_id(spark, sf):
    """Three type-1 runs over events (a third each); a new task starts at the first id."""
    ev = D.table(spark, sf, "events")
    task = SyncTask(source_table_id=2, source_db="src_db", source_table="events", target_db="dw",
                    target_table="events_t", etl_type=1, sync_field="event_id, ts, user_id, event_type, value",
                    pk_field="event_id", id_field_name="event_id", batch_size=third(ev), max_loop_count=1,
                    partition_size=1000)
    store = TableStore(spark, scratch_path(spark, "sync_by_id"))
    for _ in range(3):
        run_task(spark, SyncTask(**{**task.__dict__}), ev, store, as_of="2024-02-01 00:00:00")
    return store.read()


@register("sync_run_lagged", f"""
SELECT {_ORD5}, o_orderkey // 1000 + 1 AS partition_num, TIMESTAMP '2001-08-01 12:00:00' AS etl_update_time
FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-29'""")
def q_sync_run_lagged(spark, sf):
    """Three type-3 runs (3-day settle lag), a third of the rows each past the watermark; the later ones
    also re-read the rows at their watermark's timestamp (harmless through the upsert)."""
    orders = D.table(spark, sf, "orders")
    store = TableStore(spark, scratch_path(spark, "sync_lagged"))
    cap = third(orders)
    for _ in range(3):
        run_task(spark, orders_task(3, batch_size=cap, loops=1), orders, store, as_of="2001-08-01 12:00:00")
    return store.read()


@register("sync_run_drift", f"""
SELECT {_ORD5}, CASE WHEN rn <= (SELECT ceil(count(*) / 3) FROM orders) THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderkey // 1000 + 1 AS partition_num,
       CASE WHEN rn <= (SELECT ceil(count(*) / 3) FROM orders) THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS etl_update_time
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""")
def q_sync_run_drift(spark, sf):
    """Source drift: the first run sees orders before o_orderpriority existed, the later runs
    refresh sync_field from the source and the target gains the column (add-only)."""
    orders = D.table(spark, sf, "orders")
    store = TableStore(spark, scratch_path(spark, "sync_drift"))
    cap = third(orders)
    first = orders_task(batch_size=cap, loops=1)
    run_task(spark, first, orders.drop("o_orderpriority"), store, as_of="2001-08-10 00:00:00", refresh_fields=True)
    for _ in range(2):
        second = orders_task(batch_size=cap, loops=1)
        second.sync_field = first.sync_field        # the control row as the first run left it
        res = run_task(spark, second, orders, store, as_of="2001-08-11 00:00:00", refresh_fields=True)
    assert "o_orderpriority" in res.sync_field
    return store.read()


def line_pairs(lineitem):
    """A procedure result keyed by two ids: one row per (order, line number) of lineitem."""
    return (lineitem.groupBy("l_orderkey", "l_linenumber")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")))


@register("procedure_sync_two_ids", """
SELECT l_orderkey, l_linenumber, count(*) AS n_lines, sum(l_quantity) AS quantity,
       'src-host' AS SourceHost, 'src_db' AS SourceDB,
       CASE WHEN row_number() OVER (ORDER BY l_orderkey, l_linenumber)
              <= (SELECT ceil(count(*) / 3) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
            THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS inserttime,
       l_orderkey // 1000000000 + 1 AS partition_num
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def q_procedure_sync_two_ids(spark, sf):
    """Three procedure-sync runs keyed by (l_orderkey, l_linenumber): the pair is the watermark."""
    from .run import run_procedure_task
    src = line_pairs(D.table(spark, sf, "lineitem"))
    task = {**procedure_task(1, 3), "source_table": "lines", "target_table": "lines_sp",
            "pk_field": "l_orderkey, l_linenumber", "sync_field": "l_orderkey, l_linenumber, n_lines, quantity",
            "id_field_name_1": "l_orderkey", "id_field_name_2": "l_linenumber", "last_id_sync_record_2": 0,
            "batch_size": third(src), "max_loop_count": 1}
    store = TableStore(spark, scratch_path(spark, "procedure_two"))
    for day in DAYS:
        run_procedure_task(spark, task, src, store, (), as_of=day, source_host="src-host")
    return store.read()


@register("procedure_sync_rowversion", """
SELECT event_id, event_type, CAST(event_id AS DECIMAL(20,0)) AS rv, 'src-host' AS SourceHost, 'src_db' AS SourceDB,
       CASE WHEN row_number() OVER (ORDER BY event_id) <= (SELECT ceil(count(*) / 3) FROM events)
            THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END AS inserttime,
       event_id // 1000000000 + 1 AS partition_num
FROM events""")
def q_procedure_sync_rowversion(spark, sf):
    """Three procedure-sync runs of type 2: the 8-byte rowversion (decoded by the rule) is the watermark."""
    from ..functions.rules import unsigned_to_bytes
    from .run import run_procedure_task
    ev = D.table(spark, sf, "events").select("event_id", "event_type", unsigned_to_bytes("event_id").alias("rv"))
    task = {**procedure_task(2, 2), "source_table": "events", "target_table": "events_sp", "pk_field": "event_id",
            "sync_field": "event_id, event_type, rv", "id_field_name_1": None, "timestamp_field_name": "rv",
            "batch_size": third(ev), "max_loop_count": 1}
    rules = [{"target_db": "dw", "target_table": "events_sp", "column_name": "rv", "original_data_type": "timestamp",
              "covert_data_type": "bigint"}]
    store = TableStore(spark, scratch_path(spark, "procedure_rv"))
    for day in DAYS:
        run_procedure_task(spark, task, ev, store, rules, as_of=day, source_host="src-host")
    return store.read()


# ------------------------------------------------------------------ what a run must not lose

@register("procedure_sync_full", f"""
SELECT o_orderkey, o_custkey, cust_code, priority, is_urgent, rv, SourceHost, SourceDB,
       TIMESTAMP '2001-08-11 00:00:00' AS inserttime, o_orderkey // 1000000000 + 1 AS partition_num
FROM ({_SP_ROWS} FROM orders)""")
def q_procedure_sync_full(spark, sf):
    """Procedure type 4, run twice: the whole table each time, whatever the batch settings."""
    from .run import run_procedure_task
    src = procedure_source(D.table(spark, sf, "orders"))
    store = TableStore(spark, scratch_path(spark, "procedure_full"))
    for day in DAYS[:2]:
        run_procedure_task(spark, procedure_task(4), src, store, PROCEDURE_RULES, as_of=day, source_host="src-host")
    return store.read()


_LINES = "l_orderkey, l_linenumber, l_partkey, l_quantity"


@register("capped_extract_ties", f"""
SELECT {_LINES} FROM lineitem QUALIFY rank() OVER (ORDER BY l_orderkey) <= 20000""")
def q_capped_extract_ties(spark, sf):
    """A capped read on a key that repeats: the ties of the last key come along."""
    from ..operators.extract import capped_with_ties
    return capped_with_ties(D.table(spark, sf, "lineitem"), ["l_orderkey"], 20_000).select(*_LINES.split(", "))


@register("sync_run_ties", f"""
SELECT {_LINES}, l_orderkey // 1000000000 + 1 AS partition_num, TIMESTAMP '2001-08-10' AS etl_update_time FROM lineitem""")
def q_sync_run_ties(spark, sf):
    """Type 1 on an id that repeats, without a key: capped runs until nothing is left read every row once."""
    li = D.table(spark, sf, "lineitem")
    store = TableStore(spark, scratch_path(spark, "sync_ties"))
    cap = third(li)
    while run_task(spark, SyncTask(source_table_id=3, source_db="src_db", source_table="lineitem", target_db="dw",
                                   target_table="lines_t", etl_type=1, sync_field=_LINES, id_field_name="l_orderkey",
                                   batch_size=cap, max_loop_count=1, partition_size=1_000_000_000),
                   li, store, as_of="2001-08-10 00:00:00").rows:
        pass
    return store.read()


@register("sync_run_rejects", """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
       CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, 'key' AS reject_column
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""")
def q_sync_run_rejects(spark, sf):
    """Rows with a NULL id or timestamp: each is in the reject table once, however many runs meet it."""
    orders = D.table(spark, sf, "orders")
    src = orders.withColumns({
        "o_orderkey": F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")),
        "o_orderdate": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))})
    root = scratch_path(spark, "sync_rejects")
    store, bad = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/rejects")
    for day in DAYS[:2]:
        run_task(spark, production_task(housekeeping=0), src, store, as_of=day, reject_store=bad)
    return bad.read().select("o_orderkey", "o_custkey", "o_orderstatus", "reject_column")


@register("sync_run_retyped", f"""
SELECT {_ORD5}, o_orderkey // 1000000000 + 1 AS partition_num,
       CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2001-08-10' ELSE TIMESTAMP '2001-08-11' END
         AS etl_update_time
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus <> 'P'""")
def q_sync_run_retyped(spark, sf):
    """A column turns to text at the source: rows whose value does not fit are rejected, never set to NULL."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "sync_retyped")
    store, bad = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/rejects")
    run_task(spark, production_task(housekeeping=0), orders.filter(F.col("o_orderdate") < D.ts_literal("2000-01-01 00:00:00")),
             store, as_of=DAYS[0], reject_store=bad)
    text = orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") == "P", F.lit("abc"))
                             .otherwise(F.col("o_custkey").cast("string")))
    run_task(spark, production_task(housekeeping=0), text, store, as_of=DAYS[1], reject_store=bad)
    return store.read()


@register("procedure_sync_rejects", """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN 'key' WHEN o_orderpriority = '5-LOW' THEN 'o_custkey' END AS reject_column
FROM orders""")
def q_procedure_sync_rejects(spark, sf):
    """Procedure runs by a key of two columns, either of them NULL in places: what is not loaded (NULL reason) is in
    the reject table once, also where no batch reaches it."""
    from .run import run_procedure_task
    o = D.table(spark, sf, "orders")
    src = procedure_source(o.withColumns({
        "o_orderkey": F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")),
        "o_custkey": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))}))
    root = scratch_path(spark, "procedure_rejects")
    store, bad = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/rejects")
    task = {**procedure_task(), "pk_field": "o_orderkey, o_custkey", "batch_size": third(src), "max_loop_count": 1}
    for day in (*DAYS, DAYS[-1]):
        run_procedure_task(spark, task, src, store, PROCEDURE_RULES, as_of=day, source_host="src-host", reject_store=bad)
    keys = [F.col(k).cast("string").alias(k) for k in ("o_orderkey", "o_custkey")]
    return (store.read().select(*keys, F.lit(None).cast("string").alias("reject_column"))
            .unionByName(bad.read().select(*keys, "reject_column")))


@register("procedure_sync_retyped", """
SELECT o_orderkey, CASE WHEN late AND o_orderstatus = 'P' THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN late AND o_orderstatus = 'P' THEN 'o_custkey' END AS reject_column
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) > (SELECT ceil(count(*) / 3) FROM orders) AS late FROM orders)""")
def q_procedure_sync_retyped(spark, sf):
    """A column turns to text between procedure runs: values that do not fit are rejected, the others loaded in the
    committed type."""
    from .run import run_procedure_task
    src = procedure_source(D.table(spark, sf, "orders"))
    text = src.withColumn("o_custkey", F.when(F.col("priority") == "Null", F.lit("abc")).otherwise(F.col("o_custkey").cast("string")))
    root = scratch_path(spark, "procedure_retyped")
    store, bad = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/rejects")
    task = {**procedure_task(), "batch_size": third(src), "max_loop_count": 1}
    for day, rows in zip(DAYS, (src, text, text), strict=True):
        run_procedure_task(spark, task, rows, store, PROCEDURE_RULES, as_of=day, source_host="src-host", reject_store=bad)
    key, value = F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey")
    return (store.read().select(key, value, F.lit(None).cast("string").alias("reject_column"))
            .unionByName(bad.read().select(key, value, "reject_column")))


@register("stream_retyped", f"""
SELECT event_id, CASE WHEN late AND event_id % 7 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN late AND event_id % 7 = 0 THEN 'value' END AS reject_column
FROM (SELECT *, ts >= TIMESTAMP '{D.EVENTS_WATERMARK}' AS late FROM events)""")
def q_stream_retyped(spark, sf):
    """A second stream brings a column as text: values that do not fit go to the reject table, none becomes NULL."""
    from ..streaming.stream import rejected_rows
    events = D.table(spark, sf, "events").select("event_id", "ts", "value")
    root = scratch_path(spark, "stream_retyped")
    late = F.col("ts") >= D.ts_literal(D.EVENTS_WATERMARK)
    text = events.filter(late).withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    store, bad = TableStore(spark, f"{root}/out"), TableStore(spark, f"{root}/rejects")
    for name, part in (("a", events.filter(~late)), ("b", text)):
        part.repartition(2, "event_id").write.parquet(f"{root}/in_{name}")
        stream_sync(spark, f"{root}/in_{name}", part.schema, store, f"{root}/ckpt_{name}", keys=["event_id"], id_col="event_id",
                    partition_size=1_000_000_000, order=["ts"], reject_store=bad)
    rejected = bad.read().select(F.col("event_id").cast("long").alias("event_id"), F.lit(None).cast("double").alias("value"), "reject_column")
    if rejected.count() != rejected_rows(store):
        raise RuntimeError("the stream's count differs from its reject table")
    return store.read().select("event_id", "value", F.lit(None).cast("string").alias("reject_column")).unionByName(rejected)


@register("sync_run_versions", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN o_totalprice + 1
         ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
       o_orderkey // 1000000000 + 1 AS partition_num, TIMESTAMP '2001-08-10' AS etl_update_time FROM orders""")
def q_sync_run_versions(spark, sf):
    """Two versions of a key in the first increment: the later one is loaded."""
    orders = D.table(spark, sf, "orders")
    second = orders.filter(F.col("o_orderdate") >= D.ts_literal("2001-01-01 00:00:00")).withColumns({
        "o_totalprice": F.col("o_totalprice") + 1, "o_orderdate": F.col("o_orderdate") + F.make_dt_interval(days=F.lit(1))})
    store = TableStore(spark, scratch_path(spark, "sync_versions"))
    run_task(spark, production_task(housekeeping=0), orders.unionByName(second), store, as_of=DAYS[0])
    return store.read()


@register("procedure_rowversion_versions", """
SELECT event_id, 'aaa' AS note, CAST(event_id + 10000000 AS DECIMAL(20,0)) AS rv FROM events""")
def q_procedure_rowversion_versions(spark, sf):
    """Two versions of a row in one increment: the larger rowversion wins, not the larger text."""
    from ..functions.rules import unsigned_to_bytes
    from .run import run_procedure_task
    ev = D.table(spark, sf, "events").select("event_id")
    src = ev.select("event_id", F.lit("zzz").alias("note"), unsigned_to_bytes("event_id").alias("rv")).unionByName(
        ev.withColumn("later", F.col("event_id") + 10_000_000)
        .select("event_id", F.lit("aaa").alias("note"), unsigned_to_bytes("later").alias("rv")))
    task = {**procedure_task(2, 2), "source_table": "events", "target_table": "events_sp", "pk_field": "event_id",
            "sync_field": "event_id, note, rv", "id_field_name_1": None, "timestamp_field_name": "rv",
            "batch_size": 10_000, "max_loop_count": 1_500}
    rules = [{"target_db": "dw", "target_table": "events_sp", "column_name": "rv", "original_data_type": "timestamp",
              "covert_data_type": "bigint"}]
    store = TableStore(spark, scratch_path(spark, "procedure_versions"))
    run_procedure_task(spark, task, src, store, rules, as_of=DAYS[0], source_host="src-host")
    return store.read().select("event_id", "note", "rv")


@register("stream_two_sources", """
SELECT event_id, ts, user_id, event_type, value, props, event_id // 1000 + 1 AS partition_num FROM events""")
def q_stream_two_sources(spark, sf):
    """Two streams with checkpoints of their own fill one table: both count their epochs from 0."""
    events = D.table(spark, sf, "events")
    root = scratch_path(spark, "two_streams")
    early = F.col("ts") < D.ts_literal(D.EVENTS_WATERMARK)
    store = TableStore(spark, f"{root}/out")
    for name, part in (("a", events.filter(early)), ("b", events.filter(~early))):
        part.repartition(2, "event_id").write.parquet(f"{root}/in_{name}")
        stream_sync(spark, f"{root}/in_{name}", events.schema, store, f"{root}/ckpt_{name}", keys=["event_id"],
                    id_col="event_id", partition_size=1000, order=["ts"])
    return store.read()


@register("sync_housekeep_sync_ledger", """
SELECT o_orderkey // 10 AS house_keeping_id, count(*) AS n_ids,
       CASE WHEN max(o_orderdate) >= TIMESTAMP '2001-07-27' THEN 0 ELSE 1 END AS is_source_delete
FROM orders GROUP BY 1""")
def q_sync_housekeep_sync_ledger(spark, sf):
    """Sync, house-keeping, sync again: the marks of the ledger stay."""
    orders = D.table(spark, sf, "orders")
    root = scratch_path(spark, "housekeep_sync")
    store, source, ledger = (TableStore(spark, f"{root}/{n}") for n in ("data", "source", "ledger"))
    source.commit(orders.withColumn("partition_num", F.lit(1).cast("long")))
    task = lambda: orders_task(batch_size=10, loops=1_000_000, housekeeping=1)
    run_task(spark, task(), source.read().drop("partition_num"), store, None, ledger, as_of="2001-07-01 00:00:00")
    house_keeping(spark, task(), source, ledger, "2001-08-10 00:00:00", target_store=store)
    run_task(spark, task(), source.read().drop("partition_num"), store, None, ledger, as_of="2001-08-11 00:00:00")
    return ledger.read().select("house_keeping_id", F.size("ids").cast("long").alias("n_ids"), "is_source_delete")


def two_tasks(spark, sf):
    """The orders and the events task, with one log and one ledger."""
    root = scratch_path(spark, "two_tasks")
    log, ledger = TableStore(spark, f"{root}/log"), TableStore(spark, f"{root}/ledger")
    events = SyncTask(source_table_id=2, source_db="src_db", source_table="events", target_db="dw", target_table="events_t",
                      etl_type=2, sync_field="event_id, ts, user_id", pk_field="event_id", id_field_name="event_id",
                      timestamp_field_name="ts", batch_size=10_000, max_loop_count=1_500, partition_size=1_000_000_000,
                      if_need_house_keeping=1)
    for name, task in (("orders", production_task()), ("events", events)):
        run_task(spark, task, D.table(spark, sf, name), TableStore(spark, f"{root}/{name}"), log, ledger, as_of=DAYS[0])
    # an empty run of the first task, which looks for writes that a crash left pending
    run_task(spark, production_task(), D.table(spark, sf, "orders"), TableStore(spark, f"{root}/orders"), log, ledger, as_of=DAYS[1])
    return log, ledger


@register("two_tasks_ledger", """
SELECT source_table, house_keeping_id, count(*) AS n_ids FROM (
  SELECT 'orders' AS source_table, o_orderkey // 10000 AS house_keeping_id FROM orders
  UNION ALL SELECT 'events', event_id // 10000 FROM events) GROUP BY 1, 2""")
def q_two_tasks_ledger(spark, sf):
    """Two tasks share a ledger: the entries of both are there."""
    return two_tasks(spark, sf)[1].read().select("source_table", "house_keeping_id", F.size("ids").cast("long").alias("n_ids"))


@register("two_tasks_log", """
SELECT 'orders_t_' || (o_orderkey // 1000000000 + 1) AS sharding_table_name, min(o_orderkey) AS min_id,
       max(o_orderkey) AS max_id, min(o_orderdate) AS min_timestamp, max(o_orderdate) AS max_timestamp FROM orders GROUP BY 1
UNION ALL SELECT 'events_t_' || (event_id // 1000000000 + 1), min(event_id), max(event_id), min(ts), max(ts)
FROM events GROUP BY 1""")
def q_two_tasks_log(spark, sf):
    """Two tasks share a shard log: the rows of both are there, also after an empty run of the first."""
    return two_tasks(spark, sf)[0].read().select("sharding_table_name", "min_id", "max_id", "min_timestamp", "max_timestamp")


def run_to_end(spark, task, source, store, log, ledger, as_of):
    """Runs of ``task()``, each from the watermark of the one before, until one reads less than its cap: the source's end."""
    while True:
        run = run_task(spark, this := task(), source, store, log, ledger, as_of=as_of)
        if run.rows + run.rejected < this.row_cap:
            return


def copied_and_expired(spark, name, source, keys, copied):
    """Sync all of ``copied``, a part of ``source`` (columns ``keys`` and ``ts``), in as many runs as the cap asks for,
    then house-keep all of it long after."""
    root = scratch_path(spark, name)
    store, log, ledger, kept = (TableStore(spark, f"{root}/{n}") for n in ("data", "log", "ledger", "source"))
    kept.commit(source.withColumn("partition_num", F.lit(1).cast("long")))
    task = lambda: SyncTask(
        source_table_id=4, source_db="src_db", source_table=name, target_db="dw", target_table=f"{name}_t", etl_type=1,
        sync_field=", ".join([*keys, "ts"]), pk_field=", ".join(keys), id_field_name=keys[0], timestamp_field_name="ts",
        batch_size=10_000, max_loop_count=1_500, partition_size=1_000_000_000, if_need_house_keeping=1)
    run_to_end(spark, task, copied, store, log, ledger, "2010-01-01 00:00:00")
    house_keeping(spark, task(), kept, ledger, "2010-02-01 00:00:00", target_store=store)
    return store, kept


@register("housekeeping_composite", """
SELECT l_orderkey, l_linenumber, max(CAST(l_shipdate AS TIMESTAMP)) AS ts FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1, 2""")
def q_housekeeping_composite(spark, sf):
    """Retention by a composite key: of each order the odd lines were copied; only they go."""
    lines = (D.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
             .agg(F.max(F.col("l_shipdate").cast("timestamp_ntz")).alias("ts")))
    keys = ["l_orderkey", "l_linenumber"]
    _, kept = copied_and_expired(spark, "housekeeping_composite", lines, keys, lines.filter("l_linenumber % 2 = 1"))
    return kept.read().select(*keys, "ts")


def named_customers(spark, sf):
    return D.table(spark, sf, "customer").select("c_name", "c_nationkey", F.lit("2001-01-01").cast("timestamp_ntz").alias("ts"))


@register("housekeeping_text", """
SELECT c_name, c_nationkey FROM customer WHERE c_name NOT IN (SELECT c_name FROM customer WHERE c_nationkey < 10)""")
def q_housekeeping_text(spark, sf):
    """Retention by a text key: customers of the first nations were copied; only they go."""
    people = named_customers(spark, sf)
    _, kept = copied_and_expired(spark, "housekeeping_text", people, ["c_name"], people.filter("c_nationkey < 10"))
    return kept.read().select("c_name", "c_nationkey")


@register("sync_run_text", """
SELECT DISTINCT c_name, TIMESTAMP '2001-01-01' AS ts, TIMESTAMP '2010-01-01' AS etl_update_time FROM customer""")
def q_sync_run_text(spark, sf):
    """A run by a text id and key, with log and ledger."""
    people = named_customers(spark, sf)
    store, _ = copied_and_expired(spark, "sync_run_text", people, ["c_name"], people)
    return store.read().select("c_name", "ts", "etl_update_time")


@register("shard_log_text", f"""
SELECT CAST(h // 100000000 + 1 AS BIGINT) AS shard_id, min(c_name) AS min_key, max(c_name) AS max_key,
       CAST(NULL AS BIGINT) AS min_id FROM ({_CRC32_NAMES}) GROUP BY 1""")
def q_shard_log_text(spark, sf):
    """The shard log of a text id over three capped runs: ranges of keys in the order that the runs read them (F2)."""
    people = named_customers(spark, sf)
    root = scratch_path(spark, "shard_log_text")
    store, log = TableStore(spark, f"{root}/data"), TableStore(spark, f"{root}/log")
    for _ in range(3):
        task = SyncTask(source_table_id=5, source_db="src_db", source_table="customer", target_db="dw", target_table="customer_t",
                        etl_type=1, sync_field="c_name, c_nationkey, ts", pk_field="c_name", id_field_name="c_name",
                        timestamp_field_name="ts", batch_size=third(people), max_loop_count=1, partition_size=100_000_000)
        run_task(spark, task, people, store, log, None, as_of="2010-01-01 00:00:00")
    return log.read().select("shard_id", "min_key", "max_key", "min_id")
