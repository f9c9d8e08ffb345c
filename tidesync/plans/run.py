"""One task end to end: extract -> clean -> upsert -> profile -> commit -> ledger; and retention.

Data and watermark commit in one atomic state file, which also records the run's staged shard-log
and ledger writes as pending; those are published right after, or by the next run if a crash came
first. A ledger entry is never visible before the rows it lists are committed to the target.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bitmaps import cell_of, holds, pack_keys, set_size, spot_of, union_sets
from ..functions.cleaning import table_sync_clean
from ..functions.rules import ts_literal
from ..operators.extract import increment, lag_cutoff, unkeyed_rows
from ..operators.load import append, latest_per_key, upsert
from ..operators.profile import KEY_RANGE, shard_log_merge, shard_log_rows, shard_profile, with_key_range
from ..operators.retention import (expiry_gate, expiry_gate_bitmap, ledger_bitmap, ledger_id_count, ledger_mark,
                                   ledger_pack, ledger_purge, ledger_window, recent_from, retention_delete,
                                   retention_delete_bitmap)
from ..operators.schema_ops import align, evolve_schema, reject_reason
from ..schema import (DEFAULT_LAST_ID, DEFAULT_LAST_TIMESTAMP, LEDGER_SCHEMA, SHARD_LOG_SCHEMA, SyncTask,
                      validate_task)
from ..session import ensure_checkpoint_dir
from .commit import BUCKET, SHARD, TableStore, bucket_expr, unit_key
from .zones import files_with_nulls, units_with_keys

# Audit column of the table-sync target: the time a row was first inserted.
AUDIT_COL = "etl_update_time"
# Why a row of an increment is not loaded (NULL: it is); the column's name in the reject table.
REJECT = "reject_column"


@dataclass
class RunResult:
    rows: int
    rejected: int
    shards: list
    version: int | None
    watermark: dict
    sync_field: str | None = None
    timings: dict | None = None


class _Steps:
    """Wall time per step of a run (seconds), returned with the result."""

    def __init__(self):
        import time
        self._now = time.perf_counter
        self._t = self._now()
        self.times: dict = {}

    def done(self, name: str) -> None:
        t = self._now()
        self.times[name] = round(self.times.get(name, 0.0) + t - self._t, 3)
        self._t = t


def refresh_sync_field(task: SyncTask, source: DataFrame) -> bool:
    """Set ``sync_field`` to the source's column list (an ``ignore`` column left out); True if it
    changed. New columns then flow into the target through add-only evolution (D2)."""
    from ..schema import split_fields
    cols = [c for c in source.columns if c.lower() != "ignore"]
    if split_fields(task.sync_field) == cols:
        return False
    task.sync_field = ", ".join(cols)
    return True


def _watermark_of(task: SyncTask, store: TableStore) -> SyncTask:
    wm = store.watermark()
    if store.version() == 0 and task.last_id_sync_record in (None, DEFAULT_LAST_ID) \
            and task.last_timestamp_sync_record in (None, DEFAULT_LAST_TIMESTAMP):
        # a new task with the default watermarks reads from the start (so id 0 is not skipped)
        task.last_id_sync_record, task.last_timestamp_sync_record = None, None
        return task
    if wm.get("last_id") is not None:
        task.last_id_sync_record = wm["last_id"]
    if wm.get("last_timestamp") is not None:
        task.last_timestamp_sync_record = datetime.fromisoformat(str(wm["last_timestamp"]))
    return task


def judged(rows: DataFrame, store: TableStore, keys: list[str]) -> DataFrame:
    """``rows`` with ``reject_column``: why a row cannot be loaded into ``store``, NULL if it can. Every load path
    (table sync, procedure sync, stream) goes through here before its rows are materialised."""
    return rows.withColumn(REJECT, reject_reason(rows, [*keys, SHARD, BUCKET], store.schema()))


def admitted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows to reject) of ``judged`` rows."""
    return rows.filter(F.col(REJECT).isNull()).drop(REJECT), rows.filter(F.col(REJECT).isNotNull())


def _summary(inc: DataFrame, task: SyncTask) -> DataFrame:
    """Counts, touched units (one a unit, not a row) and the last key, which passes rejected rows too."""
    ok = F.col(REJECT).isNull()
    aggs = [F.count_if(ok).alias("n"), F.count_if(~ok).alias("n_bad"),
            F.collect_set(F.when(ok, F.struct(F.col(SHARD), F.col(BUCKET)))).alias("units")]
    if task.etl_type == 1:
        aggs += [F.max(task.id_field_name).alias("last_id"), F.lit(None).cast("timestamp_ntz").alias("last_ts")]
    elif task.etl_type in (2, 3):
        last = F.max(F.struct(F.col(task.timestamp_field_name).alias("t"), F.col(task.id_field_name).alias("i")))
        aggs += [last["i"].alias("last_id"), last["t"].alias("last_ts")]
    return inc.agg(*aggs)


def _publish_pending(store: TableStore, log_store: TableStore | None, ledger_store: TableStore | None) -> None:
    """Publish the log / ledger writes the latest data commit recorded as pending, if not yet done.

    The log and the ledger remember the last write applied for each data store, so a replay never undoes
    what later commits (marks, purges, other tasks) made of it. The log's rows are merged into the log as
    it is now."""
    pending = store.state().get("extra", {}).get("pending") or {}
    for name, target in (("log", log_store), ("ledger", ledger_store)):
        staged = pending.get(name)
        if not staged or target is None:
            continue
        extra = target.state().get("extra", {})
        applied = extra.get("applied", {})
        if applied.get(store.root) == staged["tag"]:
            continue
        extra = {**extra, "applied": {**applied, store.root: staged["tag"]}}
        if name == "ledger":
            target.publish(staged, extra=extra)
            continue
        rows = with_key_range(target.read_staged(staged)).select(*SHARD_LOG_SCHEMA.names, *KEY_RANGE)
        merged = shard_log_merge(with_key_range(target.read(SHARD_LOG_SCHEMA)).select(*rows.columns), rows) if target.version() else rows
        target.commit(merged.withColumn(SHARD, F.lit(0).cast("long")), replace_all=True, small=True, extra=extra)


def _as_text(bad: DataFrame) -> DataFrame:
    """Rejected rows as the reject table keeps them: every column as text, nested ones as JSON, bytes as hex."""
    def text(f: T.StructField):
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(f.name)
        return F.hex(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string")
    return bad.select(*[text(f).alias(f.name) for f in bad.schema.fields if f.name not in (SHARD, BUCKET)])


def _commit_rejects(reject_store: TableStore, bad: DataFrame, as_of) -> None:
    """Add rows (as text, with ``reject_column``) to the append-only reject table, once each: rows that no
    watermark passes are met again by every run. A row is known by the digest of its filled columns, the only
    column of the table that is read here; ``n`` equal rows are kept ``n`` times."""
    new = _as_text(bad)
    digest = F.sha2(F.to_json(F.struct(*sorted(new.columns))), 256)          # NULL columns are left out of the text
    new = new.withColumn("reject_digest", digest).groupBy(*new.columns, "reject_digest").agg(F.count(F.lit(1)).alias("_n"))
    if reject_store.version() and "reject_digest" in reject_store.schema().names:
        old = reject_store.read().select("reject_digest").groupBy("reject_digest").agg(F.count(F.lit(1)).alias("_had"))
        new = new.join(old, "reject_digest", "left").withColumn("_n", F.col("_n") - F.coalesce("_had", F.lit(0))).drop("_had")
    new = (new.filter(F.col("_n") > 0).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n")
           .withColumns({"rejected_at": ts_literal(as_of), SHARD: F.lit(-1).cast("long")}).checkpoint())
    if not new.isEmpty():
        reject_store.commit(new, bucket=F.lit(reject_store.version() + 1))       # a unit of its own: never replaced


def _keep_rejects(reject_store: TableStore | None, bad: DataFrame, n_bad: int, unkeyed: DataFrame | None, as_of) -> int:
    """Write the rejected rows of an increment, and the source's unkeyed ones, to the reject table; their number.
    Without a reject table the increment's are counted and the source is not searched for unkeyed rows."""
    if reject_store is None:
        return n_bad
    if unkeyed is not None:
        # this filter alone reaches the scan; what it finds is kept, so the count does not scan again
        unkeyed = unkeyed.withColumn(REJECT, F.lit("key")).checkpoint()
        n_bad, bad = n_bad + unkeyed.count(), _as_text(bad).unionByName(_as_text(unkeyed), allowMissingColumns=True)
    if n_bad:
        _commit_rejects(reject_store, bad, as_of)
    return n_bad


def _source_rows(source: DataFrame | TableStore, task: SyncTask, as_of) -> DataFrame:
    """The rows a run can extract. Of a table store only the files are read whose zones reach past the watermark
    (and, with a settle lag, begin before its end)."""
    if isinstance(source, DataFrame):
        return source
    ranges = {1: {task.id_field_name: (task.last_id_sync_record, None)},
              2: {task.timestamp_field_name: (task.last_timestamp_sync_record, None)},
              3: {task.timestamp_field_name: (task.last_timestamp_sync_record, lag_cutoff(as_of))}}.get(task.etl_type, {})
    return source.read_where(ranges).drop(SHARD)


def _unkeyed_source(source: DataFrame | TableStore, task: SyncTask) -> DataFrame | None:
    """Rows that no keyset reaches, of a table store from the files that hold a NULL in a key."""
    if task.etl_type == 4:
        return None
    if isinstance(source, TableStore):
        keys = [task.id_field_name] if task.etl_type == 1 else [task.id_field_name, task.timestamp_field_name]
        source = files_with_nulls(source, keys)
    return unkeyed_rows(source, task)


def run_task(spark: SparkSession, task: SyncTask, source: DataFrame | TableStore, store: TableStore,
             log_store: TableStore | None = None, ledger_store: TableStore | None = None,
             as_of: datetime | str | None = None, reject_store: TableStore | None = None,
             refresh_fields: bool = False, audit_col: str | None = AUDIT_COL,
             bitmap_ledger: bool = False, deltas: bool = False) -> RunResult:
    """Run one sync of ``task`` from ``source`` into ``store``; returns counts and the new watermark.

    ``bitmap_ledger`` writes the ledger as key sets, which needs a single integral key. With ``deltas`` an increment
    of types 1 to 3 with a key is written as a delta of its changed rows, and deltas are folded by size; without, the
    units it touches are rewritten.

    ``refresh_fields`` first sets ``sync_field`` to the source's columns, as a run of the source
    format does (the new value is returned for the control table). ``audit_col`` is set to ``as_of``
    when a row is first inserted and kept when it is updated (C10); None leaves it out."""
    steps = _Steps()
    _publish_pending(store, log_store, ledger_store)          # finish a run that died after its commit
    columns = source if isinstance(source, DataFrame) else source.read().drop(SHARD)
    drift = refresh_sync_field(task, columns) if refresh_fields else False
    validate_task(task)
    ensure_checkpoint_dir(spark)
    as_of = datetime.fromisoformat(as_of) if isinstance(as_of, str) else (as_of or datetime.now(timezone.utc).replace(tzinfo=None))
    task = _watermark_of(task, store)

    whole, source = source, _source_rows(source, task, as_of)
    inc = table_sync_clean(increment(source, task, as_of))
    unit_col = task.keys[0] if task.keys else task.id_field_name
    bucket = (bucket_expr(unit_col, source.schema[unit_col].dataType, task.partition_size)
              if unit_col and task.etl_type != 4 else F.lit(0).cast("long"))
    inc = inc.withColumn(BUCKET, bucket)
    # a type 4 load replaces the rows, so it looks no key up; the target's types stay
    inc = judged(inc, store, task.keys if task.etl_type != 4 else [])
    # one materialisation in the shared checkpoint folder: the increment feeds the load, the profile,
    # the watermark and the ledger, and the source may change while the run goes on
    inc = inc.checkpoint(eager=True)
    steps.done("extract")
    good, bad = admitted(inc)
    # one pass over the increment for its counts, the next watermark and the touched units
    summary = _summary(inc, task).first()
    n = summary["n"]
    steps.done("summary")
    n_bad = _keep_rejects(reject_store, bad, summary["n_bad"],
                          None if reject_store is None else _unkeyed_source(whole, task), as_of)
    steps.done("rejects")
    if task.etl_type == 4:
        watermark = {"last_id": None, "last_timestamp": str(as_of)}
    else:
        watermark = {"last_id": summary["last_id"],
                     "last_timestamp": None if summary["last_ts"] is None else str(summary["last_ts"])}
    if n == 0:
        version = None
        if task.etl_type != 4 and summary["n_bad"]:
            # nothing to load, but rejected rows: the watermark passes them, or a capped run would meet them for ever
            version = store.commit(good.drop(BUCKET).limit(0), touched=[], watermark=watermark)
        elif drift and store.version():
            # columns added at the source reach the target even when no row comes (add-only)
            version = store.commit(good.drop(BUCKET).limit(0), touched=[])
        return RunResult(0, n_bad, [], version, store.watermark(), task.sync_field, steps.times)
    units = sorted(unit_key(u[SHARD], u[BUCKET]) for u in summary["units"])
    shards = sorted({u[SHARD] for u in summary["units"]})

    # the shard log and the ledger are staged first and published after the data commit, which
    # records them as pending: the next run publishes whatever a crash left pending, so data,
    # watermark, log and ledger move together, and the ledger never shows rows not yet committed
    pending = {}
    if log_store is not None and task.etl_type in (1, 2, 3):
        prof = shard_profile(good.drop(BUCKET), task.id_field_name, task.timestamp_field_name,
                             task.event_date_field_name)
        rows = shard_log_rows(prof, task.target_table, task.source_db, task.source_table, task.id_field_name,
                              task.timestamp_field_name, task.event_date_field_name, task.fields, as_of)
        pending["log"] = log_store.stage(rows.withColumn(SHARD, F.lit(0).cast("long")), small=True)
        steps.done("shard_log")
    load_version = store.version() + 1
    if ledger_store is not None and task.if_need_house_keeping == 1 and task.keys:
        # append-only: the entries of this load are one new folder (shard = load_version)
        if bitmap_ledger:
            entries = ledger_bitmap(good, task.keys[0], as_of, task.source_db, task.source_table,
                                    batch_size=task.batch_size, load_version=load_version)
        else:
            entries = ledger_pack(good.drop(BUCKET), task.keys, as_of, task.source_db, task.source_table,
                                  batch_size=task.batch_size, load_version=load_version, n_rows=n)
        pending["ledger"] = ledger_store.stage(entries.withColumn(SHARD, F.col("load_version")),
                                               cluster_by=["house_keeping_id"], bucket=_source_number())
        steps.done("ledger")

    extra = {**store.state().get("extra", {}), "pending": pending}
    if audit_col:
        good = good.withColumn(audit_col, ts_literal(as_of))
    keep = [audit_col] if audit_col else []
    if task.etl_type == 4:
        if load_version > 1:
            good = align(good, evolve_schema(store.schema(), good.drop(BUCKET).schema).add(BUCKET, "long"))
        version = store.commit(good, watermark=watermark, replace_all=True, cluster_by=task.keys, extra=extra,
                               expected_version=load_version - 1)
    else:
        order = [c for c in (task.timestamp_field_name, task.id_field_name) if c]
        if deltas and store.version() and task.keys and not set(store.schema().names) - {*good.columns, SHARD}:
            changes = latest_per_key(good, [SHARD, BUCKET, *task.keys], order, task.id_field_name in task.keys)
            version = store.commit_delta(align(changes, evolve_schema(store.schema(), changes.drop(BUCKET).schema).add(BUCKET, "long")),
                                         task.keys, keep, watermark, extra, load_version - 1)
            store.fold_deltas()
            steps.done("load_commit")
            _publish_pending(store, log_store, ledger_store)
            steps.done("publish")
            return RunResult(n, n_bad, shards, version, watermark, task.sync_field, steps.times)
        if store.version() == 0:
            # several versions of a key in the first load: the last one wins, as in any other load
            new_part = latest_per_key(good, [SHARD, BUCKET, *task.keys], order, task.id_field_name in task.keys) \
                if task.keys else good
        else:
            old = store.read(units=units, keep_unit=True)     # only the touched unit folders
            if task.keys:
                # (key, ts, id) is unique when the id is the key: no tie-break needed
                new_part = upsert(old, good, [SHARD, BUCKET, *task.keys], order=order, changes_rows=n,
                                  unique_order=task.id_field_name in task.keys, keep=keep)
            else:
                new_part = append(old, good)
        version = store.commit(new_part, watermark=watermark, touched=units, cluster_by=task.keys, extra=extra,
                               expected_version=load_version - 1)
    steps.done("load_commit")
    _publish_pending(store, log_store, ledger_store)
    steps.done("publish")

    return RunResult(n, n_bad, shards, version, watermark, task.sync_field, steps.times)


def _source_number():
    """The ledger's unit inside a load: one per source, as tasks of one ledger count loads on their own."""
    return F.crc32(F.concat_ws(".", "source_db", "source_table"))


def house_keeping(spark: SparkSession, task: SyncTask, source_store: TableStore, ledger_store: TableStore,
                  as_of: datetime | str, start_days: int = 60, end_days: int = 14,
                  target_store: TableStore | None = None, compact: bool = False) -> dict:
    """Delete from the source what was copied and is past retention; then mark the ledger. A row is
    deleted only if its whole key was copied.

    The ledger is stored with one folder per load (shard = load_version); only the loads holding a
    marked or purged entry are rewritten. With ``target_store``, ledger entries a sync run left
    pending are published first. ``compact`` then rewrites the units that lost rows, clustered on the
    timestamp and the key, as the source format optimises its tables after deletes (G8).
    """
    from ..operators.retention import ENTRY, join_listed, ledger_keys
    validate_task(task)
    if target_store is not None:
        _publish_pending(target_store, None, ledger_store)
    full = ledger_store.read(LEDGER_SCHEMA, keep_unit=True)
    as_sets = "cell" in full.columns
    ledger = ledger_purge(full, as_of)
    window = ledger_window(ledger, as_of, start_days, end_days, task.source_db, task.source_table)
    # only files that hold recent rows can block an entry
    recent = source_store.read_where({task.timestamp_field_name: (recent_from(as_of), None)})
    if as_sets:
        deletable = expiry_gate_bitmap(window, recent, task.keys[0], task.timestamp_field_name, as_of)
    else:
        deletable = expiry_gate(window, recent, task.keys, task.timestamp_field_name, as_of)
    deletable = deletable.checkpoint(eager=True)
    if as_sets:
        n_ids = deletable.agg(F.coalesce(F.sum(set_size()), F.lit(0)).alias("n")).first()["n"]
    else:
        n_ids = ledger_id_count(deletable)
    purged_loads = full.join(ledger.select(*ENTRY), ENTRY, "left_anti").select(SHARD, BUCKET)
    marked_loads = deletable.select(SHARD, BUCKET)
    loads = sorted(unit_key(r[0], r[1]) for r in purged_loads.union(marked_loads).distinct().collect())  # one per load
    touched = []
    if n_ids:
        src = source_store.read(keep_unit=True)
        listed = None if as_sets else ledger_keys(deletable, src, task.keys)
        sets = _key_sets(deletable, listed, src, task.keys, source_store)
        touched = None if sets is None else units_with_keys(source_store, sets)
        if touched is None:
            # without key sets of the source's units: the units holding a deleted key (one row per unit)
            held = _held(src, sets, task.keys[0]) if as_sets else join_listed(src, listed, task.keys, "left_semi", n_ids)
            touched = sorted(unit_key(r[SHARD], r[BUCKET]) for r in held.select(SHARD, BUCKET).distinct().collect())
        if touched:                 # ids already gone (a retry after a crash) need no rewrite
            rows = source_store.read(units=touched, keep_unit=True)
            kept = (retention_delete_bitmap(rows, sets, task.keys[0], sets.count()) if sets is not None
                    else retention_delete(rows, deletable, task.keys, ids_rows=n_ids))
            source_store.commit(kept, touched=touched, cluster_by=task.keys)
    if loads:
        # mark only after the delete is committed; rewrite only the loads that changed
        marked = ledger_mark(ledger.filter(F.concat_ws("/", SHARD, BUCKET).isin(loads)), deletable)
        ledger_store.commit(marked, touched=loads, cluster_by=["house_keeping_id"])
    if compact and touched:
        source_store.compact([task.timestamp_field_name, *task.keys], units=touched)
    return {"entries": deletable.select(*ENTRY).distinct().count(), "ids": n_ids, "shards": touched, "loads": loads}


def _key_sets(deletable: DataFrame, listed: DataFrame | None, source: DataFrame, keys: list[str],
              store: TableStore) -> DataFrame | None:
    """The keys to delete as one set a cell: those of a ledger of sets, or of a list where the source keeps key sets
    of the same column to compare with; None where there is nothing to gain."""
    if listed is None:
        return union_sets(deletable, []).checkpoint()
    if len(keys) > 1 or (store.state().get("indexed") or {}).get("key") != keys[0]:
        return None
    return pack_keys(listed, [], "_key0").checkpoint()


def _held(source: DataFrame, sets: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is in ``sets``."""
    return source.join(sets, cell_of(F.col(key)) == sets["cell"]).filter(holds(F.col("bits"), F.col("spots"), spot_of(F.col(key))))


def _sp_keys(task: dict) -> list[str]:
    if task["etl_type"] == 2:
        return [task["timestamp_field_name"]]
    keys = [task["id_field_name_1"]]
    if task.get("arg_counts") == 3:
        keys.append(task["id_field_name_2"])
    return keys


def run_procedure_task(spark: SparkSession, task: dict, source: DataFrame, store: TableStore, rules=(),
                       as_of: datetime | str | None = None, source_host: str | None = None,
                       partition_size: int = 1_000_000_000, reject_store: TableStore | None = None) -> RunResult:
    """Procedure sync (a TASK_SP_SCHEMA row): batch read by one or two ids or by rowversion, add
    provenance, apply the conversion rules, clean, upsert with ``inserttime`` and move the
    watermark. Type 4 reads the whole table each run, without a cap.

    Rows with a NULL in the key, or with a value that does not fit its committed column, go to
    ``reject_store`` and are counted, as in ``run_task``; so do rows that no batch can reach, with a NULL in
    the columns of the watermark."""
    from ..functions.cleaning import procedure_sync_clean
    from ..functions.routing import route_expr
    from ..functions.rules import apply_rules, bytes_to_unsigned, ts_literal, with_provenance
    from ..operators.extract import capped_with_ties, not_null, rowversion_bytes
    from ..schema import split_fields, validate_sp_task

    validate_sp_task(task)
    ensure_checkpoint_dir(spark)
    as_of = datetime.fromisoformat(as_of) if isinstance(as_of, str) else (as_of or datetime.now(timezone.utc).replace(tzinfo=None))
    etl_type = task["etl_type"]
    keys = _sp_keys(task)
    wm = store.watermark() if etl_type != 4 else {}
    if etl_type == 2:
        # 8 bytes compare as the numbers: the stored column is searched and filtered, bounds reach the scan
        last = wm.get("last_rowversion", task.get("last_timestamp_sync_record"))
        watermark = None if last in (None, 0) and store.version() == 0 else [rowversion_bytes(int(last or 0))]
    else:
        last = [wm.get("last_id_1", task.get("last_id_sync_record_1")),
                wm.get("last_id_2", task.get("last_id_sync_record_2"))][:len(keys)]
        fresh = store.version() == 0 and all(v in (None, 0) for v in last)
        watermark = None if fresh or etl_type == 4 and all(v in (None, 0) for v in last) else \
            [0 if v is None else v for v in last]
    cap = int(task["batch_size"]) * int(task["max_loop_count"])
    rows = source if etl_type == 4 else capped_with_ties(source, keys, cap, watermark)
    if etl_type == 2:           # the rules may convert the column itself: the order and the watermark keep a copy
        rows, keys = rows.withColumn("_rowversion", bytes_to_unsigned(keys[0])), ["_rowversion"]
    rows = with_provenance(rows, source_host or task.get("source") or "", task["source_db"])
    rows = apply_rules(rows, rules, task["target_db"], task["target_table"])
    rows = procedure_sync_clean(rows).withColumn("inserttime", ts_literal(as_of))
    pk = split_fields(task.get("pk_field")) or keys
    rows = rows.withColumns({SHARD: route_expr(pk[0], partition_size, rows.schema[pk[0]].dataType),
                             BUCKET: bucket_expr(pk[0], rows.schema[pk[0]].dataType, partition_size)})
    rows = judged(rows, store, pk).checkpoint(eager=True)
    rows, bad = admitted(inc := rows)

    last_key = F.max(F.struct(*[F.col(k) for k in keys]))
    ok = F.col(REJECT).isNull()
    summ = inc.agg(F.count_if(ok).alias("n"), F.count_if(~ok).alias("n_bad"), last_key.alias("last"),
                   F.collect_set(F.when(ok, F.struct(F.col(SHARD), F.col(BUCKET)))).alias("units")).first()
    unkeyed = None if etl_type == 4 else source.filter(~not_null(_sp_keys(task)))
    n_bad = _keep_rejects(reject_store, bad.drop("_rowversion", "inserttime"), summ["n_bad"], unkeyed, as_of)
    if summ["n"] + summ["n_bad"] == 0:
        return RunResult(0, n_bad, [], None, store.watermark())
    if etl_type == 2:
        new_wm = {"last_rowversion": str(summ["last"][0])}
    elif etl_type == 4:
        new_wm = {}
    else:
        new_wm = {"last_id_1": summ["last"][0], **({"last_id_2": summ["last"][1]} if len(keys) == 2 else {})}
    units = sorted(unit_key(u[SHARD], u[BUCKET]) for u in summ["units"])
    shards = sorted({u[SHARD] for u in summ["units"]})
    # extraction order decides within a run, in the first load too; the rowversion goes only after that
    if store.version() == 0:
        new_part = latest_per_key(rows, [SHARD, BUCKET, *pk], keys)
    else:
        old = store.read(units=units, keep_unit=True)
        # every column is set on a key match, the key included
        new_part = upsert(old, rows, [SHARD, BUCKET, *pk], order=keys, changes_rows=summ["n"])
    version = store.commit(new_part.drop("_rowversion"), watermark=new_wm, touched=units, cluster_by=pk)
    return RunResult(summ["n"], n_bad, shards, version, new_wm)
