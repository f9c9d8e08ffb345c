"""Repeated increments as a stream.

The poll loop of the source format (read a batch, load it, move the watermark, repeat until nothing
is left or the loop cap is hit) becomes a Structured Streaming query: the file source remembers
which files were read (the watermark), ``maxFilesPerTrigger`` bounds a micro-batch, and
``trigger(availableNow=True)`` runs until nothing is left. Each micro-batch is upserted into the
target in ``foreachBatch``; the batch id is committed with the data, so a replayed batch after a
failure is skipped (exactly-once into the store). No state store is needed: deduplication happens
against the target.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import table_sync_clean
from ..functions.routing import route_expr
from ..operators.load import append, latest_per_key, upsert
from ..plans.commit import BUCKET, SHARD, TableStore, bucket_expr, unit_key


def sync_batch(batch: DataFrame, epoch_id: int, store: TableStore, keys: list[str], id_col: str,
               partition_size: int, order: list[str] | None = None, log_store: TableStore | None = None,
               ts_col: str | None = None, table_name: str = "target", query_id: str = "",
               source_db: str = "", source_table: str = "", reject_store: TableStore | None = None) -> None:
    """Load one micro-batch into ``store`` (idempotent per stream ``query_id`` and ``epoch_id``: every
    stream counts its epochs from 0); with ``log_store`` also widen the shard log, staged before and
    published after the data commit (as a run does). Rows with a NULL key, or with a value that does not fit
    its committed column, go to ``reject_store``; ``rejected_rows`` counts them, with or without one."""
    from ..operators.profile import shard_log_rows, shard_profile
    from ..plans.run import _commit_rejects, _publish_pending, admitted, judged
    _publish_pending(store, log_store, None)
    st = store.state()
    epochs = st.get("extra", {}).get("epochs", {})
    if epochs.get(query_id, -1) >= epoch_id:
        return
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    dtype = batch.schema[id_col].dataType
    rows = table_sync_clean(batch.withColumns({SHARD: route_expr(id_col, partition_size, dtype),
                                               BUCKET: bucket_expr(id_col, dtype, partition_size)}))
    # read several times below; a replayed batch meets the committed types it met the first time
    rows, bad = admitted(judged(rows, store, [*keys, id_col]).checkpoint())
    n_bad = bad.count()
    if reject_store is not None and n_bad:
        _commit_rejects(reject_store, bad, now)
    units = sorted(unit_key(r[0], r[1]) for r in rows.select(SHARD, BUCKET).distinct().collect())  # per unit
    if not units and not n_bad:
        return
    if st["version"] == 0:
        new_part = latest_per_key(rows, [SHARD, BUCKET, *keys], order) if keys else rows
    else:
        old = store.read(units=units, keep_unit=True)
        new_part = upsert(old, rows, [SHARD, BUCKET, *keys], order=order) if keys else append(old, rows)
    pending = {}
    if log_store is not None:
        prof = shard_profile(rows.drop(BUCKET), id_col, ts_col)
        log_rows = shard_log_rows(prof, table_name, source_db, source_table, id_col, ts_col, None, list(batch.columns), now)
        pending["log"] = log_store.stage(log_rows.withColumn(SHARD, F.lit(0).cast("long")), small=True)
    extra = st.get("extra", {})
    store.commit(new_part, touched=units, extra={**extra, "epochs": {**epochs, query_id: epoch_id}, "pending": pending,
                                                 "rejected": extra.get("rejected", 0) + n_bad})
    _publish_pending(store, log_store, None)


def rejected_rows(store: TableStore) -> int:
    """Rows that the streams into ``store`` did not load."""
    return store.state().get("extra", {}).get("rejected", 0)


def stream_sync(spark: SparkSession, source_path: str, schema: T.StructType, store: TableStore,
                checkpoint_location: str, keys: list[str], id_col: str, partition_size: int,
                order: list[str] | None = None, max_files_per_trigger: int = 1, fmt: str = "parquet",
                log_store: TableStore | None = None, ts_col: str | None = None,
                reject_store: TableStore | None = None) -> None:
    """Sync every file under ``source_path`` into ``store`` and stop when none is left."""
    src = (spark.readStream.format(fmt).schema(schema)
           .option("maxFilesPerTrigger", max_files_per_trigger).load(source_path))
    q = (src.writeStream
         .foreachBatch(lambda b, e: sync_batch(
             b, e, store, keys, id_col, partition_size, order, log_store, ts_col, reject_store=reject_store,
             query_id=b.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""))
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
