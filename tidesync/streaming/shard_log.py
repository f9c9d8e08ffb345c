"""The shard log kept by a streaming aggregation (F1, F2 over G9).

The state store holds one row per shard, in the query's checkpoint on the shared file system. A micro-batch sends on only
the shards that it changed (update mode), as they are now over all files read so far, and they replace their rows in the
log. Nothing is re-read or re-merged per batch, and a restart goes on from the state.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import table_sync_clean
from ..functions.routing import route_expr
from ..operators.profile import shard_log_rows, shard_profile, with_key_range
from ..plans.commit import SHARD, TableStore


def log_updates(rows: DataFrame, id_col: str, ts_col: str | None, partition_size: int) -> DataFrame:
    """The profile of the shards of a stream; rows without an id belong to none."""
    routed = table_sync_clean(rows.withColumn(SHARD, route_expr(id_col, partition_size, rows.schema[id_col].dataType)))
    return shard_profile(routed.filter(F.col(SHARD).isNotNull()), id_col, ts_col)


def _apply(batch: DataFrame, store: TableStore, describe) -> None:
    """Put the changed shards' rows in place of their old ones. A replayed batch puts the same rows again."""
    new = with_key_range(describe(batch)).checkpoint()       # the log has a row per shard, whatever the table's size
    if new.isEmpty():
        return
    if store.version():
        # a log that runs wrote has no row counts
        new = new.unionByName(store.read().join(new, "sharding_table_name", "left_anti"), allowMissingColumns=True)
    store.commit(new, replace_all=True, small=True)


def stream_shard_log(spark: SparkSession, source_path: str, schema: T.StructType, log_store: TableStore, checkpoint_location: str,
                     id_col: str, ts_col: str | None, partition_size: int, target_table: str, source_db: str, source_table: str,
                     max_files_per_trigger: int = 1, fmt: str = "parquet") -> None:
    """Read every file under ``source_path`` that the checkpoint has not seen, widen the log and stop."""
    files = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).load(source_path)
    columns = [f.name for f in schema.fields]

    def describe(batch: DataFrame) -> DataFrame:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = shard_log_rows(batch, target_table, source_db, source_table, id_col, ts_col, None, columns, now)
        counts = batch.select(F.col(SHARD).cast("long").alias("shard_id"), "n_rows")
        return rows.join(counts, "shard_id").withColumn(SHARD, F.lit(0).cast("long"))

    query = (log_updates(files, id_col, ts_col, partition_size).writeStream.outputMode("update")
             .foreachBatch(lambda batch, epoch: _apply(batch, log_store, describe))
             .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
