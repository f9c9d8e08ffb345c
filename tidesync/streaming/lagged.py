"""The settle lag in event time (B3 over G9), with a side output for what comes later.

A batch run of type 3 waits until rows are older than the lag, so that late ones are still met. A stream loads rows as
they come and lets the lag bound how late one may be: Spark's watermark is the greatest event time read so far less the
lag, its state store remembers the versions (key, event time) read since then, and re-sent copies of them go.

Spark drops what is older than the watermark without a trace. Here each micro-batch carries its rows twice, as read and
as the stateful operator let them pass; what did not pass and is not in the target goes to the late table. So the rows
loaded, and those in the late and reject tables, are together the source.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.routing import route_expr
from ..plans.commit import BUCKET, SHARD, TableStore, bucket_expr, unit_key
from .stream import sync_batch

EVENT_TIME = "_event_time"
PASSED = "_passed"


def twofold(files: DataFrame, keys: list[str], ts_col: str, lag: str) -> DataFrame:
    """A stream's rows as read and, once more with ``PASSED``, those that are neither older than the watermark nor copies
    of a version since then. Rows without an event time are never older than a watermark, so they do not pass."""
    timed = files.withColumn(EVENT_TIME, F.col(ts_col).cast("timestamp")).withWatermark(EVENT_TIME, lag)
    passed = timed.filter(F.col(EVENT_TIME).isNotNull()).dropDuplicatesWithinWatermark([*keys, EVENT_TIME])
    return (timed.withColumn(PASSED, F.lit(False)).unionByName(passed.withColumn(PASSED, F.lit(True)))
            .drop(EVENT_TIME))


def missed(rows: DataFrame, target: DataFrame | None, keys: list[str], ts_col: str) -> DataFrame:
    """``rows`` without those whose key the target holds in the same or a newer version. NULLs are in no target."""
    if target is None:
        return rows
    held = target.select(*[F.col(k).alias(f"held_{k}") for k in keys], F.col(ts_col).alias("held_ts"))
    same = reduce(and_, [F.col(k) == F.col(f"held_{k}") for k in keys]) & (F.col("held_ts") >= F.col(ts_col))
    return rows.join(held, same, "left_anti")


def _target(rows: DataFrame, store: TableStore, id_col: str, partition_size: int) -> DataFrame | None:
    """The committed rows of the units that ``rows`` fall in, None if there is none."""
    if not store.version():
        return None
    dtype = rows.schema[id_col].dataType
    named = rows.select(route_expr(id_col, partition_size, dtype).alias(SHARD), bucket_expr(id_col, dtype, partition_size).alias(BUCKET))
    units = {unit_key(r[0], r[1]) for r in named.distinct().collect()} & set(store.units())      # one a unit, not a row
    return store.read(units=sorted(units)) if units else None


def lagged_batch(batch: DataFrame, epoch_id: int, store: TableStore, late_store: TableStore, keys: list[str], id_col: str,
                 ts_col: str, partition_size: int, query_id: str = "", reject_store: TableStore | None = None) -> None:
    """Load the rows of a ``twofold`` micro-batch that passed, then keep the others that the target misses. Both steps
    may be replayed: the load knows its epoch, the late table its rows."""
    from ..plans.run import REJECT, _as_text, _commit_rejects
    batch = batch.checkpoint()                  # the stateful operator runs once, not once per step below
    if batch.isEmpty():                         # a batch without rows still moves the watermark
        return
    passed, read = batch.filter(PASSED).drop(PASSED), batch.filter(~F.col(PASSED)).drop(PASSED)
    # a version may come after a newer one of its key: then the newer one stays
    sync_batch(missed(passed, _target(batch, store, id_col, partition_size), keys, ts_col), epoch_id, store, keys, id_col, partition_size,
               [ts_col], reject_store=reject_store, query_id=query_id)
    versions = passed.select(*[F.col(c).alias(f"passed_{c}") for c in [*keys, ts_col]]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"passed_{c}")) for c in [*keys, ts_col]])
    held_back = read.join(versions, same, "left_anti").checkpoint()
    late = missed(held_back, _target(held_back, store, id_col, partition_size), keys, ts_col)
    why = F.when(F.col(ts_col).isNull(), F.lit(ts_col)).otherwise(F.lit("late"))
    _commit_rejects(late_store, _as_text(late).distinct().withColumn(REJECT, why), datetime.now(timezone.utc).replace(tzinfo=None))


def stream_lagged(spark: SparkSession, source_path: str, schema: T.StructType, store: TableStore, late_store: TableStore,
                  checkpoint_location: str, keys: list[str], id_col: str, ts_col: str, partition_size: int,
                  lag: str = "3 days", max_files_per_trigger: int = 1, fmt: str = "parquet",
                  reject_store: TableStore | None = None) -> None:
    """Sync every file under ``source_path`` that the checkpoint has not seen, and stop. Rows later than ``lag`` go to
    ``late_store`` (as text, each once, with ``reject_column`` = "late", or the event time's name where it is NULL)."""
    files = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).load(source_path)
    query = (twofold(files, keys, ts_col, lag).writeStream.outputMode("append")
             .foreachBatch(lambda b, e: lagged_batch(
                 b, e, store, late_store, keys, id_col, ts_col, partition_size, reject_store=reject_store,
                 query_id=b.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""))
             .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
