"""Load semantics (E1-E6): split by shard, upsert, append, truncate-and-load, load with disposition,
partial-column upsert. Each returns the new target as a DataFrame; ``plans.commit`` persists it.

Scale notes. The target is the big side and the changes of a run are bounded by the run's row cap.
The upsert streams the target through an anti-join against the deduplicated changes; the callers
pass only the target's touched storage units (``plans.commit``), and the changes' key side is
broadcast only when its row count is known, its columns have a fixed width and the bytes that follow
are under the limit, otherwise AQE picks the join at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema_ops import align, evolve_schema

BROADCAST_BYTES = 64 << 20     # most that the key side of an upsert may have to be sent to every executor
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _maybe_broadcast(df: DataFrame, rows: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if ``rows`` (its count, if known) rows are at most ``limit`` bytes, at 16
    bytes a column; columns without a fixed width (texts) give no such bound."""
    fixed = all(isinstance(f.dataType, FIXED_WIDTH) for f in df.schema.fields)
    return F.broadcast(df) if fixed and rows is not None and rows * 16 * len(df.columns) <= limit else df


def split_rejects(df: DataFrame, shard_col: str = "partition_num") -> tuple[DataFrame, DataFrame]:
    """(rows with a shard, rows whose shard is NULL); the second go to a reject table."""
    return df.filter(F.col(shard_col).isNotNull()), df.filter(F.col(shard_col).isNull())


def shard_counts(df: DataFrame, shard_col: str = "partition_num") -> DataFrame:
    """Rows per shard (E1): what each physical shard receives in this load."""
    return df.groupBy(shard_col).agg(F.count(F.lit(1)).alias("n_rows"))


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                   unique_order: bool = False) -> DataFrame:
    """Last row per key in ``order`` (E2: later rows of a batch win).

    The order is made total with the remaining columns as tie-break, unless the caller guarantees
    ``(keys, order)`` is unique (``unique_order``). ``max_by`` aggregates partially before the
    shuffle, so a key updated many times (a hot key) collapses map-side.
    """
    keys = list(keys)
    order = list(order or [])
    values = [c for c in changes.columns if c not in keys]
    if not values:
        return changes.select(*keys).distinct()
    if unique_order and order:
        ordering = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    else:
        tiebreak = [c for c in values if c not in order
                    and not isinstance(changes.schema[c].dataType, (T.MapType,))]
        ordering = F.struct(*[F.col(c) for c in order + tiebreak]) if (order or tiebreak) else F.lit(0)
    agg = changes.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in values]), ordering).alias("_v"))
    return agg.select(*keys, *[F.col("_v")[c].alias(c) for c in values])


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
           keep: Sequence[str] = (), dedupe: bool = True, changes_rows: int | None = None,
           unique_order: bool = False) -> DataFrame:
    """Insert new keys, replace existing ones (E2; MySQL ``INSERT .. ON DUPLICATE KEY UPDATE``).

    ``keep`` columns keep the target's value when the key exists (inserted with the change's value
    otherwise); target columns missing from ``changes`` are kept too, as an update that does not name
    a column leaves it alone. New columns in ``changes`` are added (add-only evolution).
    """
    keys = list(keys)
    latest = latest_per_key(changes, keys, order, unique_order) if dedupe else changes
    schema = evolve_schema(target.schema, latest.schema)
    keep = [c for c in keep if c in target.columns]
    keep += [c for c in target.columns if c not in latest.columns and c not in keys and c not in keep]
    key_side = _maybe_broadcast(latest.select(*keys), changes_rows)
    if keep:
        old = (target.select(*keys, *keep).join(key_side, keys, "left_semi")
               .select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_old_{c}") for c in keep]))
        joined = latest.join(old, keys, "left")
        latest = joined.withColumns({
            c: (F.when(F.col("_hit"), F.col(f"_old_{c}")).otherwise(F.col(c)) if c in latest.columns
                else F.col(f"_old_{c}"))
            for c in keep}).drop("_hit", *[f"_old_{c}" for c in keep])
    untouched = target.join(key_side, keys, "left_anti")
    return align(untouched, schema).unionByName(align(latest, schema))


def append(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Tasks without a key never conflict (E3): rows are added; new columns are added too."""
    schema = evolve_schema(target.schema, changes.schema)
    return align(target, schema).unionByName(align(changes, schema))


def full_reload(target: DataFrame, source: DataFrame) -> DataFrame:
    """Truncate and load (E4). An empty source leaves the target as it was."""
    return target if source.isEmpty() else source


DISPOSITIONS = ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY")


def load_conform(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Rows cast to the target table's schema by column name (E5); extra columns are an error."""
    extra = [c for c in df.columns if c.lower() not in {f.name.lower() for f in target_schema.fields}]
    if extra:
        raise ValueError(f"columns not in the target schema: {extra}")
    cols = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(cols[f.name.lower()]).cast(f.dataType) if f.name.lower() in cols
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target_schema.fields])


def load(df: DataFrame, target: DataFrame, disposition: str = "WRITE_APPEND") -> DataFrame:
    """Warehouse-style load with a write disposition (E5)."""
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown disposition {disposition}")
    rows = load_conform(df, target.schema)
    if disposition == "WRITE_TRUNCATE":
        return rows
    if disposition == "WRITE_EMPTY":
        if not target.isEmpty():
            raise ValueError("WRITE_EMPTY: target table is not empty")
        return rows
    return target.unionByName(rows)


def upsert_keep(target: DataFrame, changes: DataFrame, keys: Sequence[str], keep: Sequence[str],
                changes_rows: int | None = None) -> DataFrame:
    """Partial-column upsert (E6): on a key match only the columns not in ``keep`` change."""
    return upsert(target, changes, keys, keep=keep, dedupe=False, changes_rows=changes_rows)
