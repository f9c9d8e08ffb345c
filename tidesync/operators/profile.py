"""Shard profile (F1), log widening (F2), timestamp guard (F3) and next watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import ts_literal

# Timestamps before this are not recorded in the shard log (a zero date included).
MIN_VALID_TIMESTAMP = "1990-01-01 00:00:00"

KEY_RANGE = ("min_key", "max_key")      # of text ids, in the shard log


def ts_guard(c: Column | str) -> Column:
    """NULL for timestamps before 1990-01-01 (F3); applied to an aggregated min/max."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= ts_literal(MIN_VALID_TIMESTAMP), c)


def shard_profile(df: DataFrame, id_col: str | None, ts_col: str | None = None,
                  date_col: str | None = None, shard_col: str = "partition_num",
                  guard: bool = True) -> DataFrame:
    """Per shard: rows, min/max of id, event date and timestamp; NULLs skipped (F1).

    One hash aggregate with partial aggregation: each task reduces to one row per shard before the
    shuffle, so the shuffle is (tasks x shards) rows however large or skewed the shards are.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if id_col:
        aggs += [F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id")]
    if date_col:
        aggs += [F.min(date_col).alias("min_matchdate"), F.max(date_col).alias("max_matchdate")]
    if ts_col:
        aggs += [F.min(ts_col).alias("min_timestamp"), F.max(ts_col).alias("max_timestamp")]
    out = df.groupBy(shard_col).agg(*aggs)
    if ts_col and guard:
        out = out.withColumns({"min_timestamp": ts_guard("min_timestamp"),
                               "max_timestamp": ts_guard("max_timestamp")})
    return out


def shard_log_rows(profile: DataFrame, target_table: str, source_db: str, source_table: str,
                   id_col: str | None, ts_col: str | None, date_col: str | None,
                   columns: list[str], as_of, shard_col: str = "partition_num") -> DataFrame:
    """A profile in the shard-log layout (SHARD_LOG_SCHEMA). Text ids have their range in ``KEY_RANGE``, in the order of
    their bytes, as the keyset reads them; ``min_id`` and ``max_id`` are numbers and NULL then."""
    def opt(name, cast):
        if name not in profile.columns or cast == "long" and isinstance(profile.schema[name].dataType, T.StringType):
            return F.lit(None).cast(cast)
        return F.col(name).cast(cast)
    text = id_col and isinstance(profile.schema["min_id"].dataType, T.StringType)
    keys = [F.col("min_id").alias("min_key"), F.col("max_id").alias("max_key")] if text else []
    return profile.select(
        F.concat(F.lit(f"{target_table}_"), F.col(shard_col).cast("string")).alias("sharding_table_name"),
        F.col(shard_col).cast("long").alias("shard_id"),
        F.lit(source_db).alias("source_db_name"), F.lit(source_table).alias("source_table_name"),
        F.lit(id_col).cast("string").alias("id_field_name"),
        opt("min_id", "long").alias("min_id"), opt("max_id", "long").alias("max_id"),
        F.lit(date_col).cast("string").alias("matchdate_field_name"),
        opt("min_matchdate", "timestamp_ntz").alias("min_matchdate"),
        opt("max_matchdate", "timestamp_ntz").alias("max_matchdate"),
        F.lit(ts_col).cast("string").alias("timestamp_field_name"),
        opt("min_timestamp", "timestamp_ntz").alias("min_timestamp"),
        opt("max_timestamp", "timestamp_ntz").alias("max_timestamp"),
        ts_literal(as_of).alias("latest_update_time"),
        F.lit(", ".join(f"`{c}`" for c in columns)).alias("current_columns"),
        *keys,
    )


def with_key_range(log: DataFrame) -> DataFrame:
    """``log`` with ``KEY_RANGE``: NULL for logs of numeric ids only, and for those written before it was kept."""
    return log.withColumns({c: F.lit(None).cast("string") for c in KEY_RANGE if c not in log.columns})


_WIDEN = {"min_key": F.least, "max_key": F.greatest, "min_id": F.least, "max_id": F.greatest, "min_matchdate": F.least, "max_matchdate": F.greatest,
          "min_timestamp": F.least, "max_timestamp": F.greatest}


def shard_log_merge(old: DataFrame, new: DataFrame, key: str = "sharding_table_name") -> DataFrame:
    """Widen the log with a new profile (F2): a min only falls, a max only grows, NULL is unset
    (``least``/``greatest`` skip NULLs); other fields take the newest value. Associative.

    The log has one row per shard, so this full outer join is tiny whatever the table size.
    """
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    cols = []
    for c in old.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif c in _WIDEN and c in new.columns:
            cols.append(_WIDEN[c](F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in new.columns:
            has_new = F.col(f"n.{key}").isNotNull()
            cols.append(F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return j.select(*cols)


def import_legacy_log(log: DataFrame) -> DataFrame:
    """Old logs stored 0 for an unset min_id; read that as NULL (a real id 0 is then kept)."""
    return log.withColumn("min_id", F.when(F.col("min_id") != 0, F.col("min_id")))


def next_watermark(df: DataFrame, etl_type: int, id_col: str | None = None, ts_col: str | None = None,
                   as_of: datetime | str | None = None) -> DataFrame:
    """Next watermark of a run (F5) as one row (last_id, last_timestamp).

    Types 2 and 3 take the maximum of the pair ``(ts, id)`` so the id belongs to the last row read.
    """
    if etl_type == 1:
        return df.agg(F.max(id_col).alias("last_id"), F.lit(None).cast("timestamp_ntz").alias("last_timestamp"))
    if etl_type in (2, 3):
        m = df.agg(F.max(F.struct(F.col(ts_col).alias("t"), F.col(id_col).alias("i"))).alias("m"))
        return m.select(F.col("m.i").alias("last_id"), F.col("m.t").alias("last_timestamp"))
    if etl_type == 4:
        return df.sparkSession.range(1).select(F.lit(None).cast("long").alias("last_id"),
                                               ts_literal(as_of).alias("last_timestamp"))
    raise ValueError(f"unknown etl_type {etl_type}")
