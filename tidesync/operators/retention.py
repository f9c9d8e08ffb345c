"""Retention (G1-G8): the id ledger, the expiry gate, deletes and compaction.

The source format deletes ledger entry by entry, one query per entry per step; here every step is
one distributed job over all entries at once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bitmaps import BITMAP_BYTES, cell_of, holds, pack_keys, spot_of, unpack_keys
from ..functions.rules import ts_literal

# Fixed value: days a copied row is kept in the source before it may be deleted.
RETENTION_DAYS = 14

BROADCAST_BYTES = 64 << 20     # most that a list of keys may have to be sent to every executor
KEY_BYTES = 40                 # of a key of fixed width in a broadcast list (38 measured over 9 million)

# Key of a ledger entry. Load versions count per target, so a ledger shared by tasks needs the source too.
ENTRY = ["source_db", "source_table", "load_version", "house_keeping_id"]


def _day(as_of) -> date:
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.date() if isinstance(as_of, datetime) else as_of


def _midnight(d: date) -> str:
    return f"{d.isoformat()} 00:00:00"


def _names(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def ledger_pack(loaded: DataFrame, keys: str | list[str], as_of, source_db: str, source_table: str,
                batch_col: str | None = None, batch_size: int = 10_000, load_version: int = 0,
                n_rows: int | None = None) -> DataFrame:
    """One ledger entry per loaded batch with the sorted distinct keys that loaded (G1).

    A single key is listed as its text, a composite one as a JSON object of its columns. Entries are
    cut by ``batch_col`` when the loader numbered its batches; by ``key div batch_size`` on a single
    integral key, where a range of ``batch_size`` integers holds at most that many keys; else by the
    key's hash into ``n_rows / (batch_size / 2)`` entries (``n_rows`` counted if not given), which
    fills an entry half on average. So no array grows with the load. Rows with a NULL in the key are
    not listed.
    """
    names = _names(keys)
    whole = [F.col(k).isNotNull() for k in names]
    loaded = loaded.filter(reduce(lambda a, b: a & b, whole))
    key = F.col(names[0]) if len(names) == 1 else F.to_json(F.struct(*names))
    if batch_col is not None:
        entry = F.col(batch_col)
    elif len(names) == 1 and isinstance(loaded.schema[names[0]].dataType, (T.IntegerType, T.LongType, T.ShortType)):
        entry = F.call_function("div", key, F.lit(int(batch_size)))
    else:
        n = loaded.count() if n_rows is None else n_rows
        entry = F.pmod(F.xxhash64(*names), F.lit(-(-2 * n // int(batch_size)) or 1))
    ids = F.transform(F.sort_array(F.collect_set(key)), lambda x: x.cast("string"))
    return (loaded.groupBy(entry.cast("long").alias("house_keeping_id"))
            .agg(ids.alias("ids"))
            .select(F.lit(int(load_version)).cast("long").alias("load_version"), "house_keeping_id",
                    ts_literal(_midnight(_day(as_of))).alias("etl_update_date"),
                    F.lit(source_db).alias("source_db"), F.lit(source_table).alias("source_table"),
                    "ids", F.lit(0).alias("is_source_delete")))


def ledger_unpack(ledger: DataFrame) -> DataFrame:
    """Entry -> one row per key."""
    return ledger.select(*ENTRY, F.explode("ids").alias("id"))


def _parse_blob(blob: bytes | None) -> list[str] | None:
    if blob is None:
        return None
    try:
        text = zlib.decompress(blob).decode("utf-8")
    except (zlib.error, UnicodeDecodeError):
        return None
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] == "'":            # ids in quotes may hold commas and quotes
        return re.split(r"'\s*,\s*'", text[1:-1])
    return [t.strip() for t in text.split(",") if t.strip()]


def unpack_legacy_blobs(ledger: DataFrame, blob_col: str = "ids_compress") -> DataFrame:
    """Import old ledger rows whose keys are a zlib blob of ``1,2,3`` or ``'a','b'`` text.

    Runs once per import inside the tasks (Arrow batches); unreadable blobs give NULL ids.
    """
    out_schema = T.StructType([f for f in ledger.schema.fields if f.name != blob_col]
                              + [T.StructField("ids", T.ArrayType(T.StringType()), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.copy()
            pdf["ids"] = pdf[blob_col].map(_parse_blob)
            yield pdf.drop(columns=[blob_col])

    return ledger.mapInPandas(run, out_schema)


def ledger_window(ledger: DataFrame, as_of, start_days: int, end_days: int,
                  source_db: str | None = None, source_table: str | None = None) -> DataFrame:
    """Entries dated in ``[as_of - start_days, as_of - end_days)``, not yet deleted."""
    d = _day(as_of)
    lo, hi = d - timedelta(days=start_days), d - timedelta(days=end_days)
    day = F.to_date("etl_update_date")
    pred = (day >= F.lit(lo)) & (day < F.lit(hi)) & (F.col("is_source_delete") == 0)
    if source_db is not None:
        pred = pred & (F.col("source_db") == source_db)
    if source_table is not None:
        pred = pred & (F.col("source_table") == source_table)
    return ledger.filter(pred)


def ledger_purge(ledger: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Drop entries already deleted and older than ``days``."""
    cutoff = _day(as_of) - timedelta(days=days)
    done_and_old = (F.col("is_source_delete") == 1) & (F.to_date("etl_update_date") < F.lit(cutoff))
    return ledger.filter(~done_and_old)


def ledger_keys(entries: DataFrame, source: DataFrame, keys: str | list[str]) -> DataFrame:
    """(the entry's columns, ``_key0``, ``_key1``, ...): one row per listed key, in the types of the
    source's key columns, so that the big side joins on its own columns."""
    fields = [source.schema[k] for k in _names(keys)]
    ids = ledger_unpack(entries)
    if len(fields) > 1:
        parsed = F.from_json("id", T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
        return (ids.withColumn("id", parsed)
                .select(*ENTRY, *[F.col("id").getField(f.name).alias(f"_key{i}") for i, f in enumerate(fields)]))
    dtype = fields[0].dataType
    return ids.select(*ENTRY, (F.col("id") if isinstance(dtype, T.StringType)
                               else F.col("id").try_cast(dtype)).alias("_key0"))


def join_listed(source: DataFrame, listed: DataFrame, keys: str | list[str], how: str,
                listed_rows: int | None = None) -> DataFrame:
    """``source`` semi- or anti-joined to keys of ``ledger_keys``. The list is broadcast if it is
    known to have at most ``BROADCAST_BYTES``, which only keys of fixed width can show; else it is
    merged: the planner takes an unpacked list for no larger than the packed entries' file, so left
    to itself it would send lists of any length through the driver."""
    names = _names(keys)
    listed = listed.select(*[f"_key{i}" for i in range(len(names))]).distinct()
    fixed = all(isinstance(source.schema[k].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
                for k in names)
    small = fixed and listed_rows is not None and listed_rows * KEY_BYTES * len(names) <= BROADCAST_BYTES
    listed = F.broadcast(listed) if small else listed.hint("merge")
    same = [source[k] == listed[f"_key{i}"] for i, k in enumerate(names)]
    return source.join(listed, same, how)


def recent_from(as_of, days: int = RETENTION_DAYS) -> str:
    """Rows from this time on block their entry."""
    return _midnight(_day(as_of) - timedelta(days=days))


def expiry_gate(entries: DataFrame, source: DataFrame, keys: str | list[str], ts_col: str, as_of,
                days: int = RETENTION_DAYS) -> DataFrame:
    """Entries whose every source row is older than ``as_of - days`` days.

    An entry is blocked when any of its keys has ``date(ts) >= as_of - days``; keys whose row is
    gone or whose ts is NULL do not block. Only the recent rows of the source are read (the ts
    filter reaches the Parquet scan), then semi/anti joins decide per entry.
    """
    cutoff = ts_literal(recent_from(as_of, days))
    names = [f"_key{i}" for i in range(len(_names(keys)))]
    recent = source.filter(F.col(ts_col) >= cutoff).select(
        *[F.col(k).alias(n) for k, n in zip(_names(keys), names, strict=True)])
    blocked = ledger_keys(entries, source, keys).join(recent, names, "left_semi").select(*ENTRY).distinct()
    return entries.join(blocked, ENTRY, "left_anti")


def retention_delete(source: DataFrame, deletable: DataFrame, keys: str | list[str],
                     ids_rows: int | None = None) -> DataFrame:
    """Source rows left after deleting the keys of the deletable entries (G6); a row goes only if its
    whole key is listed. The ledger gives ``ids_rows`` cheaply as the sum of array sizes."""
    return join_listed(source, ledger_keys(deletable, source, keys), keys, "left_anti", ids_rows)


def ledger_id_count(entries: DataFrame) -> int:
    """Number of keys in the entries, read from the array sizes (one small aggregate)."""
    return entries.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).first()["n"]


# ---------------------------------------------------------------- ledger of bitmaps

def ledger_bitmap(loaded: DataFrame, key: str, as_of, source_db: str, source_table: str, batch_size: int = 10_000,
                  load_version: int = 0) -> DataFrame:
    """G1 for a single integral key without listing it: the entries of ``ledger_pack`` (``key div batch_size``), each
    as one key set per cell of 32,768 keys. A dense entry takes an eighth of a byte a key instead of its digits."""
    rows = loaded.withColumn("house_keeping_id", F.call_function("div", F.col(key).cast("long"), F.lit(int(batch_size))))
    return pack_keys(rows, ["house_keeping_id"], key).select(
        F.lit(int(load_version)).cast("long").alias("load_version"), "house_keeping_id",
        ts_literal(_midnight(_day(as_of))).alias("etl_update_date"), F.lit(source_db).alias("source_db"),
        F.lit(source_table).alias("source_table"), "cell", "bits", "spots", F.lit(0).alias("is_source_delete"))


def ledger_bitmap_unpack(ledger: DataFrame) -> DataFrame:
    """One row per key, in the form of ``ledger_unpack``."""
    return unpack_keys(ledger, ENTRY, "id").select(*ENTRY, F.col("id").cast("string").alias("id"))


def expiry_gate_bitmap(entries: DataFrame, source: DataFrame, key: str, ts_col: str, as_of,
                       days: int = RETENTION_DAYS) -> DataFrame:
    """G5 over key sets: the recent source rows meet the sets of their cell and are looked up there, so no key of
    the ledger becomes a row."""
    cutoff = ts_literal(recent_from(as_of, days))
    recent = source.filter(F.col(ts_col) >= cutoff).select(cell_of(F.col(key)).alias("cell"), spot_of(F.col(key)).alias("spot"))
    blocked = entries.join(recent, "cell").filter(holds(F.col("bits"), F.col("spots"), F.col("spot"))).select(*ENTRY).distinct()
    return entries.join(blocked, ENTRY, "left_anti")


def retention_delete_bitmap(source: DataFrame, sets: DataFrame, key: str, sets_rows: int | None = None) -> DataFrame:
    """G6 over key sets: source rows whose key is in none of ``sets`` (cell, bits, spots: one row a cell). They are
    broadcast if their known number of bitmaps is within ``BROADCAST_BYTES`` (some 500 million keys when dense)."""
    sets = sets.select(F.col("cell").alias("_cell"), F.col("bits").alias("_bits"), F.col("spots").alias("_spots"))
    if sets_rows is not None and sets_rows * 2 * BITMAP_BYTES <= BROADCAST_BYTES:      # a list is at most as large
        sets = F.broadcast(sets)
    met = source.join(sets, cell_of(F.col(key)) == F.col("_cell"), "left")
    return met.filter(~holds(F.col("_bits"), F.col("_spots"), spot_of(F.col(key)))).select(*[F.col(f"`{c}`") for c in source.columns])


def ledger_mark(ledger: DataFrame, deleted: DataFrame) -> DataFrame:
    """Mark entries whose delete was committed (G7). Call only after that commit."""
    done = deleted.select(*ENTRY).distinct().withColumn("_done", F.lit(True))
    return (ledger.join(done, ENTRY, "left")
            .withColumn("is_source_delete",
                        F.when(F.col("_done"), F.lit(1)).otherwise(F.col("is_source_delete")))
            .drop("_done").select(*ledger.columns))


def compact(df: DataFrame, key_cols: list[str], n_files: int, shard_col: str | None = "partition_num") -> DataFrame:
    """Rewrite layout after deletes (G8): ``n_files`` range partitions in key order.

    Range partitioning on (shard, key) keeps each output file within one or two shards and sorted,
    and splits a dominant shard across many tasks instead of funnelling it into one.
    """
    order = ([shard_col] if shard_col and shard_col in df.columns else []) + list(key_cols)
    return df.repartitionByRange(int(n_files), *order).sortWithinPartitions(*order)
