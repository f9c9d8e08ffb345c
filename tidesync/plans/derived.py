"""Inputs derived from the driver tables, for the checks and the bench.

Every input is computed by Spark from whole tables (no id subsets or row caps); the oracle SQL in
``catalog`` repeats each derivation. Increments are cut by date, as a real sync cuts them.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import ts_literal, unsigned_to_bytes  # noqa: F401  (ts_literal re-exported)
from ..operators.retention import ledger_bitmap, ledger_pack

# Fixed parameters of the checks (dates inside the driver tables' ranges).
EVENTS_WATERMARK = "2024-01-10 00:00:00"
ORDERS_AS_OF = "2001-08-10 00:00:00"
LEDGER_DAY = "2001-08-01 00:00:00"
TARGET_BEFORE = "2000-01-01 00:00:00"     # upsert target: orders before this day
CHANGES_FROM = "1999-07-01 00:00:00"      # upsert changes: orders from this day (overlap: updates)
SECOND_VERSION_FROM = "2001-01-01 00:00:00"
OLD_AUDIT = "2001-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def upsert_target(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < ts_literal(TARGET_BEFORE))


def upsert_changes(orders: DataFrame) -> DataFrame:
    """Two versions per recent key: all orders from CHANGES_FROM (+1), again from SECOND_VERSION_FROM
    (+2, later in extract order), so the later version must win."""
    v1 = (orders.filter(F.col("o_orderdate") >= ts_literal(CHANGES_FROM))
          .withColumns({"o_totalprice": F.col("o_totalprice") + 1, "_seq": F.lit(1)}))
    v2 = (orders.filter(F.col("o_orderdate") >= ts_literal(SECOND_VERSION_FROM))
          .withColumns({"o_totalprice": F.col("o_totalprice") + 2, "_seq": F.lit(2)}))
    return v1.unionByName(v2)


def events_with_nan(events: DataFrame) -> DataFrame:
    """events with value = NaN on every seventh id (a value injection; no row is dropped)."""
    return events.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan")))
                             .otherwise(F.col("value")))


def orders_with_tokens(orders: DataFrame) -> DataFrame:
    """orders with missing-value tokens injected by status/priority."""
    return orders.withColumns({
        "o_orderpriority": F.when(F.col("o_orderstatus") == "P", F.lit("Null"))
        .when(F.col("o_orderstatus") == "F", F.lit("null")).otherwise(F.col("o_orderpriority")),
        "o_orderstatus": F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NULL"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("nan")).otherwise(F.col("o_orderstatus")),
    })


def orders_with_bad_ts(orders: DataFrame) -> DataFrame:
    """orders with o_orderdate = 1980-01-01 for urgent pending orders."""
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    return orders.withColumn("o_orderdate", F.when(bad, ts_literal("1980-01-01 00:00:00"))
                             .otherwise(F.col("o_orderdate")))


def events_rowversion(events: DataFrame) -> DataFrame:
    """events with an 8-byte big-endian rowversion made from the id."""
    return events.withColumn("rv", unsigned_to_bytes("event_id"))


def two_keys(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber").distinct()


def ledger(orders: DataFrame) -> DataFrame:
    """Ledger of all orders in entries of 10 keys, dated LEDGER_DAY minus (entry % 40) days; the
    ten oldest dates are already deleted."""
    packed = ledger_pack(orders, "o_orderkey", LEDGER_DAY, "src_db", "orders", batch_size=10)
    age = F.col("house_keeping_id") % 40
    return packed.withColumns({
        "etl_update_date": F.col("etl_update_date") - F.make_dt_interval(days=age.cast("int")),
        "is_source_delete": F.when(age >= 30, F.lit(1)).otherwise(F.lit(0)),
    })


def bitmap_ledger(orders: DataFrame) -> DataFrame:
    """Ledger of all orders as key sets in entries of 600 keys, dated LEDGER_DAY minus (entry % 40) days."""
    packed = ledger_bitmap(orders, "o_orderkey", LEDGER_DAY, "src_db", "orders", batch_size=600)
    age = F.col("house_keeping_id") % 40
    return packed.withColumn("etl_update_date", F.col("etl_update_date") - F.make_dt_interval(days=age.cast("int")))


def retention_source(orders: DataFrame) -> DataFrame:
    """The source at house-keeping time: finished orders were already removed (vanished rows)."""
    return orders.filter(F.col("o_orderstatus") != "F")


def legacy_ledger(rows: DataFrame, entry: list[str], id_col: str, day: str) -> DataFrame:
    """An old ledger: one row per entry, its ids as one zlib blob of comma-separated text."""
    packed = rows.groupBy(*entry).agg(F.array_join(F.sort_array(F.collect_list(id_col)), ",").alias("ids_text"))

    @F.pandas_udf("binary")
    def compressed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: zlib.compress(t.encode()))

    return packed.select(F.lit(0).cast("long").alias("load_version"), F.lit("src_db").alias("source_db"), *entry,
                         F.lit(day).cast("timestamp_ntz").alias("etl_update_date"), F.lit(0).alias("is_source_delete"),
                         compressed("ids_text").alias("ids_compress"))
