"""Sets of integral keys as bitmaps, in built-in functions.

A key lies in a cell of 32,768 consecutive keys, at a spot in it. A cell's set is a bitmap of 4 KB, or a list of
spots where keys are sparse: columns (cell, bits, spots), one of the last two filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 32_768                  # keys of a cell, fixed by the bitmap functions
BITMAP_BYTES = CELL // 8
DENSE = 512                    # mean keys a set from which a bitmap is no larger than its keys as numbers


def cell_of(key: Column) -> Column:
    return F.bitmap_bucket_number(key.cast("long"))


def spot_of(key: Column) -> Column:
    return F.bitmap_bit_position(key.cast("long"))


def key_at(cell: Column, spot: Column) -> Column:
    """The key of a spot: cells from 1 on hold positive keys, the others 0 and negative ones."""
    return F.when(cell >= 1, (cell - 1) * CELL + spot + 1).otherwise(cell * CELL - spot)


def holds(bits: Column, spots: Column, spot: Column) -> Column:
    """Whether a set has the key at ``spot``."""
    byte = F.conv(F.hex(F.substring(bits, F.call_function("div", spot, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.when(bits.isNotNull(), F.getbit(byte, (spot % 8).cast("int")) == 1).otherwise(F.array_contains(spots, spot)), F.lit(False))


def pack_keys(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, cell, bits, spots): the distinct keys of each group. Bitmaps if a cell of a group has ``DENSE`` rows
    on average, counted before; a set never has more than a cell's keys, however large the group."""
    rows = df.filter(F.col(key).isNotNull()).select(*by, cell_of(F.col(key)).alias("cell"), spot_of(F.col(key)).alias("spot"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*by, "cell")).alias("cells")).first()
    if size["n"] >= DENSE * size["cells"]:
        return (rows.groupBy(*by, "cell").agg(F.bitmap_construct_agg("spot").alias("bits"))
                .withColumn("spots", F.lit(None).cast("array<bigint>")))
    return (rows.groupBy(*by, "cell").agg(F.array_sort(F.collect_set("spot")).alias("spots"))
            .select(*by, "cell", F.lit(None).cast("binary").alias("bits"), "spots"))


def union_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union per (by, cell). Lists and bitmaps of one cell may meet: lists are then taken in by a bitmap."""
    some = sets.groupBy(*by, "cell").agg(F.bool_or(F.col("bits").isNotNull()).alias("_dense"),
                                         F.bitmap_or_agg("bits").alias("bits"),
                                         F.array_distinct(F.flatten(F.collect_list("spots"))).alias("spots"))
    lone = (some.filter(F.col("_dense") & (F.size("spots") > 0)).select(*by, "cell", F.explode("spots").alias("spot"))
            .groupBy(*by, "cell").agg(F.bitmap_construct_agg("spot").alias("bits")))
    dense = some.filter("_dense").select(*by, "cell", "bits")
    return (dense.unionByName(lone).groupBy(*by, "cell").agg(F.bitmap_or_agg("bits").alias("bits"))
            .withColumn("spots", F.lit(None).cast("array<bigint>"))
            .unionByName(some.filter(~F.col("_dense")).select(*by, "cell", F.lit(None).cast("binary").alias("bits"), "spots")))


def unpack_keys(sets: DataFrame, by: Sequence[str], key: str = "key") -> DataFrame:
    """(by, key): one row per key. A bitmap is read as 512 words; words without a bit make no rows."""
    word = lambda j: F.conv(F.hex(F.substring("bits", j * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = (sets.filter(F.col("bits").isNotNull())
             .select(*by, "cell", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(CELL // 64 - 1)), word)).alias("word", "value"))
             .filter("value <> 0"))
    # a word's bytes stand in order, the bits of a byte from the lowest
    bits = words.select(*by, "cell", "word", "value", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).filter(
        F.getbit("value", F.lit(56) - 8 * F.floor(F.col("i") / 8).cast("int") + F.col("i") % 8) == 1)
    dense = bits.select(*by, key_at(F.col("cell"), (F.col("word") * 64 + F.col("i")).cast("long")).alias(key))
    listed = (sets.filter(F.col("bits").isNull()).select(*by, "cell", F.explode("spots").alias("spot"))
              .select(*by, key_at(F.col("cell"), F.col("spot")).alias(key)))
    return dense.unionByName(listed)


def set_size() -> Column:
    """Keys in a set."""
    return F.coalesce(F.bitmap_count("bits"), F.size("spots").cast("long"))


def set_bytes() -> Column:
    return F.when(F.col("bits").isNotNull(), F.lit(BITMAP_BYTES)).otherwise(8 * F.size("spots")).cast("long")
