"""Shard routing (C1): the shard of a row is ``key div partition_size + 1``.

Digit-only keys are used as numbers; any other text (also negative numbers, whose '-' fails the
digit test) is hashed with CRC-32 first. NULL keys route to NULL and are sent to the reject output
by the loaders instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the digit test of the routing rule.
DIGITS = r"^[0-9]+$"


def _div(a: Column, b: int) -> Column:
    # `div` is Spark's integral division (IntegralDivide): exact on longs and decimals, result bigint.
    return F.call_function("div", a, F.lit(b))


def route_expr(key: Column | str, partition_size: int, key_type: T.DataType | None = None) -> Column:
    """Column expression for ``partition_num``.

    With an integral key the digit test is just ``key >= 0`` (no string round trip); with a string
    key the test is the regex and the number is read as decimal(38,0) so 20-digit keys stay exact.
    """
    c = F.col(key) if isinstance(key, str) else key
    hashed = F.crc32(c.cast("string").cast("binary"))
    if isinstance(key_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        number = F.when(c >= 0, c.cast("long")).otherwise(hashed)
        return _div(number, int(partition_size)) + F.lit(1)
    if isinstance(key_type, T.DecimalType) and key_type.scale == 0:
        number = F.when(c >= 0, c.cast("decimal(38,0)")).otherwise(hashed.cast("decimal(38,0)"))
        return (_div(number, int(partition_size)) + F.lit(1)).cast("long")
    s = c.cast("string")
    number = F.when(s.rlike(DIGITS), s.try_cast("decimal(38,0)")).otherwise(hashed.cast("decimal(38,0)"))
    return (_div(number, int(partition_size)) + F.lit(1)).cast("long")


def with_partition_num(df: DataFrame, key: str, partition_size: int, name: str = "partition_num") -> DataFrame:
    """Add the shard column for ``key``; picks the integral fast path from the schema."""
    return df.withColumn(name, route_expr(key, partition_size, df.schema[key].dataType))
