"""Conversion rules (C6-C8), provenance (C9) and audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bytes_to_unsigned(c: Column | str) -> Column:
    """Big-endian unsigned bytes -> decimal(20,0) (C6); 8 bytes of 0xff give 18446744073709551615."""
    c = F.col(c) if isinstance(c, str) else c
    # both branches text, so the only cast is text -> decimal(20,0) (a BIGINT step would overflow)
    return (F.when(F.length(c) == 0, F.lit("0"))
            .otherwise(F.conv(F.hex(c), 16, 10))
            .cast(T.DecimalType(20, 0)))


def unsigned_to_bytes(c: Column | str, width: int = 8) -> Column:
    """Inverse of ``bytes_to_unsigned`` for non-negative integers: ``width`` big-endian bytes."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.lpad(F.conv(c.cast("string"), 10, 16), 2 * width, "0"))


def bit_expr(c: Column | str, dtype: T.DataType) -> Column:
    """Rule ``bit`` (C7): 1 where the value equals true, else 0 (NULL -> 0, 2 -> 0, text -> 0)."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit(1)).otherwise(F.lit(0))
    if isinstance(dtype, T.NumericType):
        return F.when(c == 1, F.lit(1)).otherwise(F.lit(0))
    return F.lit(0)


def _rule_rows(rules) -> list[dict]:
    if isinstance(rules, DataFrame):
        # a rule list is a small config file; it is read whole (bounded by the number of rules)
        return [r.asDict() for r in rules.collect()]
    return [dict(r) for r in rules]


def apply_rules(df: DataFrame, rules, target_db: str, target_table: str) -> DataFrame:
    """Apply the rules whose target_db and target_table match and whose column exists.

    ``original_data_type`` is not consulted. All matching rules become one ``withColumns``.
    """
    exprs = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for r in _rule_rows(rules):
        if r.get("target_db") != target_db or r.get("target_table") != target_table:
            continue
        col, kind = r.get("column_name"), r.get("covert_data_type")
        if col not in types:
            continue
        if kind == "bit":
            exprs[col] = bit_expr(col, types[col])
        elif kind == "bigint" and isinstance(types[col], T.BinaryType):
            exprs[col] = bytes_to_unsigned(col)
    return df.withColumns(exprs) if exprs else df


def with_provenance(df: DataFrame, source_host: str, source_db: str) -> DataFrame:
    """Provenance columns of the procedure-sync path."""
    return df.withColumns({"SourceHost": F.lit(source_host), "SourceDB": F.lit(source_db)})


def ts_literal(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (the tables carry zone-less timestamps)."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    # cast from text: a Python datetime literal would pass through the local time zone
    return F.lit(text).cast(T.TimestampNTZType())


def with_audit(df: DataFrame, as_of: datetime | str, name: str = "etl_update_time") -> DataFrame:
    """Audit time column set to ``as_of`` (C10 on insert, C11 on every write)."""
    return df.withColumn(name, ts_literal(as_of))
