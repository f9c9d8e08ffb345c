"""Schema operators: add-only evolution (D2), conform to a target schema (D4), key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def evolve_schema(target: T.StructType, source: T.StructType) -> T.StructType:
    """Target schema after add-only evolution: every target column kept in place and type, new
    source columns appended at the end. Columns are never dropped, retyped or reordered."""
    have = {f.name.lower() for f in target.fields}
    added = [f for f in source.fields if f.name.lower() not in have]
    return T.StructType(list(target.fields) + [T.StructField(f.name, f.dataType, True) for f in added])


def added_columns(target: T.StructType, source: T.StructType) -> list[str]:
    have = {f.name.lower() for f in target.fields}
    return [f.name for f in source.fields if f.name.lower() not in have]


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``df`` in ``schema``: missing columns NULL, types of the schema. A value that does not fit its
    column's type fails the job and never becomes NULL; ``reject_reason`` finds such rows before a load."""
    cols = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = cols.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            out.append(F.col(src).alias(f.name))
        else:
            message = F.concat(F.lit(f"column {f.name}: value does not fit {f.dataType.simpleString()}: "), F.col(src).cast("string"))
            out.append(F.when(_cast_ok(src, f.dataType), F.col(src).try_cast(f.dataType))
                       .otherwise(F.raise_error(message).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def evolve_union(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows and source rows under the evolved schema (D2): old rows get NULL in added columns."""
    schema = evolve_schema(target.schema, source.schema)
    return align(target, schema).unionByName(align(source, schema))


def _drop_ignored(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name.lower() != "ignore"])


def _cast_ok(src: str, dtype: T.DataType):
    return F.col(src).isNull() | F.col(src).try_cast(dtype).isNotNull()


def conform(df: DataFrame, schema: T.StructType, audit_col: str | None = None, as_of=None) -> DataFrame:
    """Rows of ``df`` cast to ``schema`` (D4); rows with a failing cast are left out (see ``rejects``).

    A field named ``ignore`` (any case) is dropped on both sides. ``audit_col`` is set to ``as_of``.
    """
    from ..functions.rules import ts_literal
    schema = _drop_ignored(schema)
    ok = F.lit(True)
    for f in schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            ok = ok & _cast_ok(f.name, f.dataType)
    out = align(df.filter(ok), schema)
    if audit_col:
        out = out.withColumn(audit_col, ts_literal(as_of))
    return out


def reject_reason(df: DataFrame, keys: Sequence[str], have: T.StructType | None = None) -> Column:
    """Why a row cannot be loaded, NULL if it can: the first of ``keys`` that is NULL, else the first column whose
    value does not fit its type in ``have``, the committed schema. One expression for every load path, so that
    what one of them rejects no other loses."""
    reason = F.lit(None).cast("string")
    for f in reversed(have.fields if have is not None else []):
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            reason = F.when(~_cast_ok(f.name, f.dataType), F.lit(f.name)).otherwise(reason)
    for k in reversed(list(keys)):
        reason = F.when(F.col(k).isNull(), F.lit(k)).otherwise(reason)
    return reason


def rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``df`` that ``conform`` leaves out, with the name of the first failing column."""
    schema = _drop_ignored(schema)
    return df.withColumn("reject_column", reject_reason(df, [], schema)).filter(F.col("reject_column").isNotNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (D5): what a unique index on ``keys`` would refuse."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = duplicate_keys(df, keys).limit(5).collect()
    if dup:
        raise ValueError(f"duplicate keys on {list(keys)}: {[r.asDict() for r in dup]}")
