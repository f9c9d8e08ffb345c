"""Value clean-up before a load (C2-C5, C12). All column expressions in one projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens read as missing. The table-sync path clears 'nan' and 'NULL', the
# procedure-sync path clears 'Null' (exact, case-sensitive matches).
TABLE_SYNC_NULL_TOKENS = ("nan", "NULL")
PROCEDURE_NULL_TOKENS = ("Null",)

_FLOATS = (T.FloatType, T.DoubleType)
_NESTED = (T.StructType, T.MapType, T.ArrayType)


def _pick(df: DataFrame, types: tuple, cols: Iterable[str] | None) -> list[str]:
    wanted = set(cols) if cols is not None else None
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, types) and (wanted is None or f.name in wanted)]


def null_normalise(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL on float/double columns; everything else (also '') is left as it is."""
    names = _pick(df, _FLOATS, cols)
    if not names:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in names})


def null_tokens(df: DataFrame, tokens: Iterable[str] = PROCEDURE_NULL_TOKENS,
                cols: Iterable[str] | None = None, nan_to_null: bool = True) -> DataFrame:
    """Exact text tokens -> NULL on string columns (C4, C12); NaN -> NULL on float columns too."""
    tokens = list(tokens)
    exprs = {c: F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c))
             for c in _pick(df, (T.StringType,), cols)}
    if nan_to_null:
        exprs.update({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in _pick(df, _FLOATS, cols)})
    return df.withColumns(exprs) if exprs else df


def digits_to_int(df: DataFrame, cols: Iterable[str] | None = None, as_long: Iterable[str] = ()) -> DataFrame:
    """Digit-only text becomes its integer value (C5): '007' -> '7', '000' -> '0'.

    Columns keep the string type unless listed in ``as_long``; those are try_cast to bigint, so a
    value out of range is NULL here and is caught as a reject by ``conform``. ASCII digits only.
    """
    as_long = set(as_long)
    exprs = {}
    for c in _pick(df, (T.StringType,), cols):
        stripped = F.regexp_replace(F.col(c), r"^0+(?=[0-9])", "")
        v = F.when(F.col(c).rlike(r"^[0-9]+$"), stripped).otherwise(F.col(c))
        exprs[c] = v.try_cast("long") if c in as_long else v
    return df.withColumns(exprs) if exprs else df


def nested_to_json(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Struct, map and array columns -> JSON text."""
    names = _pick(df, _NESTED, cols)
    return df.withColumns({c: F.to_json(F.col(c)) for c in names}) if names else df


def table_sync_clean(df: DataFrame) -> DataFrame:
    """The clean-up the table-sync load applies: NaN -> NULL, nested -> JSON."""
    return nested_to_json(null_normalise(df))


def procedure_sync_clean(df: DataFrame) -> DataFrame:
    """The clean-up the procedure-sync load applies: NaN and 'Null' -> NULL, digit text -> integer."""
    return digits_to_int(null_tokens(df, PROCEDURE_NULL_TOKENS))
