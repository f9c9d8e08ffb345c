"""Clustering on several columns at once (G8): Z-order, the interleaved bits of the columns' places in their ranges.

Rows close in all columns come to lie in one file, so a file's zone is narrow in each of them, where a sort by the first
column leaves the others spread over every file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .extract import _ordinal

BITS = 60                      # of an interleaved value, shared by the columns


def interleave(places: Sequence[Column], bits: int) -> Column:
    """The lowest ``bits`` bits of the columns, taken in turn from the highest down."""
    n = len(places)
    out = F.lit(0).cast("long")
    for j, place in enumerate(places):
        for i in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(place, i).bitwiseAND(F.lit(1).cast("long")), i * n + n - 1 - j))
    return out


def z_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """Z-order value of a row: each column's place between its least and greatest value (one aggregate finds
    them), NULLs first. Columns need an order-preserving number: integers, dates, times, decimals, texts (by their
    first 7 bytes)."""
    bits = min(BITS // len(columns), 30)
    ordinals = [_ordinal(F.col(c), df.schema[c].dataType) for c in columns]
    if any(o is None for o in ordinals):
        raise ValueError(f"no order-preserving number for one of {list(columns)}")
    ends = df.agg(*[f(o).alias(f"{f.__name__}{i}") for i, o in enumerate(ordinals) for f in (F.min, F.max)]).first()
    places = []
    for i, o in enumerate(ordinals):
        lo, hi = ends[f"min{i}"], ends[f"max{i}"]
        if lo is None or lo == hi:
            places.append(F.lit(0).cast("long"))
            continue
        shift = max(0, (hi - lo).bit_length() - 62)                # keeps the difference a long
        place = F.shiftright(o, shift) - F.lit(lo >> shift)
        excess = ((hi >> shift) - (lo >> shift)).bit_length() - bits
        # a narrow range is widened to all bits, so that every column has a say in the highest ones
        place = F.shiftright(place, excess) if excess > 0 else F.shiftleft(place, -excess)
        places.append(F.coalesce(place, F.lit(0)).cast("long"))
    return interleave(places, bits)
