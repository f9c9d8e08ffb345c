"""Incremental extraction (B1-B11): keyset filters, batch top-k, and the exact per-run cap.

A keyset is an ordered list of key columns; a watermark is the tuple of the last values read.
``after(keys, wm)`` is the lexicographic ``(k1, k2, ...) > (w1, w2, ...)``; a redundant
``k1 >= w1`` conjunct is added so the Parquet reader can prune row groups on the leading key.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import bytes_to_unsigned, ts_literal
from ..functions.routing import route_expr
from ..schema import SyncTask, split_fields

# Caps up to this size use Spark's distributed top-k (TakeOrderedAndProject) directly.
TOPK_LIMIT = 100_000
# Histogram width for the cap search; bounds what the driver collects per pass.
HIST_BUCKETS = 4096


def _lit_like(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return ts_literal(value)
    if isinstance(dtype, T.TimestampType):
        v = datetime.fromisoformat(value) if isinstance(value, str) else value
        return F.lit(v).cast(T.TimestampType())
    if isinstance(dtype, T.DateType):
        v = date.fromisoformat(value) if isinstance(value, str) else value
        return F.lit(v).cast(T.DateType())
    return F.lit(value).cast(dtype)


def after(df: DataFrame, keys: Sequence[str], watermark: Sequence, inclusive: bool = False) -> Column:
    """Lexicographic keyset predicate ``keys > watermark`` (``>=`` when ``inclusive``).

    A trailing ``None`` in the watermark drops that column and the ones after it, so
    ``(ts, None)`` with ``inclusive`` reads every row at or after ``ts``.
    """
    pairs = []
    for k, w in zip(keys, watermark):
        if w is None:
            break
        pairs.append((F.col(k), _lit_like(w, df.schema[k].dataType)))
    if not pairs:
        return F.lit(True)
    last_col, last_w = pairs[-1]
    pred = (last_col >= last_w) if inclusive else (last_col > last_w)
    for c, w in reversed(pairs[:-1]):
        pred = (c > w) | ((c == w) & pred)
    return (pairs[0][0] >= pairs[0][1]) & pred


def not_null(keys: Sequence[str]) -> Column:
    pred = F.lit(True)
    for k in keys:
        pred = pred & F.col(k).isNotNull()
    return pred


def extract_batch(df: DataFrame, keys: Sequence[str], watermark: Sequence | None,
                  batch_size: int | None, inclusive: bool = False) -> DataFrame:
    """One loop of a keyset sync: rows after the watermark, in key order, at most ``batch_size``."""
    out = df.filter(not_null(keys))
    if watermark is not None:
        out = out.filter(after(df, keys, watermark, inclusive))
    out = out.orderBy(*keys)
    return out.limit(int(batch_size)) if batch_size else out


def extract_by_id(df: DataFrame, id_col: str, last_id, batch_size: int | None = None) -> DataFrame:
    """Type 1 (B1, B5): ``id > last_id ORDER BY id LIMIT batch_size``."""
    return extract_batch(df, [id_col], [last_id], batch_size)


def extract_by_ts(df: DataFrame, ts_col: str, id_col: str, last_ts, last_id,
                  batch_size: int | None = None) -> DataFrame:
    """Type 2 (B2): composite keyset ``(ts, id) > (last_ts, last_id)``."""
    return extract_batch(df, [ts_col, id_col], [last_ts, last_id], batch_size)


def lag_cutoff(as_of: datetime | str, lag_days: int = 3) -> datetime:
    """Start of the day ``lag_days`` before ``as_of``: rows must be older than this to be read."""
    a = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    d = a.date() - timedelta(days=lag_days)
    return datetime(d.year, d.month, d.day)


def extract_lagged(df: DataFrame, ts_col: str, id_col: str, last_ts, last_id, as_of,
                   lag_days: int = 3, batch_size: int | None = None, inclusive: bool = False) -> DataFrame:
    """Type 3 (B3): type-2 keyset plus a settle lag, ``ts < date(as_of) - lag_days``.

    ``inclusive`` re-reads every row at the watermark's timestamp (a run's first loop does this so
    late rows with the same timestamp are still picked up; the upsert makes the re-read harmless).
    """
    cutoff = ts_literal(lag_cutoff(as_of, lag_days))
    wm = [last_ts, None] if inclusive else [last_ts, last_id]
    src = df.filter(F.col(ts_col) < cutoff)
    return extract_batch(src, [ts_col, id_col], wm, batch_size, inclusive)


def extract_full(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Type 4 (B4, B8): the whole table in one read, ``partition_num = 0``."""
    out = df.select(*fields) if fields else df
    return out.withColumn("partition_num", F.lit(0).cast("long"))


def extract_by_two_ids(df: DataFrame, main_id: str, sub_id: str, last_main, last_sub,
                       batch_size: int | None = None) -> DataFrame:
    """Procedure type 1 with two keys (B6): keyset over ``(main_id, sub_id)``."""
    return extract_batch(df, [main_id, sub_id], [last_main, last_sub], batch_size)


def extract_by_rowversion(df: DataFrame, rv_col: str, last_rv: int, batch_size: int | None = None,
                          out_col: str = "rowversion") -> DataFrame:
    """Procedure type 2 (B7): rows after an 8-byte big-endian rowversion, with its value as unsigned
    decimal(20,0) (C6). 8 bytes compare as the numbers they stand for, so the bound is a binary literal on the
    stored column and reaches the scan."""
    rows = extract_batch(df, [rv_col], [rowversion_bytes(last_rv)], batch_size)
    return rows.withColumn(out_col, bytes_to_unsigned(rv_col))


def project_sync_fields(df: DataFrame, sync_field: str) -> DataFrame:
    """Projection of the trimmed ``sync_field`` list (B11); an ``ignore`` field is dropped."""
    return df.select(*split_fields(sync_field))


# ---------------------------------------------------------------- per-run cap

def _ordinal(c: Column, dtype: T.DataType, offset: int = 0) -> Column | None:
    """Order-preserving long for a leading key, or None when the type has none here."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock arithmetic: independent of the session time zone
        return (F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
                + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(1_000_000)
                + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(10 ** dtype.scale)).cast("long")      # the unscaled value: exact
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        # 7 bytes from ``offset`` as a big-endian number (past the end: zero bytes): monotone in
        # Spark's byte-wise order among values that share the first ``offset`` bytes
        head = F.substring(c.cast("binary"), offset + 1, 7)
        return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long")
    return None


EIGHT = "8 bytes"              # stands for the type of a binary key whose values all have 8 bytes


def _ordinal_of_eight(c: Column) -> Column:
    """Order-preserving long of 8 big-endian bytes read as unsigned: their bits, the highest one flipped."""
    return F.conv(F.hex(c), 16, -10).cast("long").bitwiseXOR(F.lit(-1 << 63))


def rowversion_bytes(value: int) -> bytes:
    """The 8 bytes of an unsigned number; they compare as the numbers do."""
    return int(value).to_bytes(8, "big")


def _is_prefix_ordinal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.BinaryType))


def _from_ordinal(v: int, dtype: T.DataType) -> Column:
    """Literal of the key's own type for an ordinal bound, so the filter reaches the scan."""
    if dtype == EIGHT:
        return F.lit(rowversion_bytes(v + (1 << 63)))
    if isinstance(dtype, T.TimestampNTZType):
        return ts_literal(datetime(1970, 1, 1) + timedelta(microseconds=v))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(v))
    if isinstance(dtype, T.DateType):
        return F.lit(date(1970, 1, 1) + timedelta(days=v))
    if isinstance(dtype, T.DecimalType):
        return F.lit(str(Decimal(v).scaleb(-dtype.scale))).cast(dtype)
    return F.lit(v).cast(dtype)


def capped_extract(df: DataFrame, keys: Sequence[str], cap: int, watermark: Sequence | None = None,
                   inclusive: bool = False, topk_limit: int = TOPK_LIMIT,
                   buckets: int = HIST_BUCKETS) -> DataFrame:
    """Exactly the rows of ``ORDER BY keys LIMIT cap`` after the watermark, without one-task funnel.

    Small caps use Spark's top-k. Large caps search the cut point: a histogram of the leading key
    (at most ``buckets`` rows reach the driver per pass) finds the bucket where the running count
    crosses the cap; every lower bucket is taken whole by a range filter, and the search narrows
    into the crossing bucket (and to the next key when one leading value holds too many rows) until
    what is left fits the top-k. A hot key value holding a third of the table is handled the same
    way: it only makes the search step to the next key column. Text keys are searched seven bytes
    at a time (a slice sharing a prefix moves on to the next seven bytes).
    """
    base = _readable(df, list(keys), watermark, inclusive)
    found = _search(base, list(keys), int(cap), topk_limit, buckets)
    if found is None:
        return _capped_by_rank(base, keys, cap)
    taken, tail, _ = found
    parts = [base.filter(reduce(lambda p, q: p | q, taken))] if taken else []
    if tail is not None:
        parts.append(tail.select(*df.columns))
    return reduce(DataFrame.unionByName, parts)


def _readable(df: DataFrame, keys: list[str], watermark: Sequence | None, inclusive: bool) -> DataFrame:
    base = df.filter(not_null(keys))
    return base if watermark is None else base.filter(after(df, keys, watermark, inclusive))


def _search(base: DataFrame, keys: list[str], cap: int, topk_limit: int, buckets: int
            ) -> tuple[list[Column], DataFrame | None, bool] | None:
    """(ranges taken whole in ascending order, rows taken from the range the cut lies in, whether nothing was
    cut); None when the leading key has no ordinal."""
    if cap <= topk_limit:
        return [], base.orderBy(*keys).limit(cap), False
    types = {f.name: f.dataType for f in base.schema.fields}
    if _ordinal(F.col(keys[0]), types[keys[0]]) is None:
        return None

    taken: list[Column] = []          # predicates of ranges taken whole
    scope = F.lit(True)               # predicate of the range still being searched
    remaining = cap
    whole = False
    level = 0
    offset = 0                        # byte offset inside a text key
    tail = None
    while True:
        k = keys[level]
        ordv = _ordinal_of_eight(F.col(k)) if types[k] == EIGHT else _ordinal(F.col(k), types[k], offset)
        if ordv is None:              # a later key without an ordinal: finish with a rank cut
            tail = _capped_by_rank(base.filter(scope), keys[level:], remaining, keys)
            break
        prefix = _is_prefix_ordinal(types[k])
        stats = [F.count(F.lit(1)).alias("n"), F.min(ordv).alias("lo"), F.max(ordv).alias("hi")]
        if prefix:
            size = F.length(F.col(k).cast("binary"))
            stats.append(F.max(size).alias("len"))
        fixed = isinstance(types[k], T.BinaryType) and offset == 0
        if fixed:                     # rowversions: searched as numbers, so that bounds are literals that reach the scan
            eight = F.when(size == 8, _ordinal_of_eight(F.col(k)))
            stats += [F.min(size).alias("least_len"), F.min(eight).alias("lo8"), F.max(eight).alias("hi8")]
        st = base.filter(scope).agg(*stats).first()
        n, lo, hi = st["n"], st["lo"], st["hi"]
        if fixed and st["least_len"] == st["len"] == 8:
            types[k], prefix, ordv, lo, hi = EIGHT, False, _ordinal_of_eight(F.col(k)), st["lo8"], st["hi8"]
        if n <= remaining:            # only ever at the start: a range narrowed to holds more than is left
            taken.append(scope)
            whole = True
            break
        if remaining <= topk_limit:
            tail = base.filter(scope).orderBy(*keys).limit(remaining)
            break
        if lo == hi:
            if prefix:
                scope = scope & (ordv == F.lit(lo))
                if offset + 7 < (st["len"] or 0):
                    offset += 7       # the same text key, next 7 bytes
                    continue
                offset = 0            # equal texts (up to trailing zero bytes): next key column
            else:
                scope = scope & (F.col(k) == _from_ordinal(lo, types[k]))
            level += 1
            if level == len(keys):    # full-key ties: any `remaining` of them, as LIMIT would
                tail = base.filter(scope).limit(remaining)
                break
            continue
        span = hi - lo + 1
        if span >= 1 << 62:           # a difference would overflow: buckets by the leading bits
            shift = (span // buckets).bit_length()
            width, first = 1 << shift, lo >> shift << shift
            b = F.shiftright(ordv, shift) - F.lit(lo >> shift)
        else:
            # exact integral division (a double division misplaces rows at bucket edges above 2^53)
            width, first = max(1, -(-span // buckets)), lo
            b = F.call_function("div", ordv - F.lit(lo), F.lit(int(width)))
        hist = sorted((r["b"], r["n"]) for r in
                      base.filter(scope).groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        before = 0
        cross = None
        for bucket, cnt in hist:
            if before + cnt > remaining:
                cross = bucket
                break
            before += cnt
        lower, upper = max(lo, first + cross * width), first + (cross + 1) * width
        if prefix:                    # bounds on the ordinal itself (text keys: no literal bound)
            below = ordv < F.lit(lower)
            inside = (ordv >= F.lit(lower)) & (ordv < F.lit(upper))
        else:                         # bounds as literals of the key's type: they reach the scan
            below = F.col(k) < _from_ordinal(lower, types[k])
            inside = F.col(k) >= _from_ordinal(lower, types[k])
            if upper <= hi:           # the last bucket needs no bound, which could pass the type's range
                inside = inside & (F.col(k) < _from_ordinal(upper, types[k]))
        if before > 0:
            taken.append(scope & below)
        remaining -= before
        scope = scope & inside

    return taken, tail, whole


def _capped_by_rank(base: DataFrame, keys: Sequence[str], cap: int,
                    order: Sequence[str] | None = None) -> DataFrame:
    """Cap for keys without an ordinal (floating point, decimals over 18 digits): range-partition,
    count per partition, cut.

    The sorted candidates are checkpointed to the shared checkpoint folder so the counts and the
    rows come from the same partitioning; only one count per partition reaches the driver.
    """
    from ..session import ensure_checkpoint_dir
    spark = base.sparkSession
    ensure_checkpoint_dir(spark)
    order = list(order or keys)
    n_parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")) * 4, 4096))
    ranged = (base.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()).checkpoint())
    counts = sorted((r["_pid"], r["n"]) for r in
                    ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    before, cut, need = 0, None, 0
    for pid, n in counts:
        if before + n > cap:
            cut, need = pid, cap - before
            break
        before += n
    if cut is None:
        return ranged.drop("_pid")
    whole = ranged.filter(F.col("_pid") < cut)
    part = ranged.filter(F.col("_pid") == cut).orderBy(*order).limit(int(need))
    return whole.unionByName(part).drop("_pid")


def capped_with_ties(df: DataFrame, keys: Sequence[str], cap: int, watermark: Sequence | None = None,
                     inclusive: bool = False, topk_limit: int = TOPK_LIMIT, buckets: int = HIST_BUCKETS) -> DataFrame:
    """The rows of ``capped_extract`` and every further row with the last one's key, so that a watermark
    at that key leaves nothing behind. The result is one range filter up to the cut key, which is looked for
    only in the range where the search ended."""
    keys = list(keys)
    base = _readable(df, keys, watermark, inclusive)
    found = _search(base, keys, int(cap), topk_limit, buckets)
    if found is None:
        last_rows = _capped_by_rank(base, keys, cap)
    else:
        taken, tail, whole = found
        if whole:
            return base
        last_rows = tail
    largest = lambda rows: rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*[F.col(k) for k in keys])).alias("last")).first()
    cut = largest(last_rows)
    if found is None or not taken:
        if cut["n"] < cap:
            return base
    elif cut["n"] == 0:               # the cap ended with a range: its last key is the largest of the range before
        cut = largest(base.filter(taken[-1]))
    return base.filter(~after(df, keys, list(cut["last"])))


def unkeyed_rows(df: DataFrame, task: SyncTask) -> DataFrame:
    """Rows a keyset read can never reach: a NULL in the id or timestamp of a type 1 to 3 task."""
    keys = {1: [task.id_field_name], 2: [task.timestamp_field_name, task.id_field_name],
            3: [task.timestamp_field_name, task.id_field_name]}.get(task.etl_type)
    src = project_sync_fields(df, task.sync_field)
    return src.filter(~not_null(keys)) if keys else src.limit(0)


# ---------------------------------------------------------------- whole increment of a task

def increment(df: DataFrame, task: SyncTask, as_of=None, first_loop_inclusive: bool = True,
              lag_days: int = 3) -> DataFrame:
    """Everything one run of ``task`` reads, as one extraction: the loops of the source format
    become one keyset range cut at ``batch_size * max_loop_count`` rows (and the ties of the last key); adds ``partition_num``.
    """
    src = project_sync_fields(df, task.sync_field)
    idf, tsf = task.id_field_name, task.timestamp_field_name
    if task.etl_type == 4:
        return extract_full(src)
    if task.etl_type == 1:
        wm, keys, inc = [task.last_id_sync_record], [idf], False
    elif task.etl_type == 2:
        wm, keys, inc = [task.last_timestamp_sync_record, task.last_id_sync_record], [tsf, idf], False
    elif task.etl_type == 3:
        # the capped part always moves past the watermark (so a timestamp holding more rows than
        # the cap cannot stall the runs); the re-read of rows at the watermark's timestamp is a
        # separate slice on top, for rows that arrived late with a lower id
        keys, inc = [tsf, idf], False
        wm = [task.last_timestamp_sync_record, task.last_id_sync_record]
        src = src.filter(F.col(tsf) < ts_literal(lag_cutoff(as_of, lag_days)))
        if first_loop_inclusive and wm[0] is not None and wm[1] is not None:
            at_wm = (F.col(tsf) == _lit_like(wm[0], df.schema[tsf].dataType)) & \
                    (F.col(idf) <= _lit_like(wm[1], df.schema[idf].dataType))
            reread = src.filter(not_null(keys) & at_wm)
            out = capped_with_ties(src, keys, task.row_cap, wm).unionByName(reread)
            return out.withColumn("partition_num", route_expr(idf, task.partition_size, df.schema[idf].dataType))
    else:
        return src.limit(0).withColumn("partition_num", F.lit(None).cast("long"))
    if wm[0] is None:               # no watermark yet: from the start
        wm = None
    out = capped_with_ties(src, keys, task.row_cap, wm, inclusive=inc)
    return out.withColumn("partition_num", route_expr(idf, task.partition_size, df.schema[idf].dataType))
