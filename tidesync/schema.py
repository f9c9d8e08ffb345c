"""Schemas of the control tables, the shard log, the id ledger and the rule list; type map; task checks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from datetime import datetime

from pyspark.sql import types as T

# Control table, table sync. The credential columns of the source format are replaced by one
# `source` and one `target` reference (a connection name resolved by the caller).
TASK_SCHEMA = T.StructType([
    T.StructField("source_table_id", T.IntegerType(), False),
    T.StructField("job_group", T.IntegerType(), True),
    T.StructField("is_active", T.IntegerType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("source_db", T.StringType(), True),
    T.StructField("source_table", T.StringType(), True),
    T.StructField("target", T.StringType(), True),
    T.StructField("target_db", T.StringType(), True),
    T.StructField("target_table", T.StringType(), True),
    T.StructField("pk_field", T.StringType(), True),
    T.StructField("sync_field", T.StringType(), True),
    T.StructField("etl_type", T.IntegerType(), True),
    T.StructField("max_loop_count", T.IntegerType(), True),
    T.StructField("batch_size", T.IntegerType(), True),
    T.StructField("partition_size", T.LongType(), True),
    T.StructField("id_field_name", T.StringType(), True),
    T.StructField("last_id_sync_record", T.LongType(), True),
    T.StructField("last_id_house_keeping_record", T.LongType(), True),
    T.StructField("timestamp_field_name", T.StringType(), True),
    T.StructField("last_timestamp_sync_record", T.TimestampNTZType(), True),
    T.StructField("last_timestamp_house_keeping_record", T.TimestampNTZType(), True),
    T.StructField("source_write", T.StringType(), True),
    T.StructField("if_need_house_keeping", T.IntegerType(), True),
    T.StructField("event_date_field_name", T.StringType(), True),
])

# Control table, procedure sync: two id watermarks and a rowversion watermark (unsigned 64 bit).
TASK_SP_SCHEMA = T.StructType([
    T.StructField("source_table_id", T.IntegerType(), False),
    T.StructField("job_group", T.IntegerType(), True),
    T.StructField("is_active", T.IntegerType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("source_db", T.StringType(), True),
    T.StructField("source_table", T.StringType(), True),
    T.StructField("source_sp", T.StringType(), True),
    T.StructField("etl_type", T.IntegerType(), True),
    T.StructField("arg_counts", T.IntegerType(), True),
    T.StructField("target", T.StringType(), True),
    T.StructField("target_db", T.StringType(), True),
    T.StructField("target_table", T.StringType(), True),
    T.StructField("pk_field", T.StringType(), True),
    T.StructField("sync_field", T.StringType(), True),
    T.StructField("max_loop_count", T.IntegerType(), True),
    T.StructField("batch_size", T.IntegerType(), True),
    T.StructField("id_field_name_1", T.StringType(), True),
    T.StructField("last_id_sync_record_1", T.LongType(), True),
    T.StructField("id_field_name_2", T.StringType(), True),
    T.StructField("last_id_sync_record_2", T.LongType(), True),
    T.StructField("timestamp_field_name", T.StringType(), True),
    T.StructField("last_timestamp_sync_record", T.DecimalType(20, 0), True),
])

# One row per shard: min/max of id, event date and timestamp; NULL means "unset".
SHARD_LOG_SCHEMA = T.StructType([
    T.StructField("sharding_table_name", T.StringType(), False),
    T.StructField("shard_id", T.LongType(), True),
    T.StructField("source_db_name", T.StringType(), True),
    T.StructField("source_table_name", T.StringType(), True),
    T.StructField("id_field_name", T.StringType(), True),
    T.StructField("min_id", T.LongType(), True),
    T.StructField("max_id", T.LongType(), True),
    T.StructField("matchdate_field_name", T.StringType(), True),
    T.StructField("min_matchdate", T.TimestampNTZType(), True),
    T.StructField("max_matchdate", T.TimestampNTZType(), True),
    T.StructField("timestamp_field_name", T.StringType(), True),
    T.StructField("min_timestamp", T.TimestampNTZType(), True),
    T.StructField("max_timestamp", T.TimestampNTZType(), True),
    T.StructField("latest_update_time", T.TimestampNTZType(), True),
    T.StructField("current_columns", T.StringType(), True),
])

# Id ledger: one entry per loaded batch with the keys that loaded. An entry is keyed by the data
# commit that loaded it (load_version) and its batch within that load (house_keeping_id).
LEDGER_SCHEMA = T.StructType([
    T.StructField("load_version", T.LongType(), False),
    T.StructField("house_keeping_id", T.LongType(), False),
    T.StructField("etl_update_date", T.TimestampNTZType(), True),
    T.StructField("source_db", T.StringType(), True),
    T.StructField("source_table", T.StringType(), True),
    T.StructField("ids", T.ArrayType(T.StringType()), True),
    T.StructField("is_source_delete", T.IntegerType(), True),
])

# Conversion rule list (the field name `covert_data_type` is spelled as in the source format).
RULE_SCHEMA = T.StructType([
    T.StructField("target_db", T.StringType(), True),
    T.StructField("target_table", T.StringType(), True),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("original_data_type", T.StringType(), True),
    T.StructField("covert_data_type", T.StringType(), True),
])

# Default watermarks of a new task, as in the source format.
DEFAULT_LAST_ID = 0
DEFAULT_LAST_TIMESTAMP = datetime(1970, 1, 1, 0, 0, 1)

# Source column type text (information-schema style) -> Spark type. Decimal, char and varchar carry
# parameters and are matched by pattern below.
_SIMPLE_TYPES = {
    "tinyint": T.IntegerType(), "smallint": T.IntegerType(), "mediumint": T.IntegerType(),
    "int": T.IntegerType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "real": T.DoubleType(),
    "date": T.DateType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType(),
    "time": T.StringType(), "year": T.IntegerType(),
    "text": T.StringType(), "tinytext": T.StringType(), "mediumtext": T.StringType(),
    "longtext": T.StringType(), "json": T.StringType(), "enum": T.StringType(), "set": T.StringType(),
    "blob": T.BinaryType(), "longblob": T.BinaryType(), "binary": T.BinaryType(),
    "varbinary": T.BinaryType(), "bit": T.IntegerType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
}


def spark_type(type_text: str) -> T.DataType:
    """Map a source column type such as ``decimal(12,2)``, ``varchar(64)`` or ``bigint unsigned``."""
    t = type_text.strip().lower()
    unsigned = " unsigned" in t
    t = t.replace(" unsigned", "").replace(" zerofill", "").strip()
    m = re.fullmatch(r"(decimal|numeric)\s*\((\d+)\s*(?:,\s*(\d+))?\)", t)
    if m:
        p, s = int(m.group(2)), int(m.group(3) or 0)
        if p > 38:
            raise ValueError(f"decimal precision {p} exceeds Spark's 38: {type_text}")
        return T.DecimalType(p, s)
    if t in ("decimal", "numeric"):
        return T.DecimalType(10, 0)
    if re.fullmatch(r"tinyint\s*\(1\)", t):
        return T.IntegerType()
    base = re.sub(r"\s*\(.*\)$", "", t)
    if base in ("char", "varchar"):
        return T.StringType()
    if base == "bigint" and unsigned:
        return T.DecimalType(20, 0)
    if base == "int" and unsigned:
        return T.LongType()
    if base not in _SIMPLE_TYPES:
        raise ValueError(f"unknown source type: {type_text}")
    return _SIMPLE_TYPES[base]


def split_fields(sync_field: str | None) -> list[str]:
    """Trimmed field list of a comma-separated `sync_field`; backticks removed; `ignore` dropped."""
    if not sync_field:
        return []
    out = []
    for f in sync_field.split(","):
        name = f.strip().strip("`").strip()
        if name and name.lower() != "ignore":
            out.append(name)
    return out


@dataclass
class SyncTask:
    """One table-sync task (a row of TASK_SCHEMA) in the form the operators take."""
    source_table_id: int
    source_db: str
    source_table: str
    target_db: str
    target_table: str
    etl_type: int
    sync_field: str
    pk_field: str | None = None
    id_field_name: str | None = None
    timestamp_field_name: str | None = None
    event_date_field_name: str | None = None
    batch_size: int = 10_000
    max_loop_count: int = 1_500
    partition_size: int = 1_000_000_000
    last_id_sync_record: int | str | None = DEFAULT_LAST_ID
    last_timestamp_sync_record: datetime | None = DEFAULT_LAST_TIMESTAMP
    if_need_house_keeping: int = 0
    is_active: int = 1
    job_group: int = 0
    source: str | None = None
    target: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        return split_fields(self.sync_field)

    @property
    def keys(self) -> list[str]:
        """Key columns (a comma list is a composite key)."""
        return split_fields(self.pk_field)

    @property
    def row_cap(self) -> int:
        return int(self.batch_size) * int(self.max_loop_count)

    @classmethod
    def from_row(cls, row: dict) -> "SyncTask":
        names = {f.name for f in fields(cls)}
        kw = {k: v for k, v in row.items() if k in names}
        rest = {k: v for k, v in row.items() if k not in names}
        return cls(**kw, extra=rest)


class TaskError(ValueError):
    """A task row that cannot run as configured."""


def validate_task(task: SyncTask) -> SyncTask:
    """Reject task rows the reference would run into an error or silently lose rows with."""
    if task.etl_type not in (0, 1, 2, 3, 4):
        raise TaskError(f"task {task.source_table_id}: unknown etl_type {task.etl_type}")
    if not task.fields:
        raise TaskError(f"task {task.source_table_id}: empty sync_field")
    if task.etl_type in (1, 2, 3) and not task.id_field_name:
        raise TaskError(f"task {task.source_table_id}: type {task.etl_type} needs id_field_name")
    if task.etl_type in (2, 3) and not task.timestamp_field_name:
        raise TaskError(f"task {task.source_table_id}: type {task.etl_type} needs timestamp_field_name")
    if task.if_need_house_keeping == 1 and not task.timestamp_field_name:
        # a blank timestamp field would turn into the text 'nan' inside the retention query
        raise TaskError(f"task {task.source_table_id}: house-keeping needs timestamp_field_name")
    if task.if_need_house_keeping == 1 and not task.keys:
        raise TaskError(f"task {task.source_table_id}: house-keeping needs pk_field")
    missing = [k for k in task.keys if k not in task.fields]
    if missing:
        raise TaskError(f"task {task.source_table_id}: key {missing} not in sync_field")
    for name in ("batch_size", "max_loop_count", "partition_size"):
        value = getattr(task, name)
        if value is None or int(value) <= 0:
            raise TaskError(f"task {task.source_table_id}: {name} must be a positive number, got {value}")
    return task


def validate_sp_task(row: dict) -> dict:
    """Procedure-sync task checks: the argument count must fit the type."""
    etl_type, args = row.get("etl_type"), row.get("arg_counts")
    allowed = {1: (2, 3), 2: (2,), 4: (2, 3)}
    if etl_type not in allowed:
        raise TaskError(f"task {row.get('source_table_id')}: unknown procedure etl_type {etl_type}")
    if args not in allowed[etl_type]:
        raise TaskError(f"task {row.get('source_table_id')}: type {etl_type} takes {allowed[etl_type]} arguments, "
                        f"got {args}")
    if args == 3 and not row.get("id_field_name_2"):
        raise TaskError(f"task {row.get('source_table_id')}: 3 arguments need id_field_name_2")
    return row
