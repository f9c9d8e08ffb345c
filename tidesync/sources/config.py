"""Config sources (A4, A5): the control-table CSV and the JSON rule list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RULE_SCHEMA, TASK_SCHEMA, TASK_SP_SCHEMA

# Column names of the control-table CSV (table sync), in file order.
TASK_CSV_COLUMNS = [
    "source_table_id", "airflow_task_id", "is_active", "source_username", "source_password", "source_host",
    "source_db", "source_table", "target_username", "target_password", "target_host", "target_db",
    "target_table", "pk_field", "sync_field", "etl_type", "max_loop_count", "batch_size", "partition_size",
    "id_field_name", "last_id_sync_record", "last_id_house_keeping_record", "timestamp_field_name",
    "last_timestamp_sync_record", "last_timestamp_house_keeping_record", "source_write_username",
    "source_write_password", "if_need_house_keeping", "event_date_field_name",
]

# Column names of the control-table CSV (procedure sync), in file order.
TASK_SP_CSV_COLUMNS = [
    "source_table_id", "airflow_task_id", "is_active", "source_username", "source_password", "source_host",
    "source_db", "source_table", "source_sp", "etl_type", "arg_counts", "target_username", "target_password",
    "target_host", "target_db", "target_table", "pk_field", "sync_field", "max_loop_count", "batch_size",
    "id_field_name_1", "last_id_sync_record_1", "id_field_name_2", "last_id_sync_record_2",
    "timestamp_field_name", "last_timestamp_sync_record",
]

# Fixed value: the timestamp format of the CSV watermarks ('1970-01-01 0:00:01').
CSV_TIMESTAMP_FORMAT = "yyyy-M-d H:mm:ss"

_NULL_TOKENS = ("", "nan", "NULL")


def _raw_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    raw = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
           .option("mode", "FAILFAST").csv(path))
    # blank and 'nan' / 'NULL' cells are missing values
    return raw.select(*[F.when(F.trim(F.col(c)).isin(list(_NULL_TOKENS)), F.lit(None))
                      .otherwise(F.trim(F.col(c))).alias(c) for c in columns])


def _ref(user: str, host: str):
    # a connection reference without the secret: user@host
    return F.when(F.col(host).isNotNull(), F.concat_ws("@", F.col(user), F.col(host)))


def _typed(raw: DataFrame, schema: T.StructType, renames: dict) -> DataFrame:
    cols = []
    for f in schema.fields:
        src = renames.get(f.name, f.name)
        if isinstance(src, str):
            c = F.col(src) if src in raw.columns else F.lit(None)
        else:
            c = src
        if isinstance(f.dataType, T.TimestampNTZType):
            c = F.try_to_timestamp(c, F.lit(CSV_TIMESTAMP_FORMAT)).cast(T.TimestampNTZType())
        else:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_tasks_csv(spark: SparkSession, path: str) -> DataFrame:
    """Control-table CSV (table sync) -> TASK_SCHEMA rows; passwords are not carried (A4)."""
    raw = _raw_csv(spark, path, TASK_CSV_COLUMNS)
    return _typed(raw, TASK_SCHEMA, {
        "job_group": "airflow_task_id",
        "source": _ref("source_username", "source_host"),
        "target": _ref("target_username", "target_host"),
        "source_write": _ref("source_write_username", "source_host"),
    })


def read_sp_tasks_csv(spark: SparkSession, path: str) -> DataFrame:
    """Control-table CSV (procedure sync) -> TASK_SP_SCHEMA rows (A4)."""
    raw = _raw_csv(spark, path, TASK_SP_CSV_COLUMNS)
    return _typed(raw, TASK_SP_SCHEMA, {
        "job_group": "airflow_task_id",
        "source": _ref("source_username", "source_host"),
        "target": _ref("target_username", "target_host"),
    })


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """JSON rule list (A5): a JSON array of rule objects."""
    return spark.read.schema(RULE_SCHEMA).option("multiLine", True).json(path)
