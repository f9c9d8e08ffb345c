"""Table sources (A1, A3): Parquet/ORC/CSV/JSON files, catalog tables and JDBC databases.

A JDBC read is split into ``num_partitions`` parallel range queries on a numeric column; the database
evaluates the pushed filters, so a keyset extract only ships the rows after the watermark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, spec: Mapping) -> DataFrame:
    """Read a source described by ``spec``.

    ``{"format": "parquet", "path": ...}`` (also orc, csv, json), ``{"format": "table", "name": ...}``,
    or ``{"format": "jdbc", "url": ..., "dbtable": ..., "partition_column": ..., "num_partitions": ...,
    "lower_bound": ..., "upper_bound": ..., "properties": {...}}``. Optional ``columns`` projects.
    """
    fmt = spec.get("format", "parquet")
    if fmt == "table":
        df = spark.read.table(spec["name"])
    elif fmt == "jdbc":
        df = read_jdbc(spark, spec)
    else:
        reader = spark.read.format(fmt)
        if spec.get("schema") is not None:
            reader = reader.schema(spec["schema"])
        for k, v in (spec.get("options") or {}).items():
            reader = reader.option(k, v)
        df = reader.load(spec["path"])
    cols = spec.get("columns")
    return df.select(*cols) if cols else df


def jdbc_bounds(spark: SparkSession, url: str, dbtable: str, column: str, properties: Mapping) -> tuple:
    """min/max of the split column, computed by the database (one small query)."""
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {dbtable}"
    row = (spark.read.format("jdbc").option("url", url).option("query", q)
           .options(**dict(properties)).load().first())
    return row[0], row[1]            # by position: databases differ in the case of column names


def read_jdbc(spark: SparkSession, spec: Mapping) -> DataFrame:
    props = dict(spec.get("properties") or {})
    reader = spark.read.format("jdbc").option("url", spec["url"]).options(**props)
    if spec.get("query"):
        return reader.option("query", spec["query"]).load()
    reader = reader.option("dbtable", spec["dbtable"])
    col = spec.get("partition_column")
    if col:
        lo, hi = spec.get("lower_bound"), spec.get("upper_bound")
        if lo is None or hi is None:
            lo, hi = jdbc_bounds(spark, spec["url"], spec["dbtable"], col, props)
        if lo is not None and hi is not None:
            reader = (reader.option("partitionColumn", col).option("lowerBound", str(lo))
                      .option("upperBound", str(hi)).option("numPartitions", str(spec.get("num_partitions", 8))))
    if spec.get("fetchsize"):
        reader = reader.option("fetchsize", str(spec["fetchsize"]))
    return reader.load()


def register_views(spark: SparkSession, base_dir: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Register ``base_dir/NAME.parquet`` as temp views ``NAME``; returns the frames."""
    out = {}
    for n in names:
        df = spark.read.parquet(f"{base_dir.rstrip('/')}/{n}.parquet")
        df.createOrReplaceTempView(n)
        out[n] = df
    return out


def read_query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A query to a frame with its column names (A3): Spark SQL over registered views.

    For a query run inside a database use ``read_table`` with ``{"format": "jdbc", "query": ...}``.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
