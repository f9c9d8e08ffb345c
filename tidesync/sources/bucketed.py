"""A target kept in hash buckets of its key, so that an upsert joins it where it lies.

The files of a bucket hold the rows whose key hashes to it, as a shuffle by the key would deal them. A scan of the table is
therefore already partitioned: only the changes are shuffled, to the table's number of buckets, and neither the join nor the
write moves a target row to another task. A table is a folder ``root/V-T`` a version and a state file that names the
current one, switched like ``TableStore``'s.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.load import upsert
from ..plans.commit import CommitConflict, _FS


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """``df`` as a folder of bucket files. Rows are not shuffled here: a task writes a file for each bucket it
    holds, which is one if ``df`` is dealt by the keys into as many partitions."""
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")          # the catalog's entry; the files are not its own


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A scan that knows the files' buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")                    # the frame holds the files and their buckets already
    return df


class BucketedTarget:
    """A target table by ``keys`` in ``buckets`` buckets; both stay as the first load set them."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), buckets: int = 0):
        self.spark, self.root, self._fs = spark, root.rstrip("/"), _FS(spark, root)
        st = self.state()
        self.keys, self.buckets = (st["keys"], st["buckets"]) if st else (list(keys), int(buckets))
        if not self.keys or self.buckets < 1:
            raise ValueError(f"{root}: a new table needs keys and a number of buckets")

    def state(self) -> dict | None:
        versions = [int(n[:-5]) for n in self._fs.list_names("_state") if n.endswith(".json") and n[:-5].isdigit()]
        return json.loads(self._fs.read_text(f"_state/{max(versions):08d}.json")) if versions else None

    def read(self) -> DataFrame:
        st = self.state()
        if st is None:
            raise ValueError(f"{self.root}: no load yet")
        return read_bucketed(self.spark, f"{self.root}/{st['folder']}", T.StructType.fromJson(st["schema"]), self.keys, self.buckets)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` shuffled as the table's buckets are."""
        return rows.repartition(self.buckets, *self.keys)

    def upserted(self, changes: DataFrame, order: Sequence[str] | None = None, keep: Sequence[str] = (),
                 unique_order: bool = False) -> DataFrame:
        """The table's rows after ``changes`` (E2); as a plan, its one shuffle is that of the changes."""
        return upsert(self.read(), self.dealt(changes), self.keys, order=order, keep=keep, unique_order=unique_order)

    def load(self, rows: DataFrame, expected_version: int | None = None, watermark: Mapping | None = None) -> int:
        """Make ``rows`` the content. A first load is dealt into buckets; what ``upserted`` returns lies in them."""
        st = self.state()
        version = 0 if st is None else st["version"]
        if expected_version is not None and expected_version != version:
            raise CommitConflict(f"expected version {expected_version}, found {version}")
        folder = f"{version + 1}-{uuid.uuid4().hex[:12]}"
        write_bucketed(self.dealt(rows) if st is None else rows, f"{self.root}/{folder}", self.keys, self.buckets)
        state = {"version": version + 1, "folder": folder, "keys": self.keys, "buckets": self.buckets,
                 "schema": json.loads(rows.schema.json()), "watermark": dict(watermark or (st or {}).get("watermark") or {})}
        self._fs.write_new(f"_state/{version + 1:08d}.json", json.dumps(state, default=str, sort_keys=True))
        return version + 1

    def upsert(self, changes: DataFrame, order: Sequence[str] | None = None, keep: Sequence[str] = (),
               unique_order: bool = False, watermark: Mapping | None = None) -> int:
        st = self.state()
        if st is None:
            from ..operators.load import latest_per_key
            return self.load(latest_per_key(self.dealt(changes), self.keys, order, unique_order), 0, watermark)
        return self.load(self.upserted(changes, order, keep, unique_order), st["version"], watermark)
