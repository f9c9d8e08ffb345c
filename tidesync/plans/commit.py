"""Versioned table store with one atomic commit of data and watermark.

Layout under ``root`` (a folder on the shared file system)::

    root/ver=V-T/partition_num=P/bucket=B/part-*.parquet   data: one folder per commit attempt and unit
    root/_zones/V-T/, root/_keys/V-T/                      what the attempt's files and units hold (``plans.zones``)
    root/_state/00000007.json                             commit V: {"P/B": "V-T"}, watermark, extras

A unit is a shard (``partition_num``) or a key range inside it (``bucket``): the unit, not the shard,
is what a commit rewrites, so an upsert into a shard of a billion ids rewrites only the key ranges
its changes touch. A commit writes the new unit folders first (readers do not see them), then
creates the next state file: written under a temporary name and renamed to its final name, refused
if a concurrent writer took that version first. A crash before the rename leaves the old data and
the old watermark. Every attempt writes under its own tag ``V-T``, so the files of an attempt that
died are never read by the retry that takes the same version (``vacuum`` removes them).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD = "partition_num"
BUCKET = "bucket"
MIN_BUCKET_SPAN = 1_000_000
BUCKETS_PER_SHARD = 64


# Rows of a file that compaction writes.
FILE_ROWS = 4_000_000
# Deltas of a size that are merged into one, and the share of a unit's rows from which they are written into it.
FAN_IN = 4
# Least bytes of a writing task: a file's cost counts more than its bytes where units are many and small.
SMALLEST_TASK = "64k"
# Shuffled (compressed) bytes from which a unit's rows are dealt to several writing tasks. A task sorts its rows unpacked, which
# took up to 20 times as much of regular columns.
LARGEST_TASK = 16 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Number of tasks that list a table's folders.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _bytes_of(spark: SparkSession, key: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


def bucket_span(partition_size: int) -> int:
    """Key range of one bucket: a shard splits into up to 64 buckets of at least 1e6 keys."""
    return int(min(partition_size, max(MIN_BUCKET_SPAN, partition_size // BUCKETS_PER_SHARD)))


def bucket_expr(key: str, dtype: T.DataType, partition_size: int) -> Column:
    """Bucket of a row inside its shard: integral keys by key range, other keys by hash."""
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.call_function("div", F.col(key).cast("long"), F.lit(bucket_span(partition_size)))
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(BUCKETS_PER_SHARD)).cast("long")


def unit_key(shard, bucket) -> str:
    return f"{shard}/{bucket}"


class _FS:
    """The few Hadoop FileSystem calls the store needs (works on HDFS, object stores and local)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, rel: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, rel)

    def list_names(self, rel: str) -> list[str]:
        p = self.path(rel)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p)]

    def glob_parents(self, pattern: str, levels: int) -> list[list[str]]:
        """For each match of ``pattern``: its own name and its parents', ``levels`` in all, outermost first."""
        out = []
        for st in (self.fs.globStatus(self.path(pattern)) or []):
            p, names = st.getPath(), []
            for _ in range(levels):
                names.append(p.getName())
                p = p.getParent()
            out.append(names[::-1])
        return out

    def read_text(self, rel: str) -> str:
        stream = self.fs.open(self.path(rel))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, rel: str, text: str) -> None:
        """Create ``rel`` with ``text``: written to a temporary name, then renamed into place.

        On HDFS the rename itself fails when ``rel`` exists, so two writers of one version cannot
        both win; on a local disk the existence check before the rename is best effort (one writer).
        """
        final = self.path(rel)
        tmp = self.path(f"{rel}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if self.fs.exists(final) or not self.fs.rename(tmp, final):
            self.fs.delete(tmp, False)
            raise CommitConflict(f"{final} already exists")


class TableStore:
    """A table folder with versioned units (shard, bucket) and a committed watermark."""

    def __init__(self, spark: SparkSession, root: str, zones: Iterable[str] = (), key: str | None = None):
        """``zones``: columns whose least and greatest value each commit records per file; ``key``: an integral
        column whose values it records per unit as bitmaps. The first commit's choice stays with the table."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.indexed = {"zones": list(zones), "key": key} if zones or key else None
        self._fs = _FS(spark, self.root)
        self._cache: tuple[int, dict] | None = None     # (version, parsed state): a state never changes

    # ------------------------------------------------------------------ state
    def version(self) -> int:
        names = [n for n in self._fs.list_names("_state") if n.endswith(".json") and n[:-5].isdigit()]
        return max((int(n[:-5]) for n in names), default=0)

    def state(self) -> dict:
        v = self.version()
        if v == 0:
            return {"version": 0, "units": {}, "tags": {}, "watermark": {}, "schema": None, "extra": {}}
        if self._cache is None or self._cache[0] != v:
            self._cache = (v, json.loads(self._fs.read_text(f"_state/{v:08d}.json")))
        return json.loads(json.dumps(self._cache[1]))   # a copy: callers may change what they get

    def watermark(self) -> dict:
        return self.state()["watermark"]

    def units(self) -> list[str]:
        return sorted(self.state()["units"])

    def schema(self) -> T.StructType | None:
        """The committed columns, None before the first commit."""
        text = self.state().get("schema")
        return T.StructType.fromJson(json.loads(text)) if text else None

    # ------------------------------------------------------------------ read
    def read(self, schema: T.StructType | None = None, units: Iterable[str] | None = None,
             shards: Iterable | None = None, keep_unit: bool = False) -> DataFrame:
        """The committed rows; only the folders of ``units`` (or of ``shards``) when given.
        ``keep_unit`` keeps the ``bucket`` column (to rewrite exactly the units rows came from)."""
        st = self.state()
        committed = st["units"]
        pick = set(committed) if units is None else set(units) & set(committed)
        if shards is not None:
            wanted = {str(s) for s in shards}
            pick = {u for u in pick if u.split("/", 1)[0] in wanted}
        want = T.StructType.fromJson(json.loads(st["schema"])) if st.get("schema") else schema
        if not pick and want is None:
            raise ValueError(f"{self.root}: empty table and no schema given")
        changed = {u for u in pick if u in st.get("deltas", {})}
        plain = self.read_paths(self._folders(st, [(u, committed[u]) for u in pick - changed]), want, keep_unit)
        if not changed:
            return plain
        merged = self._merged(st, changed, want)
        merged = merged if keep_unit else merged.drop(BUCKET)
        return merged if changed == pick else plain.unionByName(merged)

    def _merged(self, st: dict, units: set[str], want: T.StructType) -> DataFrame:
        """Rows of units with deltas: the last version of a key, the kept columns as first written. The base rows are
        read through an anti-join, as in an upsert; only the deltas are aggregated."""
        from ..operators.load import upsert
        by = st["delta_by"]
        base = self.read_paths(self._folders(st, [(u, st["units"][u]) for u in units]), want, True)
        changes = self._delta_rows(st, {u: st["deltas"][u] for u in units}, want)
        return upsert(base, changes, [SHARD, BUCKET, *by["keys"]], keep=by["keep"], dedupe=False).select(*base.columns)

    def _delta_rows(self, st: dict, deltas: Mapping[str, list[str]], want: T.StructType) -> DataFrame:
        """One row per key of the given deltas: its last version, the kept columns of its first one."""
        by = st["delta_by"]
        rows = self.read_paths(self._folders(st, [(u, t) for u, tags in deltas.items() for t in tags]), want, True, keep_version=True)
        keys = [SHARD, BUCKET, *by["keys"]]
        kept = [c for c in by["keep"] if c in rows.columns]
        values = [c for c in rows.columns if c not in (*keys, *kept, "ver")]
        at = F.split("ver", "-")[0].cast("long")
        aggs = [F.max_by(F.struct(*values), at).alias("_last"), *([F.min_by(F.struct(*kept), at).alias("_first")] if kept else [])]
        last = rows.groupBy(*keys).agg(*aggs)
        return last.select(*[F.col(c) if c in keys else F.col("_first" if c in kept else "_last")[c].alias(c)
                             for c in rows.columns if c != "ver"])

    def _folders(self, st: dict, pairs: Iterable[tuple[str, str]]) -> list[str]:
        """Folders of (unit, attempt) pairs; an attempt's own folder where all its units are read."""
        by_tag: dict[str, list[str]] = {}
        for u, tag in sorted(pairs):
            by_tag.setdefault(tag, []).append(u)
        whole = st.get("tags", {})
        return [path for tag, units in by_tag.items() for path in
                ([f"{self.root}/ver={tag}"] if whole.get(tag, {}).get("units") == len(units) else [self.unit_path(u, tag) for u in units])]

    def unit_path(self, unit: str, tag: str) -> str:
        p, b = unit.split("/", 1)
        return f"{self.root}/ver={tag}/{SHARD}={p}/{BUCKET}={b}"

    def read_paths(self, paths: list[str], want: T.StructType | None, keep_unit: bool = False,
                   keep_version: bool = False) -> DataFrame:
        """Rows of files or folders of this table under the schema ``want`` (the committed one);
        ``keep_version`` keeps the attempt's tag as ``ver``."""
        if not paths:
            empty = self.spark.createDataFrame([], want)
            return empty.withColumn(BUCKET, F.lit(None).cast("long")) if keep_unit else empty
        reader = self.spark.read.option("basePath", self.root)
        if want is not None:
            # the committed schema, not one file's: columns added later read as NULL in older files
            have_cols = {f.name for f in want.fields}
            extra = [T.StructField(c, T.LongType()) for c in (SHARD, BUCKET) if c not in have_cols]
            reader = reader.schema(T.StructType(list(want.fields) + extra + [T.StructField("ver", T.StringType())]))
        # by default a task lists one folder, and each sends its own report to the driver
        with _setting(self.spark, LISTING, str(4 * max(8, self.spark.sparkContext.defaultParallelism))):
            df = reader.parquet(*paths)
        if not keep_version:
            df = df.drop("ver")
        if want is not None:
            have = {f.name: f.dataType for f in df.schema.fields}

            def col(f):
                if f.name not in have:
                    return F.lit(None).cast(f.dataType).alias(f.name)
                if have[f.name].simpleString() == f.dataType.simpleString():
                    return F.col(f.name)      # same type (nullability may differ after a round trip)
                return F.col(f.name).cast(f.dataType).alias(f.name)
            df = df.select(*[col(f) for f in want.fields], BUCKET, *(["ver"] if keep_version else []))
        return df if keep_unit else df.drop(BUCKET)

    def read_where(self, ranges: Mapping, keep_unit: bool = False) -> DataFrame:
        """The committed rows without the files whose zones show that they hold no row within ``ranges``
        (column -> (least, greatest), None for open ends). Files of commits without zones are read, and so
        are units with deltas, where a file alone does not show a row's last version. The caller still
        filters."""
        from .zones import matching_files
        st = self.state()
        found = self.read_paths(matching_files(self, st, ranges), self.schema(), keep_unit)
        changed = list(st.get("deltas", {}))
        return found.unionByName(self.read(units=changed, keep_unit=keep_unit)) if changed else found

    # ------------------------------------------------------------------ write
    def stage(self, df: DataFrame, cluster_by: list[str] | None = None, small: bool = False,
              bucket: Column | None = None, ranges: tuple[int, Column] | None = None) -> dict:
        """Write ``df`` under a fresh attempt tag; readers do not see it until ``publish``.

        ``df`` carries ``partition_num``; ``bucket`` (an expression) splits shards into units,
        default one unit per shard. Rows are rebalanced on the unit (AQE): small units are coalesced
        and a dominant one is split into pieces of ``LARGEST_TASK`` bytes, never funnelled into one task; files
        are sorted by ``cluster_by`` so keyset filters can skip row groups. ``small`` is for tables
        bounded by design (the shard log: one row per shard): one file. ``ranges`` (a number and an
        expression) deals and sorts the rows by ranges of the expression inside their units instead.
        """
        tag = f"{self.version() + 1}-{uuid.uuid4().hex[:12]}"      # this attempt's folders only
        if SHARD not in df.columns:
            df = df.withColumn(SHARD, F.lit(0).cast("long"))
        data_cols = [c for c in df.columns if c != BUCKET]
        b = bucket if bucket is not None else (F.col(BUCKET) if BUCKET in df.columns else F.lit(0))
        df = df.withColumn(BUCKET, b.cast("long"))
        cluster = [c for c in (cluster_by or []) if c in df.columns and c not in (SHARD, BUCKET)]
        if ranges is not None:
            out, cluster = df.withColumn("_place", ranges[1]), ["_place"]
            out = out.repartitionByRange(ranges[0], SHARD, BUCKET, "_place")
        else:
            # a shuffle, as coalesce(1) would run the joins and sorts before it in one task, a partition after the other
            out = df.repartition(1) if small else df.hint("rebalance", SHARD, BUCKET)
        # the write itself reports its units (one entry a unit): no folder is listed for them
        seen = Observation()
        out = (out.sortWithinPartitions(SHARD, BUCKET, *cluster).drop("_place").withColumn("ver", F.lit(tag))
               .observe(seen, F.collect_set(F.struct(SHARD, BUCKET)).alias("units"), F.count(F.lit(1)).alias("rows")))
        with (_setting(self.spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", SMALLEST_TASK),
              _setting(self.spark, ADVISORY, f"{min(_bytes_of(self.spark, ADVISORY), LARGEST_TASK)}b")):
            out.write.mode("append").partitionBy("ver", SHARD, BUCKET).parquet(self.root)
        written = sorted(unit_key(u[SHARD], u[BUCKET]) for u in seen.get["units"])
        indexed = self.state().get("indexed") or self.indexed
        if indexed and written:
            from .zones import write_index
            write_index(self, tag, indexed)
        return {"tag": tag, "written": written, "rows": seen.get["rows"], "schema": df.select(*data_cols).schema.json(),
                "indexed": indexed}

    def publish(self, staged: Mapping, watermark: Mapping | None = None, touched: Iterable[str] | None = None,
                replace_all: bool = False, extra: Mapping | None = None,
                expected_version: int | None = None, delta: Mapping | None = None) -> int:
        """Make a staged write the table's content: one new state file (atomic).

        ``touched`` lists unit keys ("P/B") whose content the staged rows replace (listed units left
        empty are dropped); ``replace_all`` drops every unit absent from the staged rows. With ``delta``
        ({"keys", "keep", "merges"}) the staged rows change units instead: they are read over what the units
        hold, and take the place of the deltas that "merges" lists per unit.
        """
        st = self.state()
        base = st["version"] if expected_version is None else expected_version
        if base != st["version"]:
            raise CommitConflict(f"expected version {base}, found {st['version']}")
        new_v = base + 1
        units = {} if replace_all else dict(st["units"])
        deltas = {} if replace_all else {u: list(tags) for u, tags in st.get("deltas", {}).items()}
        for u in touched or ():
            units.pop(str(u), None)         # replaced; re-added below when it still has rows
            deltas.pop(str(u), None)
        merges = (delta or {}).get("merges", {})
        for u, gone in merges.items():
            deltas[u] = [t for t in deltas[u] if t not in gone]
        for u in staged["written"]:
            if delta is not None and u in units:
                deltas.setdefault(u, []).append(staged["tag"])
            else:
                units[u] = staged["tag"]
                deltas.pop(u, None)
        deltas = {u: tags for u, tags in deltas.items() if tags}
        live = set(units.values()) | {t for tags in deltas.values() for t in tags}
        written = {"units": len(staged["written"]), "rows": staged["rows"]}
        tags = {t: n for t, n in {**st.get("tags", {}), staged["tag"]: written}.items() if t in live}
        with_index = set(st.get("with_index", [])) | ({staged["tag"]} if staged.get("indexed") else set())
        by = st.get("delta_by") if delta is None else {"keys": list(delta["keys"]), "keep": list(delta["keep"])}
        new_state = {"version": new_v, "units": units, "deltas": deltas, "delta_by": by, "tags": tags,
                     "indexed": staged.get("indexed"), "with_index": sorted(with_index & live),
                     "watermark": dict(watermark if watermark is not None else st.get("watermark") or {}),
                     "schema": self._evolved(st, T.StructType.fromJson(json.loads(staged["schema"]))).json(),
                     "extra": dict(extra if extra is not None else st.get("extra") or {})}
        self._fs.write_new(f"_state/{new_v:08d}.json", json.dumps(new_state, default=str, sort_keys=True))
        return new_v

    def commit(self, df: DataFrame, watermark: Mapping | None = None, touched: Iterable[str] | None = None,
               replace_all: bool = False, extra: Mapping | None = None, cluster_by: list[str] | None = None,
               expected_version: int | None = None, small: bool = False,
               bucket: Column | None = None) -> int:
        """``stage`` then ``publish``: write ``df`` as the new content of the units it holds and of
        ``touched``, then switch to it."""
        staged = self.stage(df, cluster_by=cluster_by, small=small, bucket=bucket)
        return self.publish(staged, watermark=watermark, touched=touched, replace_all=replace_all, extra=extra,
                            expected_version=expected_version)

    def commit_delta(self, changes: DataFrame, keys: list[str], keep: Iterable[str] = (), watermark: Mapping | None = None,
                     extra: Mapping | None = None, expected_version: int | None = None) -> int:
        """Write only ``changes`` (one row per key and unit, all committed columns, ``bucket`` included): readers put
        them over the rows of their units by the last version. ``keep`` columns stay as first written."""
        missing = [f.name for f in (self.schema() or T.StructType()).fields if f.name not in changes.columns]
        if missing:
            raise ValueError(f"a delta needs all committed columns, not only without {missing}")
        staged = self.stage(changes, cluster_by=list(keys))
        return self.publish(staged, watermark, extra=extra, expected_version=expected_version, delta={"keys": keys, "keep": list(keep)})

    def fold_deltas(self, fan_in: int = FAN_IN) -> dict:
        """Merge deltas by size tiers. A unit whose newest ``fan_in`` deltas have rows of the same power of
        ``fan_in`` gets one delta for them; where that would have a ``fan_in``-th of the rows of its base, or where
        ``fan_in ** 2`` deltas of mixed sizes have come together, the unit is rewritten. So a row is written again
        once a tier, not once a run. Rows of a unit are taken as its attempt's mean."""
        st = self.state()
        size = lambda t: st["tags"][t]["rows"] / st["tags"][t]["units"]
        tier = lambda t: int(math.log(max(size(t), 1), fan_in))
        rewrite, merges = [], {}
        for u, tags in st.get("deltas", {}).items():
            newest = tags[-fan_in:]
            alike = len(newest) == fan_in and len({tier(t) for t in newest}) == 1
            if len(tags) >= fan_in * fan_in or alike and sum(map(size, newest)) * fan_in >= size(st["units"][u]):
                rewrite.append(u)
            elif alike:
                merges[u] = newest
        by, want = st.get("delta_by"), self.schema()
        if merges:
            staged = self.stage(self._delta_rows(st, merges, want), cluster_by=by["keys"])
            self.publish(staged, delta={**by, "merges": merges}, expected_version=st["version"])
        if rewrite:
            self.commit(self.read(units=rewrite, keep_unit=True), touched=rewrite, cluster_by=by["keys"])
        return {"merged": len(merges), "rewritten": len(rewrite)}

    def compact(self, columns: list[str], units: Iterable[str] | None = None, file_rows: int = FILE_ROWS) -> int | None:
        """Rewrite units (all by default) in files of about ``file_rows`` rows, clustered on all ``columns`` at
        once by Z-order; deltas go into them. Refused if another commit came in between. The new version."""
        from ..operators.layout import z_value
        version = self.version()
        picked = self.units() if units is None else sorted(set(units) & set(self.units()))
        if not picked:
            return None
        rows = self.read(units=picked, keep_unit=True)
        staged = self.stage(rows, ranges=(max(1, -(-rows.count() // file_rows)), z_value(rows, columns)))
        return self.publish(staged, touched=picked, expected_version=version)

    def read_staged(self, staged: Mapping) -> DataFrame:
        """The rows of a staged write, published or not."""
        schema = T.StructType.fromJson(json.loads(staged["schema"]))
        if not staged["written"]:
            return self.spark.createDataFrame([], schema)
        fields = [f for f in schema.fields if f.name != SHARD]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/ver={staged['tag']}").select(
            *[f.name for f in fields])

    def holds(self, tag: str) -> bool:
        """Whether the current state references the staged write ``tag``."""
        return tag in self.state()["tags"]

    # ------------------------------------------------------------------ clean-up
    def vacuum(self, keep: int = 5) -> dict:
        """Delete what the last ``keep`` commits do not reference: older state files and unit
        folders left behind by copy-on-write (or by a writer that lost a commit race). Folders newer
        than the latest commit are left alone: a writer may be producing them. Readers holding a
        state older than the last ``keep`` commits must have finished."""
        versions = sorted(int(n[:-5]) for n in self._fs.list_names("_state")
                          if n.endswith(".json") and n[:-5].isdigit())
        if not versions:
            return {"states": 0, "folders": 0}
        kept = versions[-max(1, keep):]
        latest = kept[-1]
        referenced = set()
        for v in kept:
            st = json.loads(self._fs.read_text(f"_state/{v:08d}.json"))
            referenced |= {(u, str(tag)) for u, tag in st["units"].items()}
            referenced |= {(u, str(tag)) for u, tags in st.get("deltas", {}).items() for tag in tags}
        folders = 0
        live = {tag for _, tag in referenced}
        for (ver,) in self._fs.glob_parents("ver=*", 1):
            tag = ver.split("=", 1)[1]
            if int(tag.split("-", 1)[0]) > latest:
                continue
            dead = [f"{p}/{b}" for p, b in self._fs.glob_parents(f"{ver}/{SHARD}=*/{BUCKET}=*", 2)
                    if (unit_key(p.split("=", 1)[1], b.split("=", 1)[1]), tag) not in referenced]
            folders += len(dead)
            gone = [f"{ver}/{u}" for u in dead] if tag in live else [ver, f"_zones/{tag}", f"_keys/{tag}"]
            for path in gone:
                self._fs.fs.delete(self._fs.path(path), True)
        states = 0
        for v in versions[:-len(kept)]:
            self._fs.fs.delete(self._fs.path(f"_state/{v:08d}.json"), False)
            states += 1
        return {"states": states, "folders": folders}

    @staticmethod
    def _evolved(st: dict, new: T.StructType) -> T.StructType:
        """Add-only: the committed columns keep place and type; new ones are appended."""
        from ..operators.schema_ops import evolve_schema
        if not st.get("schema"):
            return new
        return evolve_schema(T.StructType.fromJson(json.loads(st["schema"])), new)
