"""Zone maps and key sets of a table store, written with each commit and read back at planning.

``_zones/V-T`` has a row per data file: its unit, its rows, and for each zone column the least and the greatest value
and the number of NULLs. ``_keys/V-T`` has the key sets (bitmaps) of each unit. Both are small Parquet tables that a
Spark job makes from the files just written; only the paths of matching files and the names of matching units reach the
driver, as they do for any scan that Spark plans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bitmaps import holds, pack_keys
from ..operators.extract import _lit_like
from .commit import BUCKET, SHARD, TableStore, unit_key


def write_index(store: TableStore, tag: str, indexed: Mapping) -> None:
    """The zones and key sets of the files that the attempt ``tag`` wrote."""
    files = store.spark.read.option("basePath", store.root).parquet(f"{store.root}/ver={tag}")
    zones = [c for c in indexed["zones"] if c in files.columns]
    if zones:
        bounds = [a for c in zones for a in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"),
                                             F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
        (files.groupBy(F.col(SHARD).cast("string").alias(SHARD), F.col(BUCKET).cast("string").alias(BUCKET),
                       F.col("_metadata.file_path").alias("file"))
         .agg(F.count(F.lit(1)).alias("n_rows"), *bounds).coalesce(1).write.parquet(f"{store.root}/_zones/{tag}"))
    if indexed.get("key") in files.columns:
        unit = files.select(F.col(SHARD).cast("string").alias(SHARD), F.col(BUCKET).cast("string").alias(BUCKET), indexed["key"])
        pack_keys(unit, [SHARD, BUCKET], indexed["key"]).write.parquet(f"{store.root}/_keys/{tag}")


def _index(store: TableStore, st: dict, name: str) -> tuple[DataFrame | None, set[str]]:
    """(the index rows of the live attempts, with ``tag``; those attempts)."""
    tags = set(st.get("with_index", []))
    if not tags:
        return None, tags
    parts = [store.spark.read.parquet(f"{store.root}/{name}/{t}").withColumn("tag", F.lit(t)) for t in sorted(tags)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out, tags


def _paths(store: TableStore, st: dict, found: DataFrame | None, tags: set[str]) -> list[str]:
    """Files of live units in ``found``, and whole units of attempts without an index."""
    units = st["units"]
    rows = [] if found is None else found.select(SHARD, BUCKET, "tag", "file").collect()      # matching files only
    units = {u: t for u, t in units.items() if u not in st.get("deltas", {})}      # read_where reads those whole
    plain = [store.unit_path(u, t) for u, t in sorted(units.items()) if t not in tags]
    return plain + sorted(r["file"] for r in rows if units.get(unit_key(r[SHARD], r[BUCKET])) == r["tag"])


def matching_files(store: TableStore, st: dict, ranges: Mapping) -> list[str]:
    """Paths that can hold a row whose columns lie within ``ranges`` (column -> (least, greatest), None if open)."""
    zones, tags = _index(store, st, "_zones") if _zoned(st, ranges) else (None, set())
    if zones is None:
        return _paths(store, st, None, set())
    schema = store.schema()
    for c, (least, greatest) in ranges.items():
        if least is not None:
            zones = zones.filter(F.col(f"greatest_{c}") >= _lit_like(least, schema[c].dataType))
        if greatest is not None:
            zones = zones.filter(F.col(f"least_{c}") <= _lit_like(greatest, schema[c].dataType))
    return _paths(store, st, zones, tags)


def _zoned(st: dict, columns) -> bool:
    return set(columns) <= set((st.get("indexed") or {}).get("zones", []))


def files_with_nulls(store: TableStore, columns: list[str]) -> DataFrame:
    """The rows of the files that hold a NULL in one of the zone ``columns``."""
    st = store.state()
    zones, tags = _index(store, st, "_zones") if _zoned(st, columns) else (None, set())
    if zones is not None:
        some = F.lit(False)
        for c in columns:
            some = some | (F.col(f"nulls_{c}") > 0)
        zones = zones.filter(some)
    found = store.read_paths(_paths(store, st, zones, tags), store.schema())
    changed = list(st.get("deltas", {}))
    return found.unionByName(store.read(units=changed)) if changed else found


def units_with_keys(store: TableStore, sets: DataFrame) -> list[str] | None:
    """The units that hold a key of ``sets`` (cell, bits, spots: one row a cell), by intersecting their key sets: no
    data file is opened and none is named that holds no such key. None if the table keeps no key sets."""
    st = store.state()
    of = {u: {t, *st.get("deltas", {}).get(u, [])} for u, t in st["units"].items()}
    if not (st.get("indexed") or {}).get("key") or set().union(*of.values()) - set(st.get("with_index", [])):
        return None
    own, _ = _index(store, st, "_keys")
    listed = sets.select("cell", F.col("bits").alias("other_bits"), F.col("spots").alias("other_spots"))
    met = own.join(listed, "cell")
    # two bitmaps meet in a bit of their conjunction, lists in a spot that the other side holds
    lists = met.filter(F.col("bits").isNull() | F.col("other_bits").isNull())
    spots = F.coalesce("spots", "other_spots")
    by_list = lists.filter(F.when(F.col("bits").isNull() & F.col("other_bits").isNull(), F.arrays_overlap("spots", "other_spots"))
                           .otherwise(F.exists(spots, lambda s: holds(F.coalesce("bits", "other_bits"), F.lit(None).cast("array<bigint>"), s))))
    both = met.filter(F.col("bits").isNotNull() & F.col("other_bits").isNotNull())
    by_bits = (both.select("tag", SHARD, BUCKET, "cell", F.explode(F.array("bits", "other_bits")).alias("b"))
               .groupBy("tag", SHARD, BUCKET, "cell").agg(F.bitmap_and_agg("b").alias("b")).filter(F.bitmap_count("b") > 0))
    rows = by_list.select("tag", SHARD, BUCKET).union(by_bits.select("tag", SHARD, BUCKET)).distinct().collect()     # one a unit
    return sorted({unit_key(r[SHARD], r[BUCKET]) for r in rows if r["tag"] in of.get(unit_key(r[SHARD], r[BUCKET]), ())})
