"""Bench: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan executes, nothing is
collected to the driver). The end-to-end runs also write and commit their tables (to fresh folders
under the checkpoint folder). Every query runs once untimed (JIT, class loading and code generation
of its plan shapes at this scale), then once timed: the numbers are warm, steady-state times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidesync.functions.routing import with_partition_num  # noqa: E402
from tidesync.functions.rules import ts_literal  # noqa: E402
from tidesync.operators import extract as X  # noqa: E402
from tidesync.operators import load as L  # noqa: E402
from tidesync.operators import profile as P  # noqa: E402
from tidesync.plans import catalog  # noqa: E402
from tidesync.plans.derived import table  # noqa: E402
from tidesync.session import build_session  # noqa: E402

LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def lineitem_upsert(spark, sf):
    """Upsert of every lineitem row: target = lines shipped before 1999, changes = lines from 1998
    (overlap: updates) with two versions of the lines from 2000 (the later must win)."""
    li = with_partition_num(table(spark, sf, "lineitem"), "l_orderkey", 1000)
    target = li.filter(F.col("l_shipdate") < ts_literal("1999-01-01 00:00:00"))
    v1 = li.filter(F.col("l_shipdate") >= ts_literal("1998-01-01 00:00:00")) \
        .withColumns({"l_quantity": F.col("l_quantity") + 1, "_seq": F.lit(1)})
    v2 = li.filter(F.col("l_shipdate") >= ts_literal("2000-01-01 00:00:00")) \
        .withColumns({"l_quantity": F.col("l_quantity") + 2, "_seq": F.lit(2)})
    return L.upsert(target, v1.unionByName(v2), ["partition_num", *LI_KEYS], order=["_seq"],
                    unique_order=True).drop("_seq")


def lineitem_capped(spark, sf):
    """A production-batch run cap (10,000 x 20 loops) over lineitem's 4-column key."""
    li = table(spark, sf, "lineitem")
    return X.capped_extract(li, LI_KEYS, cap=10_000 * 20, watermark=[0, 0, 0, 0])


def lineitem_profile(spark, sf):
    """Type-2 increment of lineitem by (ship date, keys) -> route -> shard profile."""
    li = table(spark, sf, "lineitem")
    inc = X.capped_extract(li, ["l_shipdate", *LI_KEYS], cap=10_000 * 1_500,
                           watermark=["1996-01-01 00:00:00", 0, 0, 0, 0])
    inc = with_partition_num(inc, "l_orderkey", 100).withColumn("ship_date", F.to_date("l_shipdate"))
    return P.shard_profile(inc, "l_orderkey", "l_shipdate", "ship_date")


BENCH = {
    "shard_profile": catalog.QUERIES["shard_profile"],
    "lineitem_profile": lineitem_profile,
    "capped_extract": lineitem_capped,
    "upsert_lineitem": lineitem_upsert,
    "upsert_orders": catalog.QUERIES["upsert_orders"],
    "expiry_gate": catalog.QUERIES["expiry_gate"],
    "retention_delete": catalog.QUERIES["retention_delete"],
    "duplicate_keys": catalog.QUERIES["duplicate_keys"],
    "shard_log_merge": catalog.QUERIES["shard_log_merge"],
    "conform": catalog.QUERIES["conform"],
}


# Input rows of a query, as the tables it reads; rows/s is reported for these.
INPUTS = {"shard_profile": ["events"], "lineitem_profile": ["lineitem"], "capped_extract": ["lineitem"],
          "upsert_lineitem": ["lineitem"], "upsert_orders": ["orders"], "sync_run_production": ["orders"],
          "duplicate_keys": ["lineitem"]}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="tidesync-bench", shuffle_partitions=max(8, cpus),
                          extra={"spark.driver.memory": "16g"})
    from tidesync.plans import e2e  # noqa: F401  (registers the end-to-end queries)
    bench = dict(BENCH)
    bench["sync_run"] = catalog.QUERIES["sync_run"]
    bench["sync_run_production"] = catalog.QUERIES["sync_run_production"]
    bench["housekeeping_run"] = catalog.QUERIES["housekeeping_run"]
    times = {}
    for name, fn in bench.items():
        fn(spark, sf).write.format("noop").mode("overwrite").save()          # warm-up, untimed
        t0 = time.perf_counter()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    rates = {name: round(sum(table(spark, sf, t).count() for t in read) / times[name])
             for name, read in INPUTS.items() if name in times}
    sf_val = os.path.basename(sf.rstrip("/")).replace("sf", "")
    try:
        sf_num = float(sf_val)
    except ValueError:
        sf_num = sf_val
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows_per_sec": rates, "sf": sf_num, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
