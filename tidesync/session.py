"""Session helpers: the settings every job here assumes, and the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. UTC keeps TIMESTAMP audit columns stable; ANSI makes bad casts fail
# loudly (we use try_cast where a failure must become a reject row instead); AQE re-plans joins and
# coalesces small shuffle partitions at run time and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", app: str = "tidesync", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is used as is."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         # checkpointed increments are removed once no plan references them
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session has none (local tests) is a folder set here; on a cluster the configured
    shared folder is always used, never a machine-local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    target = conf_dir or fallback
    if target is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        target = os.path.join("/tmp", "tidesync-checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for tables a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidesync/{name}-{uuid.uuid4().hex[:12]}"
