"""tidesync: table sync on Spark.

Incremental extraction by keyset, shard routing, value clean-up, upsert / append / reload, shard
profile and watermark, and retention deletes; every operator a DataFrame-to-DataFrame function.
"""

from .schema import SyncTask, validate_task
from .session import build_session, ensure_checkpoint_dir

__all__ = ["SyncTask", "validate_task", "build_session", "ensure_checkpoint_dir"]
