"""shardwise: Spark-native analytics over sharded, append-only log stores.

A log store is a partitioned Parquet table of log records (see
``shardwise.model``).  Every operator is a DataFrame / SQL / Structured
Streaming expression over that table or over small per-shard control
tables; nothing routes log rows through the driver.
"""

from shardwise.model import LOG_COLUMNS, log_store, shards_table, checkpoints_table
from shardwise.session import get_session, scratch_dir

__all__ = [
    "LOG_COLUMNS",
    "log_store",
    "shards_table",
    "checkpoints_table",
    "get_session",
    "scratch_dir",
]
