"""User-facing readers: a batch read between two offset limits and a stream
from a starting limit, shaped into the default row or a user schema.

Offset limits are ``"earliest"``, ``"latest"`` or offset JSON
(``{"project#store": {"shard": seconds}}``, -2 = earliest, -1 = latest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.functions.shape import project
from shardwise.manifest import has_manifest, open_at, was_compacted
from shardwise.model import INDEX_DIR, attach_index, literal_table, read_index, read_log_store
from shardwise.plans.offsets import (
    EARLIEST, LATEST, SHARD_KEY, OffsetError, offset_violations, parse_offsets_json,
    resolve_sentinels, shard_bounds,
)
from shardwise.session import path_exists
from shardwise.sources.batch import scan_range


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The log records under ``path`` with their index: as of the newest entry
    of its manifest, or all files of a store without one."""
    if has_manifest(spark, path):
        return open_at(spark, path)
    logs = read_log_store(spark, path)
    if path_exists(spark, f"{path}/{INDEX_DIR}"):
        logs = attach_index(logs, read_index(spark, path))
    return logs


def limit_offsets(spark: SparkSession, logs: DataFrame, limit: str) -> DataFrame:
    """Per-shard offsets (sentinels allowed) of one limit."""
    text = limit.strip()
    low = text.lower()
    if low in ("earliest", "latest"):
        sentinel = EARLIEST if low == "earliest" else LATEST
        return shard_bounds(logs).select(*SHARD_KEY, F.lit(sentinel).cast("bigint").alias("offset"))
    df = literal_table(spark, [(text,)], "offsets_json string")
    return parse_offsets_json(df)


def read_logs(spark: SparkSession, path: str, starting_offsets: str = "earliest",
              ending_offsets: str = "latest", schema: T.StructType | None = None,
              append_sequence_number: bool = False) -> DataFrame:
    """Batch read of ``[start, end)`` per shard, shaped by ``schema``.

    The limits are checked first (start may not be latest, end may not be
    earliest, specific offsets must name every shard of the store)."""
    if starting_offsets.strip().lower() == "latest":
        raise OffsetError("starting offsets may not be latest for a batch read")
    if ending_offsets.strip().lower() == "earliest":
        raise OffsetError("ending offsets may not be earliest for a batch read")
    logs = open_store(spark, path)
    start = limit_offsets(spark, logs, starting_offsets)
    end = limit_offsets(spark, logs, ending_offsets)
    known = shard_bounds(logs).select(*SHARD_KEY)
    bad = offset_violations(start, end, known).limit(1).collect()
    if bad:
        raise OffsetError(f"invalid offsets for shard {bad[0]['shard']}: {bad[0]['reason']}")
    b = shard_bounds(logs)
    s = resolve_sentinels(start, b, out="start_time").drop("offset")
    e = resolve_sentinels(end, b, out="end_time").drop("offset")
    rows = scan_range(logs, s.join(e, SHARD_KEY))
    return project(rows, schema, append_sequence_number)


def check_stream_offsets(start: DataFrame, known: DataFrame) -> None:
    """Specific start offsets name every shard of the store and no other."""
    j = start.select(*SHARD_KEY, F.lit(True).alias("_given")).join(
        known.select(*SHARD_KEY, F.lit(True).alias("_known")), SHARD_KEY, "full_outer")
    bad = j.where(F.col("_given").isNull() | F.col("_known").isNull()).limit(1).collect()
    if bad:
        what = "is not in the store" if bad[0]["_known"] is None else "has no start offset"
        raise OffsetError(f"shard {bad[0]['shard']} of {bad[0]['log_project']}#{bad[0]['log_store']} {what}")


def read_stream(spark: SparkSession, path: str, starting_offsets: str = "latest",
                schema: T.StructType | None = None, max_files_per_trigger: int | None = None,
                append_sequence_number: bool = False, checkpoint: str | None = None,
                records: bool = False) -> DataFrame:
    """A stream of the store from a starting limit, shaped by ``schema`` (or
    the log records themselves with ``records``).

    With the query's ``checkpoint`` folder the start is resolved on the first
    start only and stored there; a restart reads the stored start, so logs that
    arrived while the query was stopped are not skipped.  Without it,
    ``run_available_now`` stores the start of a ``latest`` stream on its first run
    and refuses a later one, which would skip logs.  Shards that appear later are
    read from their earliest log.

    Files come in no order of time, limited by their number.  ``streaming.follow``
    takes whole writes in cursor order, limited by logs, and keeps its own start;
    a store that was compacted is streamed by it only."""
    from shardwise.streaming.core import from_start, pinned_start_offsets, stream_logs

    if was_compacted(spark, path):
        raise OffsetError(f"{path} was compacted: follow it with shardwise.streaming.follow")

    def resolve() -> DataFrame:
        logs = open_store(spark, path)
        start = limit_offsets(spark, logs, starting_offsets)
        bounds = shard_bounds(logs)
        if starting_offsets.strip().lower() not in ("earliest", "latest"):
            check_stream_offsets(start, bounds)
        return resolve_sentinels(start, bounds, out="start_time").select(*SHARD_KEY, "start_time")

    starts = pinned_start_offsets(spark, f"{checkpoint.rstrip('/')}/start_offsets", resolve) if checkpoint else resolve()
    moves = not checkpoint and (starting_offsets.strip().lower() == "latest" or "-1" in starting_offsets)
    stream = from_start(stream_logs(spark, path, max_files_per_trigger), starts, moves)
    return stream if records else project(stream, schema, append_sequence_number)
