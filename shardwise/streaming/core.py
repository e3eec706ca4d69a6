"""Structured Streaming over a log store.

The source is Spark's file stream over the store's Parquet folder (offsets,
restart and exactly-once bookkeeping are Spark's checkpoint); start
positions are a small broadcast per-shard table; sinks are ``foreachBatch``
writers that are idempotent per batch id.  ``run_available_now`` drives a
query to the end of the data, which is what tests and batch-like callers
need; production callers pass their own trigger.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shardwise.claims import ClaimLog
from shardwise.manifest import COMPACT_PREFIX
from shardwise.model import LOG_COLUMNS, STORE_SCHEMA, literal_table
from shardwise.plans.offsets import SHARD_KEY, OffsetError
from shardwise.session import path_exists


def stream_logs(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of the log records under ``path``, as they were
    written (what a compaction rewrites later is no new log)."""
    r = spark.readStream.schema(STORE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path).where(~F.col("write_id").startswith(COMPACT_PREFIX)).select(*LOG_COLUMNS)


# Starts of streams that were resolved without a checkpoint and would move with
# the store, by the mark that their filter carries.
_MOVING: dict[str, list] = {}


def from_start(stream: DataFrame, starts: DataFrame, moves: bool = False) -> DataFrame:
    """Logs at or after each shard's start second; a shard without a start
    (one that appeared later) is read from its earliest log.  ``starts`` is
    resolved once (one row per shard), so micro-batches do not recompute it.
    ``moves`` marks starts that another resolution would place later."""
    mark = f"_start_{uuid.uuid4().hex}" if moves else "_start"
    fixed = starts.select(*SHARD_KEY, F.col("start_time").alias(mark))
    rows = fixed.collect()
    if moves:
        _MOVING[mark] = sorted([*r] for r in rows)
    s = literal_table(stream.sparkSession, rows, fixed.schema)
    return stream.join(s, SHARD_KEY, "left").where(F.col(mark).isNull() | (F.col("cursor_time") >= F.col(mark))).drop(mark)


def _keep_starts(df: DataFrame, checkpoint: str) -> None:
    """Store the moving starts of a query's first run beside its checkpoint; a
    later run that would start elsewhere fails instead of skipping logs."""
    marks = sorted(set(re.findall(r"_start_[0-9a-f]{32}", df._jdf.queryExecution().logical().toString())) & set(_MOVING))
    if not marks:
        return
    kept = ClaimLog(df.sparkSession, f"{checkpoint.rstrip('/')}/moving_starts")
    now = sorted(_MOVING[m] for m in marks)
    kept.claim(0, {"starts": now})
    if kept.read(0)["starts"] != now:
        raise OffsetError("the store has grown since this query's first start, and its start was not kept: "
                          "give read_stream the query's checkpoint, or use streaming.follow")


def run_available_now(df: DataFrame, checkpoint: str, batch_fn: Callable | None = None,
                      output_mode: str = "append", sink_path: str | None = None,
                      query_name: str | None = None):
    """Run ``df`` until the data present at start is consumed; returns the
    finished ``StreamingQuery`` (its progress stays readable)."""
    _keep_starts(df, checkpoint)
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn)
    else:
        w = w.format("parquet").option("path", sink_path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def idempotent_writer(path: str, overwrite_all: bool = False) -> Callable:
    """``foreachBatch`` function writing each micro-batch to partition
    ``batch_id=N`` with dynamic partition overwrite: a replayed batch id
    replaces its own output, also after a restart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def last_version(df: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Per key, the values of the highest ``batch_id`` (update-mode readers)."""
    return df.groupBy(*keys).agg(
        *[F.max_by(c, "batch_id").alias(c) for c in value_cols]
    )


def latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the newest batch only (complete-mode readers)."""
    top = df.agg(F.max("batch_id").alias("_top"))
    return df.join(F.broadcast(top), F.col("batch_id") == F.col("_top")).drop("_top")


class _ProgressLog(StreamingQueryListener):
    """(batch_id, num_input_rows) of every trigger of every query, keyed by
    query id; one small row per trigger on the driver."""

    def __init__(self):
        self.rows: dict[str, list[tuple[int, int]]] = {}
        self.finished: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _done(self, qid: str) -> threading.Event:
        with self._lock:
            return self.finished.setdefault(qid, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self.rows.setdefault(str(p.id), []).append((int(p.batchId), int(p.numInputRows)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._done(str(event.id)).set()


def run_with_progress(df: DataFrame, checkpoint: str, batch_fn: Callable | None = None,
                      output_mode: str = "append", wait_seconds: int = 120) -> list[tuple[int, int]]:
    """``run_available_now`` plus every trigger's (batch_id, num_input_rows).

    ``StreamingQuery.recentProgress`` keeps only the last few triggers
    (``spark.sql.streaming.numRecentProgressUpdates``); a listener sees all
    of them.  Listener events are delivered asynchronously, so this waits
    for the query's termination event, which follows its last progress."""
    spark = df.sparkSession
    log = _ProgressLog()
    spark.streams.addListener(log)
    try:
        q = run_available_now(df, checkpoint, batch_fn, output_mode)
        qid = str(q.id)
        if not log._done(qid).wait(wait_seconds):
            raise RuntimeError(f"no termination event for query {qid} within {wait_seconds}s")
        return sorted(log.rows.get(qid, []))
    finally:
        spark.streams.removeListener(log)


def progress_rows(spark: SparkSession, rows: list[tuple[int, int]]) -> DataFrame:
    """One row per trigger: (batch_id, num_input_rows); trigger counts are
    bounded by the run, not by the data."""
    return literal_table(spark, rows, "batch_id bigint, num_input_rows bigint")


def pinned_start_offsets(spark: SparkSession, state_path: str, resolve: Callable[[], DataFrame]) -> DataFrame:
    """Start offsets resolved once and stored next to the checkpoint; a
    restart reads the stored ones even if the store has grown since."""
    if not path_exists(spark, f"{state_path}/_SUCCESS"):
        resolve().coalesce(1).write.mode("overwrite").json(state_path)
    return spark.read.schema(
        "log_project string, log_store string, shard int, start_time bigint"
    ).json(state_path)
