"""A stream that takes whole writes of a log store in cursor order.

The manifest of a store says which folders (store, day, write) each write added
and which cursors they hold.  ``follow`` runs a streaming query trigger by
trigger: a trigger admits the next folders in the order of their first cursors,
up to a number of logs counted from the manifest's index rows, and runs the query
on exactly these files as one micro-batch.  So watermarks, joins and windows see
time move forward, whatever the order of the files, and each run of the query
goes on from Spark's checkpoint.

Windows: the folders of the store at the first start come first; then, again
and again, those of the writes published since.  A window is passed in cursor
order before the next one opens, so a write that was published late is read late,
never skipped.

The position is one entry per trigger beside Spark's checkpoint, claimed before
the trigger runs: a restart repeats a trigger that was cut short with the same
folders (Spark's checkpoint makes this harmless) and then goes on.  The start
is kept with it, so ``latest`` means the latest at the first start.

A compaction does not disturb a follower: it reads the writes as they were
published.  It fails when a folder it still needs was vacuumed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwise.claims import ClaimLog
from shardwise.manifest import COMPACT_PREFIX, UNIT, ConflictError, by_unit, control_rows, entries, folder, live, open_at
from shardwise.model import LOG_COLUMNS, STORE_SCHEMA, literal_table
from shardwise.plans.offsets import SHARD_KEY, OffsetError, resolve_sentinels, shard_bounds
from shardwise.plans.ratelimit import MAX_OFFSETS_PER_TRIGGER
from shardwise.streaming.core import from_start, run_available_now

# Folders of one trigger, at most (a longer list makes a further trigger).
MAX_FOLDERS = 1000
START_SCHEMA = "log_project string, log_store string, shard int, start_time bigint"


def _first(spark: SparkSession, path: str, checkpoint: str, starting_offsets: str) -> dict:
    """Where the query starts, resolved and stored on its first start."""
    kept = ClaimLog(spark, f"{checkpoint}/follow_start")
    if kept.read(0) is None:
        head = entries(spark, path).last()
        if head < 0:
            raise OffsetError(f"no manifest at {path}: only stores written by this library's sinks can be followed")
        text = starting_offsets.strip()
        start = {"from": -1, "to": head, "starts": None}
        if text.lower() == "latest":
            start["from"] = head
        elif text.lower() != "earliest":
            from shardwise.sources.reader import check_stream_offsets, limit_offsets  # noqa: PLC0415 (reader imports streaming)

            logs = open_at(spark, path, head)
            offsets, bounds = limit_offsets(spark, logs, text), shard_bounds(logs)
            check_stream_offsets(offsets, bounds)
            rows = resolve_sentinels(offsets, bounds, out="start_time").select(*SHARD_KEY, "start_time").collect()  # one per shard
            start["starts"] = sorted([*r] for r in rows)
        kept.claim(0, start)
    return kept.read(0)


def _wanted(spark: SparkSession, rows: DataFrame, starts: list | None) -> DataFrame:
    """Control rows that hold logs at or after their shard's start."""
    if starts is None:
        return rows
    s = literal_table(spark, starts, START_SCHEMA)
    return rows.join(s, SHARD_KEY, "left").where(F.col("start_time").isNull() | (F.col("max_time") >= F.col("start_time"))).drop("start_time")


def next_trigger(spark: SparkSession, path: str, position: dict, starts: list | None, max_offsets: int, max_folders: int = MAX_FOLDERS) -> dict | None:
    """The folders after ``position``: from, to (entries of the window), after
    (key of the last folder taken), folders and logs; None at the end."""
    at = {k: position.get(k) for k in ("from", "to", "after")}
    while True:
        every = control_rows(spark, path)
        if at["from"] < 0:
            rows = live(every, at["to"])
        else:
            rows = every.where((F.col("added") > at["from"]) & (F.col("added") <= at["to"]) & ~F.col("write_id").startswith(COMPACT_PREFIX))
        folders = by_unit(_wanted(spark, rows, starts))
        key = F.struct("min_cursor", "log_store", F.col("dt").cast("string").alias("dt"), "write_id")
        if at["after"]:
            folders = folders.where(key > F.struct(*[F.lit(v) for v in at["after"]]))
        got = folders.orderBy("min_cursor", "log_store", "dt", "write_id").limit(max_folders).collect()
        if got:
            break
        head = entries(spark, path).last()
        if head == at["to"]:
            return None
        at = {"from": at["to"], "to": head, "after": None}
    taken, logs = [], 0
    for r in got:
        if taken and logs >= max_offsets:
            break
        if r["vacuumed"]:
            raise OffsetError(f"logs of {r['log_store']} of {r['dt']} (write {r['write_id']}) were vacuumed before this query read them")
        taken.append(r)
        logs += r["n"]
    last = taken[-1]
    return at | {"after": [last["min_cursor"], last["log_store"], str(last["dt"]), last["write_id"]],
                 "folders": [folder(spark, *[r[c] for c in UNIT]) for r in taken], "logs": logs}


def stream_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The records of some folders of a store as a stream of one micro-batch."""
    quoted = ["".join(f"\\{c}" if c in "{}[]*?,\\" else c for c in f) for f in folders]
    r = spark.readStream.schema(STORE_SCHEMA).option("basePath", path).option("maxFileAge", "36500d")
    return r.parquet(f"{path}/{{{','.join(quoted)}}}").select(*LOG_COLUMNS)


def follow(spark: SparkSession, path: str, checkpoint: str, build: Callable[[DataFrame], DataFrame], batch_fn: Callable | None = None,
           starting_offsets: str = "latest", max_offsets: int = MAX_OFFSETS_PER_TRIGGER, max_folders: int = MAX_FOLDERS,
           output_mode: str = "append", sink_path: str | None = None, triggers: int | None = None) -> list[dict]:
    """Run ``build(stream of log records)`` over the writes of the store at
    ``path``, ``max_offsets`` logs (and the folder that passes them) at a time,
    until it is read to its newest write or ``triggers`` were run; returns
    their entries.  Call it again to go on."""
    checkpoint = checkpoint.rstrip("/")
    if max_offsets < 1:
        raise ValueError("a trigger reads one log at least")
    start = _first(spark, path, checkpoint, starting_offsets)
    steps, done = ClaimLog(spark, f"{checkpoint}/triggers"), ClaimLog(spark, f"{checkpoint}/triggers_done")

    def run(step: dict) -> None:
        stream = stream_folders(spark, path, step["folders"])
        if start["starts"] is not None:
            stream = from_start(stream, literal_table(spark, start["starts"], START_SCHEMA))
        run_available_now(build(stream), checkpoint, batch_fn, output_mode, sink_path)

    ran = []
    at = steps.last()
    position = steps.read(at) if at >= 0 else start
    if at >= 0 and not done.exists(at):
        run(position)
        done.claim(at, {})
        ran.append(position)
    while triggers is None or len(ran) < triggers:
        step = next_trigger(spark, path, position, start["starts"], max_offsets, max_folders)
        if step is None:
            break
        at += 1
        if not steps.claim(at, step | {"time": _dt.datetime.now(_dt.timezone.utc).isoformat()}):
            raise ConflictError(f"another driver runs trigger {at} of {checkpoint}")
        run(step)
        done.claim(at, {})
        ran.append(step)
        position = step
    return ran
