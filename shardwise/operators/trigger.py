"""Rate-limited incremental reading: one call plans a trigger, reads it, hands
it to a writer and commits its end offsets.

The end of a trigger is common to all shards: whole histogram buckets from the
smallest committed second on, while the logs before the bucket are below the
limit.  Each shard is then read from its own committed second (a new shard from
its earliest log) to that end.  State is a log of commits, each claimed once and
holding every shard's end, so the newest one is the whole state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwise.claims import LEASE_SECONDS, ClaimLog, give_up_turn, take_turn
from shardwise.manifest import ConflictError
from shardwise.model import attach_index, index_of, literal_table
from shardwise.plans.offsets import SHARD_KEY, shard_bounds
from shardwise.plans.ratelimit import LOOK_AHEAD_SECONDS, MAX_OFFSETS_PER_TRIGGER, rate_limit_cut
from shardwise.plans.shards import incremental_ranges
from shardwise.sources.batch import scan_range

STATE_SCHEMA = "log_project string, log_store string, shard int, end_time bigint, trigger bigint"


def commits_at(spark: SparkSession, state_path: str) -> ClaimLog:
    return ClaimLog(spark, f"{state_path.rstrip('/')}/commits")


def committed_ends(spark: SparkSession, state_path: str) -> DataFrame:
    """(shard key, end_time, trigger) of the newest commit of each shard.  A
    commit names every shard's end, so the newest one is all that is read."""
    commits = commits_at(spark, state_path)
    newest = commits.read(commits.last())
    return literal_table(spark, [tuple(r) for r in newest["ends"]] if newest else [], STATE_SCHEMA)


def next_second(logs: DataFrame, at: int) -> int | None:
    """First second with a log at or after ``at``: the index answers for days
    that start later, so at most one day is scanned.  None when there is none."""
    idx = index_of(logs)
    if idx is None:
        return logs.where(F.col("cursor_time") >= at).agg(F.min("cursor_time")).first()[0]
    later = idx.where(F.col("max_time") >= at)
    # days whose first log lies before ``at`` but which reach beyond it are scanned, and only them
    row = later.agg(F.min(F.when(F.col("min_time") >= at, F.col("min_time"))).alias("whole"), F.count_if(F.col("min_time") < at).alias("cut")).first()
    found = row["whole"]
    if row["cut"]:
        days = [r[0] for r in later.where(F.col("min_time") < at).select("dt").distinct().collect()]  # the day of ``at``
        inside = logs.where(F.col("dt").isin(days) & (F.col("cursor_time") >= at)).agg(F.min("cursor_time")).first()[0]
        found = min(x for x in (found, inside) if x is not None)
    return found


def run_trigger(spark: SparkSession, logs: DataFrame, state_path: str, write: Callable[[DataFrame, int], None],
                max_offsets: int = MAX_OFFSETS_PER_TRIGGER, now: int | None = None,
                look_ahead: int = LOOK_AHEAD_SECONDS, width: int = 1, owner: str | None = None,
                lease_seconds: float = LEASE_SECONDS) -> dict | None:
    """Read and commit the next trigger; None when every shard is read to its
    end.  ``write(batch, trigger)`` runs before the commit and must replace what
    an earlier attempt of the same trigger wrote.

    A stretch without logs longer than the look-ahead is skipped: the trigger
    goes on at the next second that has one.  Drivers that share a state folder take turns (one prepares a
    trigger at a time), and a trigger is committed once."""
    commits = commits_at(spark, state_path)
    trigger, attempt = take_turn(spark, commits, owner, lease_seconds)
    state = committed_ends(spark, state_path)
    bounds = shard_bounds(logs)
    pos = bounds.join(state.select(*SHARD_KEY, F.col("end_time").alias("done")), SHARD_KEY, "left")
    at = F.coalesce("done", "begin_time")
    head = pos.agg(F.min(F.when(at < F.col("end_time"), at)).alias("start"), F.max("end_time").alias("latest")).first()
    if head["start"] is None:
        give_up_turn(spark, commits, trigger, attempt)
        return None
    now = head["latest"] if now is None else now
    start = head["start"]
    cut = rate_limit_cut(spark, logs, start, [max_offsets], now, look_ahead, width, latest_min=head["latest"]).first()
    if cut["logs"] == 0:
        # nothing within the look-ahead: go on at the next log that is not read yet (a shard that lags may hold it)
        start = _next_unread(logs, pos.select(*SHARD_KEY, at.alias("at"), "end_time"), start)
        cut = rate_limit_cut(spark, logs, start, [max_offsets], now, look_ahead, width, latest_min=head["latest"]).first()
    end = cut["end_time"]
    if end <= start:
        give_up_turn(spark, commits, trigger, attempt)
        return {"trigger": trigger, "start": start, "end": start, "logs": 0}
    planned = pos.select(*SHARD_KEY, F.greatest(at, F.least("end_time", F.lit(end))).alias("end_time"))
    fixed = literal_table(spark, planned.collect(), planned.schema)  # one row per shard
    ranges = incremental_ranges(fixed, state, bounds)
    write(scan_range(logs, ranges), trigger)
    gone = state.join(fixed, SHARD_KEY, "left_anti").select(*SHARD_KEY, "end_time", "trigger")
    ends = fixed.withColumn("trigger", F.lit(trigger).cast("bigint")).unionByName(gone).collect()  # one row per shard
    if not commits.claim(trigger, {"ends": sorted([*r] for r in ends), "start": start, "end": end}):
        raise ConflictError(f"trigger {trigger} of {state_path} was committed by another driver")
    return {"trigger": trigger, "start": start, "end": end, "logs": cut["logs"]}


def _next_unread(logs: DataFrame, pos: DataFrame, start: int) -> int:
    """The first second at or after ``start`` with a log in a shard that is not
    yet read so far; the shards are searched together by their positions."""
    rows = pos.where(F.col("at") < F.col("end_time")).collect()  # one row per shard
    groups: dict[int, list] = {}
    for r in rows:
        groups.setdefault(r["at"], []).append(r["shard"])
    best = None
    for second in sorted(groups):
        if best is not None and second >= best:
            break
        keys = [r for r in rows if r["at"] == second]
        own = logs.where(F.col("shard").isin(groups[second]))
        idx = index_of(logs)
        if idx is not None:
            own = attach_index(own, idx.join(literal_table(logs.sparkSession, [tuple(r[k] for k in SHARD_KEY) for r in keys], "log_project string, log_store string, shard int"), SHARD_KEY, "left_semi"))
        found = next_second(own, second)
        if found is not None and (best is None or found < best):
            best = found
        if best == second:
            break
    return start if best is None else best
