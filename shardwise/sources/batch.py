"""Batch reads of a log store: offset ranges, time ranges, slices, cursor
lookups and start positions.

A range read keeps literal bounds on ``cursor_time`` and ``dt``, over all and for
groups of shards, so Parquet pushdown and partition pruning apply, and expresses
the per-shard part as a semi-join on the shard key, broadcast behind a size check.
"""

from __future__ import annotations

import datetime as _dt
import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardwise.functions.shape import cursor_to_b64, whole_units, with_json_record
from shardwise.model import index_of, literal_table
from shardwise.plans.offsets import SHARD_KEY, shard_bounds

# A range table is broadcast up to this many rows and shuffled above.
BROADCAST_MAX_ROWS = 200_000
# Ranges up to this many are grouped into at most so many literal predicates,
# which name their shards if these are few.
COVER_MAX_ROWS = 20_000
COVER_CLUSTERS = 16
COVER_SHARDS = 200

START_MODES = ("BEGIN_CURSOR", "END_CURSOR", "SPECIAL_TIMER_CURSOR")


def epoch_day(seconds: int) -> _dt.date:
    return _dt.date(1970, 1, 1) + _dt.timedelta(days=seconds // 86400)


def unix_day(t: Column) -> Column:
    """DATE of an epoch-seconds column, independent of the session zone."""
    return F.date_from_unix_date(whole_units(t, 86400).cast("int"))


def bounded(logs: DataFrame, lo: int, hi: int) -> DataFrame:
    """Literal ``[lo, hi)`` on cursor_time plus the implied ``dt`` range."""
    if hi <= lo:
        return logs.where(F.lit(False))
    return logs.where(
        (F.col("dt") >= F.lit(epoch_day(lo)))
        & (F.col("dt") <= F.lit(epoch_day(hi - 1)))
        & (F.col("cursor_time") >= F.lit(lo))
        & (F.col("cursor_time") < F.lit(hi))
    )


def interval_cover(rows: list[tuple], most: int = COVER_CLUSTERS) -> list[tuple]:
    """At most ``most`` (lo, hi, shards) that cover the ranges (shard, start,
    end).  Neighbours in order of their start are merged, always the pair whose
    union reads least beyond its parts (seconds times shards)."""
    by_range: dict[tuple, set] = {}
    for shard, lo, hi in rows:
        if hi > lo:
            by_range.setdefault((lo, hi), set()).add(shard)
    parts = [[lo, hi, shards] for (lo, hi), shards in sorted(by_range.items())]
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]

    def extra(i: int) -> tuple:
        a, b = parts[i], parts[after[i]]
        together = (max(a[1], b[1]) - a[0]) * len(a[2] | b[2])
        return together - (a[1] - a[0]) * len(a[2]) - (b[1] - b[0]) * len(b[2]), i, after[i], id(a[2]), id(b[2])

    heap = [extra(i) for i in range(len(parts) - 1)]
    heapq.heapify(heap)
    left = len(parts)
    while heap and (left > most or heap[0][0] <= 0):
        _, i, j, a, b = heapq.heappop(heap)
        if parts[i] is None or parts[j] is None or after[i] != j or (id(parts[i][2]), id(parts[j][2])) != (a, b):
            continue  # one of them was merged since
        parts[i] = [parts[i][0], max(parts[i][1], parts[j][1]), parts[i][2] | parts[j][2]]
        parts[j], after[i] = None, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            heapq.heappush(heap, extra(i))
        if before[i] >= 0:
            heapq.heappush(heap, extra(before[i]))
        left -= 1
    return [tuple(p) for p in parts if p is not None]


def covered(logs: DataFrame, rows: list[tuple]) -> DataFrame:
    """``logs`` within the cover of the ranges (shard, start, end): literal
    bounds on days and seconds for groups of shards, so a shard that lags far
    behind does not widen the scan of the others."""
    parts = interval_cover(rows)
    if not parts:
        return logs.where(F.lit(False))
    base = bounded(logs, min(p[0] for p in parts), max(p[1] for p in parts))
    if len(parts) == 1:
        return base
    any_ = F.lit(False)
    for lo, hi, shards in parts:
        one = (F.col("dt") >= F.lit(epoch_day(lo))) & (F.col("dt") <= F.lit(epoch_day(hi - 1))) & (F.col("cursor_time") >= F.lit(lo)) & (F.col("cursor_time") < F.lit(hi))
        any_ = any_ | (one & F.col("shard").isin(sorted(shards)) if len(shards) <= COVER_SHARDS else one)
    return base.where(any_)


def scan_range(logs: DataFrame, ranges: DataFrame) -> DataFrame:
    """All logs with ``start_time <= cursor_time < end_time`` of their shard,
    each once, however many ranges of a shard hold it.

    ``ranges`` is a control table (shard key, ``start_time``, ``end_time``; a
    null bound is an error).  Up to ``COVER_MAX_ROWS`` of its rows come back and
    make literal bounds per group of shards that prune days and row groups
    (``covered``); of more, only the outer bounds.  The exact per-shard part is a
    semi-join on the shard key, broadcast behind the size check."""
    rng = ranges.select(*SHARD_KEY, F.col("start_time").alias("_s"), F.col("end_time").alias("_e")).distinct()
    rows = rng.limit(COVER_MAX_ROWS + 1).collect()
    if len(rows) <= COVER_MAX_ROWS:
        size = {"open": sum(r["_s"] is None or r["_e"] is None for r in rows), "n": len(rows)}
    else:
        size = rng.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_s").isNull() | F.col("_e").isNull()).alias("open"),
                       F.min("_s").alias("lo"), F.max("_e").alias("hi")).first()
    if size["open"]:
        raise ValueError(f"{size['open']} ranges lack a start or an end")
    if not size["n"]:
        return logs.where(F.lit(False))
    if len(rows) <= COVER_MAX_ROWS:
        rng = literal_table(logs.sparkSession, [tuple(r) for r in rows], rng.schema)
        base = covered(logs, [(r["shard"], r["_s"], r["_e"]) for r in rows])
    else:
        base = bounded(logs, size["lo"], size["hi"])
    if size["n"] <= BROADCAST_MAX_ROWS:
        rng = F.broadcast(rng)
    inside = [base[c] == rng[c] for c in SHARD_KEY] + [base["cursor_time"] >= rng["_s"], base["cursor_time"] < rng["_e"]]
    cond = inside[0]
    for c in inside[1:]:
        cond = cond & c
    return base.join(rng, cond, "left_semi")


def store_latest_time(logs: DataFrame) -> int:
    """One past the newest arrival second of the store (from the index when
    there is one, else a single aggregate)."""
    idx = index_of(logs)
    if idx is not None:
        return int(idx.agg(F.max("max_time")).collect()[0][0]) + 1
    return int(logs.agg(F.max("cursor_time")).collect()[0][0]) + 1


def time_range_scan(logs: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """JSON records of all shards with ``start <= cursor_time < end``;
    ``end=None`` reads up to the store's latest (repeatable, unlike "now")."""
    if end is None:
        end = store_latest_time(logs)
    return with_json_record(bounded(logs, start, end)).select(*SHARD_KEY, "cursor", "record")


def time_range_slices(logs: DataFrame, start: int, end: int, parallelism: int = 1) -> DataFrame:
    """Records per (shard, slice) of ``[start, end)`` cut into 1..5 contiguous
    half-open slices; the last slice takes the remainder."""
    if not 1 <= parallelism <= 5:
        raise ValueError(f"a shard is read in 1 to 5 slices, not {parallelism}")
    if end - start < parallelism:
        raise ValueError(f"{end - start} seconds from {start} on cannot make {parallelism} slices")
    size = (end - start) // parallelism
    sl = F.least(F.lit(parallelism - 1), whole_units(F.col("cursor_time") - start, size))
    b = bounded(logs, start, end).withColumn("slice", sl.cast("int"))
    return b.groupBy(*SHARD_KEY, "slice").agg(F.count(F.lit(1)).alias("records")).select(
        *SHARD_KEY, "slice",
        (F.lit(start) + F.col("slice") * size).alias("from_time"),
        F.when(F.col("slice") == parallelism - 1, F.lit(end))
        .otherwise(F.lit(start) + (F.col("slice") + 1) * size).alias("to_time"),
        "records",
    )


def cursor_at_time(logs: DataFrame, probes: DataFrame) -> DataFrame:
    """First cursor at or after ``t`` in each probed shard; the shard's end
    cursor when nothing follows.  ``probes``: (shard key, ``t``).

    The probe's own day is scanned (its days are literals, so only they are
    read); when it has no such log the answer is the first cursor of a later
    day: the (shard, day) table carries the smallest cursor after each day (a
    running minimum from the last day back), and a probe meets one row of it."""
    p = probes.select(*SHARD_KEY, "t").distinct().withColumn("dt", unix_day(F.col("t")))
    idx = index_of(logs)
    days = (
        idx.select(*SHARD_KEY, "dt", F.col("min_cursor").alias("c"))
        if idx is not None
        else logs.groupBy(*SHARD_KEY, "dt").agg(F.min("cursor").alias("c"))
    )
    # a union sorted by day: each probe takes the smallest cursor of the days after its own
    after = Window.partitionBy(*SHARD_KEY).orderBy("dt").rangeBetween(1, Window.unboundedFollowing)
    day_no = F.unix_date("dt").alias("dt")
    both = days.select(*SHARD_KEY, day_no, F.lit(None).cast("bigint").alias("t"), "c").unionByName(
        p.select(*SHARD_KEY, day_no, "t", F.lit(None).cast("bigint").alias("c")))
    later = both.withColumn("c_later", F.min("c").over(after)).where(F.col("t").isNotNull()).select(*SHARD_KEY, "t", "c_later")
    wanted = [r[0] for r in p.select("dt").distinct().collect()]  # at most the probed days
    same_day = (
        logs.select(*SHARD_KEY, "dt", "cursor", "cursor_time").where(F.col("dt").isin(wanted))
        .join(p, SHARD_KEY + ["dt"])
        .where(F.col("cursor_time") >= F.col("t"))
        .groupBy(*SHARD_KEY, "t")
        .agg(F.min("cursor").alias("c_same"))
    )
    ends = shard_bounds(logs).select(*SHARD_KEY, "end_cursor")
    return (
        probes.select(*SHARD_KEY, "t")
        .join(same_day, SHARD_KEY + ["t"], "left")
        .join(later, SHARD_KEY + ["t"], "left")
        .join(ends, SHARD_KEY, "left")
        .select(*SHARD_KEY, "t", F.coalesce("c_same", "c_later", "end_cursor").alias("cursor"))
    )


def start_positions(logs: DataFrame, mode: str, start_time: int | None = None) -> DataFrame:
    """Start cursor of every shard for a start mode."""
    if mode not in START_MODES:
        raise ValueError(f"Unknown start position mode {mode!r}; expected one of {START_MODES}")
    b = shard_bounds(logs)
    if mode == "BEGIN_CURSOR":
        return b.select(*SHARD_KEY, F.col("begin_cursor").alias("cursor"))
    if mode == "END_CURSOR":
        return b.select(*SHARD_KEY, F.col("end_cursor").alias("cursor"))
    if start_time is None:
        raise ValueError("SPECIAL_TIMER_CURSOR needs a start time")
    probes = b.select(*SHARD_KEY, F.lit(int(start_time)).cast("bigint").alias("t"))
    return cursor_at_time(logs, probes).select(*SHARD_KEY, "cursor")


def start_positions_b64(logs: DataFrame, mode: str, start_time: int | None = None) -> DataFrame:
    return start_positions(logs, mode, start_time).select(
        *SHARD_KEY, cursor_to_b64(F.col("cursor")).alias("cursor_b64")
    )
