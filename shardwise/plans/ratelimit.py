"""Batch planning under rate limits: histograms, the common end time of a
trigger, exact per-shard caps and the per-shard rate of a direct stream.

Every window here runs over an *aggregated* table with a proven bound
(buckets of one look-ahead, days of one shard, seconds of one day), never over raw
logs, or over the distinct cursors of one second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardwise.functions.shape import whole_units
from shardwise.model import index_of, literal_table
from shardwise.plans.offsets import SHARD_KEY, shard_bounds

# Look-ahead of the rate limiter and the "caught up" lag (s),
# default records per trigger and default max rate per shard (records/s).
LOOK_AHEAD_SECONDS = 300
CAUGHT_UP_SECONDS = 60
MAX_OFFSETS_PER_TRIGGER = 65536
MAX_RATE_PER_SHARD = 10000
LONG_MAX = 9223372036854775807


def histogram(spark: SparkSession, logs: DataFrame, start: int, end: int, width: int = 1) -> DataFrame:
    """Log counts of the whole store per bucket ``[from_time, to_time)`` over
    ``[start, end)``; empty buckets are present with ``cnt = 0``.

    The bucket table has ``ceil((end-start)/width)`` rows (bounded by the
    look-ahead); counts come from a partial aggregate over a pruned scan."""
    n_buckets = max(0, -(-(end - start) // width))
    buckets = spark.range(n_buckets).select(
        (F.lit(start) + F.col("id") * width).alias("from_time"),
        F.least(F.lit(start) + (F.col("id") + 1) * width, F.lit(end)).alias("to_time"),
        F.col("id").alias("bucket"),
    )
    counts = (
        logs.where(
            (F.col("cursor_time") >= start) & (F.col("cursor_time") < end)
            & (F.col("dt") >= F.lit(_day_of(start))) & (F.col("dt") <= F.lit(_day_of(max(start, end - 1))))
        )
        .groupBy(whole_units(F.col("cursor_time") - start, width).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return buckets.join(counts, "bucket", "left").select(
        "from_time", "to_time", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")
    )


def histogram_end(latest_min: int, start: int, now: int, look_ahead: int = LOOK_AHEAD_SECONDS) -> int | None:
    """End of the histogram window; ``None`` means caught up (no histogram)."""
    lag = now - start
    if lag <= CAUGHT_UP_SECONDS:
        return None
    if lag > look_ahead:
        return start + look_ahead
    return latest_min


def min_latest_time(logs: DataFrame) -> int:
    """Smallest shard end time (one row per shard, aggregated on executors)."""
    return int(shard_bounds(logs).agg(F.min("end_time")).collect()[0][0])


def rate_limit_cut(spark: SparkSession, logs: DataFrame, start: int, limits: list[int],
                   now: int, look_ahead: int = LOOK_AHEAD_SECONDS, width: int = 1,
                   latest_min: int | None = None) -> DataFrame:
    """Common end time of one trigger for each limit in ``limits``.

    Whole buckets are taken while the count *before* the bucket is below the
    limit.  Returns (``max_offsets``, ``end_time``, ``logs``)."""
    if latest_min is None and now - start <= look_ahead:
        latest_min = min_latest_time(logs)
    hend = histogram_end(latest_min if latest_min is not None else start, start, now, look_ahead)
    if hend is None:
        rows = [(int(lim), int(latest_min), None) for lim in limits]
        return literal_table(spark, rows, "max_offsets bigint, end_time bigint, logs bigint")
    h = histogram(spark, logs, start, hend, width)
    w = Window.orderBy("from_time").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("before", F.coalesce(F.sum("cnt").over(w), F.lit(0)))
    parts = []
    for lim in limits:
        taken = h.where(F.col("before") < F.lit(int(lim)))
        parts.append(
            taken.agg(
                F.lit(int(lim)).cast("bigint").alias("max_offsets"),
                F.coalesce(F.max("to_time"), F.lit(start)).cast("bigint").alias("end_time"),
                F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("logs"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _day_of(seconds: int):
    import datetime as dt

    return dt.date(1970, 1, 1) + dt.timedelta(days=seconds // 86400)


def cap_records_per_shard(logs: DataFrame, n: int, starts: DataFrame | None = None,
                          start_rows: list[tuple] | None = None) -> DataFrame:
    """At most ``n`` logs of each shard in cursor order from its start cursor.

    Logs with an equal cursor are never parted: the cut falls before the
    cursor that would pass ``n`` (a shard whose first cursor alone holds more
    than ``n`` logs gives that cursor whole, so every batch makes progress).
    Skew-safe, in bounded steps whose results are per-shard rows:

    1. per-(shard, day) counts from the start on -- from the store index for
       whole days plus a scan of each shard's start day only (without an
       index: a scan from the earliest start) -> the boundary day per shard;
    2. per-second counts of the boundary days only (literal ``dt`` filter)
       -> the boundary second;
    3. per-cursor counts of the boundary seconds -> the last cursor that fits;
    4. the batch: a scan between the earliest start and the latest cut or end
       (literal bounds: partition and row-group pruning).

    ``starts`` holds (shard key, ``start_cursor``) (or ``start_rows``, the
    same rows already collected); without it every shard starts at its
    first log."""
    spark = logs.sparkSession
    n = int(n)
    idx = index_of(logs)
    plan_schema = "log_project string, log_store string, shard int, start_cursor bigint"
    bounds = {tuple(x[k] for k in SHARD_KEY): x for x in shard_bounds_rows(logs)}
    if start_rows is not None:  # (project, store, shard, start_cursor) already on the driver
        srows = [tuple(x) for x in start_rows]
    elif starts is None:
        srows = [(*k, x["begin_cursor"]) for k, x in bounds.items()]
    else:
        srows = [tuple(x) for x in starts.select(*SHARD_KEY, "start_cursor").collect()]  # per shard
    if not srows or n <= 0:
        return logs.where(F.lit(False))
    lo = min(x[3] for x in srows) // 1_000_000_000
    plan = literal_table(spark, srows, plan_schema)
    from shardwise.sources.batch import COVER_MAX_ROWS, covered  # noqa: PLC0415 (batch imports plans)

    near = logs.where((F.col("cursor_time") >= F.lit(lo)) & (F.col("dt") >= F.lit(_day_of(lo))))
    if len(srows) <= COVER_MAX_ROWS:
        # each shard from its own start to its end, in groups: one far behind does not widen the others' scan
        near = covered(near, [(x[2], x[3] // 1_000_000_000, bounds[x[:3]]["end_time"]) for x in srows if x[:3] in bounds])
    r = (
        near.join(plan, SHARD_KEY)
        .where(F.col("cursor") >= F.col("start_cursor"))
        .drop("start_cursor")
    )

    # 1. day counts from the start on
    if idx is not None:
        start_days = sorted({_day_of(x[3] // 1_000_000_000) for x in srows})
        plan_dt = plan.withColumn("start_dt", F.date_from_unix_date(whole_units(F.col("start_cursor"), 86_400_000_000_000).cast("int")))
        first = (
            r.where(F.col("dt").isin(start_days))
            .join(plan_dt.select(*SHARD_KEY, F.col("start_dt").alias("dt")), SHARD_KEY + ["dt"])
            .groupBy(*SHARD_KEY, "dt").agg(F.count(F.lit(1)).alias("c"))
        )
        later = (
            idx.join(plan_dt.select(*SHARD_KEY, "start_dt"), SHARD_KEY)
            .where(F.col("dt") > F.col("start_dt"))
            .select(*SHARD_KEY, "dt", F.col("n").alias("c"))
        )
        day = first.unionByName(later)
    else:
        day = r.groupBy(*SHARD_KEY, "dt").agg(F.count(F.lit(1)).alias("c"))
    days = _crossing(day, "dt", F.lit(n)).collect()  # one row per shard that reaches the cap
    if not days:
        return r

    # 2. boundary second inside the boundary day
    bday = literal_table(spark, [tuple(x) for x in days], "log_project string, log_store string, shard int, dt date, need bigint")
    sec = (
        r.where(F.col("dt").isin(sorted({x["dt"] for x in days})))
        .join(bday, SHARD_KEY + ["dt"])
        .groupBy(*SHARD_KEY, "need", "cursor_time")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    seconds = _crossing(sec, "cursor_time", F.col("need")).collect()  # one row per capped shard

    # 3. the last cursor of the boundary second that fits whole
    bsec = literal_table(spark, [tuple(x) for x in seconds], "log_project string, log_store string, shard int, cursor_time bigint, need bigint")
    times = [x["cursor_time"] for x in seconds]
    per = (
        r.where((F.col("cursor_time") >= min(times)) & (F.col("cursor_time") <= max(times))
                & F.col("dt").isin(sorted({_day_of(t) for t in times})))
        .join(bsec, SHARD_KEY + ["cursor_time"])
        .groupBy(*SHARD_KEY, "cursor_time", "need", "cursor").agg(F.count(F.lit(1)).alias("c"))
    )
    upto = Window.partitionBy(*SHARD_KEY).orderBy("cursor").rowsBetween(Window.unboundedPreceding, 0)
    fits = (F.col("incl") <= F.col("need")) | ((F.col("need") == n) & (F.col("incl") == F.col("c")))
    cuts = per.withColumn("incl", F.sum("c").over(upto)).groupBy(*SHARD_KEY, F.col("cursor_time").alias("cut_time")).agg(
        F.max(F.when(fits, F.col("cursor"))).alias("cut_cursor")).collect()

    # 4. the batch: capped shards end at their cut, others at their last log
    capped = {tuple(x[k] for k in SHARD_KEY) for x in cuts}
    ends = [bounds[x[:3]]["end_time"] - 1 for x in srows if x[:3] not in capped and x[:3] in bounds]
    hi = max([x["cut_time"] for x in cuts] + ends)
    cut = literal_table(spark, [tuple(x) for x in cuts], "log_project string, log_store string, shard int, cut_time bigint, cut_cursor bigint")
    j = r.where((F.col("cursor_time") <= F.lit(hi)) & (F.col("dt") <= F.lit(_day_of(hi)))).join(cut, SHARD_KEY, "left")
    inside = F.col("cut_time").isNull() | (F.col("cursor_time") < F.col("cut_time")) | (
        (F.col("cursor_time") == F.col("cut_time")) & (F.col("cursor") <= F.col("cut_cursor")))
    return j.where(inside).drop("cut_time", "cut_cursor")


def _crossing(counts: DataFrame, order: str, need) -> DataFrame:
    """Per shard the row at which the running count reaches ``need``, with what
    is still needed there: (shard key, ``order``, need).  The window runs over
    counted rows only (days of a shard, seconds of a day)."""
    upto = Window.partitionBy(*SHARD_KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumn("_need", need.cast("bigint")).withColumn("_incl", F.sum("c").over(upto))
    hit = run.where((F.col("_incl") - F.col("c") < F.col("_need")) & (F.col("_incl") >= F.col("_need")))
    return hit.select(*SHARD_KEY, order, (F.col("_need") - (F.col("_incl") - F.col("c"))).alias("need"))


def shard_bounds_rows(logs: DataFrame) -> list:
    """Per-shard bounds as driver rows (one per shard)."""
    return shard_bounds(logs).collect()


def batch_ranges(batch: DataFrame) -> DataFrame:
    """(shard, from, until, count) of a planned batch; until is exclusive."""
    return batch.groupBy(*SHARD_KEY).agg(
        F.min("cursor").alias("from_cursor"),
        (F.max("cursor") + 1).alias("until_cursor"),
        F.count(F.lit(1)).alias("records"),
    )


def rate_per_shard(estimates: DataFrame, n_shards: int, batch_millis: int,
                   max_rate: int = MAX_RATE_PER_SHARD, initial_rate: float = 0.0) -> DataFrame:
    """Records each shard may give one batch:
    ``int(min(rate / shards, max_rate) * whole batch seconds)`` where the rate
    is the latest estimate when positive, else the initial rate; with no
    positive rate the cap is ``max_rate`` per second."""
    est = F.col("estimated_rate")
    rate = F.when(est > 0, est).otherwise(F.lit(float(initial_rate)))
    per_shard = F.when(rate > 0, F.least(rate / F.lit(float(n_shards)), F.lit(float(max_rate)))).otherwise(
        F.lit(float(max_rate))
    )
    secs = int(batch_millis) // 1000
    return estimates.withColumn("records_per_shard", (per_shard * F.lit(float(secs))).cast("int"))
