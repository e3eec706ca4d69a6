"""Offsets: per-shard positions, their JSON form, sentinels and checks.

An *offset* is an arrival second (``cursor_time``) per shard; a *cursor* is
the arrival counter.  Offset tables are tiny control DataFrames with one row
per (log_project, log_store, shard); they are computed with partial
aggregates over the log store and joined back, never collected row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardwise.functions.shape import b64_to_cursor, cursor_to_b64, time_at_cursor, whole_units
from shardwise.model import index_of

SHARD_KEY = ["log_project", "log_store", "shard"]

# Offset sentinels.
EARLIEST = -2
LATEST = -1

OFFSETS_JSON_SCHEMA = "map<string,map<string,bigint>>"
OFFSETS_JSON_EXAMPLE = '{"logProject#logStore":{"0":23,"1":-1},"logProject#logStore2":{"0":-2}}'


# The whole text must have this form (two levels, whole numbers): a JSON parser
# alone lets trailing text and missing values pass.
_SHARD_TEXT = r'\s*"[0-9]+"\s*:\s*-?[0-9]+\s*'
_STORE_TEXT = rf'\s*"[^"\\#]+#[^"\\]+"\s*:\s*\{{({_SHARD_TEXT}(,{_SHARD_TEXT})*|\s*)\}}\s*'
OFFSETS_TEXT = rf"^\s*\{{({_STORE_TEXT}(,{_STORE_TEXT})*|\s*)\}}\s*$"


class OffsetError(ValueError):
    pass


def list_shards(logs: DataFrame) -> DataFrame:
    """Shards that hold logs (from the store index when there is one, else a
    partial aggregate over the shard column)."""
    idx = index_of(logs)
    return (idx if idx is not None else logs).select(*SHARD_KEY).distinct()


def shard_bounds(logs: DataFrame) -> DataFrame:
    """Earliest and latest position of every shard in one pass.

    ``begin_*`` is the first log; ``end_*`` is one past the last, so
    ``[begin, end)`` covers the shard.  A store with an index answers from
    its (shard, day) rows instead of scanning a column of every log."""
    idx = index_of(logs)
    if idx is not None:
        return idx.groupBy(*SHARD_KEY).agg(
            F.min("min_time").alias("begin_time"),
            F.min("min_cursor").alias("begin_cursor"),
            (F.max("max_time") + 1).alias("end_time"),
            (F.max("max_cursor") + 1).alias("end_cursor"),
        )
    return logs.groupBy(*SHARD_KEY).agg(
        F.min("cursor_time").alias("begin_time"),
        F.min("cursor").alias("begin_cursor"),
        (F.max("cursor_time") + 1).alias("end_time"),
        (F.max("cursor") + 1).alias("end_cursor"),
    )


def daily_first_offsets(logs: DataFrame) -> DataFrame:
    """First arrival second of every (day, shard) -- the store index's rows
    when there is one."""
    idx = index_of(logs)
    if idx is not None:
        return idx.select("dt", *SHARD_KEY, F.col("min_time").alias("offset"))
    return logs.groupBy("dt", *SHARD_KEY).agg(F.min("cursor_time").alias("offset"))


def earliest_offsets(logs: DataFrame, shards: list[int] | None = None) -> DataFrame:
    b = shard_bounds(logs).select(*SHARD_KEY, "begin_time", "begin_cursor")
    return b if shards is None else b.where(F.col("shard").isin(shards))


def latest_offsets(logs: DataFrame, shards: list[int] | None = None) -> DataFrame:
    b = shard_bounds(logs).select(*SHARD_KEY, "end_time", "end_cursor")
    return b if shards is None else b.where(F.col("shard").isin(shards))


# ---------------------------------------------------------------------------
# JSON form: {"project#store": {"shard": seconds, ...}, ...}

def parse_offsets_json(df: DataFrame, col: str = "offsets_json", keep: list[str] | None = None,
                       strict: bool = True) -> DataFrame:
    """Offset JSON text -> rows (``log_project, log_store, shard, offset``).

    Malformed text (also trailing text or a missing offset) fails the query
    with a message quoting the expected form."""
    keep = keep or []
    parsed = F.from_json(F.col(col), OFFSETS_JSON_SCHEMA)
    if strict:
        parsed = F.when(
            F.col(col).isNotNull() & (parsed.isNull() | ~F.col(col).rlike(OFFSETS_TEXT)),
            F.raise_error(
                F.concat(
                    F.lit("Expected e.g. " + OFFSETS_JSON_EXAMPLE + ", got "), F.col(col)
                )
            ).cast(OFFSETS_JSON_SCHEMA),
        ).otherwise(parsed)
    outer = df.select(*keep, F.explode(parsed).alias("store_key", "per_shard"))
    inner = outer.select(*keep, "store_key", F.explode("per_shard").alias("shard_key", "offset"))
    parts = F.split(F.col("store_key"), "#", 2)
    bad = (F.size(parts) < 2) | ~F.col("shard_key").rlike(r"^[0-9]+$")
    return inner.select(
        *keep,
        F.when(bad, F.raise_error(F.concat(
            F.lit("Expected e.g. " + OFFSETS_JSON_EXAMPLE + ", got key "), F.col("store_key"),
            F.lit(" / "), F.col("shard_key"),
        ))).otherwise(parts.getItem(0)).alias("log_project"),
        parts.getItem(1).alias("log_store"),
        F.col("shard_key").cast("int").alias("shard"),
        F.col("offset").alias("offset"),
    )


def render_offsets_json(offsets: DataFrame, group_by: list[str] | None = None,
                        offset_col: str = "offset") -> DataFrame:
    """Rows -> offset JSON text, one per ``group_by`` key; entries sorted by
    text key.  Collects only per-shard entries (bounded by the shard count)."""
    group_by = group_by or []
    per_store = offsets.groupBy(*group_by, "log_project", "log_store").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(F.col("shard").cast("string"), F.col(offset_col).cast("bigint")))
            )
        ).alias("per_shard")
    )
    entries = F.collect_list(
        F.struct(F.concat_ws("#", "log_project", "log_store").alias("k"), F.col("per_shard").alias("v"))
    )
    by_key = F.array_sort(
        entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)
    )
    return per_store.groupBy(*group_by).agg(
        F.to_json(F.map_from_entries(by_key)).alias("offsets_json")
    )


def resolve_sentinels(offsets: DataFrame, bounds: DataFrame, offset_col: str = "offset",
                      out: str = "resolved") -> DataFrame:
    """-2 -> the shard's earliest, -1 -> its latest, anything else unchanged."""
    b = bounds.select(*SHARD_KEY, F.col("begin_time").alias("_b"), F.col("end_time").alias("_e"))
    j = offsets.join(b, SHARD_KEY, "left")  # control rows: AQE broadcasts a side that is small when it runs
    o = F.col(offset_col)
    return j.withColumn(
        out, F.when(o == EARLIEST, F.col("_b")).when(o == LATEST, F.col("_e")).otherwise(o)
    ).drop("_b", "_e")


def offset_violations(start: DataFrame, end: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows describing why a (start, end) offset pair is not a valid batch.

    ``start``/``end`` carry ``offset`` per shard (sentinels allowed); ``shards``
    lists the store's shards.  Empty result = valid.  All inputs are per-shard
    control tables, so the full outer joins are small."""
    s = start.select(*SHARD_KEY, F.col("offset").alias("start_offset"))
    e = end.select(*SHARD_KEY, F.col("offset").alias("end_offset"))
    known = shards.select(*SHARD_KEY).withColumn("known", F.lit(True))
    j = s.join(e, SHARD_KEY, "full_outer").join(known, SHARD_KEY, "full_outer")
    reason = (
        F.when(F.col("known").isNull(), F.lit("unknown shard"))
        .when(F.col("start_offset").isNull() & F.col("end_offset").isNull(),
              F.lit("shard missing in start and end"))
        .when(F.col("start_offset").isNull(), F.lit("shard missing in start"))
        .when(F.col("end_offset").isNull(), F.lit("shard missing in end"))
        .when(F.col("start_offset") == LATEST, F.lit("start may not be latest"))
        .when(F.col("end_offset") == EARLIEST, F.lit("end may not be earliest"))
    )
    return j.select(*SHARD_KEY, "start_offset", "end_offset", reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def validate_offsets(start: DataFrame, end: DataFrame, shards: DataFrame) -> None:
    """Raise when any violation exists (looks at one row only)."""
    bad = offset_violations(start, end, shards).limit(1).collect()
    if bad:
        r = bad[0]
        raise OffsetError(f"invalid offsets for shard {r['shard']}: {r['reason']}")


def clamp_offset(times: DataFrame, bounds: DataFrame, time_col: str = "requested",
                 ignore_error: bool = True) -> DataFrame:
    """Requested time clamped to each shard's [earliest, latest]."""
    j = times.join(bounds.select(*SHARD_KEY, "begin_time", "end_time"), SHARD_KEY)
    t = F.col(time_col)
    clamped = F.greatest(F.least(t, F.col("end_time")), F.col("begin_time"))
    res = F.when(t < F.col("begin_time"), F.col("begin_time")).when(
        t > F.col("end_time"), F.col("end_time")
    ).otherwise(t)
    out = j.select(*[c for c in times.columns], res.alias("offset"),
                   (clamped != t).alias("clamped"))
    if not ignore_error:
        out = out.withColumn(
            "offset",
            F.when(F.col("clamped"), F.raise_error(F.concat(
                F.lit("Specific offset "), t.cast("string"), F.lit(" is outside shard "),
                F.col("shard").cast("string"), F.lit("'s range")))).otherwise(F.col("offset")),
        )
    return out


def checkpoint_key(checkpoints: DataFrame) -> list[str]:
    """The columns that identify a checkpoint's shard: project, store and
    shard; a table without the first two belongs to a single store."""
    return [c for c in SHARD_KEY if c in checkpoints.columns]


def start_from_checkpoint(shards: DataFrame, checkpoints: DataFrame, initial: DataFrame,
                          consumer_group: str) -> DataFrame:
    """Start cursor per shard: the non-empty checkpoint, else the initial one.

    ``initial`` has (shard key, ``initial_cursor``)."""
    key = checkpoint_key(checkpoints)
    ck = checkpoints.where(F.col("consumer_group") == consumer_group).select(
        *key, F.nullif(F.col("cursor_b64"), F.lit("")).alias("ckpt")
    )
    # checkpoints of one group and initial cursors: one row per shard at most
    j = shards.select(*SHARD_KEY).join(ck, key, "left").join(initial, SHARD_KEY, "left")
    return j.select(
        *SHARD_KEY,
        F.coalesce(F.col("ckpt"), cursor_to_b64(F.col("initial_cursor"))).alias("start_cursor_b64"),
        F.col("ckpt").isNotNull().alias("from_checkpoint"),
    )


def merge_partition_offsets(task_offsets: DataFrame) -> DataFrame:
    """Per-shard offsets reported by many tasks -> the furthest one per shard."""
    return task_offsets.groupBy(*SHARD_KEY).agg(
        F.max("cursor").alias("cursor"), F.max_by("offset", "cursor").alias("offset")
    )


def offsets_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Count of shards whose cursor differs or that only one side has."""
    x = a.select(*SHARD_KEY, F.col("cursor").alias("a"))
    y = b.select(*SHARD_KEY, F.col("cursor").alias("b"))
    j = x.join(y, SHARD_KEY, "full_outer")
    return j.agg(
        F.count("a").alias("n_a"),
        F.count("b").alias("n_b"),
        F.sum(F.when(~F.col("a").eqNullSafe(F.col("b")), 1).otherwise(0)).cast("bigint").alias("n_diff"),
    ).withColumn("equal", F.col("n_diff") == 0)


def committed_position(checkpoints: DataFrame, consumer_group: str) -> DataFrame:
    return checkpoints.where(
        (F.col("consumer_group") == consumer_group) & (F.col("cursor_b64") != "")
    ).select(*checkpoint_key(checkpoints), b64_to_cursor(F.col("cursor_b64")).alias("committed_cursor"))


def consumer_lag(logs: DataFrame, checkpoints: DataFrame, consumer_group: str) -> DataFrame:
    """Per shard: committed cursor (earliest when none), seconds and records
    behind.  With a store index the records behind are the index counts of
    the days after the committed one plus a scan of the committed days only
    (the days are collected: at most the days of the store)."""
    pos = shard_bounds(logs).join(
        committed_position(checkpoints, consumer_group), checkpoint_key(checkpoints), "left"
    ).select(*SHARD_KEY, "end_time", F.coalesce("committed_cursor", "begin_cursor").alias("committed_cursor"))
    pos = pos.withColumn("committed_time", time_at_cursor(F.col("committed_cursor")))
    pos = pos.withColumn("committed_dt", F.date_from_unix_date(whole_units(F.col("committed_time"), 86400).cast("int")))
    idx = index_of(logs)
    rows = logs.select(*SHARD_KEY, "dt", "cursor")
    if idx is not None:
        days = sorted(r[0] for r in pos.select("committed_dt").distinct().collect())
        first = rows.where(F.col("dt").isin(days)).join(
            pos.select(*SHARD_KEY, F.col("committed_dt").alias("dt"), "committed_cursor"), [*SHARD_KEY, "dt"]
        ).where(F.col("cursor") >= F.col("committed_cursor")).groupBy(*SHARD_KEY).agg(F.count(F.lit(1)).alias("c"))
        later = idx.join(pos.select(*SHARD_KEY, "committed_dt"), SHARD_KEY).where(
            F.col("dt") > F.col("committed_dt")).select(*SHARD_KEY, F.col("n").alias("c"))
        behind = first.unionByName(later).groupBy(*SHARD_KEY).agg(F.sum("c").alias("records_behind"))
    else:
        behind = rows.join(pos.select(*SHARD_KEY, "committed_cursor"), SHARD_KEY).where(
            F.col("cursor") >= F.col("committed_cursor")
        ).groupBy(*SHARD_KEY).agg(F.count(F.lit(1)).alias("records_behind"))
    return pos.join(behind, SHARD_KEY, "left").select(
        *SHARD_KEY, "committed_cursor",
        (F.col("end_time") - F.col("committed_time")).alias("lag_seconds"),
        F.coalesce("records_behind", F.lit(0)).cast("bigint").alias("records_behind"),
    )
