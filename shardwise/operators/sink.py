"""Sinks: rows -> log items -> the log store layout.

A log item is a ``contents`` map of (column name, text) with null columns
left out, plus topic, source and (optionally) a hash key that routes the item
to a shard.  Writing appends Parquet files in the store layout; nothing is
sent row by row and no row passes through the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.functions.convert import check_sink_schema, to_log_text
from shardwise.functions.shape import sorted_json, time_at_cursor
from shardwise.claims import ClaimLog
from shardwise.manifest import begin, check_write_id, is_published, publish, reserve
from shardwise.model import LOG_COLUMNS, read_index, seconds_to_ntz, write_index, write_log_store
from shardwise.plans.shards import route_by_hash_key, write_map
from shardwise.session import path_exists, remove_path, scratch_dir

ALLOWED_MODES = ("append", "errorifexists", "error", "default")
REFUSED_MODES = ("overwrite", "ignore")


class SaveModeError(ValueError):
    pass


def check_save_mode(mode: str) -> str:
    m = (mode or "append").lower()
    if m in REFUSED_MODES:
        raise SaveModeError(f"a log store is only appended to: save mode {mode} is refused (append or errorifexists)")
    if m not in ALLOWED_MODES:
        raise SaveModeError(f"Unknown save mode {mode}")
    return "append" if m == "default" else m


def _sink_fields(df: DataFrame, columns: list[str] | None) -> list[T.StructField]:
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    check_sink_schema(T.StructType(fields))
    return sorted(fields, key=lambda f: f.name)


def contents_of(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A string map of the given columns in their sink text.  A null column
    becomes a null value, which every reader treats as a missing key (the
    JSON of an item leaves it out); no per-row filtering is needed."""
    kv = []
    for f in _sink_fields(df, columns):
        kv += [F.lit(f.name), _text(F.col(f"`{f.name}`"), f.dataType)]
    return F.create_map(*kv)


def item_json_of(df: DataFrame, columns: list[str] | None = None) -> Column:
    """JSON text of the item built from columns: keys in name order, null
    columns left out.  The keys are known when the plan is built, so this is
    one ``to_json`` of a struct -- no per-entry lambdas."""
    return F.to_json(F.struct(*[
        _text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in _sink_fields(df, columns)
    ]))


def _text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StructType):
        # an inner item: its own fields in sink text, fields in name order
        inner = [
            _text(c.getField(f.name), f.dataType).alias(f.name)
            for f in sorted(dt.fields, key=lambda f: f.name)
        ]
        return F.when(c.isNotNull(), F.to_json(F.struct(*inner)))
    return to_log_text(c, dt)


def to_log_items(df: DataFrame, columns: list[str] | None = None, contents: Column | None = None,
                 topic: Column | str | None = None, source: Column | str | None = None,
                 time_col: Column | None = None, hash_key: Column | None = None) -> DataFrame:
    """Rows -> (topic, source, log_time, hash_key, contents, item) where
    ``item`` is the JSON text of the contents.  A row whose contents are null
    stays an item without contents: the write leaves it out and counts it."""
    lit = lambda v: F.lit(v) if isinstance(v, str) or v is None else v
    c = contents if contents is not None else contents_of(df, columns)
    return df.select(
        lit(topic).cast("string").alias("topic"),
        lit(source).cast("string").alias("source"),
        (time_col if time_col is not None else F.lit(None)).cast("timestamp_ntz").alias("log_time"),
        (hash_key if hash_key is not None else F.lit(None)).cast("string").alias("hash_key"),
        c.alias("contents"),
        (sorted_json(c) if contents is not None else item_json_of(df, columns)).alias("item"),
    )


def item_json(items: DataFrame) -> Column:
    return F.col("item")


def route_items(items: DataFrame, shards: DataFrame | None, n_shards: int) -> DataFrame:
    """Items with their shard: the hash-key route over the write map
    (``write_map``) when a shard map is given and the item has a key, else a
    hash of the contents; a key no shard holds fails the write."""
    spread = F.pmod(F.hash(F.to_json("contents")), F.lit(n_shards)).cast("int")
    if shards is None:
        return items.withColumn("shard", spread)
    wmap = write_map(items.sparkSession, shards)
    keyed = route_by_hash_key(items.where(F.col("hash_key").isNotNull()), wmap)
    keyed = keyed.withColumn("shard", F.col("routed_shard")).drop("routed_shard")
    return keyed.unionByName(items.where(F.col("hash_key").isNull()).withColumn("shard", spread))


def is_empty() -> Column:
    """No contents, or only null values (a null column is a missing key)."""
    return F.col("contents").isNull() | F.forall(F.map_values("contents"), lambda v: v.isNull())


def stage_items(items: DataFrame, shards: DataFrame | None, n_shards: int, path: str) -> DataFrame:
    """Routed items written once to ``path`` with the task that wrote them
    (``_task``), their place in it (``_place``) and whether they are empty:
    counts, cursors and index rows all read the same rows."""
    spark = items.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    routed = route_items(items, shards, n_shards).select("topic", "source", "log_time", "contents", "shard", is_empty().alias("_empty"))
    out = routed.withColumn("_task", F.spark_partition_id()).withColumn("_place", place)
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def store_records(staged: DataFrame, project: str, store: str, base_cursor: int) -> DataFrame:
    """Staged items -> store records.  Arrival cursors are dense: the write's
    first cursor plus the items of earlier tasks (a running sum over one row per
    task) plus the item's place, so a write of n items spans n nanoseconds.  Each
    item is its own log group."""
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = staged.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = staged.where(~F.col("_empty")).join(tasks, "_task")
    rows = rows.withColumn("cursor", F.lit(base_cursor) + F.col("_before") + F.col("_place"))
    rows = rows.withColumn("cursor_time", time_at_cursor(F.col("cursor")))
    arrival = seconds_to_ntz("cursor_time")
    return rows.select(
        F.lit(project).alias("log_project"),
        F.lit(store).alias("log_store"),
        "shard", "cursor", "cursor_time",
        F.col("cursor").alias("group_cursor"),
        F.lit(0).alias("log_index"),
        F.coalesce("log_time", arrival).alias("log_time"),
        F.coalesce("topic", F.lit("")).alias("topic"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.lit(None).cast("bigint").alias("event_id"),
        "contents",
        F.create_map().cast("map<string,string>").alias("tags"),
        F.to_date(arrival).alias("dt"),
    ).select(*LOG_COLUMNS)


def next_base_cursor(spark: SparkSession, path: str) -> int:
    """First cursor of a new write: now (ns), but never at or below a cursor
    the store already holds (its index, with writes that lack index rows)."""
    base = time.time_ns()
    if path_exists(spark, path):
        prev = read_index(spark, path).agg(F.max("max_cursor")).first()[0]
        if prev is not None:
            base = max(base, int(prev) + 1)
    return base


def _pinned_base(spark: SparkSession, path: str, write_id: str, n: int) -> int:
    """The first cursor of a repeatable write, kept from its first attempt."""
    pin = ClaimLog(spark, f"{path}/_manifest/pins/{write_id}")
    kept = pin.read(0)
    if kept is None:
        pin.claim(0, {"base": reserve(spark, path, n)})
        kept = pin.read(0)
    return kept["base"]


def write_logs(items: DataFrame, path: str, project: str, store: str, mode: str = "append",
               shards: DataFrame | None = None, n_shards: int = 1, max_dropped: int | None = None,
               write_id: str | None = None) -> dict:
    """Append items to a log store at ``path`` (the save-mode rules apply);
    returns the counts (rows, written, dropped).

    The items are staged first, so more than ``max_dropped`` items without
    contents, or a key no shard holds, fail the write before anything is
    published.  Their cursors are reserved, then come the data, the write's
    index rows and its entry in the manifest, which makes it visible; the stage
    is removed.  With a ``write_id`` a write that was published adds nothing when
    it is repeated, and one cut short is written again with the same cursors."""
    spark = items.sparkSession
    if check_save_mode(mode) != "append" and path_exists(spark, path):
        raise SaveModeError(f"a log store exists at {path}")
    if write_id is not None:
        check_write_id(write_id)
    stage = scratch_dir(spark, "write-stage")
    try:
        staged = stage_items(items, shards, n_shards, stage)
        n = staged.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_empty").alias("dropped")).first()
        counts = {"rows": n["rows"], "written": n["rows"] - n["dropped"], "dropped": n["dropped"]}
        if max_dropped is not None and n["dropped"] > max_dropped:
            raise RuntimeError(f"{n['dropped']} of {n['rows']} items have no contents; at most {max_dropped} may be left out")
        begin(spark, path)
        if write_id is None:
            write_id, base = uuid.uuid4().hex, reserve(spark, path, n["rows"])
        else:
            base = _pinned_base(spark, path, write_id, n["rows"])
            if is_published(spark, path, write_id):
                return counts
        if counts["written"]:
            records = store_records(staged, project, store, base)
            write_log_store(records, path, write_id, rows=counts["written"], one_task=True)
            write_index(records, path, write_id)
        publish(spark, path, write_id, counts["written"])
        return counts
    finally:
        remove_path(spark, stage)


def insert_into(df: DataFrame, path: str, project: str, store: str, columns: list[str] | None = None, overwrite: bool = False, **options) -> dict:
    """``INSERT INTO`` a log store: rows become items and are appended;
    overwriting is refused (not ignored)."""
    if overwrite:
        raise SaveModeError("a log store cannot be overwritten by an insert")
    return write_logs(to_log_items(df, columns), path, project, store, **options)


def log_store_sink(path: str, project: str, store: str, writer: str, to_items: Callable[[DataFrame], DataFrame] = to_log_items, **options) -> Callable:
    """``foreachBatch`` function that appends each micro-batch to a log store.
    The write is named by ``writer`` (stable over restarts) and the batch id, so
    a replayed batch adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_logs(to_items(batch), path, project, store, write_id=f"{writer}-{int(batch_id)}", **options)

    return write


def observed_write(spark: SparkSession, items: DataFrame, path: str, project: str, store: str,
                   max_dropped: int = 0, shards: DataFrame | None = None) -> dict:
    """Write with counts; more than ``max_dropped`` rows that could not become
    items (null or empty contents) fail it before anything is published."""
    return write_logs(items, path, project, store, shards=shards, max_dropped=max_dropped)
