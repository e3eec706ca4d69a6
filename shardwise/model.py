"""Data model: the canonical log record, the log store and its control tables.

A *log store* is a Parquet table of log records partitioned by
``(log_store, dt)`` and sorted inside files by ``(shard, cursor)``, so a
cursor-time range prunes partitions and Parquet row groups.

Record layout::

    log_project STRING, log_store STRING, shard INT, cursor BIGINT,
    cursor_time BIGINT (arrival epoch seconds), group_cursor BIGINT,
    log_index INT, log_time TIMESTAMP_NTZ (whole seconds), topic STRING,
    source STRING, event_id BIGINT, contents MAP<STRING,STRING>,
    tags MAP<STRING,STRING>, dt DATE

``cursor`` is the arrival counter (epoch nanoseconds), ``cursor_time`` its
whole second.  A log group is (shard, topic, dt); ``group_cursor`` is the
group's first cursor and ``log_index`` the 0-based position of the log in
its group, both fixed at write time so reads never need a window.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shardwise.session import checkpoint_root, path_exists

# Fixed values of the fixture store.
PROJECT = "analytics"
STORE = "events"
N_SHARDS = 4
# A fixture log arrives up to this many seconds (exclusive) after its event.
ARRIVAL_DELAY = 90

LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_project", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("cursor", T.LongType()),
        T.StructField("cursor_time", T.LongType()),
        T.StructField("group_cursor", T.LongType()),
        T.StructField("log_index", T.IntegerType()),
        T.StructField("log_time", T.TimestampNTZType()),
        T.StructField("topic", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("contents", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("log_store", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)

LOG_COLUMNS = [
    "log_project", "log_store", "shard", "cursor", "cursor_time", "group_cursor",
    "log_index", "log_time", "topic", "source", "event_id", "contents", "tags", "dt",
]

# The stored table also names the write each record came with.
STORE_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("write_id", T.StringType())])

GROUP_KEYS = ["shard", "topic", "dt"]

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_micros(col: str) -> Column:
    """Zone-free microseconds since the epoch of a TIMESTAMP_NTZ column."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {col})")


def seconds_to_ntz(col: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ without touching the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("SECOND", c, F.expr(_EPOCH_NTZ))


def shard_records(events: DataFrame, project: str = PROJECT, store: str = STORE,
                  n_shards: int = N_SHARDS) -> DataFrame:
    """Events as log records without the group position columns."""
    us = epoch_micros("ts")
    cursor_time = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, ts) div 1000000")
    return events.select(
        F.lit(project).alias("log_project"),
        F.lit(store).alias("log_store"),
        (F.col("user_id") % n_shards).cast("int").alias("shard"),
        (us * 1000).alias("cursor"),
        cursor_time.alias("cursor_time"),
        F.col("event_type").alias("topic"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % n_shards).cast("string")).alias("source"),
        "event_id",
        F.create_map(
            F.lit("msg"), F.col("event_id").cast("string"),
            F.lit("user_id"), F.col("user_id").cast("string"),
            F.lit("value"), F.col("value").cast("string"),
            F.lit("props"), F.col("props"),
        ).alias("contents"),
        F.create_map(
            F.lit("__hostname__"),
            F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")),
        ).alias("tags"),
        F.col("ts").cast("date").alias("dt"),
    )


def derive_logs(events: DataFrame, project: str = PROJECT, store: str = STORE,
                n_shards: int = N_SHARDS) -> DataFrame:
    """Canonical log records from ``events``.

    The position of a log in its (shard, topic, day) group is the number of its
    group's logs in earlier seconds (a running sum over the per-second counts, at
    most 86,400 rows per group) plus its place inside its own second.  So no
    task numbers more than one second of one group, however hot the group."""
    b = shard_records(events, project, store, n_shards)
    group = Window.partitionBy(*GROUP_KEYS)
    seconds = b.groupBy(*GROUP_KEYS, "cursor_time").agg(F.count(F.lit(1)).alias("c"), F.min("cursor").alias("m"))
    earlier = group.orderBy("cursor_time").rowsBetween(Window.unboundedPreceding, -1)
    seconds = seconds.select(
        *[F.col(k).alias(f"_{k}") for k in [*GROUP_KEYS, "cursor_time"]],
        F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_before"), F.min("m").over(group).alias("group_cursor"),
    )
    inside = Window.partitionBy(*GROUP_KEYS, "cursor_time").orderBy("cursor", "event_id")
    r = b.withColumn("_pos", F.row_number().over(inside))
    same = r["cursor_time"] == seconds["_cursor_time"]
    for k in GROUP_KEYS:
        same = same & r[k].eqNullSafe(seconds[f"_{k}"])
    return r.join(seconds, same).select(
        "log_project", "log_store", "shard", "cursor", "cursor_time", "group_cursor",
        (F.col("_before") + F.col("_pos") - 1).cast("int").alias("log_index"),
        seconds_to_ntz(F.col("cursor_time") - F.coalesce(F.col("event_id") % ARRIVAL_DELAY, F.lit(0))).alias("log_time"),
        "topic", "source", "event_id", "contents", "tags", "dt",
    )


# Store write: log rows per range partition when the row count is known.
ROWS_PER_WRITE_PARTITION = 2_000_000


# A write of no more records than this may be sorted and written by one task.
SMALL_WRITE_ROWS = 200_000


def write_log_store(logs: DataFrame, path: str, write_id: str, rows: int | None = None, one_task: bool = False) -> None:
    """Write records in the store layout: partitioned by (log_store, dt,
    write_id), sorted by (shard, cursor) inside files.  Range partitioning keeps
    a hot day or shard spread over many tasks.

    Only the partitions of ``write_id`` are replaced, so repeating a write
    leaves its records once.  A write of more than ``ROWS_PER_WRITE_PARTITION``
    records (``rows``, when known) for each shuffle partition gets as many range
    partitions as that takes; any other gets the shuffle partitions, which AQE
    coalesces by size, so a small write leaves one file a day.  With ``one_task``
    a write of up to ``SMALL_WRITE_ROWS`` (known) records needs no range sample."""
    order = ["log_store", "dt", "shard", "cursor"]
    n = -(-int(rows or 0) // ROWS_PER_WRITE_PARTITION)
    if one_task and rows is not None and rows <= SMALL_WRITE_ROWS:
        r = logs.repartition(1)
    elif n > int(logs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        r = logs.repartitionByRange(n, *order)
    else:
        r = logs.repartitionByRange(*order)
    (
        r.sortWithinPartitions(*order).withColumn("write_id", F.lit(write_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_store", "dt", "write_id").parquet(path)
    )


def ingest_events(events: DataFrame, path: str) -> None:
    """Derive the log store from ``events`` and write it; one log per event,
    so the event count (Parquet metadata for a plain scan) sizes the write."""
    write_log_store(derive_logs(events), path, "ingest", rows=events.count())


def read_log_store(spark: SparkSession, path: str, write_ids: list[str] | None = None) -> DataFrame:
    """The records under ``path``, or only those of some writes (a partition
    filter)."""
    df = spark.read.schema(STORE_SCHEMA).parquet(path)
    if write_ids is not None:
        df = df.where(F.col("write_id").isin(write_ids))
    return df.select(*LOG_COLUMNS)


# ---------------------------------------------------------------------------
# Store index: one row per (shard, day) per write, kept in ``<store>/_index``
# (names starting with "_" are invisible to scans of the store).  Shard bounds
# and day-level lookups read it instead of a column of every log.  Each write's
# rows are its own partition, written after its data.  A store with a manifest
# (``shardwise.manifest``) names its writes there; in one without, a write whose
# index rows are missing (a crash between the two) is found by its id when the
# store is opened, and its rows are computed from its own files.

INDEX_DIR = "_index"
INDEX_SCHEMA = (
    "log_project string, log_store string, shard int, dt date, n bigint, "
    "min_cursor bigint, max_cursor bigint, min_time bigint, max_time bigint, write_id string"
)


def index_rows(logs: DataFrame) -> DataFrame:
    """Per-(shard, day) statistics of a set of records (partial aggregate)."""
    return logs.groupBy("log_project", "log_store", "shard", "dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("cursor").alias("min_cursor"),
        F.max("cursor").alias("max_cursor"),
        F.min("cursor_time").alias("min_time"),
        F.max("cursor_time").alias("max_time"),
    )


def write_index(records: DataFrame, store_path: str, write_id: str) -> None:
    """Index rows of one write, replacing those of an earlier attempt."""
    (
        index_rows(records).withColumn("write_id", F.lit(write_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("write_id").parquet(f"{store_path}/{INDEX_DIR}")
    )


_WRITE_ID = re.compile(r"/write_id=([^/]+)/")


def write_ids(df: DataFrame) -> set[str]:
    """Writes that a scan's files belong to (from the file listing)."""
    return {unquote(m[1]) for f in df.inputFiles() if (m := _WRITE_ID.search(f))}


def read_index(spark: SparkSession, store_path: str) -> DataFrame:
    """The index, one row per (shard, day) (several writes to a day merge)."""
    have: set[str] = set()
    raw = None
    if path_exists(spark, f"{store_path}/{INDEX_DIR}"):
        raw = spark.read.schema(INDEX_SCHEMA).parquet(f"{store_path}/{INDEX_DIR}")
        have = write_ids(raw)
        raw = raw.drop("write_id")
    missing = write_ids(spark.read.schema(STORE_SCHEMA).parquet(store_path)) - have
    if missing or raw is None:
        own = index_rows(read_log_store(spark, store_path, sorted(missing)))
        raw = own if raw is None else raw.unionByName(own)
    return raw.groupBy("log_project", "log_store", "shard", "dt").agg(
        F.sum("n").alias("n"), F.min("min_cursor").alias("min_cursor"),
        F.max("max_cursor").alias("max_cursor"), F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
    )


_INDEXES: dict[int, tuple[DataFrame, DataFrame]] = {}


def attach_index(logs: DataFrame, index: DataFrame) -> DataFrame:
    """Remember ``index`` as the statistics of exactly the rows of ``logs``."""
    _INDEXES[id(logs)] = (logs, index)
    return logs


def index_of(logs: DataFrame) -> DataFrame | None:
    """The index of a store DataFrame as returned by ``log_store`` (not of a
    filtered or derived one)."""
    hit = _INDEXES.get(id(logs))
    return hit[1] if hit is not None and hit[0] is logs else None


# Bumped whenever the derivation or layout changes, so an old store is never reused.
STORE_LAYOUT_VERSION = "9"


def _source_fingerprint(spark: SparkSession, path: str) -> str:
    """Changes whenever a file under ``path`` (or in a folder below it) is
    added, removed or rewritten."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    stamps = []
    while files.hasNext():
        f = files.next()
        stamps.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    text = "\n".join([STORE_LAYOUT_VERSION, path, *sorted(stamps)])
    return hashlib.sha1(text.encode()).hexdigest()[:16]


_STORE_CACHE: dict[tuple[str, str], DataFrame] = {}


def log_store_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the log store derived from ``{sf_dir}/events.parquet``,
    written on first use."""
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    path = f"{checkpoint_root(spark)}/shardwise/logstore/{_source_fingerprint(spark, events_path)}"
    if not path_exists(spark, f"{path}/_ready/_SUCCESS"):
        from shardwise.manifest import begin, is_published, publish  # noqa: PLC0415 (manifest imports model)

        begin(spark, path)
        ingest_events(spark.read.parquet(events_path), path)
        records = read_log_store(spark, path)
        write_index(records, path, "ingest")
        if not is_published(spark, path, "ingest"):
            publish(spark, path, "ingest", records.count())
        literal_table(spark, [(events_path,)], "source string").write.mode("overwrite").json(f"{path}/_ready")
    return path


def log_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log store derived from ``{sf_dir}/events.parquet``.

    Written once per input into the shared checkpoint folder and read back,
    which cuts the derivation's lineage and gives scans Parquet pushdown on
    ``cursor_time``/``shard`` and partition pruning on ``dt``.  The opened table
    is kept per application and store folder, whose name follows the input.
    """
    path = log_store_path(spark, sf_dir)
    key = (spark.sparkContext.applicationId, path)
    if key not in _STORE_CACHE:
        from shardwise.manifest import open_at  # noqa: PLC0415

        _STORE_CACHE[key] = open_at(spark, path)
    return _STORE_CACHE[key]


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small control table as a local relation (one Arrow table handed to
    the JVM; Spark knows its size, so joins with it need no hint).  For
    per-shard and per-trigger rows."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    columns = list(zip(*[tuple(r) for r in rows], strict=True)) if rows else [[] for _ in st.fields]
    kinds = to_arrow_schema(st)
    items = [[list(v.items()) if isinstance(v, dict) else v for v in c] for c in columns]
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(items, kinds, strict=True)], schema=kinds), st)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Control tables: one row per shard / consumer position.

HASH_SPACE_END = "g"  # sorts above any hex text

# The fixture store's shard map (hash ranges are 32 hex digits,
# end exclusive) -- shard, status, hash_begin, hash_end.
SHARD_ROWS = [
    (0, "readwrite", "0" * 32, "4" + "0" * 31),
    (1, "readwrite", "4" + "0" * 31, "8" + "0" * 31),
    (2, "readonly", "8" + "0" * 31, "c" + "0" * 31),
    (3, "readwrite", "c" + "0" * 31, HASH_SPACE_END),
]

SHARDS_SCHEMA = (
    "log_project string, log_store string, shard int, status string, "
    "hash_begin string, hash_end string"
)


def shards_table(spark: SparkSession, project: str = PROJECT, store: str = STORE) -> DataFrame:
    return literal_table(
        spark, [(project, store, s, st, hb, he) for s, st, hb, he in SHARD_ROWS], SHARDS_SCHEMA
    )


CHECKPOINTS_SCHEMA = "consumer_group string, shard int, cursor_b64 string"


def checkpoints_table(spark: SparkSession, logs: DataFrame) -> DataFrame:
    """Consumer checkpoints: shard 0 at 2024-01-10, shard 1 empty, shard 2 at
    its end (an exhausted read-only shard), shard 3 never committed."""
    fixed = literal_table(
        spark, [("g1", 0, "MTcwNDg0NDgwMDAwMDAwMDAwMA=="), ("g1", 1, "")], CHECKPOINTS_SCHEMA
    )
    from shardwise.plans.offsets import shard_bounds  # noqa: PLC0415 (offsets imports model)

    end2 = (
        shard_bounds(logs).where(F.col("shard") == 2)
        .select(F.col("end_cursor").alias("c"))
        .select(
            F.lit("g1").alias("consumer_group"),
            F.lit(2).alias("shard"),
            F.base64(F.col("c").cast("string").cast("binary")).alias("cursor_b64"),
        )
    )
    return fixed.unionByName(end2)
