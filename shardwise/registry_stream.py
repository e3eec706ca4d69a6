"""Registered queries for consumption, sinks, streaming and the relational
work run on log records (continuation of ``shardwise.registry``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise import fixtures as fx
from shardwise import manifest as mf
from shardwise.fixtures import with_logs
from shardwise.functions import shape
from shardwise.model import (
    ARRIVAL_DELAY, checkpoints_table, log_store, log_store_path, shards_table, table, write_index, write_log_store,
)
from shardwise.operators import analytics as an
from shardwise.operators import consume as co
from shardwise.operators import sink as sk
from shardwise.operators import trigger as tr
from shardwise.plans import offsets as off
from shardwise.plans import ratelimit as rl
from shardwise.registry import DUCK_START, SCAN_COLS, register
from shardwise.session import path_exists, scratch_dir
from shardwise.sources.reader import open_store, read_logs, read_stream
from shardwise.streaming import core as st
from shardwise.streaming.follow import follow

K = off.SHARD_KEY
DIRECT_CAP = 500

# ---------------------------------------------------------------------------
# Direct-style consumption

DUCK_DIRECT = f"""pos AS (SELECT shard, cast(decode(from_base64(start_cursor_b64)) AS BIGINT) start_cursor FROM st),
x AS (SELECT l.*, row_number() OVER (PARTITION BY l.shard ORDER BY l."cursor") rn
  FROM logs l JOIN pos USING (shard) WHERE l."cursor" >= pos.start_cursor),
batch AS (SELECT * FROM x WHERE rn <= {DIRECT_CAP})"""

DUCK_J4 = (
    "'{\"__time__\":' || cast(log_second AS varchar) || ',\"__shard__\":' || cast(shard AS varchar) || ',' || "
    f"substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2)"
)


def _direct(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return co.direct_batch(spark, logs, shards_table(spark), checkpoints_table(spark, logs), "g1", DIRECT_CAP)


@register("direct_stream_batch", with_logs(
    f'SELECT log_project, log_store, shard, "cursor", {DUCK_J4} AS record FROM batch', DUCK_START, DUCK_DIRECT))
def q_direct_stream_batch(spark, sf_dir):
    return _direct(spark, sf_dir)


@register("batch_offset_ranges", with_logs(
    """SELECT log_project, log_store, shard, min("cursor") AS from_cursor, max("cursor") + 1 AS until_cursor,
  count(*) AS records FROM batch GROUP BY ALL""", DUCK_START, DUCK_DIRECT))
def q_batch_offset_ranges(spark, sf_dir):
    return rl.batch_ranges(_direct(spark, sf_dir))


@register("commit_offsets", with_logs(
    """SELECT consumer_group, shard, to_base64(encode(cast(c AS varchar))) AS cursor_b64 FROM m
UNION ALL SELECT consumer_group, shard, '' FROM checkpoints WHERE cursor_b64 = '' AND shard NOT IN (SELECT shard FROM m)""",
    DUCK_START, DUCK_DIRECT,
    """rg AS (SELECT shard, max("cursor") + 1 until_cursor FROM batch GROUP BY shard),
m AS (SELECT consumer_group, shard, max(c) c FROM (
  SELECT consumer_group, shard, cast(decode(from_base64(cursor_b64)) AS BIGINT) c FROM checkpoints WHERE cursor_b64 <> ''
  UNION ALL SELECT 'g1', shard, until_cursor FROM rg) GROUP BY ALL)"""))
def q_commit_offsets(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    ranges = rl.batch_ranges(_direct(spark, sf_dir))
    return co.commit_offsets(checkpoints_table(spark, logs), ranges, "g1")


# ---------------------------------------------------------------------------
# Sinks

def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


# Orders below this price have no contents (a rejected row); some are.
PRICE_MIN = 100000

DUCK_ORDER_ITEMS = """SELECT cast(json_object('o_custkey', cast(o_custkey AS varchar),
  'o_orderdate', cast(epoch_ms(o_orderdate) AS varchar), 'o_orderkey', cast(o_orderkey AS varchar),
  'o_orderpriority', o_orderpriority, 'o_orderstatus', o_orderstatus, 'o_totalprice', cast(o_totalprice AS varchar)) AS varchar) AS item
FROM orders"""


def _item(df: DataFrame) -> F.Column:
    """The item text of rows read back through the default projection."""
    return F.col("__value__").alias("item")


@register("write_logs_batch", DUCK_ORDER_ITEMS)
def q_write_logs_batch(spark, sf_dir):
    """Orders written to a log store, read back through the reader."""
    path = scratch_dir(spark, "w1-store")
    sk.write_logs(sk.to_log_items(_orders(spark, sf_dir)), path, "analytics", "orders", n_shards=4)
    back = read_logs(spark, path)
    return back.select(_item(back))


@register("sink_value_rules", """SELECT l_orderkey, l_linenumber, cast(json_object(
  'price', cast(cast(cast(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS varchar),
  'qty', cast(l_quantity AS varchar), 'returned', cast(l_returnflag = 'R' AS varchar),
  'ship_date', cast(epoch_ms(cast(cast(l_shipdate AS date) AS timestamp)) AS varchar),
  'ship_ts', cast(epoch_ms(l_shipdate) AS varchar)) AS varchar) AS item FROM lineitem""")
def q_sink_value_rules(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").cast(T.DecimalType(12, 2)).alias("price"),
        F.col("l_quantity").alias("qty"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_shipdate").alias("ship_ts"),
    )
    cols = ["price", "qty", "returned", "ship_date", "ship_ts"]
    return li.select("l_orderkey", "l_linenumber", sk.item_json_of(li, cols).alias("item"))


@register("sink_nested_struct", """SELECT cast(json_object('detail', cast(json_object('o_orderstatus', o_orderstatus,
  'o_totalprice', cast(o_totalprice AS varchar)) AS varchar), 'o_orderkey', cast(o_orderkey AS varchar)) AS varchar) AS item
FROM orders""")
def q_sink_nested_struct(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        "o_orderkey", F.struct("o_totalprice", "o_orderstatus").alias("detail")
    )
    items = sk.to_log_items(o)
    return items.select(sk.item_json(items).alias("item"))


@register("sink_nulls", """SELECT CASE WHEN o_orderpriority LIKE '1%'
  THEN cast(json_object('o_orderkey', cast(o_orderkey AS varchar)) AS varchar)
  ELSE cast(json_object('o_orderkey', cast(o_orderkey AS varchar), 'o_orderpriority', o_orderpriority) AS varchar) END AS item
FROM orders""")
def q_sink_nulls(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    items = sk.to_log_items(o)
    return items.select(sk.item_json(items).alias("item"))


def _topic_source_items(spark, sf_dir, with_key: bool):
    o = _orders(spark, sf_dir)
    contents = F.when(
        F.col("o_totalprice") >= PRICE_MIN,
        F.create_map(
            F.lit("key"), F.col("o_orderkey").cast("string"),
            F.lit("price"), F.col("o_totalprice").cast("string"),
        ),
    )
    key = F.md5(F.col("o_custkey").cast("string")) if with_key else None
    return sk.to_log_items(o, contents=contents, topic=F.col("o_orderstatus"),
                           source=F.col("o_orderpriority"), hash_key=key)


@register("write_with_topic_source", """SELECT o_orderstatus AS topic, o_orderpriority AS source,
  cast(json_object('key', cast(o_orderkey AS varchar), 'price', cast(o_totalprice AS varchar)) AS varchar) AS item
FROM orders WHERE o_totalprice >= 100000""")
def q_write_with_topic_source(spark, sf_dir):
    """Rows without contents are left out of the store; the rest is read back."""
    path = scratch_dir(spark, "w9-store")
    sk.write_logs(_topic_source_items(spark, sf_dir, with_key=False), path, "analytics", "orders", n_shards=4)
    back = read_logs(spark, path)
    return back.select(F.col("__topic__").alias("topic"), F.col("__source__").alias("source"), _item(back))


@register("write_with_hash_key", with_logs("""SELECT s.shard AS routed_shard, o_orderstatus AS topic,
  cast(json_object('key', cast(o_orderkey AS varchar), 'price', cast(o_totalprice AS varchar)) AS varchar) AS item
FROM orders JOIN shards s ON md5(cast(o_custkey AS varchar)) >= s.hash_begin AND md5(cast(o_custkey AS varchar)) < s.hash_end
WHERE o_totalprice >= 100000"""))
def q_write_with_hash_key(spark, sf_dir):
    """Items routed by their key on the way into the store, read back."""
    path = scratch_dir(spark, "w10-store")
    sk.write_logs(_topic_source_items(spark, sf_dir, with_key=True), path, "analytics", "orders", shards=shards_table(spark))
    back = read_logs(spark, path)
    return back.select(F.col("__shard__").cast("int").alias("routed_shard"), F.col("__topic__").alias("topic"), _item(back))


@register("insert_into", DUCK_ORDER_ITEMS)
def q_insert_into(spark, sf_dir):
    """INSERT INTO a log store in two parts; the rows are read back."""
    path = scratch_dir(spark, "w7-store")
    orders = _orders(spark, sf_dir)
    for part in (0, 1):
        sk.insert_into(orders.where(F.col("o_orderkey") % 2 == part), path, "analytics", "orders", n_shards=4)
    back = read_logs(spark, path)
    return back.select(_item(back))


@register("stream_sink_idempotent", with_logs(
    """SELECT shard, cast(json_object('cursor', cast("cursor" AS varchar), 'shard', cast(shard AS varchar)) AS varchar) AS item
FROM logs"""))
def q_stream_sink_idempotent(spark, sf_dir):
    """Stream the store into another log store, then replay its first batch:
    the target, read back, holds each record once."""
    out, ck = scratch_dir(spark, "w8-store"), scratch_dir(spark, "w8-ck")
    batches: dict[int, str] = {}
    sink = sk.log_store_sink(out, "analytics", "copy", "w8", n_shards=4)

    def keep_and_write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:  # kept for the replay below
            batches[0] = scratch_dir(spark, "w8-batch")
            batch.write.parquet(batches[0])
        sink(batch, batch_id)

    st.run_available_now(st.stream_logs(spark, log_store_path(spark, sf_dir), 40).select("shard", "cursor"), ck, keep_and_write)
    sink(spark.read.parquet(batches[0]), 0)
    back = read_logs(spark, out, schema=T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("cursor", T.LongType())]))
    item = F.to_json(F.struct(F.col("cursor").cast("string").alias("cursor"), F.col("shard").cast("string").alias("shard")))
    return back.select("shard", item.alias("item"))


@register("write_observed", """SELECT count(*)::BIGINT AS "rows",
  count(*) FILTER (WHERE o_totalprice >= 100000)::BIGINT AS written,
  count(*) FILTER (WHERE o_totalprice < 100000 OR o_totalprice IS NULL)::BIGINT AS dropped,
  count(*) FILTER (WHERE o_totalprice >= 100000)::BIGINT AS read_back FROM orders""")
def q_write_observed(spark, sf_dir):
    """Counts of a write in which some rows have no contents, and what a reader
    then finds; the same write with a lower limit fails and publishes nothing."""
    path = scratch_dir(spark, "w11-store")
    items = _topic_source_items(spark, sf_dir, with_key=False)
    try:
        sk.observed_write(spark, items, path, "analytics", "orders", max_dropped=0)
        refused = False
    except RuntimeError:
        refused = not path_exists(spark, path)
    res = sk.observed_write(spark, items, path, "analytics", "orders", max_dropped=2**62)
    assert refused == (res["dropped"] > 0)
    back = read_logs(spark, path).agg(F.count(F.lit(1)).alias("read_back"))
    return back.select(*[F.lit(res[k]).cast("bigint").alias(k) for k in ("rows", "written", "dropped")], "read_back")


PART_CASE = f"CASE WHEN cursor_time < {fx.DAY10} THEN 0 WHEN cursor_time < {fx.DAY20} THEN 1 ELSE 2 END"
STAGED_SCHEMA = "shard int, cursor bigint, cursor_time bigint"


def _staged_runs(spark, sf_dir, name, run, columns=("shard", "cursor", "cursor_time")) -> None:
    """The store arrives in three parts (before day 10, days 10-20, after):
    each part is written, then ``run(stage)`` starts the stream on the same
    checkpoint.  Each run has exactly one micro-batch, so batch k holds part k
    and the parts come in time order."""
    logs = log_store(spark, sf_dir).select(*columns)
    stage = scratch_dir(spark, name)
    c = F.col("cursor_time")
    parts = [c < fx.DAY10, (c >= fx.DAY10) & (c < fx.DAY20), c >= fx.DAY20]
    for i, cond in enumerate(parts):
        logs.where(cond).write.parquet(f"{stage}/part={i}")
        run(stage)


def _staged_stream(spark, stage, schema=STAGED_SCHEMA):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(stage)


@register("foreach_batch_table", with_logs(
    f"""SELECT shard, "cursor", batch_id FROM (
  SELECT shard, "cursor", {PART_CASE} AS batch_id, row_number() OVER (PARTITION BY {PART_CASE} ORDER BY "cursor") rn
  FROM logs) WHERE rn <= 10"""))
def q_foreach_batch_table(spark, sf_dir):
    """Per micro-batch the 10 first records by cursor, added to a table.  The
    batch's rows replace its own partition (dynamic overwrite), so a replayed
    batch is not added twice."""
    out, ck = scratch_dir(spark, "w12-table"), scratch_dir(spark, "w12-ck")

    def top10(batch: DataFrame, batch_id: int) -> None:
        (
            batch.orderBy("cursor").limit(10).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(out)
        )

    _staged_runs(spark, sf_dir, "w12-in",
                 lambda stage: st.run_available_now(_staged_stream(spark, stage).select("shard", "cursor"), ck, top10))
    return spark.read.parquet(out).select("shard", "cursor", "batch_id")


# ---------------------------------------------------------------------------
# Streaming sources

def _records(df: DataFrame) -> DataFrame:
    return df.select(*SCAN_COLS, F.col("contents").getItem("msg").alias("msg"))


def _arrivals(spark, sf_dir, path: str, parts: list, run) -> None:
    """A log store at ``path`` to which ``parts`` (conditions on the fixture's
    logs) are appended one by one; ``run()`` starts the stream after each."""
    logs = log_store(spark, sf_dir)
    for i, cond in enumerate(parts):
        part = logs.where(cond)
        write_log_store(part, path, f"part-{i}")
        write_index(part, path, f"part-{i}")
        run()


DUCK_STREAM_START = """so AS (SELECT * FROM (VALUES (0, -2), (1, 1704844800), (2, 1704067200)) t(shard, o))"""
STREAM_START = '{"analytics#events":{"0":-2,"1":1704844800,"2":1704067200}}'


@register("stream_scan", with_logs(
    """SELECT log_project, log_store, shard, "cursor", cursor_time, log_time, topic, source, c_msg AS msg
FROM logs LEFT JOIN so USING (shard) WHERE o IS NULL OR o = -2 OR cursor_time >= o""", DUCK_STREAM_START))
def q_stream_scan(spark, sf_dir):
    """The reader's stream from specific offsets.  The store first holds shards
    0 to 2 before day 20; while the stream is stopped, their later logs and a
    whole new shard arrive: the restart reads all of them, the new shard from
    its earliest log."""
    path, ck, out = (scratch_dir(spark, f"s4-{x}") for x in ("store", "ck", "out"))
    first = (F.col("shard") < 3) & (F.col("cursor_time") < fx.DAY20)

    def run():
        stream = read_stream(spark, path, STREAM_START, max_files_per_trigger=20, checkpoint=ck, records=True)
        st.run_available_now(_records(stream), ck, st.idempotent_writer(out))

    _arrivals(spark, sf_dir, path, [first, ~first], run)
    return st.read_batches(spark, out).drop("batch_id")


@register("initial_offsets_pinned", with_logs(
    "SELECT log_project, log_store, shard, begin_time AS start_time FROM bounds"))
def q_initial_offsets_pinned(spark, sf_dir):
    """Earliest offsets resolved on first start and stored; a second start
    reads the stored file instead of resolving again."""
    logs = log_store(spark, sf_dir)
    state = scratch_dir(spark, "s6-initial-offsets")

    def resolve():
        return off.earliest_offsets(logs).select(*K, F.col("begin_time").alias("start_time"))

    st.pinned_start_offsets(spark, state, resolve)
    return st.pinned_start_offsets(spark, state, resolve)


@register("receiver_stream_union", with_logs(
    f"""SELECT shard, strlen(rec) AS n_bytes, rec AS record FROM (
  SELECT shard, '{{"__time__":' || cast(log_second AS varchar) || ',' || substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2) AS rec FROM logs)"""))
def q_receiver_stream_union(spark, sf_dir):
    """Two receivers (shards {0,2} and {1,3}) unioned; each record is UTF-8
    JSON bytes."""
    src = log_store_path(spark, sf_dir)
    base = st.stream_logs(spark, src, 10)
    groups = [[0, 2], [1, 3]]
    parts = [base.where(F.col("shard").isin(g)) for g in groups]
    u = shape.with_json_record(parts[0].unionByName(parts[1])).select(
        "shard", F.encode("record", "UTF-8").alias("payload"))
    out = scratch_dir(spark, "s8-out")
    st.run_available_now(u, scratch_dir(spark, "s8-ck"), st.idempotent_writer(out))
    got = st.read_batches(spark, out)
    return got.select("shard", F.octet_length("payload").cast("bigint").alias("n_bytes"),
                      F.decode("payload", "UTF-8").alias("record"))


SCAN_SQL = 'SELECT log_project, log_store, shard, "cursor", cursor_time, log_time, topic, source, c_msg AS msg FROM logs'


def _share(spark, sf_dir, parts: int = 5) -> int:
    """Logs of a trigger so that the store takes about ``parts`` of them."""
    return max(1, log_store(spark, sf_dir).count() // parts)


@register("limited_stream", with_logs(SCAN_SQL))
def q_limited_stream(spark, sf_dir):
    """The store as a stream of limited triggers in cursor order; the stream is
    stopped after two of them and goes on from its checkpoint: every log once."""
    path, ck, out = log_store_path(spark, sf_dir), scratch_dir(spark, "s4-limit-ck"), scratch_dir(spark, "s4-limit-out")
    limit = _share(spark, sf_dir, 4)
    for triggers in (2, None):
        follow(spark, path, ck, _records, st.idempotent_writer(out), "earliest", limit, triggers=triggers)
    return st.read_batches(spark, out).drop("batch_id")


@register("compacted_store", DUCK_ORDER_ITEMS)
def q_compacted_store(spark, sf_dir):
    """Orders written by six micro-batches, then compacted and vacuumed: the
    rows read back are those written, from one folder a day."""
    path = scratch_dir(spark, "w8-compact")
    sink = sk.log_store_sink(path, "analytics", "orders", "w8c", n_shards=4)
    orders = _orders(spark, sf_dir)
    for i in range(6):
        sink(orders.where(F.pmod(F.hash("o_orderkey"), F.lit(6)) == i), i)
    done = mf.compact(spark, path)
    mf.vacuum(spark, path, done["entry"])
    back = read_logs(spark, path)
    return back.select(_item(back))


# ---------------------------------------------------------------------------
# Aggregates, windows, joins, sorts and state through Spark

def _ts(df: DataFrame) -> DataFrame:
    """Event time as TIMESTAMP (watermarks refuse TIMESTAMP_NTZ)."""
    return df.withColumn("t", F.col("log_time").cast("timestamp"))


@register("window_count_watermark", with_logs(
    """SELECT make_timestamp((log_second // 5 * 5) * 1000000) AS window_start,
  make_timestamp((log_second // 5 * 5 + 5) * 1000000) AS window_end, count(*) AS "count" FROM logs GROUP BY ALL"""))
def q_window_count_watermark(spark, sf_dir):
    """Counts per 5-second window in update mode over the store itself, followed
    in cursor order in limited triggers: a trigger writes only the windows it
    changes, and readers take each window's last version."""
    ck, out = scratch_dir(spark, "q1-ck"), scratch_dir(spark, "q1-out")

    def counts(logs: DataFrame) -> DataFrame:
        s = _ts(logs.select("log_time")).withWatermark("t", f"{10 + ARRIVAL_DELAY} seconds")  # events reach the store up to that late
        return s.groupBy(F.window("t", "5 seconds").alias("w")).agg(F.count(F.lit(1)).alias("count"))

    follow(spark, log_store_path(spark, sf_dir), ck, counts, st.idempotent_writer(out), "earliest", _share(spark, sf_dir), output_mode="update")
    last = st.last_version(st.read_batches(spark, out), ["w"], ["count"])
    return last.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "count",
    )


@register("late_data_drop", with_logs(
    f"""SELECT date_trunc('hour', log_time) AS window_start, count(*) AS "count"
FROM logs, (SELECT max(log_time) - INTERVAL 10 SECOND AS wm FROM logs WHERE cursor_time >= {fx.DAY10}) w
WHERE cursor_time >= {fx.DAY10} GROUP BY 1, wm HAVING date_trunc('hour', log_time) + INTERVAL 1 HOUR <= wm"""))
def q_late_data_drop(spark, sf_dir):
    """Hourly counts in append mode with a 10 s watermark.  The stream first
    reads the logs from day 10 on; then the older logs arrive and the stream
    restarts on the same checkpoint, whose watermark is restored: every late
    log is dropped.  Emitted are the windows of the first part that end at
    or before the watermark."""
    logs = log_store(spark, sf_dir)
    stage = scratch_dir(spark, "q2-in")
    ck, out = scratch_dir(spark, "q2-ck"), scratch_dir(spark, "q2-out")
    import shardwise.model as m

    def run():
        s = spark.readStream.schema(m.LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(stage)
        s = _ts(s).withWatermark("t", "10 seconds")
        agg = s.groupBy(F.window("t", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("count"))
        st.run_available_now(agg, ck, st.idempotent_writer(out), output_mode="append")

    logs.where(F.col("cursor_time") >= fx.DAY10).write.parquet(f"{stage}/part=1")
    run()
    logs.where(F.col("cursor_time") < fx.DAY10).write.parquet(f"{stage}/part=2")
    run()
    return st.read_batches(spark, out).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "count"
    )


def _table_stream(spark, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of
    them.  The braces make the path a pattern: only then is the given base path
    kept (the stream's own path would be it, which one file cannot be)."""
    base = sf_dir.rstrip("/")
    r = spark.readStream.schema(table(spark, sf_dir, name).schema).option("basePath", base).option("maxFileAge", "36500d")
    return r.parquet(f"{base}/{{{name}.parquet}}")


DUCK_WORDS = """SELECT w AS word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ' ')) w FROM documents) GROUP BY w"""


@register("word_count_stream", """SELECT w AS word, count(*) AS "count" FROM (
  SELECT unnest(CASE WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(rtrim(text, ' '), ' ') END) w FROM documents) GROUP BY w""")
def q_word_count_stream(spark, sf_dir):
    """Java-style split (trailing empty tokens dropped; every text gets some) in
    update mode into a log store: a batch appends the words it changes, readers
    take each word's newest item."""
    docs = _table_stream(spark, sf_dir, "documents")
    counts = an.word_count(docs.withColumn("text", F.concat("text", F.lit("  "))), "text", java_split=True)
    out = scratch_dir(spark, "q3-store")
    sink = sk.log_store_sink(out, "analytics", "words", "q3", n_shards=4)
    st.run_available_now(counts, scratch_dir(spark, "q3-ck"), sink, output_mode="update")
    item = open_store(spark, out).select("cursor", *[F.col("contents").getItem(k).alias(k) for k in ("word", "count")])
    return item.groupBy("word").agg(F.max_by("count", "cursor").cast("bigint").alias("count"))


@register("word_count_batch", DUCK_WORDS)
def q_word_count_batch(spark, sf_dir):
    return an.word_count(table(spark, sf_dir, "documents"), "text", java_split=False)


@register("agg_update_sink", with_logs('SELECT topic, count(*) AS "count" FROM logs GROUP BY topic'))
def q_agg_update_sink(spark, sf_dir):
    """Running counts in update mode; the sink keeps every version, readers
    take the last one per key."""
    s = st.stream_logs(spark, log_store_path(spark, sf_dir), 10)
    agg = s.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))
    out = scratch_dir(spark, "q5-out")
    st.run_available_now(agg, scratch_dir(spark, "q5-ck"), st.idempotent_writer(out), output_mode="update")
    return st.last_version(st.read_batches(spark, out), ["topic"], ["count"])


SELF_JOIN_SECONDS = 1800


@register("stream_self_join", with_logs(
    """SELECT l.user_id, l.event_id AS l_event_id, r.event_id AS r_event_id FROM logs l JOIN logs r
  ON l.user_id = r.user_id AND r.log_time >= l.log_time AND r.log_time <= l.log_time + INTERVAL 30 MINUTE"""))
def q_stream_self_join(spark, sf_dir):
    """Inner self-join of one stream on the user plus a 30-minute time bound,
    watermarked on both sides so join state is dropped as time passes; the
    join key includes a time bucket so a hot user is spread over buckets.  The
    store is followed in cursor order, so pairs across two triggers meet in the
    join's state."""
    ck, out = scratch_dir(spark, "q6-ck"), scratch_dir(spark, "q6-out")

    def pairs(logs: DataFrame) -> DataFrame:
        s = _ts(logs).select(F.col("contents").getItem("user_id").cast("bigint").alias("user_id"), "event_id", "t")
        return an.bounded_self_join(s, "user_id", "t", "event_id", SELF_JOIN_SECONDS)

    follow(spark, log_store_path(spark, sf_dir), ck, pairs, st.idempotent_writer(out), "earliest", _share(spark, sf_dir))
    return st.read_batches(spark, out).drop("batch_id")


@register("map_cast_increment", with_logs("SELECT c_msg AS msg, cast(c_msg AS INT) + 1 AS value FROM logs"))
def q_map_cast_increment(spark, sf_dir):
    s = st.stream_logs(spark, log_store_path(spark, sf_dir), 10)
    m = s.select(F.col("contents").getItem("msg").alias("msg")).select(
        "msg", (F.col("msg").cast("int") + 1).alias("value")
    )
    out = scratch_dir(spark, "q7-out")
    st.run_available_now(m, scratch_dir(spark, "q7-ck"), sink_path=out)
    return spark.read.parquet(out)


@register("top_k_desc", with_logs(
    "SELECT event_id, cast(c_value AS DOUBLE) AS value FROM logs ORDER BY value DESC, event_id DESC LIMIT 10"))
def q_top_k_desc(spark, sf_dir):
    logs = log_store(spark, sf_dir).select("event_id", F.col("contents").getItem("value").cast("double").alias("value"))
    return an.top_k(logs, 10, F.col("value").desc(), F.col("event_id").desc())


@register("count_by_length", with_logs(
    f"""SELECT len, records, count(*) OVER () AS n_lengths FROM (
  SELECT length('{{"__time__":' || cast(log_second AS varchar) || ',' || substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2)) AS len,
  count(*) AS records FROM logs GROUP BY 1)"""))
def q_count_by_length(spark, sf_dir):
    recs = shape.with_json_record(log_store(spark, sf_dir)).select("record")
    return an.count_by_length(recs, "record")


@register("cast_select_expr", with_logs(
    "SELECT cast(c_msg AS INT) AS value, cast(c_msg AS INT) % 5 AS key FROM logs"))
def q_cast_select_expr(spark, sf_dir):
    logs = log_store(spark, sf_dir).select(F.col("contents").getItem("msg").alias("msg"))
    return logs.selectExpr("CAST(msg AS INT) AS value", "CAST(msg AS INT) % 5 AS key")


@register("restart_recovery", with_logs(f'SELECT shard, "cursor" FROM logs WHERE cursor_time >= {fx.DAY10}'))
def q_restart_recovery(spark, sf_dir):
    """A stream from the latest offsets stops, logs arrive, and it restarts on
    the same checkpoint: its start is the one of the first run, so exactly the
    logs that came later are read, each once."""
    path, ck, out = (scratch_dir(spark, f"q11-{x}") for x in ("store", "ck", "out"))

    def run():
        stream = read_stream(spark, path, "latest", checkpoint=ck, records=True)
        st.run_available_now(stream.select("shard", "cursor"), ck, st.idempotent_writer(out))

    early, late = F.col("cursor_time") < fx.DAY10, F.col("cursor_time") < fx.DAY20
    _arrivals(spark, sf_dir, path, [early, ~early & late, ~late], run)
    return st.read_batches(spark, out).select("shard", "cursor")


@register("rate_limited_triggers", with_logs('SELECT log_project, log_store, shard, "cursor", cursor_time, log_time, topic, source, c_msg AS msg FROM logs'))
def q_rate_limited_triggers(spark, sf_dir):
    """Triggers limited to a share of the store until it is read: each one
    plans its end, reads, writes and commits; together they hold every log once."""
    logs = log_store(spark, sf_dir)
    state, out = scratch_dir(spark, "trigger-state"), scratch_dir(spark, "trigger-out")
    total = logs.count()

    def write(batch: DataFrame, trigger: int) -> None:
        st.idempotent_writer(out)(_records(batch), trigger)

    while tr.run_trigger(spark, logs, state, write, max_offsets=max(1, total // 3), look_ahead=15 * 86400, width=3600):
        pass
    return st.read_batches(spark, out).drop("batch_id")


@register("input_row_metrics", with_logs(
    f"SELECT CAST({PART_CASE} AS BIGINT) AS batch_id, count(*) AS num_input_rows FROM logs GROUP BY 1"))
def q_input_row_metrics(spark, sf_dir):
    """Rows read per trigger while the store arrives in three parts: one
    trigger per part, every trigger reported (query listener)."""
    ck, out = scratch_dir(spark, "q12-ck"), scratch_dir(spark, "q12-out")
    rows: list[tuple[int, int]] = []

    def run(stage):
        s = _staged_stream(spark, stage).select("shard", "cursor")
        rows.extend(st.run_with_progress(s, ck, st.idempotent_writer(out)))

    _staged_runs(spark, sf_dir, "q12-in", run)
    return st.progress_rows(spark, rows)


@register("transform_forward", with_logs(
    f"""SELECT cast(shard AS varchar) AS hash_key, log_time, cast({fx.DUCK_RECORD_STRINGS} AS varchar) AS item FROM logs"""))
def q_transform_forward(spark, sf_dir):
    recs = shape.with_json_record(log_store(spark, sf_dir), with_shard=True).select("record")
    return an.forward_records(recs)
