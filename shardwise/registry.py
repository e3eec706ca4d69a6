"""Registered queries (one per operator) and their DuckDB oracle SQL.

Every query reads the driver's tables from ``sf_dir`` (or the log store
Spark derives from ``events``) over whole tables.  ``QUERIES[name]`` takes
``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE[name]`` is the same
result as DuckDB SQL over the raw tables, with equal column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise import fixtures as fx
from shardwise.fixtures import with_logs
from shardwise.functions import shape
from shardwise.functions.convert import checked_not_null, convert, null_message
from shardwise.model import (
    checkpoints_table, literal_table, log_store, seconds_to_ntz, shards_table, table, write_index, write_log_store,
)
from shardwise.plans import offsets as off
from shardwise.plans import ratelimit as rl
from shardwise.plans import shards as sh
from shardwise.session import scratch_dir
from shardwise.sources import batch as src
from shardwise.sources.reader import open_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

K = off.SHARD_KEY


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _json_df(spark: SparkSession, texts: list[str]) -> DataFrame:
    return literal_table(spark, [(t,) for t in texts], "offsets_json string")


def _parsed(spark: SparkSession, text: str) -> DataFrame:
    return off.parse_offsets_json(_json_df(spark, [text]))


def _fixture_ranges(spark: SparkSession, logs: DataFrame) -> DataFrame:
    """Start/end offsets of the fixture JSON with sentinels resolved."""
    b = off.shard_bounds(logs)
    s = off.resolve_sentinels(_parsed(spark, fx.OFFSETS_START), b, out="start_time").drop("offset")
    e = off.resolve_sentinels(_parsed(spark, fx.OFFSETS_END), b, out="end_time").drop("offset")
    return s.join(e, K)


SCAN_COLS = ["log_project", "log_store", "shard", "cursor", "cursor_time", "log_time", "topic", "source"]


def _scan_cols(df: DataFrame) -> DataFrame:
    return df.select(*SCAN_COLS, F.col("contents").getItem("msg").alias("msg"))


DUCK_RANGES = """so AS (SELECT * FROM (VALUES (0, -2), (1, 1704844800), (2, 1704067200), (3, -2)) t(shard, o)),
eo AS (SELECT * FROM (VALUES (0, -1), (1, 1705708800), (2, 1705708800), (3, -1)) t(shard, o)),
rng AS (SELECT b.log_project, b.log_store, b.shard,
  CASE so.o WHEN -2 THEN begin_time WHEN -1 THEN end_time ELSE so.o END start_time,
  CASE eo.o WHEN -2 THEN begin_time WHEN -1 THEN end_time ELSE eo.o END end_time
  FROM bounds b JOIN so USING (shard) JOIN eo USING (shard))"""

DUCK_SCAN = """SELECT log_project, log_store, shard, "cursor", cursor_time, log_time, topic, source, c_msg AS msg
FROM logs JOIN rng USING (log_project, log_store, shard)
WHERE cursor_time >= start_time AND cursor_time < end_time"""

# ---------------------------------------------------------------------------
# Flagship: middle half of every shard -> typed projection -> hourly rollup.

FLAGSHIP_SCHEMA = T.StructType([
    T.StructField("value", T.DoubleType()),
    T.StructField("__time__", T.TimestampNTZType()),
    T.StructField("__shard__", T.IntegerType()),
    T.StructField("__topic__", T.StringType()),
])


@register("hourly_topic_rollup", with_logs(
    """SELECT date_trunc('hour', log_time) AS hour, topic AS __topic__, count(*) AS logs,
  round(sum(cast(c_value AS double)), 2) AS value_sum
FROM logs JOIN bounds USING (log_project, log_store, shard)
WHERE cursor_time >= begin_time + (end_time - begin_time) // 4
  AND cursor_time < begin_time + (3 * (end_time - begin_time)) // 4
GROUP BY ALL"""))
def q_flagship(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    b = off.shard_bounds(logs)
    ranges = b.select(
        *K,
        (F.col("begin_time") + F.expr("(end_time - begin_time) div 4")).alias("start_time"),
        (F.col("begin_time") + F.expr("(3 * (end_time - begin_time)) div 4")).alias("end_time"),
    )
    typed = src.scan_range(logs, ranges).select(*shape.schema_columns(FLAGSHIP_SCHEMA))
    secs = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("__time__"))
    hour = seconds_to_ntz(F.floor(secs / 3600) * 3600)
    return typed.groupBy(hour.alias("hour"), "__topic__").agg(
        F.count(F.lit(1)).alias("logs"), F.round(F.sum("value"), 2).alias("value_sum")
    )


# ---------------------------------------------------------------------------
# 2.1 Scans and sources

@register("batch_scan_range", with_logs(DUCK_SCAN, DUCK_RANGES))
def q_batch_scan_range(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return _scan_cols(src.scan_range(logs, _fixture_ranges(spark, logs)))


@register("time_range_scan", with_logs(
    f"""SELECT log_project, log_store, shard, "cursor",
  '{{"__time__":' || cast(log_second AS varchar) || ',' || substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2) AS record
FROM logs WHERE cursor_time >= {fx.DAY10}"""))
def q_time_range_scan(spark, sf_dir):
    return src.time_range_scan(log_store(spark, sf_dir), fx.DAY10)


@register("time_range_slices", with_logs(
    f"""SELECT log_project, log_store, shard, cast(least(2, (cursor_time - {fx.DAY10}) // 288000) AS int) AS slice,
  {fx.DAY10} + least(2, (cursor_time - {fx.DAY10}) // 288000) * 288000 AS from_time,
  CASE WHEN least(2, (cursor_time - {fx.DAY10}) // 288000) = 2 THEN {fx.DAY20}
       ELSE {fx.DAY10} + (least(2, (cursor_time - {fx.DAY10}) // 288000) + 1) * 288000 END AS to_time,
  count(*) AS records
FROM logs WHERE cursor_time >= {fx.DAY10} AND cursor_time < {fx.DAY20} GROUP BY ALL"""))
def q_time_range_slices(spark, sf_dir):
    return src.time_range_slices(log_store(spark, sf_dir), fx.DAY10, fx.DAY20, 3)


def _probes(logs: DataFrame) -> DataFrame:
    b = off.shard_bounds(logs)
    ts = [F.lit(fx.DAY10), F.lit(fx.DAY10 + 43210), F.col("begin_time") - 1000, F.col("end_time") + 5]
    parts = [b.select(*K, t.cast("bigint").alias("t")) for t in ts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DUCK_PROBES = f"""probes AS (
  SELECT log_project, log_store, shard, {fx.DAY10}::BIGINT t, end_cursor FROM bounds
  UNION ALL SELECT log_project, log_store, shard, {fx.DAY10 + 43210}, end_cursor FROM bounds
  UNION ALL SELECT log_project, log_store, shard, begin_time - 1000, end_cursor FROM bounds
  UNION ALL SELECT log_project, log_store, shard, end_time + 5, end_cursor FROM bounds)"""


@register("cursor_at_time", with_logs(
    """SELECT p.log_project, p.log_store, p.shard, p.t,
  coalesce((SELECT min(l."cursor") FROM logs l WHERE l.shard = p.shard AND l.cursor_time >= p.t), p.end_cursor) AS "cursor"
FROM probes p""", DUCK_PROBES))
def q_cursor_at_time(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return src.cursor_at_time(logs, _probes(logs))


@register("time_at_cursor", with_logs(
    'SELECT shard, "cursor", "cursor" // 1000000000 AS cursor_second FROM logs'))
def q_time_at_cursor(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return logs.select("shard", "cursor", shape.time_at_cursor(F.col("cursor")).alias("cursor_second"))


@register("start_position_modes", with_logs(
    f"""SELECT 'BEGIN_CURSOR' AS mode, log_project, log_store, shard, to_base64(encode(cast(begin_cursor AS varchar))) AS cursor_b64 FROM bounds
UNION ALL SELECT 'END_CURSOR', log_project, log_store, shard, to_base64(encode(cast(end_cursor AS varchar))) FROM bounds
UNION ALL SELECT 'SPECIAL_TIMER_CURSOR', b.log_project, b.log_store, b.shard, to_base64(encode(cast(coalesce(
  (SELECT min(l."cursor") FROM logs l WHERE l.shard = b.shard AND l.cursor_time >= {fx.DAY10 + 12345}), b.end_cursor) AS varchar)))
FROM bounds b"""))
def q_start_position_modes(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    parts = [
        src.start_positions_b64(logs, m, fx.DAY10 + 12345).select(F.lit(m).alias("mode"), "*")
        for m in src.START_MODES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("scan_reuse_union", with_logs(f"{DUCK_SCAN}\nUNION ALL\n{DUCK_SCAN}", DUCK_RANGES))
def q_scan_reuse_union(spark, sf_dir):
    df = q_batch_scan_range(spark, sf_dir)
    return df.unionAll(df)


DUCK_INCR = """cm AS (SELECT * FROM (VALUES (0, 1704844800), (1, 1704844800), (2, 1704844800)) t(shard, committed_time)),
pl AS (SELECT * FROM (VALUES (0, 1705708800), (1, 1705708800), (3, 1705708800)) t(shard, end_time)),
rng AS (SELECT b.log_project, b.log_store, pl.shard, coalesce(cm.committed_time, b.begin_time) start_time, pl.end_time
  FROM pl LEFT JOIN cm USING (shard) JOIN bounds b USING (shard))"""


@register("incremental_batch", with_logs(DUCK_SCAN, DUCK_INCR))
def q_incremental_batch(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    lit_rows = lambda rows, col: literal_table(spark,
        [(fx_p, fx_s, k, v) for fx_p, fx_s, k, v in rows], f"log_project string, log_store string, shard int, {col} bigint"
    )
    committed = lit_rows([("analytics", "events", k, fx.DAY10) for k in (0, 1, 2)], "end_time")
    planned = lit_rows([("analytics", "events", k, fx.DAY20) for k in (0, 1, 3)], "end_time")
    ranges = sh.incremental_ranges(planned, committed, off.earliest_offsets(logs))
    return _scan_cols(src.scan_range(logs, ranges))


# ---------------------------------------------------------------------------
# 2.2 Offsets, planning and progress

@register("list_shards", with_logs("SELECT DISTINCT log_project, log_store, shard FROM logs"))
def q_list_shards(spark, sf_dir):
    return off.list_shards(log_store(spark, sf_dir))


@register("earliest_offsets", with_logs("SELECT log_project, log_store, shard, begin_time, begin_cursor FROM bounds"))
def q_earliest(spark, sf_dir):
    return off.earliest_offsets(log_store(spark, sf_dir))


@register("latest_offsets", with_logs("SELECT log_project, log_store, shard, end_time, end_cursor FROM bounds"))
def q_latest(spark, sf_dir):
    return off.latest_offsets(log_store(spark, sf_dir))


def _daily_offsets(logs: DataFrame) -> DataFrame:
    return off.daily_first_offsets(logs)


DUCK_DAILY_JSON = """per AS (SELECT dt, log_project, log_store, shard, min(cursor_time) o FROM logs GROUP BY ALL),
ps AS (SELECT dt, log_project, log_store,
  '{' || string_agg('"' || cast(shard AS varchar) || '":' || cast(o AS varchar), ',' ORDER BY cast(shard AS varchar)) || '}' j
  FROM per GROUP BY ALL)"""


@register("render_offsets_json", with_logs(
    """SELECT dt, '{' || string_agg('"' || log_project || '#' || log_store || '":' || j, ','
  ORDER BY log_project || '#' || log_store) || '}' AS offsets_json FROM ps GROUP BY dt""", DUCK_DAILY_JSON))
def q_render_offsets_json(spark, sf_dir):
    return off.render_offsets_json(_daily_offsets(log_store(spark, sf_dir)), group_by=["dt"])


@register("parse_offsets_json", with_logs(
    'SELECT dt, log_project, log_store, shard, min(cursor_time) AS "offset" FROM logs GROUP BY ALL'))
def q_parse_offsets_json(spark, sf_dir):
    texts = q_render_offsets_json(spark, sf_dir)
    return off.parse_offsets_json(texts, keep=["dt"])


@register("resolve_sentinels", with_logs("SELECT log_project, log_store, shard, start_time, end_time FROM rng", DUCK_RANGES))
def q_resolve_sentinels(spark, sf_dir):
    return _fixture_ranges(spark, log_store(spark, sf_dir))


# Candidate offset pairs for validation (A valid, B and C not).
VALIDATION_CANDIDATES = [
    ("A", fx.OFFSETS_START, fx.OFFSETS_END),
    ("B", '{"analytics#events":{"0":-1,"1":-2,"2":-2,"3":-2}}',
     '{"analytics#events":{"0":-1,"1":-2,"2":-1,"3":-1}}'),
    ("C", '{"analytics#events":{"0":-2,"1":-2,"2":-2}}',
     '{"analytics#events":{"0":-1,"1":-1,"2":-1,"3":-1,"7":-1}}'),
]

DUCK_VALIDATION = """st AS (SELECT * FROM (VALUES ('A',0,-2),('A',1,1704844800),('A',2,1704067200),('A',3,-2),
  ('B',0,-1),('B',1,-2),('B',2,-2),('B',3,-2),('C',0,-2),('C',1,-2),('C',2,-2)) t(candidate, shard, o)),
en AS (SELECT * FROM (VALUES ('A',0,-1),('A',1,1705708800),('A',2,1705708800),('A',3,-1),
  ('B',0,-1),('B',1,-2),('B',2,-1),('B',3,-1),('C',0,-1),('C',1,-1),('C',2,-1),('C',3,-1),('C',7,-1)) t(candidate, shard, o)),
known AS (SELECT c.candidate, s.shard FROM (SELECT DISTINCT candidate FROM st) c, (SELECT DISTINCT shard FROM logs) s),
se AS (SELECT coalesce(st.candidate, en.candidate) candidate, coalesce(st.shard, en.shard) shard,
  st.o start_offset, en.o end_offset FROM st FULL OUTER JOIN en ON st.candidate = en.candidate AND st.shard = en.shard),
j AS (SELECT coalesce(se.candidate, known.candidate) candidate, coalesce(se.shard, known.shard) shard,
  start_offset, end_offset, known.shard IS NOT NULL is_known
  FROM se FULL OUTER JOIN known ON se.candidate = known.candidate AND se.shard = known.shard),
r AS (SELECT *, CASE WHEN NOT is_known THEN 'unknown shard'
  WHEN start_offset IS NULL AND end_offset IS NULL THEN 'shard missing in start and end'
  WHEN start_offset IS NULL THEN 'shard missing in start'
  WHEN end_offset IS NULL THEN 'shard missing in end'
  WHEN start_offset = -1 THEN 'start may not be latest'
  WHEN end_offset = -2 THEN 'end may not be earliest' END reason FROM j)"""


@register("validate_batch_offsets", with_logs(
    """SELECT candidate, 'analytics' AS log_project, 'events' AS log_store, shard, start_offset, end_offset, reason
FROM r WHERE reason IS NOT NULL""", DUCK_VALIDATION))
def q_validate(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    known = off.list_shards(logs)
    out = None
    for name, s_txt, e_txt in VALIDATION_CANDIDATES:
        v = off.offset_violations(_parsed(spark, s_txt), _parsed(spark, e_txt), known)
        v = v.select(F.lit(name).alias("candidate"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("clamp_specific_offset", with_logs(
    """SELECT log_project, log_store, shard, t.requested,
  CASE WHEN t.requested < begin_time THEN begin_time WHEN t.requested > end_time THEN end_time ELSE t.requested END AS "offset",
  (t.requested < begin_time OR t.requested > end_time) AS clamped
FROM bounds, (VALUES (1704844800::BIGINT), (1704000000), (1800000000)) t(requested)"""))
def q_clamp(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    b = off.shard_bounds(logs)
    parts = [b.select(*K, F.lit(t).cast("bigint").alias("requested")) for t in (fx.DAY10, 1704000000, 1800000000)]
    req = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return off.clamp_offset(req, b)


DUCK_START = """ck AS (SELECT shard, nullif(cursor_b64, '') ckpt FROM checkpoints WHERE consumer_group = 'g1'),
st AS (SELECT s.log_project, s.log_store, s.shard,
  coalesce(ck.ckpt, to_base64(encode(cast(b.begin_cursor AS varchar)))) start_cursor_b64,
  ck.ckpt IS NOT NULL from_checkpoint
  FROM shards s LEFT JOIN ck USING (shard) LEFT JOIN bounds b USING (log_project, log_store, shard))"""


def _start_positions(spark, logs):
    initial = off.earliest_offsets(logs).select(*K, F.col("begin_cursor").alias("initial_cursor"))
    return off.start_from_checkpoint(shards_table(spark), checkpoints_table(spark, logs), initial, "g1")


@register("start_from_checkpoint", with_logs("SELECT * FROM st", DUCK_START))
def q_start_from_checkpoint(spark, sf_dir):
    return _start_positions(spark, log_store(spark, sf_dir))


@register("histogram", with_logs(
    f"""SELECT {fx.DAY10} + i * 3600 AS from_time, {fx.DAY10} + (i + 1) * 3600 AS to_time, coalesce(c, 0) AS cnt
FROM range(0, 24) t(i) LEFT JOIN (SELECT (cursor_time - {fx.DAY10}) // 3600 AS i, count(*) c FROM logs
  WHERE cursor_time >= {fx.DAY10} AND cursor_time < {fx.DAY10 + 86400} GROUP BY 1) USING (i)"""))
def q_histogram(spark, sf_dir):
    return rl.histogram(spark, log_store(spark, sf_dir), fx.DAY10, fx.DAY10 + 86400, 3600)


RATE_LIMITS = [0, 1, 100, rl.LONG_MAX]


@register("rate_limit_cut", with_logs(
    f"""SELECT max_offsets, coalesce(max(to_time), {fx.DAY10}) AS end_time, cast(coalesce(sum(c), 0) AS BIGINT) AS logs
FROM lim LEFT JOIN hc ON hc.before < lim.max_offsets GROUP BY max_offsets""",
    f"""bk AS (SELECT {fx.DAY10} + i * 300 from_time, least({fx.DAY10} + (i + 1) * 300, {fx.DAY10 + 86400}) to_time, i FROM range(0, 288) t(i)),
cnt AS (SELECT (cursor_time - {fx.DAY10}) // 300 i, count(*) c FROM logs
  WHERE cursor_time >= {fx.DAY10} AND cursor_time < {fx.DAY10 + 86400} GROUP BY 1),
h AS (SELECT from_time, to_time, coalesce(c, 0) c FROM bk LEFT JOIN cnt USING (i)),
hc AS (SELECT *, coalesce(sum(c) OVER (ORDER BY from_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) before FROM h),
lim AS (SELECT * FROM (VALUES (0::BIGINT), (1), (100), (9223372036854775807)) t(max_offsets))"""))
def q_rate_limit_cut(spark, sf_dir):
    return rl.rate_limit_cut(spark, log_store(spark, sf_dir), fx.DAY10, RATE_LIMITS,
                             now=fx.DAY10 + 10 * 86400, look_ahead=86400, width=300)


@register("cap_records_per_shard", with_logs(
    """SELECT log_project, log_store, shard, "cursor", cursor_time, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY "cursor") rn FROM logs) WHERE rn <= 700"""))
def q_cap(spark, sf_dir):
    capped = rl.cap_records_per_shard(log_store(spark, sf_dir), 700)
    return capped.select(*K, "cursor", "cursor_time", "event_id")


@register("rate_per_shard", with_logs(
    """SELECT dt, estimated_rate, cast(trunc(CASE WHEN coalesce(estimated_rate, 0) > 0 THEN estimated_rate ELSE 2.0 END / 4.0 * 60) AS INT) AS records_per_shard
FROM (SELECT dt, lag(n) OVER (ORDER BY dt) / 86400.0 estimated_rate FROM (SELECT dt, count(*) n FROM logs GROUP BY dt))"""))
def q_rate_per_shard(spark, sf_dir):
    from pyspark.sql import Window

    days = log_store(spark, sf_dir).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    est = days.select("dt", (F.lag("n").over(Window.orderBy("dt")) / F.lit(86400.0)).alias("estimated_rate"))
    return rl.rate_per_shard(est, n_shards=4, batch_millis=60000, initial_rate=2.0)


@register("detect_rollback", with_logs(
    """SELECT log_project, log_store, shard, batch_id, start_cursor, prev_start_cursor,
  coalesce(prev_start_cursor > start_cursor, false) AS rolled_back FROM (
  SELECT *, lag(start_cursor) OVER (PARTITION BY shard ORDER BY batch_id) prev_start_cursor FROM (
    SELECT log_project, log_store, shard, row_number() OVER (PARTITION BY shard ORDER BY dt, topic) batch_id, start_cursor
    FROM (SELECT log_project, log_store, shard, dt, topic, min(group_cursor) start_cursor FROM logs GROUP BY ALL)))"""))
def q_detect_rollback(spark, sf_dir):
    from pyspark.sql import Window

    g = log_store(spark, sf_dir).groupBy(*K, "dt", "topic").agg(F.min("group_cursor").alias("start_cursor"))
    g = g.withColumn("batch_id", F.row_number().over(Window.partitionBy(*K).orderBy("dt", "topic")))
    return sh.detect_rollback(g.select(*K, "batch_id", "start_cursor"))


def _positions(spark, logs):
    st = _start_positions(spark, logs).select(*K, shape.b64_to_cursor(F.col("start_cursor_b64")).alias("start_cursor"))
    return st.join(off.shard_bounds(logs).select(*K, "end_cursor"), K)


@register("skip_exhausted_shards", with_logs(
    """SELECT s.log_project, s.log_store, s.shard, cast(decode(from_base64(start_cursor_b64)) AS BIGINT) AS start_cursor, b.end_cursor
FROM st s JOIN bounds b USING (log_project, log_store, shard) JOIN shards USING (log_project, log_store, shard)
WHERE NOT (status = 'readonly' AND cast(decode(from_base64(start_cursor_b64)) AS BIGINT) >= b.end_cursor)""", DUCK_START))
def q_skip_exhausted(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return sh.skip_exhausted_shards(_positions(spark, logs), shards_table(spark))


@register("cursor_codec", with_logs(
    """SELECT shard, "cursor", to_base64(encode(cast("cursor" AS varchar))) AS cursor_b64,
  cast(decode(from_base64(to_base64(encode(cast("cursor" AS varchar))))) AS BIGINT) AS decoded FROM logs"""))
def q_cursor_codec(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    enc = shape.cursor_to_b64(F.col("cursor"))
    return logs.select("shard", "cursor", enc.alias("cursor_b64"), shape.b64_to_cursor(enc).alias("decoded"))


@register("consumer_lag", with_logs(
    """SELECT b.log_project, b.log_store, b.shard, p.committed_cursor,
  b.end_time - p.committed_cursor // 1000000000 AS lag_seconds,
  (SELECT count(*) FROM logs l WHERE l.shard = b.shard AND l."cursor" >= p.committed_cursor) AS records_behind
FROM bounds b JOIN (SELECT b2.shard, coalesce(cast(decode(from_base64(nullif(c.cursor_b64, ''))) AS BIGINT), b2.begin_cursor) committed_cursor
  FROM bounds b2 LEFT JOIN (SELECT * FROM checkpoints WHERE consumer_group = 'g1' AND cursor_b64 <> '') c USING (shard)) p USING (shard)"""))
def q_consumer_lag(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    return off.consumer_lag(logs, checkpoints_table(spark, logs), "g1")


def _task_offsets(logs):
    return logs.groupBy(*K, "dt").agg(F.max("cursor").alias("cursor"), F.max_by("cursor_time", "cursor").alias("offset"))


@register("merge_partition_offsets", with_logs(
    """SELECT log_project, log_store, shard, max("cursor") AS "cursor", arg_max(cursor_time, "cursor") AS "offset"
FROM logs GROUP BY ALL"""))
def q_merge(spark, sf_dir):
    return off.merge_partition_offsets(_task_offsets(log_store(spark, sf_dir)))


@register("offsets_equal", with_logs(
    """SELECT pair, count(*) AS n_a, count(*) AS n_b, cast(sum(CASE WHEN a <> m THEN 1 ELSE 0 END) AS BIGINT) AS n_diff,
  sum(CASE WHEN a <> m THEN 1 ELSE 0 END) = 0 AS equal
FROM (SELECT 'last_vs_merged' pair, end_cursor - 1 a, shard FROM bounds
  UNION ALL SELECT 'first_vs_merged', begin_cursor, shard FROM bounds) x
JOIN (SELECT shard, max("cursor") m FROM logs GROUP BY shard) USING (shard) GROUP BY pair"""))
def q_offsets_equal(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    b = off.shard_bounds(logs)
    merged = off.merge_partition_offsets(_task_offsets(logs))
    last = b.select(*K, (F.col("end_cursor") - 1).alias("cursor"))
    first = b.select(*K, F.col("begin_cursor").alias("cursor"))
    return off.offsets_diff(last, merged).select(F.lit("last_vs_merged").alias("pair"), "*").unionByName(
        off.offsets_diff(first, merged).select(F.lit("first_vs_merged").alias("pair"), "*")
    )


@register("route_by_hash_key", with_logs(
    """SELECT l.event_id, md5(cast(l.user_id AS varchar)) AS hash_key, s.shard AS routed_shard
FROM logs l JOIN shards s ON md5(cast(l.user_id AS varchar)) >= s.hash_begin AND md5(cast(l.user_id AS varchar)) < s.hash_end"""))
def q_route(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    rec = logs.select("event_id", F.md5(F.col("contents").getItem("user_id")).alias("hash_key"))
    return sh.route_by_hash_key(rec, shards_table(spark))


@register("split_shard", with_logs(
    f"""SELECT m.log_project, m.log_store, m.shard, m.status, m.hash_begin, m.hash_end,
  CASE WHEN m.shard = 0 THEN 0 ELSE
  (SELECT count(*) FROM logs l WHERE md5(cast(l.user_id AS varchar)) >= m.hash_begin AND md5(cast(l.user_id AS varchar)) < m.hash_end) END AS records
FROM (SELECT log_project, log_store, shard, CASE WHEN shard = 0 THEN 'readonly' ELSE status END status, hash_begin, hash_end FROM shards
  UNION ALL SELECT log_project, log_store, 4, 'readwrite', hash_begin, '{fx.SPLIT_KEY}' FROM shards WHERE shard = 0
  UNION ALL SELECT log_project, log_store, 5, 'readwrite', '{fx.SPLIT_KEY}', hash_end FROM shards WHERE shard = 0) m"""))
def q_split(spark, sf_dir):
    """The map after a split and the records each shard now takes: the parent
    takes none, its children share its range."""
    logs = log_store(spark, sf_dir)
    new_map = sh.split_shard(shards_table(spark), 0, fx.SPLIT_KEY)
    rec = logs.select(F.md5(F.col("contents").getItem("user_id")).alias("hash_key"))
    counts = sh.route_by_hash_key(rec, sh.write_map(spark, new_map)).groupBy(F.col("routed_shard").alias("shard")).agg(
        F.count(F.lit(1)).alias("records")
    )
    return new_map.join(counts, "shard", "left").select(
        *K, "status", "hash_begin", "hash_end", F.coalesce("records", F.lit(0)).alias("records")
    )


# ---------------------------------------------------------------------------
# 2.3 Record shaping and converters

@register("project_default", with_logs(
    f"""SELECT log_project AS __logProject__, log_store AS __logStore__, cast(shard AS varchar) AS __shard__,
  strftime(log_time, '%Y-%m-%d %H:%M:%S') || '.0' AS __time__, topic AS __topic__, source AS __source__,
  cast({fx.DUCK_STRINGS_JSON} AS varchar) AS __value__, NULL::VARCHAR AS __sequence_number__ FROM logs"""))
def q_project_default(spark, sf_dir):
    return shape.project(log_store(spark, sf_dir))


SCHEMA_J2 = T.StructType([
    T.StructField("msg", T.LongType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
    T.StructField("__time__", T.TimestampNTZType()),
    T.StructField("__shard__", T.IntegerType()),
    T.StructField("__topic__", T.StringType()),
    T.StructField("missing", T.StringType()),
])


@register("project_schema", with_logs(
    """SELECT cast(c_msg AS BIGINT) AS msg, cast(c_user_id AS INT) AS user_id, cast(c_value AS DOUBLE) AS value,
  c_props AS props, log_time AS __time__, shard AS __shard__, topic AS __topic__, NULL::VARCHAR AS missing FROM logs"""))
def q_project_schema(spark, sf_dir):
    return shape.project(log_store(spark, sf_dir), SCHEMA_J2)


@register("project_json_record", with_logs(
    f"""SELECT shard, "cursor",
  '{{"__time__":' || cast(log_second AS varchar) || ',' || substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2) AS record FROM logs"""))
def q_project_json_record(spark, sf_dir):
    return shape.with_json_record(log_store(spark, sf_dir)).select("shard", "cursor", "record")


DUCK_RECORD_NO_TAGS = (
    "json_object('__source__', source, '__topic__', topic, 'msg', c_msg, 'props', c_props, "
    "'user_id', c_user_id, 'value', c_value)"
)


@register("project_json_record_shard", with_logs(
    f"""SELECT shard, "cursor",
  '{{"__time__":' || cast(log_second AS varchar) || ',"__shard__":' || cast(shard AS varchar) || ',' || substr(cast({fx.DUCK_RECORD_STRINGS} AS varchar), 2) AS record,
  '{{"__time__":' || cast(log_second AS varchar) || ',"__shard__":' || cast(shard AS varchar) || ',' || substr(cast({DUCK_RECORD_NO_TAGS} AS varchar), 2) AS record_no_tags
FROM logs"""))
def q_project_json_record_shard(spark, sf_dir):
    logs = shape.with_json_record(log_store(spark, sf_dir), "record", with_shard=True)
    logs = shape.with_json_record(logs, "record_no_tags", with_shard=True, ignore_tags=True)
    return logs.select("shard", "cursor", "record", "record_no_tags")


SCHEMA_J5 = T.StructType([
    T.StructField("__logProject__", T.StringType()),
    T.StructField("__logStore__", T.StringType()),
    T.StructField("__shard__", T.IntegerType()),
    T.StructField("__time__", T.TimestampNTZType()),
    T.StructField("__topic__", T.StringType()),
    T.StructField("__source__", T.StringType()),
])


@register("metadata_columns", with_logs(
    """SELECT log_project AS __logProject__, log_store AS __logStore__, shard AS __shard__, log_time AS __time__,
  topic AS __topic__, source AS __source__ FROM logs"""))
def q_metadata_columns(spark, sf_dir):
    return shape.project(log_store(spark, sf_dir), SCHEMA_J5)


@register("tag_columns", with_logs(
    """SELECT c_msg AS msg, t_hostname AS "__tag__:__hostname__", NULL::VARCHAR AS "__tag__:absent" FROM logs"""))
def q_tag_columns(spark, sf_dir):
    schema = T.StructType([
        T.StructField("msg", T.StringType()),
        T.StructField("__tag__:__hostname__", T.StringType()),
        T.StructField("__tag__:absent", T.StringType()),
    ])
    return shape.project(log_store(spark, sf_dir), schema)


@register("sequence_number", with_logs(
    """SELECT c_msg AS msg, cast(group_cursor AS varchar) || '-' || cast(log_index AS varchar) AS __sequence_number__,
  cast(json_object('__sequence_number__', cast(group_cursor AS varchar) || '-' || cast(log_index AS varchar),
    '__tag__:__hostname__', t_hostname, 'msg', c_msg, 'props', c_props, 'user_id', c_user_id, 'value', c_value) AS varchar) AS __value__
FROM logs"""))
def q_sequence_number(spark, sf_dir):
    logs = log_store(spark, sf_dir)
    schema = T.StructType([T.StructField("msg", T.StringType()), T.StructField("__sequence_number__", T.StringType())])
    value = shape.default_columns(append_sequence_number=True)[6]
    return logs.select(*shape.schema_columns(schema), value)


def _conflicting(logs: DataFrame) -> DataFrame:
    """Logs whose contents also carry a metadata key and a tag key."""
    extra = F.create_map(
        F.lit("__topic__"), F.concat(F.lit("c-"), F.col("topic")),
        F.lit("__tag__:__hostname__"), F.lit("c-host"),
    )
    return logs.withColumn("contents", F.map_concat("contents", extra))


@register("key_precedence", with_logs(
    """SELECT c_msg AS msg,
  cast(json_object('__tag__:__hostname__', t_hostname, '__topic__', 'c-' || topic, 'msg', c_msg, 'props', c_props,
    'user_id', c_user_id, 'value', c_value) AS varchar) AS j1_value,
  topic AS j2_topic, t_hostname AS j2_tag,
  '{"__time__":' || cast(log_second AS varchar) || ',' || substr(cast(json_object('__source__', source,
    '__tag__:__hostname__', t_hostname, '__topic__', 'c-' || topic, 'msg', c_msg, 'props', c_props,
    'user_id', c_user_id, 'value', c_value) AS varchar), 2) AS j3_record
FROM logs"""))
def q_key_precedence(spark, sf_dir):
    c = shape.with_json_record(_conflicting(log_store(spark, sf_dir)), "j3_record")
    return c.select(
        F.col("contents").getItem("msg").alias("msg"),
        shape.default_columns()[6].alias("j1_value"),
        shape.field_text("__topic__").alias("j2_topic"),
        shape.field_text("__tag__:__hostname__").alias("j2_tag"),
        "j3_record",
    )


@register("store_identity", with_logs(
    f"""SELECT log_project, log_store, shard, begin_time AS "offset", end_time FROM bounds
UNION ALL SELECT 'analytics', 'archive', shard, min(cursor_time), max(cursor_time) + 1 FROM logs
WHERE cursor_time < {fx.DAY10} AND shard < 3 GROUP BY shard"""))
def q_store_identity(spark, sf_dir):
    """Two stores with the same shard numbers: the fixture store and an archive
    that holds shards 0 to 2 up to day 10.  Their earliest offsets go into one
    offset JSON; parsed back, each entry meets the bounds of its own store."""
    logs = log_store(spark, sf_dir)
    path = scratch_dir(spark, "archive")
    old = logs.where((F.col("cursor_time") < fx.DAY10) & (F.col("shard") < 3)).withColumn("log_store", F.lit("archive"))
    write_log_store(old, path, "archive")
    write_index(old, path, "archive")
    bounds = off.shard_bounds(logs).unionByName(off.shard_bounds(open_store(spark, path)))
    first = bounds.select(*K, F.col("begin_time").alias("offset"))
    parsed = off.parse_offsets_json(off.render_offsets_json(first))
    return parsed.join(bounds.select(*K, "end_time"), K, "left")


def _items(spark, sf_dir, *keys):
    return fx.lineitem_items(table(spark, sf_dir, "lineitem"), list(keys) or None)


def _typed(items: DataFrame, fields: list[tuple[str, T.DataType]], nullable: bool = True) -> DataFrame:
    return items.select(
        "l_orderkey", "l_linenumber",
        *[convert(F.col("contents").getItem(k), t, k, nullable).alias(k) for k, t in fields],
    )


@register("convert_integral", with_logs(
    """SELECT l_orderkey, l_linenumber, cast(ln AS TINYINT) AS ln_byte, cast(ln AS SMALLINT) AS ln_short,
  cast(ln AS INT) AS ln, cast(ok AS BIGINT) AS ok FROM items""", fx.DUCK_ITEMS))
def q_convert_integral(spark, sf_dir):
    it = _items(spark, sf_dir, "ln", "ok")
    c = F.col("contents").getItem
    return it.select(
        "l_orderkey", "l_linenumber",
        convert(c("ln"), T.ByteType(), "ln").alias("ln_byte"),
        convert(c("ln"), T.ShortType(), "ln").alias("ln_short"),
        convert(c("ln"), T.IntegerType(), "ln").alias("ln"),
        convert(c("ok"), T.LongType(), "ok").alias("ok"),
    )


@register("convert_floating", with_logs(
    """SELECT l_orderkey, l_linenumber, cast(q AS DOUBLE) AS q, cast(p AS DOUBLE) AS p,
  cast(cast(d AS FLOAT) AS DOUBLE) AS d FROM items""", fx.DUCK_ITEMS))
def q_convert_floating(spark, sf_dir):
    t = _typed(_items(spark, sf_dir, "q", "p", "d"), [("q", T.DoubleType()), ("p", T.DoubleType()), ("d", T.FloatType())])
    return t.withColumn("d", F.col("d").cast("double"))


@register("convert_boolean", with_logs(
    "SELECT l_orderkey, l_linenumber, lower(flag) = 'true' AS flag FROM items", fx.DUCK_ITEMS))
def q_convert_boolean(spark, sf_dir):
    return _typed(_items(spark, sf_dir, "flag"), [("flag", T.BooleanType())])


@register("convert_decimal", with_logs(
    "SELECT l_orderkey, l_linenumber, cast(replace(comma, ',', '') AS DECIMAL(12,2)) AS comma FROM items", fx.DUCK_ITEMS))
def q_convert_decimal(spark, sf_dir):
    return _typed(_items(spark, sf_dir, "comma"), [("comma", T.DecimalType(12, 2))])


@register("convert_timestamp", with_logs(
    "SELECT l_orderkey, l_linenumber, cast(ts AS TIMESTAMP) AS ts FROM items", fx.DUCK_ITEMS))
def q_convert_timestamp(spark, sf_dir):
    return _typed(_items(spark, sf_dir, "ts"), [("ts", T.TimestampNTZType())])


@register("convert_date", with_logs(
    "SELECT l_orderkey, l_linenumber, cast(sd AS DATE) AS sd FROM items", fx.DUCK_ITEMS))
def q_convert_date(spark, sf_dir):
    return _typed(_items(spark, sf_dir, "sd"), [("sd", T.DateType())])


@register("convert_string", with_logs(
    "SELECT l_orderkey, l_linenumber, x, flag FROM items", fx.DUCK_ITEMS))
def q_convert_string(spark, sf_dir):
    return _typed(_items(spark, sf_dir, "x", "flag"), [("x", T.StringType()), ("flag", T.StringType())])


@register("null_in_non_nullable", with_logs(
    f"""SELECT l_orderkey, l_linenumber, x,
  CASE WHEN x IS NULL THEN '{null_message("x")}' END AS reason FROM items""",
    fx.DUCK_ITEMS))
def q_null_in_non_nullable(spark, sf_dir):
    """The non-nullable conversion of every row: its value, or the reason for
    which the strict form would fail the query."""
    it = _items(spark, sf_dir, "x")
    v = F.col("contents").getItem("x")
    return it.select("l_orderkey", "l_linenumber", *checked_not_null(v, T.StringType(), "x", "reason"))
