"""Inputs shared by the registered queries: offset JSON of the fixture store,
the typed-conversion frame over ``lineitem`` and the DuckDB text of the same
derived tables (used by the oracle SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixture offsets (seconds; -2 earliest, -1 latest).
OFFSETS_START = '{"analytics#events":{"0":-2,"1":1704844800,"2":1704067200,"3":-2}}'
OFFSETS_END = '{"analytics#events":{"0":-1,"1":1705708800,"2":1705708800,"3":-1}}'
TWO_STORES = (
    '{"analytics#events":{"0":1704844800,"1":1704844801},'
    '"analytics#archive":{"5":1704844802}}'
)
DAY10 = 1704844800  # 2024-01-10 00:00:00
DAY20 = 1705708800  # 2024-01-20 00:00:00
SPLIT_KEY = "0f" + "0" * 30


def lineitem_items(lineitem: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Each lineitem row as a text map (the shape a log record has); ``x`` is
    null (a missing key) when the tax is zero.  ``keys`` limits the map to the
    entries a query reads (a map column cannot be pruned by the optimizer)."""
    s = lambda c: F.col(c).cast("string")
    entries = {
        "q": s("l_quantity"),
        "p": s("l_extendedprice"),
        "d": s("l_discount"),
        "x": F.when(F.col("l_tax") > 0, s("l_tax")),
        "sd": F.col("l_shipdate").cast("date").cast("string"),
        "ts": s("l_shipdate"),
        "ln": s("l_linenumber"),
        "ok": s("l_orderkey"),
        "comma": F.concat(
            s("l_linenumber"), F.lit(","),
            F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"), F.lit(".50"),
        ),
        "flag": F.when(F.col("l_returnflag") == "R", F.lit("TRUE")).otherwise(F.lit("false")),
    }
    args = []
    for k, v in entries.items():
        if keys is None or k in keys:
            args += [F.lit(k), v]
    return lineitem.select("l_orderkey", "l_linenumber", F.create_map(*args).alias("contents"))


# ---------------------------------------------------------------------------
# DuckDB text of the same derived tables.

DUCK_LOGS = """b AS (SELECT 'analytics' log_project, 'events' log_store, cast(user_id % 4 AS int) shard,
  epoch_us(ts) * 1000 "cursor", epoch_us(ts) // 1000000 cursor_time,
  date_trunc('second', ts) - to_seconds(event_id % 90) lt, epoch_us(ts) // 1000000 - event_id % 90 log_second, event_type topic, '10.0.0.' || cast(user_id % 4 AS varchar) source,
  event_id, user_id, value, props, cast(ts AS date) dt FROM events),
logs AS (SELECT log_project, log_store, shard, "cursor", cursor_time,
  min("cursor") OVER (PARTITION BY shard, topic, dt) group_cursor,
  cast(row_number() OVER (PARTITION BY shard, topic, dt ORDER BY event_id) - 1 AS int) log_index,
  lt log_time, log_second, topic, source, event_id, user_id,
  cast(event_id AS varchar) c_msg, cast(user_id AS varchar) c_user_id,
  cast(value AS varchar) c_value, props c_props,
  'host-' || cast(user_id % 8 AS varchar) t_hostname, dt FROM b),
bounds AS (SELECT log_project, log_store, shard, min(cursor_time) begin_time, min("cursor") begin_cursor,
  max(cursor_time) + 1 end_time, max("cursor") + 1 end_cursor FROM logs GROUP BY ALL),
shards AS (SELECT * FROM (VALUES
  ('analytics', 'events', 0, 'readwrite', '00000000000000000000000000000000', '40000000000000000000000000000000'),
  ('analytics', 'events', 1, 'readwrite', '40000000000000000000000000000000', '80000000000000000000000000000000'),
  ('analytics', 'events', 2, 'readonly', '80000000000000000000000000000000', 'c0000000000000000000000000000000'),
  ('analytics', 'events', 3, 'readwrite', 'c0000000000000000000000000000000', 'g')
  ) t(log_project, log_store, shard, status, hash_begin, hash_end)),
checkpoints AS (SELECT * FROM (VALUES ('g1', 0, 'MTcwNDg0NDgwMDAwMDAwMDAwMA=='), ('g1', 1, '')) t(consumer_group, shard, cursor_b64)
  UNION ALL SELECT 'g1', 2, to_base64(encode(cast(end_cursor AS varchar))) FROM bounds WHERE shard = 2)"""

# JSON of the string entries of a log in key order (tags sort before contents).
DUCK_STRINGS_JSON = (
    "json_object('__tag__:__hostname__', t_hostname, 'msg', c_msg, 'props', c_props, "
    "'user_id', c_user_id, 'value', c_value)"
)
DUCK_RECORD_STRINGS = (
    "json_object('__source__', source, '__tag__:__hostname__', t_hostname, '__topic__', topic, "
    "'msg', c_msg, 'props', c_props, 'user_id', c_user_id, 'value', c_value)"
)

DUCK_ITEMS = """items AS (SELECT l_orderkey, l_linenumber,
  cast(l_quantity AS varchar) q, cast(l_extendedprice AS varchar) p, cast(l_discount AS varchar) d,
  CASE WHEN l_tax > 0 THEN cast(l_tax AS varchar) END x,
  cast(cast(l_shipdate AS date) AS varchar) sd, cast(l_shipdate AS varchar) ts,
  cast(l_linenumber AS varchar) ln, cast(l_orderkey AS varchar) ok,
  cast(l_linenumber AS varchar) || ',' || lpad(cast(l_partkey % 1000 AS varchar), 3, '0') || '.50' comma,
  CASE WHEN l_returnflag = 'R' THEN 'TRUE' ELSE 'false' END flag FROM lineitem)"""


def with_logs(body: str, *extra: str) -> str:
    ctes = ",\n".join([DUCK_LOGS, *extra])
    return f"WITH {ctes}\n{body}"
