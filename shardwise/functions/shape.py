"""Record shaping: log records -> JSON text or typed columns.

Key precedence when the same key appears in several places:

* default row and schema rows: later wins -- contents, then tags
  (``__tag__:<key>``), then metadata / sequence number;
* JSON records: time, topic, source (and shard) first, so contents win.

``map_concat`` refuses duplicate keys, so the losing map is filtered first
(``without_keys``); we never rely on ``spark.sql.mapKeyDedupPolicy``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.functions.convert import check_read_schema, convert

# Metadata field names and the tag prefix.
PROJECT_FIELD = "__logProject__"
STORE_FIELD = "__logStore__"
SHARD_FIELD = "__shard__"
TIME_FIELD = "__time__"
TOPIC_FIELD = "__topic__"
SOURCE_FIELD = "__source__"
VALUE_FIELD = "__value__"
SEQUENCE_FIELD = "__sequence_number__"
TAG_PREFIX = "__tag__:"

DEFAULT_FIELDS = [
    PROJECT_FIELD, STORE_FIELD, SHARD_FIELD, TIME_FIELD,
    TOPIC_FIELD, SOURCE_FIELD, VALUE_FIELD, SEQUENCE_FIELD,
]
DEFAULT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in DEFAULT_FIELDS])


def is_default_schema(schema: T.StructType | None) -> bool:
    """Exact equality with the eight-string default (no prefix/extension match)."""
    if schema is None:
        return True
    return [(f.name, f.dataType) for f in schema.fields] == [
        (f.name, f.dataType) for f in DEFAULT_SCHEMA.fields
    ]


# ---------------------------------------------------------------------------
# Map helpers

def without_keys(loser: Column, winner: Column) -> Column:
    return F.map_filter(loser, lambda k, v: ~F.array_contains(F.map_keys(winner), k))


def merge_later_wins(*maps: Column) -> Column:
    acc = maps[0]
    for m in maps[1:]:
        acc = F.map_concat(without_keys(acc, m), m)
    return acc


def drop_null_values(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: v.isNotNull())


def sorted_json(m: Column) -> Column:
    """JSON object text of a string map: keys sorted, null values left out."""
    clean = drop_null_values(m)
    return F.when(F.size(clean) == 0, F.lit("{}")).otherwise(
        F.to_json(F.map_from_entries(F.array_sort(F.map_entries(clean))))
    )


def prefixed_tags(tags: Column = None) -> Column:
    tags = F.col("tags") if tags is None else tags
    return F.transform_keys(tags, lambda k, v: F.concat(F.lit(TAG_PREFIX), k))


# ---------------------------------------------------------------------------
# Scalar pieces

def sequence_number() -> Column:
    """``<group cursor>-<index in group>``; both parts stored at write time."""
    return F.concat_ws("-", F.col("group_cursor").cast("string"), F.col("log_index").cast("string"))


def time_text() -> Column:
    """Arrival second as ``yyyy-MM-dd HH:mm:ss.0`` (the default row's text)."""
    return F.concat(F.date_format("log_time", "yyyy-MM-dd HH:mm:ss"), F.lit(".0"))


def log_epoch_seconds() -> Column:
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("log_time"))


def cursor_to_b64(c: Column) -> Column:
    """Cursor number -> base64 text of its decimal digits."""
    return F.base64(c.cast("string").cast("binary"))


def b64_to_cursor(c: Column) -> Column:
    """Base64 cursor text -> number (compared numerically, not as text)."""
    return F.decode(F.unbase64(c), "UTF-8").cast("bigint")


def time_at_cursor(c: Column) -> Column:
    """Arrival second of a cursor (cursors count nanoseconds)."""
    return whole_units(c, 1_000_000_000)


def whole_units(c: Column, unit: int) -> Column:
    """``floor(c / unit)`` of a BIGINT in integer arithmetic: nanosecond
    cursors are beyond what a double holds exactly."""
    u = F.lit(unit).cast("bigint")
    return F.call_function("div", c - F.pmod(c, u), u)


# ---------------------------------------------------------------------------
# Projections

def metadata_text(name: str) -> Column:
    return {
        PROJECT_FIELD: F.col("log_project"),
        STORE_FIELD: F.col("log_store"),
        SHARD_FIELD: F.col("shard").cast("string"),
        TIME_FIELD: time_text(),
        TOPIC_FIELD: F.col("topic"),
        SOURCE_FIELD: F.col("source"),
    }[name]


def default_columns(append_sequence_number: bool = False) -> list[Column]:
    """The eight STRING columns of a read without a schema.  ``__value__`` is
    the sorted JSON of contents and ``__tag__:`` keys (plus the sequence
    number when asked); the ``__sequence_number__`` column stays null."""
    parts = [F.col("contents"), prefixed_tags()]
    if append_sequence_number:
        parts.append(F.create_map(F.lit(SEQUENCE_FIELD), sequence_number()))
    value = sorted_json(merge_later_wins(*parts))
    return [
        F.col("log_project").alias(PROJECT_FIELD),
        F.col("log_store").alias(STORE_FIELD),
        F.col("shard").cast("string").alias(SHARD_FIELD),
        time_text().alias(TIME_FIELD),
        F.col("topic").alias(TOPIC_FIELD),
        F.col("source").alias(SOURCE_FIELD),
        value.alias(VALUE_FIELD),
        F.lit(None).cast("string").alias(SEQUENCE_FIELD),
    ]


def field_text(name: str) -> Column:
    """Text of one schema field: contents, overridden by a tag of that name,
    overridden by metadata / sequence number."""
    if name in (PROJECT_FIELD, STORE_FIELD, SHARD_FIELD, TIME_FIELD, TOPIC_FIELD, SOURCE_FIELD):
        return metadata_text(name)
    if name == SEQUENCE_FIELD:
        return sequence_number()
    from_contents = F.col("contents").getItem(name)
    if name.startswith(TAG_PREFIX):
        key = name[len(TAG_PREFIX):]
        return F.when(
            F.map_contains_key("tags", F.lit(key)), F.col("tags").getItem(key)
        ).otherwise(from_contents)
    return from_contents


def _typed_metadata(name: str, dtype: T.DataType) -> Column | None:
    """Metadata fields already typed in the store skip the text round trip."""
    if name == TIME_FIELD and isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.col("log_time").cast(dtype)
    if name == SHARD_FIELD and isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col("shard").cast(dtype)
    return None


def schema_columns(schema: T.StructType) -> list[Column]:
    """One typed column per schema field (missing keys -> null)."""
    check_read_schema(schema)
    out = []
    for f in schema.fields:
        direct = _typed_metadata(f.name, f.dataType)
        c = direct if direct is not None else convert(field_text(f.name), f.dataType, f.name, f.nullable)
        out.append(c.alias(f.name))
    return out


def project(logs, schema: T.StructType | None = None, append_sequence_number: bool = False):
    """Shape log records into the default row or a user schema."""
    if is_default_schema(schema):
        return logs.select(*default_columns(append_sequence_number))
    return logs.select(*schema_columns(schema))


def record_strings(ignore_tags: bool = False) -> Column:
    """String entries of a JSON record: topic and source, then contents, then
    ``__tag__:`` keys -- later entries win -- with null values left out."""
    meta = F.create_map(F.lit(TOPIC_FIELD), F.col("topic"), F.lit(SOURCE_FIELD), F.col("source"))
    parts = [meta, F.col("contents")] + ([] if ignore_tags else [prefixed_tags()])
    return drop_null_values(merge_later_wins(*parts))


def record_text(strings: Column, with_shard: bool = False) -> Column:
    """``{"__time__":N[,"__shard__":S],<sorted string entries>}``; a number is
    left out when a string entry has its key (the string wins)."""
    numbers = [(TIME_FIELD, log_epoch_seconds())]
    if with_shard:
        numbers.append((SHARD_FIELD, F.col("shard")))
    head = F.concat_ws(",", *[
        F.when(~F.map_contains_key(strings, F.lit(key)), F.concat(F.lit(f'"{key}":'), val.cast("string")))
        for key, val in numbers
    ])
    body = F.when(F.size(strings) == 0, F.lit("")).otherwise(
        _strip_braces(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(strings)))))
    )
    inner = F.concat_ws(",", F.when(head != "", head), F.when(body != "", body))
    return F.concat(F.lit("{"), inner, F.lit("}"))


def json_record(with_shard: bool = False, ignore_tags: bool = False) -> Column:
    """One JSON text per log as a single Column (see ``with_json_record`` for
    the cheaper two-step form)."""
    return record_text(record_strings(ignore_tags), with_shard)


def with_json_record(df, name: str = "record", with_shard: bool = False, ignore_tags: bool = False):
    """Add the JSON record as ``name``.  The input maps and the merged string
    map are projected first, so the per-entry lambdas read columns and the
    merged map is built once and read three times by the next projection (the
    optimizer keeps projections apart when an expensive expression is
    referenced more than once)."""
    tmp, tags, meta = "__record_strings__", "__record_tags__", "__record_meta__"
    staged = df.withColumn(tags, prefixed_tags()).withColumn(
        meta, F.create_map(F.lit(TOPIC_FIELD), F.col("topic"), F.lit(SOURCE_FIELD), F.col("source"))
    )
    parts = [F.col(meta), F.col("contents")] + ([] if ignore_tags else [F.col(tags)])
    return (
        staged.withColumn(tmp, drop_null_values(merge_later_wins(*parts)))
        .withColumn(name, record_text(F.col(tmp), with_shard))
        .drop(tmp, tags, meta)
    )


def _strip_braces(j: Column) -> Column:
    # by position: a pattern's dot would stop at line separators inside the text
    return F.substring(j, F.lit(2), F.length(j) - 2)
