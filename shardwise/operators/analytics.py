"""Relational work run on log records: word counts, top-k, length counts,
casts and record forwarding.  Each is a plain DataFrame expression so it
runs the same in batch and inside a streaming query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardwise.functions.shape import SHARD_FIELD, TIME_FIELD, sorted_json


def split_keep_trailing(text: Column, sep: str = " ") -> Column:
    """Split on one separator, keeping every empty token (Python ``str.split(sep)``)."""
    return F.split(text, sep, -1)


def split_drop_trailing(text: Column, sep: str = " ") -> Column:
    """Split on one separator, dropping trailing empty tokens (Java
    ``String.split``): ``"a b  "`` -> [a, b]; all-separator text -> []."""
    stripped = F.regexp_replace(text, f"(?:{_re(sep)})+$", "")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, sep, -1))
    )


def _re(s: str) -> str:
    import re

    return re.escape(s)


def word_count(df: DataFrame, text_col: str, java_split: bool = False) -> DataFrame:
    """(word, count) over whole texts; a partial aggregate before the shuffle."""
    toks = split_drop_trailing(F.col(text_col)) if java_split else split_keep_trailing(F.col(text_col))
    return df.select(F.explode(toks).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The k first rows by ``order`` (TakeOrderedAndProject: a bounded heap
    per task, k rows per task to the final merge)."""
    return df.orderBy(*order).limit(k)


def count_by_length(df: DataFrame, text_col: str) -> DataFrame:
    """Records per text length and the number of distinct lengths (the
    window runs over the aggregated lengths only)."""
    by_len = df.groupBy(F.length(text_col).alias("len")).agg(F.count(F.lit(1)).alias("records"))
    return by_len.withColumn("n_lengths", F.count(F.lit(1)).over(Window.partitionBy()))


def forward_records(df: DataFrame, record_col: str = "record") -> DataFrame:
    """JSON record -> new item: ``__shard__`` becomes the hash key, ``__time__``
    the log time, string entries are kept and numbers skipped.

    The record is parsed once into a string map; the keys whose JSON value is
    an unquoted number are found once per record.  Both are projected before
    the filter so its per-entry lambda only reads columns."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    parsed = df.select(
        F.from_json(F.col(record_col), "map<string,string>").alias("_raw"),
        F.regexp_extract_all(F.col(record_col), F.lit(r'"((?:[^"\\]|\\.)*)":-?[0-9]'), 1).alias("_numeric"),
    )
    kept = parsed.select(
        F.col("_raw").getItem(SHARD_FIELD).alias("hash_key"),
        F.timestamp_add("SECOND", F.col("_raw").getItem(TIME_FIELD).cast("bigint"), epoch).alias("log_time"),
        F.map_filter(
            "_raw", lambda k, v: ~k.isin(TIME_FIELD, SHARD_FIELD) & ~F.array_contains(F.col("_numeric"), k)
        ).alias("_strings"),
    )
    return kept.select("hash_key", "log_time", sorted_json(F.col("_strings")).alias("item"))


def bounded_self_join(df: DataFrame, key: str, time_col: str, id_col: str, bound_seconds: int) -> DataFrame:
    """Pairs (l, r) of the same ``key`` with ``l.t <= r.t <= l.t + bound``.

    The equi-key is (key, time bucket of width ``bound``): each left row is
    copied to its own bucket and the next one, each right row sits in one
    bucket, so every pair meets exactly once and a hot key is split over its
    time buckets instead of landing in one task (or one state partition when
    streaming).  ``time_col`` must be a TIMESTAMP."""
    b = F.floor(F.unix_seconds(F.col(time_col)) / F.lit(bound_seconds)).cast("bigint")
    left = df.select(
        F.col(key).alias("l_key"), F.col(id_col).alias(f"l_{id_col}"), F.col(time_col).alias("l_t"),
        F.explode(F.array(b, b + 1)).alias("l_bucket"),
    )
    right = df.select(
        F.col(key).alias("r_key"), F.col(id_col).alias(f"r_{id_col}"), F.col(time_col).alias("r_t"),
        b.alias("r_bucket"),
    )
    if df.isStreaming:
        left = left.withWatermark("l_t", f"{bound_seconds * 2} seconds")
        right = right.withWatermark("r_t", f"{bound_seconds * 2} seconds")
    cond = (
        (F.col("l_key") == F.col("r_key"))
        & (F.col("l_bucket") == F.col("r_bucket"))
        & (F.col("r_t") >= F.col("l_t"))
        & (F.col("r_t") <= F.col("l_t") + F.expr(f"make_dt_interval(0, 0, 0, {bound_seconds})"))
    )
    return left.join(right, cond).select(F.col("l_key").alias(key), f"l_{id_col}", f"r_{id_col}")
