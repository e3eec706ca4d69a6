"""Shard maps: routing by hash key, splits, exhausted read-only shards,
incremental batch planning and rollback detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardwise.plans.offsets import SHARD_KEY

# A map with overlapping ranges is joined by the leading digits of the key, as
# many as give each shard about one prefix, and broadcast up to this many rows.
BROADCAST_MAX_ROWS = 200_000
# Up to this many shards a map has few prefixes (16**2 and one per shard, at most).
SMALL_MAP = 256


def hash_key(col: str) -> F.Column:
    """Hash key of a record: md5 hex of the text of ``col``."""
    return F.md5(F.col(col).cast("string"))


def shard_prefixes(shards: DataFrame, digits: int) -> DataFrame:
    """Each shard's hash range exploded to the key prefixes it touches (at
    most 16**digits + #shards rows for ranges that do not overlap)."""
    begin_p = F.conv(F.substring("hash_begin", 1, digits), 16, 10).cast("int")
    end_head = F.substring("hash_end", 1, digits)
    end_rest_zero = F.substring("hash_end", digits + 1, 64).rlike("^0*$")
    end_p = (
        F.when(~F.col("hash_end").rlike("^[0-9a-f]+$"), F.lit(16**digits - 1))
        .when(end_rest_zero, F.conv(end_head, 16, 10).cast("int") - 1)
        .otherwise(F.conv(end_head, 16, 10).cast("int"))
    )
    return shards.select(
        "*", F.explode(F.sequence(begin_p, F.greatest(begin_p, end_p))).alias("_p")
    ).select(
        "*", F.lpad(F.lower(F.conv(F.col("_p").cast("string"), 10, 16)), digits, "0").alias("prefix")
    ).drop("_p")


def _disjoint(rows: list) -> bool:
    return all(a["hash_end"] <= b["hash_begin"] for a, b in zip(rows, rows[1:]))


def route_by_hash_key(records: DataFrame, shards: DataFrame, key_col: str = "hash_key",
                      writable_only: bool = False, strict: bool = True) -> DataFrame:
    """Attach the shard whose ``[hash_begin, hash_end)`` holds the key.

    The map (one row per shard) is sorted on the driver.  In a large map whose
    ranges do not overlap a record finds its shard by binary search in the sorted
    bounds, an expression of log2(#shards) comparisons: no join, no shuffle, and
    the same path for each record however many shards there are.  Small maps
    and overlapping ranges (a split parent beside its children) are joined by key
    prefix, which gives a record every shard that holds its key.  A key that no shard holds
    (also a null, short or upper-case one) fails the query; ``strict=False``
    leaves such records unrouted (``routed_shard`` null)."""
    m = shards.where(F.col("status") != "readonly") if writable_only else shards
    rows = sorted(m.select("shard", "hash_begin", "hash_end").collect(), key=lambda r: (r["hash_begin"], r["hash_end"]))
    if len(rows) > SMALL_MAP and _disjoint(rows):
        routed = records.withColumn("routed_shard", _search(F.col(key_col), rows))
    else:
        routed = _join_by_prefix(records, m, key_col, len(rows))
    if not strict:
        return routed
    missing = F.concat(F.lit("no shard holds hash key "), F.coalesce(F.col(key_col), F.lit("(null)")))
    return routed.withColumn("routed_shard", F.coalesce("routed_shard", F.raise_error(missing).cast("int")))


def _search(key, rows: list):
    """The shard of ``key`` among disjoint ranges in order: the last begin at or
    below the key, found by halving steps, if the key is below that range's end."""
    if not rows:
        return F.lit(None).cast("int")
    n, text = len(rows), lambda c: F.split(F.lit(",".join(str(r[c]) for r in rows)), ",")
    begins, steps = text("hash_begin"), F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s <= n) & (F.try_element_at(begins, F.least(p + s, F.lit(n))) <= key), p + s).otherwise(p))
    found = F.aggregate(F.array(at), F.lit(None).cast("int"), lambda _, p: F.when(
        (p > 0) & (key < F.try_element_at(text("hash_end"), F.greatest(p, F.lit(1)))), F.try_element_at(text("shard"), F.greatest(p, F.lit(1))).cast("int")))
    return F.when(key.rlike("^[0-9a-f]{2}"), found)  # as a prefix that the other way would find


def _join_by_prefix(records: DataFrame, shards: DataFrame, key_col: str, n: int) -> DataFrame:
    digits = max(2, min(6, (n.bit_length() + 3) // 4))
    pref = shard_prefixes(shards, digits).select(F.col("shard").alias("routed_shard"), "hash_begin", "hash_end", "prefix")
    if 16**digits + n <= BROADCAST_MAX_ROWS and pref.count() <= BROADCAST_MAX_ROWS:
        pref = F.broadcast(pref)
    r = records.withColumn("prefix", F.substring(F.col(key_col), 1, digits))
    in_range = (F.col(key_col) >= F.col("hash_begin")) & (F.col(key_col) < F.col("hash_end"))
    return r.join(pref, (r["prefix"] == pref["prefix"]) & in_range, "left").drop("prefix", "hash_begin", "hash_end")


def write_map(spark, shards: DataFrame) -> DataFrame:
    """Non-overlapping map for writes: writable shards, plus read-only shards
    whose range no writable shard overlaps (a split parent is covered by its
    children; an unsplit read-only shard still owns its range).  Built on the
    driver from the per-shard rows of the map."""
    from shardwise.model import literal_table

    rows = shards.collect()
    live = [r for r in rows if r["status"] != "readonly"]

    def covered(r):
        return any(w["hash_begin"] < r["hash_end"] and r["hash_begin"] < w["hash_end"] for w in live)

    keep = live + [r for r in rows if r["status"] == "readonly" and not covered(r)]
    return literal_table(spark, keep, shards.schema)


def split_shard(shards: DataFrame, shard_id: int, split_key: str) -> DataFrame:
    """Parent becomes read-only; two children with ids max+1 and max+2 take
    ``[begin, split)`` and ``[split, end)``."""
    store = Window.partitionBy("log_project", "log_store")
    kids = shards.withColumn("mx", F.max("shard").over(store)).where(F.col("shard") == shard_id)
    left = kids.select(
        "log_project", "log_store", (F.col("mx") + 1).cast("int").alias("shard"),
        F.lit("readwrite").alias("status"), "hash_begin", F.lit(split_key).alias("hash_end"),
    )
    right = kids.select(
        "log_project", "log_store", (F.col("mx") + 2).cast("int").alias("shard"),
        F.lit("readwrite").alias("status"), F.lit(split_key).alias("hash_begin"), "hash_end",
    )
    rest = shards.select(
        "log_project", "log_store", "shard",
        F.when(F.col("shard") == shard_id, F.lit("readonly")).otherwise(F.col("status")).alias("status"),
        "hash_begin", "hash_end",
    )
    return rest.unionByName(left).unionByName(right)


def skip_exhausted_shards(positions: DataFrame, shards: DataFrame) -> DataFrame:
    """Drop read-only shards whose start is at (or past) their end.

    ``positions`` has (shard key, ``start_cursor``, ``end_cursor``)."""
    # one pass over the positions (a shard missing from the map is kept)
    status = shards.select(*SHARD_KEY, F.col("status").alias("_status"))
    exhausted = (F.col("_status") == "readonly") & (F.col("start_cursor") >= F.col("end_cursor"))
    return positions.join(status, SHARD_KEY, "left").where(~F.coalesce(exhausted, F.lit(False))).drop("_status")


def shard_lineage(shards: DataFrame) -> list[tuple]:
    """(project, store, shard, ancestor) of every shard that came out of a split:
    read-only shards with a smaller id whose hash range holds the shard's.  Made
    on the driver from the map's rows (one per shard)."""
    by_store: dict[tuple, list] = {}
    for r in shards.collect():
        by_store.setdefault((r["log_project"], r["log_store"]), []).append(r)
    out = []
    for store, rows in by_store.items():
        # ranges nest or are apart: a walk by (begin, widest first, id) meets every holder of a range before it
        open_: list = []
        for r in sorted(rows, key=lambda r: (r["hash_begin"], _descending(r["hash_end"]), r["shard"])):
            open_ = [p for p in open_ if p["hash_end"] > r["hash_begin"]]
            out += [(*store, r["shard"], p["shard"]) for p in open_ if p["status"] == "readonly" and p["shard"] < r["shard"] and p["hash_end"] >= r["hash_end"]]
            open_.append(r)
    return out


def _descending(text: str) -> tuple:
    return tuple(-ord(c) for c in text)


def hold_back_children(positions: DataFrame, shards: DataFrame) -> DataFrame:
    """Positions without the shards that a split made while a shard they came
    from has logs left (``start_cursor`` below ``end_cursor``): a key's logs lie in
    the parent first, so its order is kept across the split."""
    from shardwise.model import literal_table

    lineage = shard_lineage(shards)
    if not lineage:
        return positions
    edges = literal_table(positions.sparkSession, lineage, "log_project string, log_store string, shard int, _ancestor int")
    busy = positions.where(F.col("start_cursor") < F.col("end_cursor")).select("log_project", "log_store", F.col("shard").alias("_ancestor"))
    held = edges.join(busy, ["log_project", "log_store", "_ancestor"]).select(*SHARD_KEY).distinct()
    return positions.join(held, SHARD_KEY, "left_anti")


def incremental_ranges(planned_ends: DataFrame, committed: DataFrame, earliest: DataFrame) -> DataFrame:
    """Ranges of one trigger: known shards from their committed end, new
    shards from their earliest; shards missing from the plan are dropped."""
    j = planned_ends.select(*SHARD_KEY, F.col("end_time")).join(
        committed.select(*SHARD_KEY, F.col("end_time").alias("committed_time")), SHARD_KEY, "left"
    ).join(earliest.select(*SHARD_KEY, "begin_time"), SHARD_KEY, "left")
    return j.select(
        *SHARD_KEY,
        F.coalesce("committed_time", "begin_time").alias("start_time"),
        "end_time",
        F.col("committed_time").isNull().alias("new_shard"),
    )


def detect_rollback(batches: DataFrame) -> DataFrame:
    """Flag batches whose start cursor lies below the previous batch's start
    in the same shard.  ``batches`` holds one row per (shard, batch_id)."""
    w = Window.partitionBy(*SHARD_KEY).orderBy("batch_id")
    prev = F.lag("start_cursor").over(w)
    return batches.withColumn("prev_start_cursor", prev).withColumn(
        "rolled_back", F.coalesce(prev > F.col("start_cursor"), F.lit(False))
    )
