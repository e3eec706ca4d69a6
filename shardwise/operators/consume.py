"""Direct-style consumption: plan a capped batch per shard from the consumer
group's checkpoints, write it, then commit the batch's end cursors.

One call = one Spark job chain.  The driver only sees per-shard rows (the
plan); log rows go from the store scan to the output files.  Output is
written to a partition named by the batch id with dynamic partition
overwrite *before* the commit, so a crash between the two replays the same
batch into the same partition: no loss, no repeat.  The commits of a group are
numbered entries, each made by one consumer only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwise.claims import LEASE_SECONDS, ClaimLog, give_up_turn, take_turn
from shardwise.model import literal_table
from shardwise.functions.shape import b64_to_cursor, cursor_to_b64, with_json_record
from shardwise.plans.offsets import SHARD_KEY, checkpoint_key, shard_bounds, start_from_checkpoint
from shardwise.plans.ratelimit import batch_ranges, cap_records_per_shard
from shardwise.plans.shards import hold_back_children, skip_exhausted_shards
from shardwise.session import remove_path
from shardwise.sources.batch import start_positions

CHECKPOINT_SCHEMA = "consumer_group string, log_project string, log_store string, shard int, cursor_b64 string"


def plan_starts(spark: SparkSession, logs: DataFrame, shards: DataFrame, checkpoints: DataFrame,
                consumer_group: str, mode: str = "BEGIN_CURSOR", start_time: int | None = None) -> DataFrame:
    """(shard key, start_cursor, end_cursor) of shards that may give data now:
    checkpoint else the mode's initial cursor; exhausted read-only shards are left
    out, and so are shards made by a split until what they were split from is
    read to its end."""
    bounds = shard_bounds(logs)
    if mode == "BEGIN_CURSOR":
        initial = bounds.select(*SHARD_KEY, F.col("begin_cursor").alias("initial_cursor"))
    else:
        initial = start_positions(logs, mode, start_time).withColumnRenamed("cursor", "initial_cursor")
    st = start_from_checkpoint(shards, checkpoints, initial, consumer_group).select(
        *SHARD_KEY, b64_to_cursor(F.col("start_cursor_b64")).alias("start_cursor")
    )
    pos = st.join(bounds.select(*SHARD_KEY, "end_cursor"), SHARD_KEY)
    return skip_exhausted_shards(hold_back_children(pos, shards), shards)


def direct_batch(spark: SparkSession, logs: DataFrame, shards: DataFrame, checkpoints: DataFrame,
                 consumer_group: str, max_records_per_shard: int, mode: str = "BEGIN_CURSOR",
                 start_time: int | None = None, ignore_tags: bool = False) -> DataFrame:
    """The next batch: at most ``max_records_per_shard`` logs per shard from its
    start cursor, as JSON records with ``__shard__``."""
    starts = plan_starts(spark, logs, shards, checkpoints, consumer_group, mode, start_time)
    # the plan is one row per shard: fixed on the driver before the scan so
    # the batch query does not re-derive it in every branch
    rows = starts.select(*SHARD_KEY, "start_cursor").collect()
    capped = cap_records_per_shard(logs, max_records_per_shard, start_rows=rows)
    return with_json_record(capped, with_shard=True, ignore_tags=ignore_tags).select(*SHARD_KEY, "cursor", "record")


def commit_offsets(checkpoints: DataFrame, ranges: DataFrame, consumer_group: str) -> DataFrame:
    """Merge a batch's ``until_cursor`` per shard into the checkpoints; a
    smaller cursor never replaces a larger one; empty checkpoints count as
    no position."""
    key = ["consumer_group", *checkpoint_key(checkpoints)]
    old = checkpoints.where(F.col("cursor_b64") != "").select(*key, b64_to_cursor(F.col("cursor_b64")).alias("c"))
    new = ranges.withColumn("consumer_group", F.lit(consumer_group)).select(*key, F.col("until_cursor").alias("c"))
    empty = checkpoints.where(F.col("cursor_b64") == "").select(*key)
    merged = old.unionByName(new).groupBy(*key).agg(F.max("c").alias("c"))
    kept_empty = empty.join(merged, key, "left_anti").select(*key, F.lit("").alias("cursor_b64"))
    return merged.select(*key, cursor_to_b64(F.col("c")).alias("cursor_b64")).unionByName(kept_empty)


def _batch_id(consumer_group: str, number: int, attempt: int, starts_rows) -> str:
    key = ";".join(sorted(f"{r['log_project']}#{r['log_store']}:{r['shard']}:{r['start_cursor']}" for r in starts_rows))
    return hashlib.sha1(f"{consumer_group};{number};{attempt};{key}".encode()).hexdigest()[:16]


def commits_of(spark: SparkSession, checkpoint_path: str, consumer_group: str) -> ClaimLog:
    """The group's commits: entry n holds the positions after its nth batch."""
    name = hashlib.sha1(consumer_group.encode()).hexdigest()[:16]
    return ClaimLog(spark, f"{checkpoint_path.rstrip('/')}/group-{name}")


def positions(spark: SparkSession, checkpoint_path: str, consumer_group: str) -> DataFrame:
    """Checkpoints of a group: the newest commit, which names every shard that
    was ever read (one entry is read, however many batches there were)."""
    commits = commits_of(spark, checkpoint_path, consumer_group)
    newest = commits.read(commits.last())
    rows = [(consumer_group, *k, c) for *k, c in newest["positions"]] if newest else []
    ck = literal_table(spark, rows, "consumer_group string, log_project string, log_store string, shard int, cursor bigint")
    return ck.select("consumer_group", *SHARD_KEY, cursor_to_b64(F.col("cursor")).alias("cursor_b64"))


def committed_output(spark: SparkSession, checkpoint_path: str, output_path: str, consumer_group: str) -> DataFrame:
    """The group's records of committed batches only (what a consumer that
    died left behind is not among them)."""
    commits = commits_of(spark, checkpoint_path, consumer_group)
    ids = [commits.read(n)["batch_id"] for n in range(commits.last() + 1)]
    out = spark.read.parquet(output_path).where(F.col("consumer_group") == consumer_group)
    return out.join(literal_table(spark, [(i,) for i in ids], "batch_id string"), "batch_id", "left_semi")


def consume_once(spark: SparkSession, logs: DataFrame, shards: DataFrame, checkpoint_path: str,
                 output_path: str, consumer_group: str, max_records_per_shard: int,
                 mode: str = "BEGIN_CURSOR", fail_before_commit: bool = False, owner: str | None = None,
                 lease_seconds: float = LEASE_SECONDS) -> dict:
    """Plan, write and commit one batch of a consumer group.

    Several consumers may share a group: the next batch is prepared by one of
    them at a time (``take_turn``), and its commit is made once.  Output is
    partitioned by (group, batch id), so groups may share a folder; a batch that
    another consumer took over has an id of its own, and what the slower one
    wrote is removed."""
    commits = commits_of(spark, checkpoint_path, consumer_group)
    while True:
        number, attempt = take_turn(spark, commits, owner, lease_seconds)
        newest = commits.read(number - 1)
        known = {tuple(k): c for *k, c in newest["positions"]} if newest else {}
        starts = plan_starts(spark, logs, shards, positions(spark, checkpoint_path, consumer_group), consumer_group, mode)
        starts_rows = starts.collect()  # one row per shard: the plan
        if not starts_rows:
            give_up_turn(spark, commits, number, attempt)
            return {"batch_id": None, "records": 0}
        bid = _batch_id(consumer_group, number, attempt, starts_rows)
        capped = cap_records_per_shard(
            logs, max_records_per_shard, start_rows=[(*[r[k] for k in SHARD_KEY], r["start_cursor"]) for r in starts_rows])
        out = with_json_record(capped, with_shard=True).select(
            *SHARD_KEY, "cursor", "record", F.lit(consumer_group).alias("consumer_group"), F.lit(bid).alias("batch_id"))
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("consumer_group", "batch_id")
            .parquet(output_path)
        )
        if fail_before_commit:
            raise RuntimeError("simulated failure between output and commit")
        written = spark.read.schema(out.schema).parquet(output_path).where((F.col("consumer_group") == consumer_group) & (F.col("batch_id") == bid))
        ranges = batch_ranges(written).collect()  # one row per shard
        records = sum(r["records"] for r in ranges)
        if not records:
            give_up_turn(spark, commits, number, attempt)
            return {"batch_id": bid, "records": 0}
        for r in ranges:
            key = tuple(r[k] for k in SHARD_KEY)
            known[key] = max(known.get(key, r["until_cursor"]), r["until_cursor"])
        if commits.claim(number, {"batch_id": bid, "records": records, "positions": sorted([*k, c] for k, c in known.items())}):
            return {"batch_id": bid, "records": records}
        escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        # the other one's batch stands; the next turn is planned anew
        remove_path(spark, f"{output_path}/consumer_group={escape(consumer_group)}/batch_id={bid}")
