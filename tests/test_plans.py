"""Plan shape of the data-path queries: pushdown and pruning reach the
Parquet scan, aggregates are partial before the shuffle, and no query pairs
rows by a nested loop or a cartesian product."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF01

# batch queries (defining them runs no stream)
BATCH = [
    "hourly_topic_rollup", "batch_scan_range", "time_range_scan", "time_range_slices", "cursor_at_time",
    "incremental_batch", "histogram", "rate_limit_cut", "cap_records_per_shard", "direct_stream_batch",
    "consumer_lag", "route_by_hash_key", "split_shard", "project_default", "project_schema",
    "project_json_record", "sequence_number", "key_precedence", "convert_decimal", "write_with_hash_key",
    "word_count_batch", "top_k_desc", "count_by_length", "transform_forward",
]


def _plan(spark, name):
    return entry.queries()[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loop_or_cartesian(spark, name):
    p = _plan(spark, name)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_range_scan_prunes_days_pushes_time_and_prunes_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan metadata
    try:
        p = _plan(spark, "batch_scan_range")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(dt" in p
    pushed = p[p.index("PushedFilters:"):].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(cursor_time" in pushed and "LessThan(cursor_time" in pushed
    schema = p[p.index("ReadSchema:"):].split("\n")[0]
    assert "tags" not in schema and "group_cursor" not in schema


def test_rollup_aggregates_partially_before_the_shuffle(spark):
    p = _plan(spark, "hourly_topic_rollup")
    assert "partial_count(1)" in p and "partial_sum(" in p
    assert p.index("Exchange hashpartitioning") < p.index("partial_count(1)")


def test_routing_is_a_broadcast_equi_join(spark):
    p = _plan(spark, "route_by_hash_key")
    assert "BroadcastHashJoin [prefix" in p


def test_cap_bounds_the_scan_with_an_idle_shard(spark, logs):
    """Three shards reach the cap and one does not: days after the last cut and
    the idle shard's end are still pruned."""
    from shardwise.plans import ratelimit as rl
    from shardwise.plans.offsets import SHARD_KEY, shard_bounds

    rows = shard_bounds(logs).collect()
    starts = [(*[r[k] for k in SHARD_KEY], r["end_cursor"] - 1 if r["shard"] == 2 else r["begin_cursor"]) for r in rows]
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = rl.cap_records_per_shard(logs, 50, start_rows=starts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = p[p.index("PartitionFilters:"):].split("PushedFilters")[0]
    assert "dt" in filters and ">=" in filters and "<=" in filters


def test_control_queries_read_the_index(spark):
    for name in ("earliest_offsets", "latest_offsets", "clamp_specific_offset", "resolve_sentinels", "start_from_checkpoint", "skip_exhausted_shards"):
        assert "FileScan parquet" in _plan(spark, name), name


def _behind(spark):
    """Three shards of thirty days; shard 0 is read from its first day on, the
    others from their last."""
    from tests.test_lossless import BASE, make_logs, put
    from shardwise.session import scratch_dir
    from shardwise.sources.reader import open_store

    path, day = scratch_dir(spark, "behind"), 86_400 * 10**9
    put(spark, make_logs(spark, [("s", k, BASE + d * day + k, {"m": "x"}) for d in range(30) for k in range(3)]), path)
    starts = {0: BASE // 10**9, 1: (BASE + 29 * day) // 10**9, 2: (BASE + 29 * day) // 10**9}
    return open_store(spark, path), starts, (BASE + 30 * day) // 10**9


def _filters(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return [x.split("PushedFilters")[0] for x in p.split("PartitionFilters:")[1:]], p


def test_a_shard_that_lags_does_not_widen_the_scan_of_the_others(spark):
    from shardwise.model import literal_table
    from shardwise.plans import ratelimit as rl
    from shardwise.sources.batch import scan_range

    logs, starts, end = _behind(spark)
    ranges = literal_table(spark, [("p", "s", k, t, t + 86_400 if k == 0 else end) for k, t in starts.items()],
                           "log_project string, log_store string, shard int, start_time bigint, end_time bigint")
    df = scan_range(logs, ranges)
    filters, plan = _filters(spark, df)
    # two groups of days, 2024-01-01 and 2024-01-30: the days between are no partition of the scan
    assert "2024-01-01" in filters[0] and "2024-01-30" in filters[0] and " OR " in filters[0]
    assert sorted((r["shard"], r["cursor_time"]) for r in df.collect()) == sorted(starts.items())
    assert "shard" in plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    capped = rl.cap_records_per_shard(logs, 2, start_rows=[("p", "s", k, t * 10**9) for k, t in starts.items()])
    assert " OR " in _filters(spark, capped)[0][0]
    assert capped.count() == 2 + 1 + 1


def test_interval_cover_holds_every_range_in_few_parts():
    import random

    from shardwise.sources.batch import interval_cover

    rnd = random.Random(5)
    for n in (0, 1, 7, 60, 3000):
        rows = [(rnd.randrange(50), a := rnd.randrange(10**6), a + rnd.randrange(0, 3000)) for _ in range(n)]
        parts = interval_cover(rows, 8)
        assert len(parts) <= 8
        for shard, lo, hi in rows:
            assert hi <= lo or any(p[0] <= lo and hi <= p[1] and shard in p[2] for p in parts)
    far = [(0, 0, 10)] + [(k, 1000, 1010) for k in range(1, 100)]
    assert sorted((lo, hi, len(s)) for lo, hi, s in interval_cover(far, 2)) == [(0, 10, 1), (1000, 1010, 99)]
    assert len(interval_cover([(k, 5, 9) for k in range(40)], 16)) == 1
