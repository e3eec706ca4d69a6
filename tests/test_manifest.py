"""The manifest of a store and what stands on it: reservation of cursors,
publication, snapshots, compaction, followers, turns of consumers, gaps."""

import bisect
import datetime as dt
import random
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from shardwise import manifest as mf
from shardwise.claims import ClaimLog, give_up_turn, take_turn
from shardwise.model import attach_index, index_rows, literal_table, read_log_store, write_index, write_log_store
from shardwise.operators import analytics as an
from shardwise.operators import consume as co
from shardwise.operators import sink as sk
from shardwise.operators import trigger as tr
from shardwise.plans import offsets as off
from shardwise.plans import shards as sh
from shardwise.session import path_exists, scratch_dir
from shardwise.sources.reader import open_store, read_logs, read_stream
from shardwise.streaming.core import idempotent_writer, last_version, run_available_now
from shardwise.streaming.follow import follow, next_trigger
from tests.test_lossless import BASE, make_logs, put, shard_map

DAY_NS = 86_400 * 10**9


def published(spark, path, batches):
    """Stores each batch of (store, shard, cursor, contents) as one write."""
    for i, rows in enumerate(batches):
        mf.begin(spark, path)
        put(spark, make_logs(spark, rows), path, f"w{i}")
        mf.publish(spark, path, f"w{i}", len(rows))


def pairs_of(df):
    return sorted((r["shard"], r["cursor"]) for r in df.select("shard", "cursor").collect())


# --- claims ------------------------------------------------------------------

def test_one_of_many_claims_wins(spark):
    log = ClaimLog(spark, scratch_dir(spark, "claims"))
    assert log.last() == -1 and log.read(0) is None
    won = []

    def run(i):
        for n in range(20):
            if log.claim(n, {"by": i}):
                won.append((n, i))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in won) == list(range(20)) and log.last() == 19
    assert all(log.read(n) == {"by": i} for n, i in won)


def test_turns_pass_by_lease_and_by_giving_up(spark):
    log = ClaimLog(spark, scratch_dir(spark, "turns"))
    assert take_turn(spark, log, "a") == (0, 0) == take_turn(spark, log, "a")
    now = time.time()
    assert take_turn(spark, log, "b", lease_seconds=60, clock=lambda: now + 61) == (0, 1)
    give_up_turn(spark, log, 0, 1)
    assert take_turn(spark, log, "c", lease_seconds=60) == (0, 3)
    log.claim(0, {})
    assert take_turn(spark, log, "b") == (1, 0)


# --- cursors -----------------------------------------------------------------

def test_reserved_cursors_never_overlap_though_the_clock_stands_still(spark, monkeypatch):
    path = scratch_dir(spark, "reserve")
    monkeypatch.setattr(time, "time_ns", lambda: BASE)
    monkeypatch.setattr(mf, "reserve", lambda spark, path, n, clock=lambda: BASE, real=mf.reserve: real(spark, path, n, clock))
    monkeypatch.setattr(sk, "reserve", mf.reserve)
    failed = []

    def run(k):
        try:
            sk.write_logs(sk.to_log_items(spark.range(500).select(F.lit(k).alias("k"), "id")), path, "p", "s", n_shards=3)
        except Exception as ex:  # noqa: BLE001
            failed.append(ex)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    got = open_store(spark, path)
    assert got.count() == 1500 == got.select("shard", "cursor").distinct().count()
    assert got.select("group_cursor", "log_index").distinct().count() == 1500  # the sequence number's parts
    assert got.agg(F.min("cursor"), F.max("cursor")).first() == (BASE, BASE + 1499)


def test_a_new_write_starts_after_what_an_older_store_holds(spark):
    path = scratch_dir(spark, "legacy")
    ahead = time.time_ns() + 10**15
    put(spark, make_logs(spark, [("s", 0, ahead, {"m": "old"})]), path, "old")
    write_log_store(make_logs(spark, [("s", 0, ahead + 1, {"m": "no index"})]), path, "noindex")
    sk.write_logs(sk.to_log_items(spark.range(3).select("id")), path, "p", "s")
    logs = open_store(spark, path)
    assert mf.has_manifest(spark, path) and logs.count() == 5
    assert logs.where(F.col("cursor") > ahead + 1).count() == 3
    assert read_logs(spark, path).count() == 5


# --- publication and snapshots -------------------------------------------------

def test_a_write_that_was_not_published_is_not_seen(spark):
    path = scratch_dir(spark, "unpublished")
    sink = sk.log_store_sink(path, "p", "s", "w")
    sink(spark.range(5).select("id"), 0)
    records = make_logs(spark, [("s", 0, BASE, {"m": "x"})])
    write_log_store(records, path, "crashed")
    write_index(records, path, "crashed")
    assert read_logs(spark, path).count() == 5
    sink(spark.range(5).select("id"), 0)  # a replay
    sink(spark.range(7).select("id"), 1)
    assert read_logs(spark, path).count() == 12


def test_opening_reads_one_snapshot_and_the_tail(spark, monkeypatch):
    path = scratch_dir(spark, "snapshot")
    monkeypatch.setattr(mf, "SNAPSHOT_EVERY", 4)
    published(spark, path, [[("s", i % 2, BASE + i, {"m": str(i)})] for i in range(8)])
    head = mf.entries(spark, path).last()
    assert head == 8 and mf.newest_snapshot(spark, path, head) == 7
    rows = mf.control_rows(spark, path)
    files = sorted(re.sub(r".*?/(snapshots/\d+|_index/write_id=[^/]+)/.*", r"\1", f) for f in rows.inputFiles())
    assert files == ["_index/write_id=w7", f"snapshots/{7:020d}"]
    reads = []
    monkeypatch.setattr(ClaimLog, "exists", lambda self, n, real=ClaimLog.exists: reads.append(n) or real(self, n))
    assert pairs_of(mf.open_at(spark, path)) == [(i % 2, BASE + i) for i in (0, 2, 4, 6, 1, 3, 5, 7)]
    assert len(reads) <= 6  # a few existence checks, not one per write
    early = mf.open_at(spark, path, 3)
    assert pairs_of(early) == [(0, BASE), (0, BASE + 2), (1, BASE + 1)]
    assert sorted(r["end_cursor"] for r in off.shard_bounds(early).collect()) == [BASE + 2, BASE + 3]


def test_small_writes_leave_few_files_and_no_stage(spark):
    path = scratch_dir(spark, "files")
    staged = []
    for i in range(3):
        sk.write_logs(sk.to_log_items(spark.range(100).select("id")), path, "p", "s", n_shards=4)
    root = path.rsplit("/", 1)[0]
    staged = [s for s in __import__("os").listdir(root) if s.startswith("write-stage")]
    assert len(spark.read.parquet(path).inputFiles()) <= 6 and not staged


# --- compaction ----------------------------------------------------------------

def test_first_fit_groups():
    assert mf.first_fit([5, 5, 5], 10) == [[0, 1]]
    assert mf.first_fit([10, 3, 4, 3], 10) == [[2, 1, 3]]
    assert mf.first_fit([], 10) == [] == mf.first_fit([7], 10)


def test_fifty_micro_batches_are_compacted_while_they_are_read(spark):
    path = scratch_dir(spark, "fifty")
    rows = [("s", i % 3, BASE + i, {"m": str(i)}) for i in range(500)]
    published(spark, path, [rows[i : i + 10] for i in range(0, 500, 10)])
    before = open_store(spark, path)
    expected = sorted((r[1], r[2]) for r in rows)
    done = mf.compact(spark, path)
    assert done["folders"] == 50 and done["writes"] == 1
    after = open_store(spark, path)
    assert pairs_of(before) == expected == pairs_of(after)  # the old reader and the new one
    assert len(before.inputFiles()) == 50 and len(after.inputFiles()) <= 4
    assert sorted(after.select("group_cursor", "log_index").collect()) == sorted(before.select("group_cursor", "log_index").collect())
    assert mf.compact(spark, path)["folders"] == 0
    assert mf.vacuum(spark, path, done["entry"]) == 50 and mf.vacuum(spark, path, done["entry"]) == 0
    assert pairs_of(open_store(spark, path)) == expected
    assert len(spark.read.parquet(path).inputFiles()) <= 4
    sk.write_logs(sk.to_log_items(spark.range(4).select("id")), path, "p", "s")
    assert read_logs(spark, path).count() == 504
    with pytest.raises(off.OffsetError, match="follow"):
        read_stream(spark, path, "earliest")


def test_two_compactions_of_the_same_folders_conflict(spark):
    path = scratch_dir(spark, "conflict")
    published(spark, path, [[("s", 0, BASE + i, {"m": str(i)})] for i in range(4)])
    unit = [("s", dt.date(2024, 1, 1), f"w{i}") for i in range(2)]
    for name in ("one", "two"):
        write_log_store(mf.read_folders(spark, path, [mf.folder(spark, *u) for u in unit]), path, name)
        write_index(mf.read_folders(spark, path, [mf.folder(spark, *u) for u in unit]), path, name)
    mf.publish(spark, path, "one", 2, unit, kind="compact")
    with pytest.raises(mf.ConflictError):
        mf.publish(spark, path, "two", 2, unit, kind="compact")
    assert pairs_of(open_store(spark, path)) == [(0, BASE + i) for i in range(4)]


def test_several_days_and_stores_are_compacted_apart(spark):
    path = scratch_dir(spark, "days")
    rows = [(s, 0, BASE + d * DAY_NS + i, {"m": f"{s}{d}{i}"}) for s in "ab" for d in range(3) for i in range(6)]
    random.Random(1).shuffle(rows)
    published(spark, path, [rows[i : i + 6] for i in range(0, 36, 6)])
    before = sorted(r[0] for r in open_store(spark, path).select(F.col("contents")["m"]).collect())
    mf.compact(spark, path, target_rows=4)
    after = open_store(spark, path)
    assert sorted(r[0] for r in after.select(F.col("contents")["m"]).collect()) == before == sorted(r[3]["m"] for r in rows)
    assert after.groupBy("log_store", "dt").count().count() == 6


# --- followers -----------------------------------------------------------------

@pytest.mark.parametrize("limit", [1, 100, 2**63 - 1])
def test_limits_cover_the_store_once_in_cursor_order(spark, limit):
    path, ck, out = (scratch_dir(spark, f"limit-{x}") for x in ("store", "ck", "out"))
    batches = [[("s", k, BASE + d * DAY_NS + i * 10 + k, {"m": "x"}) for k in range(3) for i in range(10)] for d in (4, 0, 3, 1, 2)]
    published(spark, path, batches)  # days in no order
    ran = follow(spark, path, ck, lambda s: s.select("shard", "cursor"), idempotent_writer(out), "earliest", limit)
    got = spark.read.parquet(out)
    assert pairs_of(got) == sorted((r[1], r[2]) for b in batches for r in b)
    assert len(ran) == {1: 5, 100: 2}.get(limit, 1)
    assert all(s["logs"] < limit + 30 for s in ran)  # a folder of 30 may pass the limit
    spans = sorted((r["batch_id"], r["lo"], r["hi"]) for r in got.groupBy("batch_id").agg(F.min("cursor").alias("lo"), F.max("cursor").alias("hi")).collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_a_latest_follower_keeps_its_start(spark):
    path, ck, out = (scratch_dir(spark, f"latest-{x}") for x in ("store", "ck", "out"))
    sink = sk.log_store_sink(path, "p", "s", "w", n_shards=2)
    run = lambda: follow(spark, path, ck, lambda s: s.select("shard", "cursor"), idempotent_writer(out))
    sink(spark.range(20).select("id"), 0)
    assert run() == []
    sink(spark.range(50).select("id"), 1)  # while it is stopped
    run()
    assert spark.read.parquet(out).count() == 50
    sink(spark.range(5).select("id"), 2)
    run()
    assert run() == [] and spark.read.parquet(out).count() == 55


def test_a_trigger_that_was_cut_short_is_repeated(spark):
    path, ck, out = (scratch_dir(spark, f"cut-{x}") for x in ("store", "ck", "out"))
    published(spark, path, [[("s", 0, BASE + d * DAY_NS + i, {"m": "x"}) for i in range(5)] for d in range(4)])
    write, calls = idempotent_writer(out), []

    def fails_once(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        write(batch, batch_id)

    run = lambda: follow(spark, path, ck, lambda s: s.select("shard", "cursor"), fails_once, "earliest", 5)
    with pytest.raises(Exception, match="lost driver"):
        run()
    mf.compact(spark, path)
    run()
    assert pairs_of(spark.read.parquet(out)) == sorted((0, BASE + d * DAY_NS + i) for d in range(4) for i in range(5))


def test_a_follower_reads_what_a_compaction_replaced_but_not_what_was_vacuumed(spark):
    path, ck, out = (scratch_dir(spark, f"old-{x}") for x in ("store", "ck", "out"))
    published(spark, path, [[("s", 0, BASE, {"m": "x"})]])
    args = (spark, path, ck, lambda s: s.select("shard", "cursor"), idempotent_writer(out), "earliest", 2)
    follow(*args)
    for i in range(1, 7):
        mf.begin(spark, path)
        put(spark, make_logs(spark, [("s", 0, BASE + i, {"m": "x"})]), path, f"more{i}")
        mf.publish(spark, path, f"more{i}", 1)
    entry = mf.compact(spark, path)["entry"]
    follow(*args, triggers=1)
    assert pairs_of(spark.read.parquet(out)) == [(0, BASE + i) for i in range(3)]
    mf.vacuum(spark, path, entry)
    with pytest.raises(off.OffsetError, match="vacuumed"):
        follow(*args)
    fresh, fresh_ck = scratch_dir(spark, "fresh"), scratch_dir(spark, "fresh-ck")
    follow(spark, path, fresh_ck, lambda s: s.select("shard", "cursor"), idempotent_writer(fresh), "earliest")
    assert pairs_of(spark.read.parquet(fresh)) == [(0, BASE + i) for i in range(7)]


def test_a_follower_from_offsets(spark):
    path, ck, out = (scratch_dir(spark, f"offsets-{x}") for x in ("store", "ck", "out"))
    published(spark, path, [[("s", k, BASE + d * DAY_NS, {"m": "x"}) for k in (0, 1)] for d in range(3)])
    day = BASE // 10**9 + 86_400
    start = f'{{"p#s":{{"0":{day},"1":-1}}}}'
    run = lambda: follow(spark, path, ck, lambda s: s.select("shard", "cursor"), idempotent_writer(out), start)
    run()
    put(spark, make_logs(spark, [("s", k, BASE + 5 * DAY_NS, {"m": "x"}) for k in (1, 2)]), path, "late")
    mf.publish(spark, path, "late", 2)
    run()
    assert pairs_of(spark.read.parquet(out)) == sorted([(0, BASE + DAY_NS), (0, BASE + 2 * DAY_NS), (1, BASE + 5 * DAY_NS), (2, BASE + 5 * DAY_NS)])
    with pytest.raises(off.OffsetError, match="no start offset"):
        follow(spark, path, scratch_dir(spark, "bad"), lambda s: s, idempotent_writer(out), '{"p#s":{"0":-2}}')


def test_joins_and_windows_over_files_in_no_order(spark):
    """Five triggers over a store whose writes were published in shuffled order:
    equal to the batch results, though the watermark is an hour."""
    path = scratch_dir(spark, "shuffled")
    rows = [("s", i % 3, BASE + i * 4000 * 10**9, {"user_id": str(i % 2), "id": str(i)}) for i in range(0, 150)]
    rows += [("s", i % 3, BASE + i * 4000 * 10**9 + 600 * 10**9, {"user_id": str(i % 2), "id": str(1000 + i)}) for i in range(0, 150)]
    days = {}
    for r in rows:
        days.setdefault(r[2] // DAY_NS, []).append(r)
    batches = list(days.values())
    random.Random(3).shuffle(batches)
    published(spark, path, batches)
    shape = lambda s: s.select(F.col("contents")["user_id"].alias("user_id"), F.col("contents")["id"].alias("id"), F.col("log_time").cast("timestamp").alias("t"))
    join = lambda s: an.bounded_self_join(shape(s), "user_id", "t", "id", 1800)
    out = scratch_dir(spark, "shuffled-join")
    ran = follow(spark, path, scratch_dir(spark, "shuffled-ck"), join, idempotent_writer(out), "earliest", 40)
    assert len(ran) >= 5
    want = sorted(map(tuple, join(open_store(spark, path)).collect()))
    assert sorted(map(tuple, spark.read.parquet(out).drop("batch_id").collect())) == want and len(want) > 300

    def windows(s):
        s = shape(s)
        s = s.withWatermark("t", "100 seconds") if s.isStreaming else s
        return s.groupBy(F.window("t", "5 seconds").alias("w")).agg(F.count(F.lit(1)).alias("count"))

    out = scratch_dir(spark, "shuffled-windows")
    follow(spark, path, scratch_dir(spark, "shuffled-ck2"), windows, idempotent_writer(out), "earliest", 50, output_mode="update")
    got = last_version(spark.read.parquet(out), ["w"], ["count"])
    assert sorted(map(tuple, got.select("w.start", "count").collect())) == sorted(map(tuple, windows(open_store(spark, path)).select("w.start", "count").collect()))


def test_next_trigger_plans_from_index_rows(spark):
    path = scratch_dir(spark, "plan")
    published(spark, path, [[("s", 0, BASE + d * DAY_NS + i, {"m": "x"}) for i in range(d + 1)] for d in range(4)])
    step = next_trigger(spark, path, {"from": -1, "to": 4}, None, 3)
    assert step["logs"] == 3 and [f.split("/")[1] for f in step["folders"]] == ["dt=2024-01-01", "dt=2024-01-02"]
    step = next_trigger(spark, path, step, None, 10**9, max_folders=1)
    assert step["logs"] == 3 and len(step["folders"]) == 1
    assert next_trigger(spark, path, next_trigger(spark, path, step, None, 1), None, 1) is None


def test_a_moving_start_is_refused_after_the_store_grew(spark):
    path, ck, out = (scratch_dir(spark, f"moving-{x}") for x in ("store", "ck", "out"))
    put(spark, make_logs(spark, [("s", 0, BASE, {"m": "0"})]), path, "a")
    run = lambda: run_available_now(read_stream(spark, path, records=True).select("shard", "cursor"), ck, idempotent_writer(out))
    run()
    run()  # nothing came: the same start
    put(spark, make_logs(spark, [("s", 0, BASE + 2 * 10**9 + i, {"m": "1"}) for i in range(50)]), path, "b")
    with pytest.raises(off.OffsetError, match="checkpoint"):
        run()


# --- consumers -----------------------------------------------------------------

def test_two_groups_share_an_output_folder(spark):
    path, ck, out = (scratch_dir(spark, f"groups-{x}") for x in ("store", "ck", "out"))
    put(spark, make_logs(spark, [("s", k, BASE + i, {"m": f"{k}{i}"}) for k in (0, 1) for i in range(20)]), path)
    logs, shards = open_store(spark, path), shard_map(spark, [("s", 0), ("s", 1)])
    for group in ("g1", "g/2 ü"):
        while co.consume_once(spark, logs, shards, ck, out, group, 15)["records"]:
            pass
    assert spark.read.parquet(out).count() == 80
    for group in ("g1", "g/2 ü"):
        assert co.committed_output(spark, ck, out, group).select("shard", "cursor").distinct().count() == 40


def test_two_consumers_of_one_group_deliver_each_log_once(spark):
    path, ck, out = (scratch_dir(spark, f"pair-{x}") for x in ("store", "ck", "out"))
    put(spark, make_logs(spark, [("s", 0, BASE + i, {"m": str(i)}) for i in range(40)]), path)
    logs, shards, failed = open_store(spark, path), shard_map(spark, [("s", 0)]), []

    def run():
        try:
            while co.consume_once(spark, logs, shards, ck, out, "g", 8)["records"]:
                pass
        except Exception as ex:  # noqa: BLE001
            failed.append(ex)

    threads = [threading.Thread(target=run) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    assert pairs_of(spark.read.parquet(out)) == [(0, BASE + i) for i in range(40)]
    assert co.commits_of(spark, ck, "g").last() == 4


def test_a_batch_that_was_taken_over_is_delivered_once(spark):
    path, ck, out = (scratch_dir(spark, f"over-{x}") for x in ("store", "ck", "out"))
    put(spark, make_logs(spark, [("s", 0, BASE + i, {"m": str(i)}) for i in range(10)]), path)
    logs, shards = open_store(spark, path), shard_map(spark, [("s", 0)])
    with pytest.raises(RuntimeError, match="simulated"):
        co.consume_once(spark, logs, shards, ck, out, "g", 5, owner="dead", fail_before_commit=True)
    while co.consume_once(spark, logs, shards, ck, out, "g", 5, owner="alive", lease_seconds=0)["records"]:
        pass
    assert pairs_of(co.committed_output(spark, ck, out, "g")) == [(0, BASE + i) for i in range(10)]


def test_state_of_many_triggers_is_one_entry(spark):
    state = scratch_dir(spark, "thousand")
    commits = tr.commits_at(spark, state)
    for n in range(1000):
        commits.claim(n, {"ends": [["p", "s", k, n, n] for k in range(3)], "start": n, "end": n})
    read = []
    real = ClaimLog._text
    try:
        ClaimLog._text = lambda self, name: read.append(name) or real(self, name)
        ends = tr.committed_ends(spark, state).collect()
    finally:
        ClaimLog._text = real
    assert len(read) == 2 and sorted((r["shard"], r["end_time"]) for r in ends) == [(k, 999) for k in range(3)]


def test_a_gap_takes_no_trigger(spark):
    rows = [("s", 0, BASE, {"m": "a"}), ("s", 0, BASE + 30 * DAY_NS, {"m": "b"})]
    for logs in (make_logs(spark, rows), attach_index(make_logs(spark, rows), index_rows(make_logs(spark, rows)))):
        state, out, n = scratch_dir(spark, "gap"), scratch_dir(spark, "gap-out"), 0
        write = lambda df, t, out=out: idempotent_writer(out)(df.select("shard", "cursor"), t)
        while tr.run_trigger(spark, logs, state, write) is not None:
            n += 1
        assert n == 2 and pairs_of(spark.read.parquet(out)) == [(0, BASE), (0, BASE + 30 * DAY_NS)]


# --- shard maps ----------------------------------------------------------------

MAP = "log_project string, log_store string, shard int, status string, hash_begin string, hash_end string"


def even_map(spark, n):
    bound = lambda i: "g" if i == n else f"{i * 16**32 // n:032x}"
    rows = [("p", "s", i, "readwrite", bound(i), bound(i + 1)) for i in range(n)]
    random.Random(2).shuffle(rows)
    return rows, literal_table(spark, rows, MAP)


@pytest.mark.parametrize("n", [1, 300, 50_000])
def test_routing_by_search_equals_the_ranges(spark, n):
    rows, shards = even_map(spark, n)
    by_begin = sorted((r[4], r[2]) for r in rows)
    keys = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("hash_key"))
    edge = [b for b, _ in by_begin[:: max(1, n // 50)]] + ["0" * 32, "f" * 32]
    keys = keys.unionByName(literal_table(spark, [(k,) for k in edge], "hash_key string"))
    routed = sh.route_by_hash_key(keys, shards)
    begins = [b for b, _ in by_begin]
    assert all(r["routed_shard"] == by_begin[bisect.bisect_right(begins, r["hash_key"]) - 1][1] for r in routed.collect())
    if n > sh.SMALL_MAP:
        assert "Join" not in routed._jdf.queryExecution().executedPlan().toString()
    bad = literal_table(spark, [("FF",), (None,), ("zz",)], "hash_key string")
    assert [r[0] for r in sh.route_by_hash_key(bad, shards, strict=False).select("routed_shard").collect()] == [None] * 3


def test_routing_with_gaps_and_overlaps(spark):
    rows, _ = even_map(spark, 400)
    holes = literal_table(spark, [r for r in rows if r[2] % 3], MAP)
    keys = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("hash_key"))
    got = {r["hash_key"]: r["routed_shard"] for r in sh.route_by_hash_key(keys, holes, strict=False).collect()}
    own = sorted((r[4], r[5], r[2]) for r in rows)
    for k, shard in got.items():
        true = next(s for b, e, s in own if b <= k < e)
        assert shard == (true if true % 3 else None)
    over = literal_table(spark, [*rows, ("p", "s", 1000, "readonly", "0" * 32, "g")], MAP)
    both = sh.route_by_hash_key(keys, over).groupBy("hash_key").count().collect()
    assert all(r["count"] == 2 for r in both)


def test_children_wait_until_their_parent_is_read(spark):
    """A split in mid-consumption: per key the order is kept and each log comes
    once, though children's cursors may lie below the parent's end."""
    path, ck, out = (scratch_dir(spark, f"split-{x}") for x in ("store", "ck", "out"))
    whole = literal_table(spark, [("p", "s", 0, "readwrite", "0" * 32, "g"), ("p", "s", 1, "readwrite", "g", "h")], MAP)
    rows = [("s", 0, BASE + i, {"key": str(i % 4), "n": str(i)}) for i in range(30)]
    put(spark, make_logs(spark, rows), path, "a")
    co.consume_once(spark, open_store(spark, path), whole, ck, out, "g", 10)
    split = sh.split_shard(whole, 0, "8" + "0" * 31)
    assert sorted(sh.shard_lineage(split)) == [("p", "s", 2, 0), ("p", "s", 3, 0)]
    split = sh.split_shard(split, 2, "4" + "0" * 31)  # a child splits again
    assert sorted(sh.shard_lineage(split)) == [("p", "s", 2, 0), ("p", "s", 3, 0), ("p", "s", 4, 0), ("p", "s", 4, 2), ("p", "s", 5, 0), ("p", "s", 5, 2)]
    rows = [("s", 2 + i % 2, BASE + 100 + i, {"key": str(i % 4), "n": str(100 + i)}) for i in range(20)]
    rows += [("s", 4, BASE + 200 + i, {"key": "0", "n": str(200 + i)}) for i in range(5)]
    put(spark, make_logs(spark, rows), path, "b")
    order = []
    while True:
        r = co.consume_once(spark, open_store(spark, path), split, ck, out, "g", 10)
        if not r["records"]:
            break
        order.append(r["batch_id"])
    ids = [co.commits_of(spark, ck, "g").read(n)["batch_id"] for n in range(co.commits_of(spark, ck, "g").last() + 1)]
    got = spark.read.parquet(out).select("batch_id", "cursor", F.get_json_object("record", "$.key").alias("key"), F.get_json_object("record", "$.n").cast("int").alias("n")).collect()
    assert len(got) == 55 and len({r["n"] for r in got}) == 55
    for key in "0123":
        seen = [r["n"] for r in sorted((r for r in got if r["key"] == key), key=lambda r: (ids.index(r["batch_id"]), r["cursor"]))]
        assert seen == sorted(seen)
