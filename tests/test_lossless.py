"""Inputs that once lost or repeated logs: tied cursors, two stores, line
separators in texts, many ranges, last nanoseconds, new shards, restarts,
crashes between data and index, replayed batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.functions import shape
from shardwise.functions.convert import convert
from shardwise.model import (
    LOG_COLUMNS, LOG_SCHEMA, attach_index, index_rows, literal_table, read_index, read_log_store, write_index, write_log_store,
)
from shardwise.operators import consume as co
from shardwise.operators import sink as sk
from shardwise.operators import trigger as tr
from shardwise.plans import offsets as off
from shardwise.plans import ratelimit as rl
from shardwise.plans import shards as sh
from shardwise.session import path_exists, scratch_dir
from shardwise.sources import batch as src
from shardwise.sources.reader import open_store, read_logs, read_stream
from shardwise.streaming.core import idempotent_writer, run_available_now

DAY = dt.date(2024, 1, 1)
BASE = 1_704_067_200 * 10**9  # 2024-01-01, ns


def make_logs(spark, rows):
    """rows: (store, shard, cursor, contents)."""
    out = []
    for i, (store, shard, cursor, contents) in enumerate(rows):
        second = cursor // 10**9
        day = dt.date(1970, 1, 1) + dt.timedelta(days=second // 86400)
        out.append(("p", shard, cursor, second, cursor, 0, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=second - 60),
                    "t", "src", i, contents, {"h": "x"}, store, day))
    return literal_table(spark, out, LOG_SCHEMA).select(*LOG_COLUMNS)


def put(spark, logs, path, write_id="w"):
    write_log_store(logs, path, write_id)
    write_index(logs, path, write_id)


def shard_map(spark, keys):
    rows = [("p", s, k, "readwrite", "0" * 32, "g") for s, k in keys]
    return literal_table(spark, rows, "log_project string, log_store string, shard int, status string, hash_begin string, hash_end string")


def test_consume_delivers_tied_cursors_of_two_stores_once(spark):
    rows = [(s, k, BASE + (i // 4) * 10 + (k * 86_400 * 10**9), {"m": f"{s}{k}{i}"}) for s in ("a", "b") for k in (0, 1) for i in range(12)]
    path, ck, out = (scratch_dir(spark, f"tied-{x}") for x in ("store", "ck", "out"))
    put(spark, make_logs(spark, rows), path)
    logs = open_store(spark, path)
    shards = shard_map(spark, [(s, k) for s in "ab" for k in (0, 1)])
    sizes = []
    for _ in range(12):
        r = co.consume_once(spark, logs, shards, ck, out, "g", 3)
        if not r["records"]:
            break
        sizes.append(r["records"])
    got = [r[0] for r in spark.read.parquet(out).select(F.get_json_object("record", "$.m")).collect()]
    assert sorted(got) == sorted(r[3]["m"] for r in rows)
    assert sizes == [16, 16, 16]  # a tie of 4 stays whole in each of the 4 shards


@pytest.mark.parametrize("sep", ["\u2028", "\u2029", "\u0085", "\n", "\r"])
def test_json_record_keeps_contents_with_line_separators(spark, sep):
    logs = make_logs(spark, [("s", 0, BASE, {"m": f"a{sep}b", "n": "1"})])
    for shard in (False, True):
        rec = shape.with_json_record(logs, "r", with_shard=shard).select(
            F.get_json_object("r", "$.m"), F.get_json_object("r", "$.n"), F.get_json_object("r", "$.__topic__"), F.get_json_object("r", "$.__time__")).first()
        assert tuple(rec) == (f"a{sep}b", "1", "t", str(BASE // 10**9 - 60))


@pytest.mark.parametrize("n", [40, 70])
def test_ranges_return_each_log_once(spark, n):
    logs = make_logs(spark, [("s", k, BASE + k, {"m": "x"}) for k in range(n)])
    ranges = [("p", "s", k, BASE // 10**9, BASE // 10**9 + 1) for k in range(n)]
    ranges += [ranges[0], ("p", "s", 0, BASE // 10**9 - 5, BASE // 10**9 + 9)]
    schema = "log_project string, log_store string, shard int, start_time bigint, end_time bigint"
    assert src.scan_range(logs, literal_table(spark, ranges, schema)).count() == n
    with pytest.raises(ValueError, match="lack a start or an end"):
        src.scan_range(logs, literal_table(spark, [("p", "s", 0, None, 5)], schema))


def test_last_nanosecond_of_a_second(spark):
    c = 1_704_067_200_999_999_900
    got = literal_table(spark, [(c,), (c + 100,), (0,), (-1,)], "c bigint").select(shape.time_at_cursor(F.col("c"))).collect()
    assert [r[0] for r in got] == [1_704_067_200, 1_704_067_201, 0, -1]
    day_end = (1_704_067_200 + 86_400) * 10**9 - 1
    logs = make_logs(spark, [("s", 0, day_end - 1, {"m": "a"}), ("s", 0, day_end, {"m": "b"}), ("s", 0, day_end + 1, {"m": "c"})])
    logs = attach_index(logs, index_rows(logs))
    start = [("p", "s", 0, day_end)]
    assert [r["cursor"] for r in rl.cap_records_per_shard(logs, 1, start_rows=start).collect()] == [day_end]


def test_cap_gives_a_large_tie_whole_and_bounds_idle_shards(spark):
    rows = [("s", 0, BASE, {"m": str(i)}) for i in range(9)] + [("s", 0, BASE + 5, {"m": "x"})] + [("s", 1, BASE + 7 * 10**9, {"m": "y"})]
    logs = make_logs(spark, rows)
    logs = attach_index(logs, index_rows(logs))
    assert rl.cap_records_per_shard(logs, 4).count() == 9 + 1
    assert rl.cap_records_per_shard(logs, 9).count() == 9 + 1
    assert rl.cap_records_per_shard(logs, 10).count() == 10 + 1


def test_stream_reads_new_shards_and_logs_that_came_while_stopped(spark):
    path, ck, out = (scratch_dir(spark, f"new-{x}") for x in ("store", "ck", "out"))

    def run():
        s = read_stream(spark, path, "latest", checkpoint=ck, records=True).select("shard", "cursor")
        run_available_now(s, ck, idempotent_writer(out))

    put(spark, make_logs(spark, [("s", 0, BASE, {"m": "0"})]), path, "a")
    run()
    put(spark, make_logs(spark, [("s", 0, BASE + 2 * 10**9 + i, {"m": "1"}) for i in range(5)]), path, "b")
    put(spark, make_logs(spark, [("s", 7, BASE - 50 * 10**9 + i, {"m": "2"}) for i in range(4)]), path, "c")
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("shard", "cursor").collect())
    assert got == [(0, BASE + 2 * 10**9 + i) for i in range(5)] + [(7, BASE - 50 * 10**9 + i) for i in range(4)]
    with pytest.raises(off.OffsetError, match="has no start offset"):
        read_stream(spark, path, '{"p#s":{"0":-2}}')
    with pytest.raises(off.OffsetError, match="is not in the store"):
        read_stream(spark, path, '{"p#s":{"0":-2,"7":-1,"9":-1}}')


def test_write_without_index_rows_is_still_read(spark):
    path = scratch_dir(spark, "crash")
    put(spark, make_logs(spark, [("s", 0, BASE + i, {"m": "x"}) for i in range(6)]), path, "one")
    write_log_store(make_logs(spark, [("s", 0, BASE + 10**10 + i, {"m": "y"}) for i in range(4)]), path, "two")  # crash here
    assert read_logs(spark, path).count() == 10
    assert sk.next_base_cursor(spark, path) > BASE + 10**10 + 3
    assert read_index(spark, path).agg(F.sum("n")).first()[0] == 10


def test_written_cursors_are_dense(spark):
    items = sk.to_log_items(spark.range(0, 2000, 1, 200).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")))
    path = scratch_dir(spark, "dense")
    assert sk.write_logs(items, path, "p", "s", n_shards=3) == {"rows": 2000, "written": 1714, "dropped": 286}
    lo, hi, n = read_log_store(spark, path).agg(F.min("cursor"), F.max("cursor"), F.count_distinct("cursor")).first()
    assert n == 1714 and hi - lo < 2000
    with pytest.raises(sk.SaveModeError):
        sk.write_logs(items, path, "p", "s", mode="errorifexists")


def test_replayed_stream_batch_adds_nothing(spark):
    path = scratch_dir(spark, "replay")
    sink = sk.log_store_sink(path, "p", "s", "q", n_shards=2)
    first, second = spark.range(50).select("id"), spark.range(50, 70).select("id")
    sink(first, 0)
    sink(second, 1)
    before = sorted(r[0] for r in read_log_store(spark, path).select("cursor").collect())
    sink(first, 0)
    sink(second, 1)
    assert sorted(r[0] for r in read_log_store(spark, path).select("cursor").collect()) == before
    assert read_logs(spark, path).count() == 70 and read_index(spark, path).agg(F.sum("n")).first()[0] == 70


def test_key_outside_the_map_fails_before_publishing(spark):
    items = sk.to_log_items(spark.range(3).select("id"), hash_key=F.lit("FFFF"))
    path = scratch_dir(spark, "nokey")
    half = literal_table(spark, [("p", "s", 0, "readwrite", "0" * 32, "8" + "0" * 31)], "log_project string, log_store string, shard int, status string, hash_begin string, hash_end string")
    with pytest.raises(Exception, match="no shard holds hash key"):
        sk.write_logs(items, path, "p", "s", shards=half)
    assert not path_exists(spark, path)
    keys = literal_table(spark, [("0a" * 16,), ("FF",), (None,), ("x",)], "hash_key string")
    assert [r[0] for r in sh.route_by_hash_key(keys, half, strict=False).orderBy("hash_key").select("routed_shard").collect()].count(None) == 3


@pytest.mark.parametrize("limit", [1, 100, rl.LONG_MAX])
def test_limited_triggers_cover_the_store_once(spark, limit):
    rows = [("s", i % 3, BASE + i * 7 * 10**9 // 2, {"m": str(i)}) for i in range(60)] + [("s", 9, BASE + 150 * 10**9, {"m": "new"})]
    logs = make_logs(spark, rows)
    logs = attach_index(logs, index_rows(logs))
    state, out = scratch_dir(spark, "trigger"), scratch_dir(spark, "trigger-out")
    sizes = []
    write = lambda df, t: idempotent_writer(out)(df.select("shard", "cursor"), t)
    for _ in range(100):
        r = tr.run_trigger(spark, logs, state, write, max_offsets=limit, look_ahead=100, width=20)
        if r is None:
            break
        sizes.append(r["logs"] or 0)  # unknown when caught up: no histogram is made
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("shard", "cursor").collect())
    assert got == sorted((r[1], r[2]) for r in rows)
    # a limit of 1 takes one bucket (20 seconds: 6 logs) at a time
    assert max(sizes) <= 7 and len(sizes) >= 9 if limit == 1 else len(sizes) <= 3


@pytest.mark.parametrize(("text", "kind"), [
    ("2024-01-01 garbage", T.DateType()), ("2024-01-01Tjunk", T.DateType()), ("2024-01-01T10:00:00+08:00", T.TimestampNTZType()),
    ("2024-01-01 10:00:00 nowhere", T.TimestampType()), ("10:00", T.TimestampType()),
])
def test_bad_dates_fail(spark, text, kind):
    with pytest.raises(Exception, match="cannot convert"):
        literal_table(spark, [(text,)], "v string").select(convert(F.col("v"), kind, "v")).collect()


@pytest.mark.parametrize("text", ['{"a#b":{"0":1}} x', '{"a#b":{"0":null}}', '{"a#b":{"0":1.5}}', '{"a":{"0":1}}', '{"a#b":{"x":1}}', "[]"])
def test_bad_offset_texts_fail(spark, text):
    with pytest.raises(Exception, match="Expected e.g."):
        off.parse_offsets_json(literal_table(spark, [(text,)], "offsets_json string")).collect()


def test_good_offset_texts(spark):
    text = ' { "a#b" : {"0": -2 , "12" :1704844800}, "a#c":{} } '
    rows = off.parse_offsets_json(literal_table(spark, [(text,)], "offsets_json string")).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "b", 0, -2), ("a", "b", 12, 1704844800)]


def test_cursor_at_time_reads_only_the_probed_days(spark):
    path = scratch_dir(spark, "probe")
    put(spark, make_logs(spark, [("s", 0, BASE + d * 86_400 * 10**9 + 5, {"m": "x"}) for d in (0, 1, 4, 9)]), path)
    logs = open_store(spark, path)
    day = BASE // 10**9
    probes = literal_table(spark, [("p", "s", 0, day + 86_400 * 2), ("p", "s", 0, day + 86_400), ("p", "s", 0, day + 86_400 * 30)],
                           "log_project string, log_store string, shard int, t bigint")
    found = src.cursor_at_time(logs, probes)
    got = {r["t"]: r["cursor"] for r in found.collect()}
    assert got == {day + 86_400 * 2: BASE + 4 * 86_400 * 10**9 + 5, day + 86_400: BASE + 86_400 * 10**9 + 5, day + 86_400 * 30: BASE + 9 * 86_400 * 10**9 + 6}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dt" in plan and "IN (" in plan


def test_a_changed_source_is_derived_anew(spark):
    from shardwise.model import log_store
    from tests.conftest import SF001

    folder = scratch_dir(spark, "source")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.limit(100).write.parquet(f"{folder}/events.parquet/part=1")
    first = log_store(spark, folder).count()
    events.limit(300).write.parquet(f"{folder}/events.parquet/part=2")
    assert (first, log_store(spark, folder).count()) == (100, 400)


@pytest.mark.parametrize("files", ["documents.parquet", "documents.parquet/part-{}.parquet", "documents.parquet/lang={}/part.parquet"])
def test_word_count_stream_reads_a_table_of_one_file_or_of_many(spark, tmp_path, files):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from shardwise.registry_stream import q_word_count_stream

    def put_texts(name, texts):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}), path)

    texts = ["a  b  ", "b \n ", None, "   ", "", "a b", "a b"]
    if "{}" in files:
        for i in range(3):
            put_texts(files.format(i), texts[i::3])
    else:
        put_texts(files, texts)
    put_texts("pages.parquet", ["not counted"])
    got = sorted(tuple(r) for r in q_word_count_stream(spark, str(tmp_path)).collect())
    assert got == [("", 1), ("\n", 1), ("a", 3), ("b", 4)]


def test_word_count_stream_without_words(spark, tmp_path):
    from shardwise.registry_stream import q_word_count_stream

    literal_table(spark, [(1, None), (2, " "), (3, "")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert q_word_count_stream(spark, str(tmp_path)).collect() == []
