"""The log of a store's writes: what readers, streams and compaction agree on.

Every write is published by one entry of ``<store>/_manifest/log`` after its
data and index rows are written.  A reader opens the store at the newest entry
and reads exactly the folders live there, so it never sees a write by halves, and
a compaction (one entry that adds a folder and retires those it replaces) shows
either the old folders or the new one.

The control table has one row per (write, shard, day): the index row plus the
entry that added it and, if any, the one that retired it.  Every
``SNAPSHOT_EVERY`` entries it is written as a snapshot; opening a store reads the
newest snapshot and the index rows of the few writes after it, whatever the
number of writes and files.

Cursors are reserved before they are written: ``reserve`` claims the next range
in ``<store>/_manifest/cursors``; two writers that start from the same time get
different ranges, in the order of their claims.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwise.claims import ClaimLog
from shardwise.model import (
    INDEX_DIR, INDEX_SCHEMA, LOG_COLUMNS, STORE_SCHEMA, attach_index, literal_table, read_index, read_log_store,
    write_ids, write_index, write_log_store,
)
from shardwise.session import _file_system, path_exists

SNAPSHOT_EVERY = 16
COMPACT_PREFIX = "compact-"
UNIT = ["log_store", "dt", "write_id"]
ROW_SCHEMA = INDEX_SCHEMA + ", added bigint, removed bigint, vacuumed boolean"
ROW_COLUMNS = [c.split()[0] for c in ROW_SCHEMA.split(", ")]
_SAFE = re.compile(r"[A-Za-z0-9._-]+")


class ConflictError(RuntimeError):
    """Another writer retired what this one meant to replace."""


def entries(spark: SparkSession, path: str) -> ClaimLog:
    return ClaimLog(spark, f"{path}/_manifest/log")


def has_manifest(spark: SparkSession, path: str) -> bool:
    return entries(spark, path).last() >= 0


def check_write_id(write_id: str) -> str:
    if not _SAFE.fullmatch(write_id):
        raise ValueError(f"a write is named by letters, digits, '.', '_' and '-', not {write_id!r}")
    return write_id


# ---------------------------------------------------------------------------
# Publishing

def publish(spark: SparkSession, path: str, write_id: str, rows: int, replaces: list[tuple] = (), kind: str = "write") -> int:
    """Make a written write visible; returns its entry.  ``replaces`` lists the
    (store, day, write) it retires: they must still be live when the entry is
    made, else ``ConflictError``."""
    begin(spark, path)
    log = entries(spark, path)
    while True:
        head = log.last()
        if replaces:
            live = {tuple(r) for r in units(spark, path, head).select(*UNIT).collect()}  # one row per live folder
            lost = [u for u in replaces if u not in live]
            if lost:
                raise ConflictError(f"{len(lost)} of {len(replaces)} folders were replaced meanwhile")
        entry = {"kind": kind, "write_id": check_write_id(write_id), "rows": int(rows), "replaces": [[s, str(d), w] for s, d, w in replaces]}
        if log.claim(head + 1, entry):
            break
    if (head + 1) % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
        write_snapshot(spark, path, head + 1)
    return head + 1


def begin(spark: SparkSession, path: str) -> None:
    """Give a store its manifest before the first write into it: entry 0 holds
    the writes made before it had one (usually none)."""
    log = entries(spark, path)
    if log.last() >= 0:
        return
    found: set[str] = set()
    if path_exists(spark, path):
        found = write_ids(spark.read.schema(STORE_SCHEMA).parquet(path))
        have: set[str] = set()
        if path_exists(spark, f"{path}/{INDEX_DIR}"):
            have = write_ids(spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/{INDEX_DIR}"))
        for w in sorted(found - have):
            write_index(read_log_store(spark, path, [w]), path, w)
    log.claim(0, {"kind": "begin", "writes": sorted(found), "rows": len(found), "replaces": []})


# ---------------------------------------------------------------------------
# The control table

def snapshot_path(path: str, number: int) -> str:
    return f"{path}/_manifest/snapshots/{number:020d}"


def snapshots(spark: SparkSession, path: str) -> ClaimLog:
    return ClaimLog(spark, f"{path}/_manifest/made")


def newest_snapshot(spark: SparkSession, path: str, head: int) -> int:
    """Entry of the newest snapshot at or before ``head``, -1 without any."""
    made = snapshots(spark, path)
    at = made.last()
    while at >= 0:
        number = made.read(at)["entry"]
        if number <= head:
            return number
        at -= 1
    return -1


def control_rows(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """One row per (write, shard, day) as of entry ``head`` (the newest):
    the newest snapshot and the index rows of the writes published after it."""
    log = entries(spark, path)
    head = log.last() if head is None else head
    base = newest_snapshot(spark, path, head)
    tail = [(n, log.read(n)) for n in range(base + 1, head + 1)]
    parts = []
    if base >= 0:
        parts.append(spark.read.schema(ROW_SCHEMA).parquet(snapshot_path(path, base)))
    added = [(n, w) for n, e in tail if e["rows"] for w in e.get("writes", [e.get("write_id")])]
    if added:
        folders = [f"{path}/{INDEX_DIR}/write_id={w}" for _, w in added]
        rows = spark.read.schema(INDEX_SCHEMA).option("basePath", f"{path}/{INDEX_DIR}").parquet(*folders)
        named = literal_table(spark, [(w, n) for n, w in added], "write_id string, added bigint")
        rows = rows.join(named, "write_id").withColumns({"removed": F.lit(None).cast("bigint"), "vacuumed": F.lit(False)})
        parts.append(rows.select(*ROW_COLUMNS))
    if not parts:
        return literal_table(spark, [], ROW_SCHEMA)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    gone = [(s, d, w, n) for n, e in tail for s, d, w in e["replaces"]]
    if gone:
        gone = literal_table(spark, gone, "log_store string, _dt string, write_id string, _removed bigint").select(
            "log_store", F.to_date("_dt").alias("dt"), "write_id", "_removed")
        out = out.join(gone, UNIT, "left").withColumn("removed", F.coalesce("removed", "_removed")).select(*ROW_COLUMNS)
    for e in (e for _, e in tail if e["kind"] == "vacuum"):
        out = out.withColumn("vacuumed", F.col("vacuumed") | F.coalesce(F.col("removed") <= e["before"], F.lit(False)))
    return out


def write_snapshot(spark: SparkSession, path: str, number: int) -> None:
    control_rows(spark, path, number).coalesce(1).write.mode("overwrite").parquet(snapshot_path(path, number))
    made = snapshots(spark, path)
    while not made.claim(made.last() + 1, {"entry": number}):
        pass


def live(rows: DataFrame, head: int) -> DataFrame:
    return rows.where((F.col("added") <= head) & (F.col("removed").isNull() | (F.col("removed") > head)))


def units(spark: SparkSession, path: str, head: int) -> DataFrame:
    """Live folders as of an entry: (store, day, write) with their logs and
    first cursor."""
    return by_unit(live(control_rows(spark, path, head), head))


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*UNIT).agg(F.sum("n").alias("n"), F.min("min_cursor").alias("min_cursor"), F.max("max_time").alias("max_time"), F.max("vacuumed").alias("vacuumed"))


def folder(spark: SparkSession, store: str, dt, write_id: str) -> str:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"log_store={escape(store)}/dt={dt}/write_id={write_id}"


def read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The records of some folders of the store."""
    if not folders:
        return literal_table(spark, [], STORE_SCHEMA).select(*LOG_COLUMNS)
    return spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).select(*LOG_COLUMNS)


def store_index(rows: DataFrame) -> DataFrame:
    """One row per (shard, day)."""
    return rows.groupBy("log_project", "log_store", "shard", "dt").agg(
        F.sum("n").alias("n"), F.min("min_cursor").alias("min_cursor"), F.max("max_cursor").alias("max_cursor"),
        F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"))


def open_at(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """The store's records as of an entry (the newest), with their index."""
    head = entries(spark, path).last() if head is None else head
    rows = live(control_rows(spark, path, head), head)
    folders = [folder(spark, *r) for r in rows.select(*UNIT).distinct().collect()]  # one row per live folder
    return attach_index(read_folders(spark, path, sorted(folders)), store_index(rows))


def is_published(spark: SparkSession, path: str, write_id: str) -> bool:
    log = entries(spark, path)
    head = log.last()
    if head < 0:
        return False
    base = newest_snapshot(spark, path, head)
    tail = [log.read(n) for n in range(base + 1, head + 1)]
    if any(e.get("write_id") == write_id or write_id in e.get("writes", []) for e in tail):
        return True
    return base >= 0 and not spark.read.schema(ROW_SCHEMA).parquet(snapshot_path(path, base)).where(F.col("write_id") == write_id).isEmpty()


# ---------------------------------------------------------------------------
# Cursors

def reserve(spark: SparkSession, path: str, n: int, clock: Callable[[], int] = time.time_ns) -> int:
    """First of ``n`` cursors that no other write has or will get: now (ns), but
    after every range reserved before and every cursor the store holds."""
    log = ClaimLog(spark, f"{path}/_manifest/cursors")
    while True:
        at = log.last()
        if at >= 0:
            after = log.read(at)["end"]
        else:
            after = _stored_end(spark, path)
        base = max(int(clock()), after)
        if log.claim(at + 1, {"base": base, "end": base + max(1, int(n))}):
            return base


def _stored_end(spark: SparkSession, path: str) -> int:
    """One past the largest cursor of a store without reservations."""
    if not path_exists(spark, path):
        return 0
    rows = control_rows(spark, path) if has_manifest(spark, path) else read_index(spark, path)
    top = rows.agg(F.max("max_cursor")).first()[0]
    return 0 if top is None else int(top) + 1


# ---------------------------------------------------------------------------
# Compaction

def first_fit(sizes: list[int], target: int) -> list[list[int]]:
    """Places of ``sizes`` in groups of at most ``target`` together, each into
    the first group with room, the largest first; groups of one are left out."""
    groups: list[list] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for g in groups:
            if g[0] + sizes[i] <= target:
                g[0] += sizes[i]
                g[1].append(i)
                break
        else:
            groups.append([sizes[i], [i]])
    return [g[1] for g in groups if len(g[1]) > 1]


def compact(spark: SparkSession, path: str, target_rows: int = 2_000_000, most: int = 10_000) -> dict:
    """Rewrite small folders of a (store, day) as larger ones, published by one
    entry; at most ``most`` folders at a time.  The replaced folders stay until
    ``vacuum``, so readers that opened before go on.  Records keep their cursors
    and places; the rows of the control table are planned on the driver."""
    log = entries(spark, path)
    head = log.last()
    small = units(spark, path, head).where(F.col("n") < target_rows).orderBy(*UNIT).limit(most).collect()
    by_day: dict[tuple, list] = {}
    for r in small:
        by_day.setdefault((r["log_store"], r["dt"]), []).append(r)
    groups = [[rs[i] for i in g] for rs in by_day.values() for g in first_fit([r["n"] for r in rs], target_rows)]
    if not groups:
        return {"entry": head, "folders": 0, "writes": 0}
    # one write for each round of groups: a day that makes several gets several
    seen: dict[tuple, int] = {}
    rounds: dict[int, list] = {}
    for g in groups:
        k = seen.get((g[0]["log_store"], g[0]["dt"]), 0)
        seen[(g[0]["log_store"], g[0]["dt"])] = k + 1
        rounds.setdefault(k, []).extend(g)
    entry = head
    done = ClaimLog(spark, f"{path}/_manifest/compactions")
    while not done.claim(done.last() + 1, {"after": head}):  # before the first is published: see ``was_compacted``
        pass
    for rs in rounds.values():
        total = sum(r["n"] for r in rs)
        write_id = f"{COMPACT_PREFIX}{uuid.uuid4().hex}"
        records = read_folders(spark, path, [folder(spark, r["log_store"], r["dt"], r["write_id"]) for r in rs])
        write_log_store(records, path, write_id, rows=total, one_task=True)
        write_index(records, path, write_id)
        entry = publish(spark, path, write_id, total, [(r["log_store"], r["dt"], r["write_id"]) for r in rs], kind="compact")
    return {"entry": entry, "folders": sum(len(r) for r in rounds.values()), "writes": len(rounds)}


def was_compacted(spark: SparkSession, path: str) -> bool:
    return ClaimLog(spark, f"{path}/_manifest/compactions").last() >= 0


def vacuum(spark: SparkSession, path: str, before: int) -> int:
    """Delete the folders retired at or before entry ``before``; returns how
    many.  A reader opened, or a follower that still stands, before it can no
    longer read them (the follower is told so: their rows stay, marked)."""
    log = entries(spark, path)
    old = (F.col("removed") <= before) & ~F.col("vacuumed")
    gone = control_rows(spark, path).where(old).select(*UNIT).distinct().collect()  # one row per retired folder
    if not gone:
        return 0
    entry = {"kind": "vacuum", "write_id": "", "rows": 0, "replaces": [], "before": int(before)}
    while not log.claim(log.last() + 1, entry):
        pass
    fs = _file_system(spark, path)
    for r in gone:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder(spark, *r)}"), True)
    return len(gone)
