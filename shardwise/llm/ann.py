"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where the nearest by Euclidean distance is the
nearest by cosine.  Each of ``tables`` hashes is a vector of ``hashes`` slots
floor((a . x + b) / width) with Gaussian (2-stable) a.  A query visits its own
bucket and the ``probes`` - 1 perturbed ones that are most likely to hold near
vectors: perturbation sets over a query's slots, sorted by the distance to the
slot's border, in the order of their expected squared distances (a template
that is made once, so a query only maps ranks to its own slots).  The candidates
of all tables are merged and reranked by exact cosine in double precision.

``fit`` draws the hashes and sets their number and that of the probes: of a
ladder of both, the pair with which a bounded sample (``SAMPLE`` vectors chosen by
a hash of the vector, ``SAMPLE_QUERIES`` of them as queries) reaches the target
recall from the smallest share of candidates, so clustered vectors get narrow
buckets and few candidates.  Where no pair reaches it, every row is a candidate:
exact, never below the target.  A task sorts its rows by bucket and a query takes
the runs of the buckets it visits, so the work follows the candidates, not the
rows.  Every row is indexed.  Equal vectors form one class with their smallest ids, so
a very common vector is hashed and scored once.  The stated queries go in blocks
of ``BLOCK`` against all rows: a task hashes its rows, marks the rows in each
query's buckets and keeps the best few per query; only those are shuffled.

Defined results: vectors that are null, zero, hold null or non-finite components
or have another length than most of the sample take no part; an id that repeats
with an equal vector counts once, and a query excludes every row of its own id;
ties go to the smaller id, null ids last; fewer candidates give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardwise.llm.common import collect_bounded, hash_sample, materialise, ship

TABLES, HASHES, WIDTH = 24, 10, 2.0
TARGET = 0.97
MOST_PROBES = 1024
SAMPLE, SAMPLE_QUERIES = 4000, 100
BLOCK = 2000
ROWS = 32_768  # rows hashed at once in a task
HASH_LADDER = (8, HASHES, 14, 18)
VISITS = 200_000  # visited buckets whose rows are marked at once
CHUNK = 64  # queries in a matrix product
DENSE = 0.02  # share of candidates from which scores come from one matrix product


@dataclass
class Index:
    directions: np.ndarray  # dims x (tables * hashes)
    offsets: np.ndarray
    multipliers: np.ndarray  # turn slots into a bucket key, per table
    template: np.ndarray  # probes x 2 * hashes: ranks in each perturbation set
    width: float = WIDTH
    exact: bool = False  # every row is a candidate
    recall: float = 1.0  # on the sample
    share: float = 1.0  # of the sample's rows that are candidates of a query

    def slots(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots and positions inside them: rows x tables x hashes."""
        p = (x @ self.directions + self.offsets) / self.width
        s = np.floor(p)
        shape = (len(x), *self.multipliers.shape)
        return s.astype(np.int64).reshape(shape), (p - s).reshape(shape)

    def keys(self, x: np.ndarray) -> np.ndarray:
        return (self.slots(x)[0] * self.multipliers).sum(axis=2)

    def probe_keys(self, x: np.ndarray) -> np.ndarray:
        """Keys of the visited buckets: tables x rows x probes."""
        s, at = self.slots(x)
        m = s.shape[2]
        to_border = np.concatenate([at, 1 - at], axis=2)  # one slot down, one up
        order = np.argsort(to_border, axis=2, kind="stable")
        change = np.where(order < m, -1, 1) * np.take_along_axis(np.broadcast_to(self.multipliers, s.shape), order % m, axis=2)
        own = (s * self.multipliers).sum(axis=2)
        return np.stack([own[:, t, None] + change[:, t] @ self.template.T.astype(np.int64) for t in range(s.shape[1])])


def perturbations(hashes: int, probes: int) -> np.ndarray:
    """The likeliest ``probes`` perturbation sets (the empty one first) over the
    2 * hashes ranked borders.  Rank j and its mirror belong to one slot, which
    moves at most once."""
    n = 2 * hashes
    j = np.arange(1, n + 1)
    low = j * (j + 1) / (4 * (hashes + 1) * (hashes + 2))
    k = n + 1 - j
    high = 1 - k / (hashes + 1) + k * (k + 1) / (4 * (hashes + 1) * (hashes + 2))
    cost = np.where(j <= hashes, low, high)
    out = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, ranks = heapq.heappop(heap)
        if not any(n - 1 - r in ranks for r in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < n:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    table = np.zeros((len(out), n), dtype=np.int8)
    for i, ranks in enumerate(out):
        table[i, list(ranks)] = 1
    return table


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def candidates(index: Index, rows: np.ndarray, probed: np.ndarray) -> np.ndarray:
    """Boolean matrix queries x rows: does any table put the row into a bucket
    that the query visits?  A visited bucket is a run of the rows sorted by key;
    probes of empty buckets fall out at the first look-up."""
    out = np.zeros((probed.shape[1], len(rows)), dtype=bool)
    if index.exact:
        out[:] = True
        return out
    keys = index.keys(rows)
    for t in range(keys.shape[1]):
        order = np.argsort(keys[:, t], kind="stable")
        buckets, first, size = np.unique(keys[order, t], return_index=True, return_counts=True)
        at = np.minimum(np.searchsorted(buckets, probed[t]), len(buckets) - 1)
        q, p = np.nonzero(buckets[at] == probed[t])
        b = at[q, p]
        many = size[b]
        for lo in range(0, len(b), VISITS):  # runs of the visited buckets, one after the other
            own = slice(lo, lo + VISITS)
            run = np.repeat(first[b[own]] - np.cumsum(many[own]) + many[own], many[own]) + np.arange(many[own].sum())
            out[np.repeat(q[own], many[own]), order[run]] = True
    return out


def fit(sample: np.ndarray, k: int = 5, target: float = TARGET, tables: int = TABLES, hashes: int | tuple = HASH_LADDER, width: float = WIDTH, queries: int = SAMPLE_QUERIES, seed: int = 11) -> Index:
    """Hashes and probes for vectors like the sample's: the fewest candidates
    with which the target recall is reached there (measured against brute
    force); all rows where it is not."""
    ladder = (hashes,) if isinstance(hashes, int) else hashes
    if len(sample) < 2:
        return _draw(sample.shape[1], tables, ladder[0], width, seed)
    x = unit(sample)
    q = x[:queries]
    near = q @ x.T
    near[np.arange(len(q)), np.arange(len(q))] = -2
    truth = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    best = None
    for m in ladder:
        index = _draw(sample.shape[1], tables, m, width, seed)
        full, probes = index.template, 1
        while probes <= len(full):
            index.template = full[:probes]
            hit = candidates(index, x, index.probe_keys(q))
            index.recall, index.share = float(np.take_along_axis(hit, truth, axis=1).mean()), float(hit.mean())
            if index.recall >= target or probes == len(full):
                break
            probes = min(2 * probes, len(full))
        if index.recall >= target and (best is None or index.share < best.share):
            best = index
    if best is None:
        best = _draw(sample.shape[1], tables, ladder[0], width, seed)
        best.template, best.exact = best.template[:1], True
    return best


def _draw(dims: int, tables: int, hashes: int, width: float, seed: int) -> Index:
    rng = np.random.default_rng(seed)
    return Index(rng.normal(size=(dims, tables * hashes)), rng.uniform(0, width, tables * hashes), rng.integers(-(1 << 62), 1 << 62, size=(tables, hashes)) | 1, perturbations(hashes, MOST_PROBES), width)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _search_block(classes: DataFrame, index: Index, queries: np.ndarray, numbers: np.ndarray, keep: int) -> DataFrame:
    """(q, score, ids) with the best ``keep`` classes of every task and query."""
    ship(classes.sparkSession)
    shared = classes.sparkSession.sparkContext.broadcast((index, queries, numbers))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, queries, numbers = shared.value
        queries_unit, probed = unit(queries), None
        lengths = np.sqrt((queries * queries).sum(axis=1))
        best: list[list[tuple]] = [[] for _ in numbers]
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                flat = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                rows, ids = flat.reshape(part.num_rows, -1), part.column(1).to_pylist()
                if probed is None:
                    probed = index.probe_keys(queries_unit)
                rows_unit = unit(rows)
                hit = candidates(index, rows_unit, probed)
                length = np.sqrt((rows * rows).sum(axis=1))
                dense = hit.mean() > DENSE
                for i in range(len(numbers)):
                    if dense and i % CHUNK == 0:  # cosines but for rounding, to leave out what cannot be among the best
                        rough = queries_unit[i : i + CHUNK] @ rows_unit.T
                    at = np.flatnonzero(hit[i])
                    if not len(at):
                        continue
                    if dense and len(at) > keep:
                        near = rough[i % CHUNK, at]
                        at = at[near >= np.partition(near, len(at) - keep)[len(at) - keep] - 1e-9]
                    score = (rows[at] * queries[i]).sum(axis=1) / (length[at] * lengths[i])
                    if len(at) > keep:  # ties with the last one stay
                        few = score >= np.partition(score, len(score) - keep)[len(score) - keep]
                        at, score = at[few], score[few]
                    found = best[i] + [(-s, _first(ids[j]), ids[j]) for s, j in zip(score.tolist(), at.tolist(), strict=True)]
                    best[i] = sorted(found, key=lambda r: r[:2])[:keep]
        out = [(int(q), -r[0], r[2]) for q, rs in zip(numbers, best, strict=True) for r in rs]
        if out:
            q, s, ids = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(s, pa.float64()), pa.array(ids, pa.list_(pa.int64()))], names=["q", "score", "ids"])

    return classes.select("vector", "ids").mapInArrow(search, "q long, score double, ids array<long>")


def _first(ids: list) -> tuple:
    return (ids[0] is None, ids[0] or 0)


def search(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id_col, score): the ``k`` nearest found of each query
    row, other rows of the same id excluded."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("vector")))
    first = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    distinct = rows.groupBy("vector", "id").agg(F.max("asks").alias("asks"))
    few = distinct.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)  # enough besides the query's own
    made = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id"))).alias("s"))
    classes = materialise(made.select("vector", F.transform("s", lambda x: x["id"]).alias("ids")), "ann-classes")
    sample = collect_bounded(hash_sample(classes.select("vector"), F.col("vector"), SAMPLE), SAMPLE, "sample")
    sizes = [len(r["vector"]) for r in sample]
    schema = "query_id long, rank int, vec_id long, score double".replace("vec_id", id_col)
    if not sizes:
        return spark.createDataFrame([], schema)
    dims = max(sorted(set(sizes)), key=sizes.count)
    index = fit(np.array([r["vector"] for r in sample if len(r["vector"]) == dims]), k, target)
    classes = classes.where(F.size("vector") == dims)
    asked = distinct.where(F.col("asks") & (F.size("vector") == dims))
    numbered = materialise(asked.select("vector").distinct().select("vector", F.monotonically_increasing_id().alias("q")), "ann-queries")
    asked = materialise(asked.join(numbered, "vector").select(F.col("id").alias("query_id"), "q"), "ann-asked")

    found, batch = None, []

    def run(batch: list, found: DataFrame | None) -> DataFrame:
        part = _search_block(classes, index, np.array([r["vector"] for r in batch]), np.array([r["q"] for r in batch]), k + 1)
        return part if found is None else found.unionByName(part)

    for r in numbered.toLocalIterator():  # a block of the stated queries at a time
        batch.append(r)
        if len(batch) == block:
            found, batch = run(batch, found), []
    if batch:
        found = run(batch, found)
    if found is None:
        return spark.createDataFrame([], schema)
    order = [F.col("score").desc(), F.col("ids")[0].asc_nulls_last()]
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("r") <= k + 1)
    pairs = asked.join(top, "q").select("query_id", "score", F.explode("ids").alias(id_col)).where(~F.col(id_col).eqNullSafe(F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col).asc_nulls_last()))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
