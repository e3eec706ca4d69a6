"""Ranked lexical search over bit-sliced Bloom signatures.

``build`` turns documents into blocks.  A block holds documents of one size
class (distinct keys, by powers of two) and a bitmap per signature bit: row r
says which documents have bit r.  A document's keys are its terms, and for a
term that occurs 2, 4, 8, ... times one more key for each power reached; a key
sets ``HASHES`` bits.  The bits of a query term, taken together with AND, thus
overestimate which documents hold it and how often.

``search`` sums, per document and query, weight x saturation for the frequency
the bitmaps allow: an upper bound of the score, since weights are not negative,
the saturation grows with the frequency and the document's length is stored.
The ``first`` highest bounds of each query are scored exactly; the k-th best of
them is a score that k documents reach, so a document with a lower bound below
it is excluded by proof.  All others are scored exactly, and the k best remain.

Weights follow the corpus: the index holds each block's terms with document
counts, summed for the query terms.  Queries are handled in blocks of about
``block_terms`` terms, broadcast; every block of queries reads the index, not
the texts, and only texts of candidates are read again.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z lower-cased.  All arithmetic on scores is in 64-bit integers (the
weights are made in doubles and floored).

Defined results: null and empty texts have no terms and are never found; a
query without terms finds nothing; documents that repeat id and text are found
once per row and rows of equal id and score stand in the order of their texts'
hashes; repeated queries are ranked each by itself; ids may be null (last among
equal scores); other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardwise.llm.bytewords import TERMS, binary, slices, words
from shardwise.llm.common import collect_bounded, materialise, ship
from shardwise.llm.textvec import U, mix

HASHES = 5
BITS_A_KEY = 12  # bits of a signature for each key of the largest document of its class
BLOCK_DOCS = 1024
BLOCK_CELLS = 1 << 24  # bits of a block, about
SLICE_BYTES = 500_000
TOP = 10
FIRST = 20
BLOCK_TERMS = 200_000
MOST_QUERIES = 100_000
CELLS = 4_000_000  # (query term, document) bounds held at once

LEVELS = mix(np.arange(1, 65, dtype=U) * U(0x9E3779B97F4A7C15))
SEEDS = mix(np.arange(1, HASHES + 1, dtype=U))


def bit_rows(keys: np.ndarray, rows: int) -> np.ndarray:
    """keys x HASHES signature rows."""
    return (mix(keys[:, None] ^ SEEDS[None, :]) % U(rows)).astype(np.int64)


def level_keys(terms: np.ndarray, level: int) -> np.ndarray:
    return mix(terms + LEVELS[level]) if level else terms


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of a large binary array by text and term, and
    the number of terms of each text."""
    w = words(texts, TERMS)
    n = np.diff(w.bounds)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((w.hashes, doc))
    term, doc = w.hashes[order], doc[order]
    new = np.ones(len(term), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], term[at], np.diff(np.append(at, len(term))), n


class _Block:
    """Documents of one size class that wait to become a block."""

    def __init__(self):
        self.ids, self.marks, self.n, self.keys, self.terms, self.top = [], [], [], [], [], 0

    def row(self, rows: int) -> dict:
        docs = len(self.ids)
        bits = np.zeros((rows, docs), dtype=bool)
        for d, keys in enumerate(self.keys):
            bits[bit_rows(keys, rows).ravel(), d] = True
        terms, dfs = np.unique(np.concatenate(self.terms), return_counts=True)
        return {"ids": self.ids, "marks": self.marks, "n": self.n, "bits": rows, "top": self.top,
                "slices": np.packbits(bits, axis=1).tobytes(), "terms": terms.view(np.int64), "dfs": dfs}


def build(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents that have terms, written once: ids, marks (the
    texts' hashes), n (terms with repeats), bits, top (highest power of a
    frequency), slices (bits x documents), terms and dfs of each block."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{kind}>, marks array<long>, n array<long>, bits long, top int, slices binary, terms array<long>, dfs array<long>"
    names = ["ids", "marks", "n", "bits", "top", "slices", "terms", "dfs"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, _Block] = {}
        types = None

        def flush(size: int) -> pa.RecordBatch:
            r = waiting.pop(size).row(BITS_A_KEY << size)
            return pa.RecordBatch.from_arrays([pa.array([r[c]], t) for c, t in zip(names, types, strict=True)], names=names)

        for batch in batches:
            types = types or [pa.list_(batch.column(0).type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            ids, marks, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch.column(2))
            for a, b in slices(blobs, SLICE_BYTES):
                doc, term, tf, n = term_counts(blobs.slice(a, b - a))
                power = np.floor(np.log2(tf)).astype(np.int64)
                key_doc, key = [doc], [term]
                for level in range(1, int(power.max(initial=0)) + 1):
                    reached = power >= level
                    key_doc.append(doc[reached])
                    key.append(level_keys(term[reached], level))
                key_doc, key = np.concatenate(key_doc), np.concatenate(key)
                order = np.argsort(key_doc, kind="stable")
                key, count = key[order], np.bincount(key_doc, minlength=b - a)
                ends, term_ends = np.cumsum(count), np.cumsum(np.bincount(doc, minlength=b - a))
                tops = np.zeros(b - a, dtype=np.int64)
                np.maximum.at(tops, doc, power)
                for d in np.flatnonzero(n).tolist():
                    size = max(4, int(count[d] - 1).bit_length())
                    w = waiting.setdefault(size, _Block())
                    w.ids.append(ids[a + d])
                    w.marks.append(marks[a + d])
                    w.n.append(int(n[d]))
                    w.keys.append(key[ends[d] - count[d] : ends[d]])
                    w.terms.append(term[term_ends[d - 1] if d else 0 : term_ends[d]])
                    w.top = max(w.top, int(tops[d]))
                    if len(w.ids) >= min(BLOCK_DOCS, max(8, BLOCK_CELLS // (BITS_A_KEY << size))):
                        yield flush(size)
        for size in list(waiting):
            yield flush(size)

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    return materialise(rows.mapInArrow(index, schema), "search-index")


class Queries(NamedTuple):
    """A block of queries: query i has the terms of ``term`` (places in
    ``terms``) between bounds[i] and bounds[i + 1], ``repeat`` times each."""

    numbers: list[int]
    bounds: np.ndarray
    term: np.ndarray
    repeat: np.ndarray
    terms: np.ndarray  # distinct, sorted
    weights: np.ndarray  # int64, of terms
    docs: int  # N
    length: int  # L

    def damp(self, n: np.ndarray) -> np.ndarray:
        """The contract's m of documents of n terms."""
        return 25 + (75 * n * self.docs) // self.length

    def factor(self) -> np.ndarray:
        return self.weights[self.term] * self.repeat


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def frequencies(block: dict, terms: np.ndarray) -> np.ndarray:
    """terms x documents: the highest frequency that the bitmaps allow."""
    docs, rows = len(block["n"]), block["bits"]
    bits = np.frombuffer(block["slices"], dtype=np.uint8).reshape(rows, -1)
    out = np.zeros((len(terms), docs), dtype=np.int64)
    alive, power = np.arange(len(terms)), 1
    for level in range(block["top"] + 1):
        at = bit_rows(level_keys(terms[alive], level), rows)
        rowed = bits[at[:, 0]]
        for h in range(1, HASHES):
            rowed &= bits[at[:, h]]
        some = rowed.any(axis=1)
        alive, rowed = alive[some], rowed[some]
        if not len(alive):
            break
        has = np.unpackbits(rowed, axis=1, count=docs).astype(bool)
        here = out[alive]
        here[has & (here == power - 1)] = 2 * power - 1  # only where all lower powers are there
        out[alive] = here
        power *= 2
    return out


def bounds_of(block: dict, q: Queries) -> np.ndarray:
    """queries x documents: upper bounds of the scores (int64)."""
    tf = frequencies(block, q.terms)
    used = np.flatnonzero(tf.any(axis=1))
    m = q.damp(np.array(block["n"], dtype=np.int64))
    part = saturation(tf[used], m[None, :])
    place = np.full(len(q.terms), -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    take = np.flatnonzero(place[q.term] >= 0)
    owner = np.repeat(np.arange(len(q.numbers)), np.diff(q.bounds))[take]
    term, factor = place[q.term[take]], q.factor()[take]
    out = np.zeros((len(q.numbers), len(m)), dtype=np.int64)
    step = max(1, CELLS // max(1, len(m)))
    for lo in range(0, len(take), step):
        rows = part[term[lo : lo + step]] * factor[lo : lo + step, None]
        own = owner[lo : lo + step]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[first]] += np.add.reduceat(rows, first, axis=0)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _frequent(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each of the terms: a count per task, then a sum."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = shared.value, np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                have = batch.column(0)[i].values.to_numpy().view(U)
                at = np.minimum(np.searchsorted(wanted, have), len(wanted) - 1)
                hit = wanted[at] == have
                total[at[hit]] += batch.column(1)[i].values.to_numpy()[hit]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    rows = index.select("terms", "dfs").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(terms), dtype=np.int64)
    for r in collect_bounded(rows, len(terms), "query terms"):
        out[r["term"]] = r["df"]
    shared.unpersist()
    return out


def _best(index: DataFrame, shared, kind: str, first: int) -> DataFrame:
    """The ``first`` highest bounds of each query in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        held: list[list[tuple]] = [[] for _ in q.numbers]
        for block in _blocks(batches):
            bounds = bounds_of(block, q)
            for i, row in enumerate(bounds):
                top = np.argpartition(-row, first)[:first] if len(row) > first else np.arange(len(row))
                new = [(int(row[d]), block["marks"][d], block["ids"][d]) for d in top.tolist() if row[d] > 0]
                if new:
                    held[i] = sorted(held[i] + new, key=lambda t: -t[0])[:first]
        rows = [(n, *t) for n, ts in zip(q.numbers, held, strict=True) for t in ts]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["query", "bound", "mark", "id"])

    return index.select("ids", "marks", "n", "bits", "top", "slices").mapInArrow(run, f"query long, bound long, mark long, id {kind}")


def _possible(index: DataFrame, shared, bars: dict[int, int], kind: str) -> DataFrame:
    """All documents whose bound is positive and not below the query's bar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        bar = np.array([max(1, bars.get(n, 1)) for n in q.numbers], dtype=np.int64)
        numbers = np.array(q.numbers)
        for block in _blocks(batches):
            i, d = np.nonzero(bounds_of(block, q) >= bar[:, None])
            if len(i):
                ids, marks = pa.array(block["ids"]), pa.array(block["marks"])
                yield pa.RecordBatch.from_arrays([pa.array(numbers[i]), marks.take(pa.array(d)), ids.take(pa.array(d))], names=["query", "mark", "id"])

    return index.select("ids", "marks", "n", "bits", "top", "slices").mapInArrow(run, f"query long, mark long, id {kind}")


def _exact(docs: DataFrame, wanted: DataFrame, shared, kind: str) -> DataFrame:
    """(query, mark, id, score) of the wanted (query, mark, id), from the texts."""
    # at most one block of queries each; written, so that Spark knows the size and moves the texts only if it is large
    lists = materialise(wanted.groupBy("mark", "id").agg(F.collect_set("query").alias("queries")), "search-wanted")
    rows = docs.join(lists, (docs["_mark"] == lists["mark"]) & docs["_id"].eqNullSafe(lists["id"])).select("_id", "_mark", "queries", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        place, factor = {n: i for i, n in enumerate(q.numbers)}, q.factor()
        for batch in batches:
            blobs = binary(batch.column(3))
            for a, b in slices(blobs, SLICE_BYTES):
                doc, term, tf, n = term_counts(blobs.slice(a, b - a))
                ends, m = np.cumsum(np.bincount(doc, minlength=b - a)), q.damp(n.astype(np.int64))
                out = []
                for d, asked in enumerate(batch.column(2).slice(a, b - a).to_pylist()):
                    own = slice(int(ends[d - 1]) if d else 0, int(ends[d]))
                    at = np.minimum(np.searchsorted(q.terms, term[own]), len(q.terms) - 1)
                    hit = q.terms[at] == term[own]
                    part = np.zeros(len(q.terms), dtype=np.int64)
                    part[at[hit]] = saturation(tf[own][hit], m[d])
                    for number in asked:
                        i = place[number]
                        terms = slice(q.bounds[i], q.bounds[i + 1])
                        out.append((number, a + d, int((part[q.term[terms]] * factor[terms]).sum())))
                if out:
                    number, at, score = zip(*out, strict=True)
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(number), batch.column(1).take(at), batch.column(0).take(at), pa.array(score)], names=["query", "mark", "id", "score"])

    return rows.mapInArrow(run, f"query long, mark long, id {kind}, score long").where("score > 0")


def _query_terms(spark: SparkSession, queries: DataFrame, id_col: str, text: str) -> DataFrame:
    """number, item, terms, repeats, size of every query that has terms."""
    kind = queries.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = binary(batch.column(2))
            for a, b in slices(blobs, SLICE_BYTES):
                doc, term, tf, _ = term_counts(blobs.slice(a, b - a))
                starts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(starts, pa.array(v)) for v in (term.view(np.int64), tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *lists], names=["number", "item", "terms", "repeats"])

    numbered = queries.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("item"), F.coalesce(text, F.lit("")).alias("_text"))
    made = numbered.mapInArrow(run, f"number long, item {kind}, terms array<long>, repeats array<long>")
    return materialise(made.where(F.size("terms") > 0).withColumn("size", F.size("terms").cast("long")), "search-queries")


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text",
           k: int = TOP, first: int = FIRST, block_terms: int = BLOCK_TERMS, index: DataFrame | None = None) -> DataFrame:
    """query_id, rank (from 1), id_col and score of the k best documents of each
    query; ``index`` is that of ``build`` over the same documents."""
    spark = docs.sparkSession
    index = build(docs, id_col, text) if index is None else index
    asked = _query_terms(spark, queries, query_id, query_text)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    totals = index.agg(F.coalesce(F.sum(F.size("n")), F.lit(0)).alias("docs"), F.coalesce(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("length")).first()
    sums = asked.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("terms"), F.count("*").alias("queries")).first()
    parts = max(1, -(-sums["terms"] // block_terms), -(-sums["queries"] // (MOST_QUERIES // 2)))
    out = None
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "mark")
    for part in range(parts if totals["docs"] and sums["queries"] else 0):
        block = sorted(collect_bounded(asked.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == part).select("number", "terms", "repeats"), MOST_QUERIES, "queries of a block"))
        if not block:
            continue
        every = np.concatenate([np.array(r["terms"], dtype=np.int64) for r in block]).view(U)
        terms, term = np.unique(every, return_inverse=True)
        df = _frequent(index, terms)
        weights = np.array([math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
        weights[df == 0] = 0  # no document holds it, whatever the bitmaps say
        q = Queries([r["number"] for r in block], np.concatenate([[0], np.cumsum([len(r["terms"]) for r in block])]), term,
                    np.concatenate([np.array(r["repeats"], dtype=np.int64) for r in block]), terms, weights, totals["docs"], totals["length"])
        shared = spark.sparkContext.broadcast(q)
        highest = Window.partitionBy("query").orderBy(F.desc("bound"), "mark")
        heads = _best(index, shared, kind, max(first, k)).withColumn("_r", F.row_number().over(highest)).where(F.col("_r") <= max(first, k))
        tried = materialise(_exact(rows, heads.select("query", "mark", "id"), shared, kind), "search-first")
        worst = tried.withColumn("_r", F.row_number().over(order)).where(F.col("_r") == k).select("query", "score")
        bars = {r["query"]: r["score"] for r in collect_bounded(worst, len(block), "bars")}  # one number per query of the block
        found = _exact(rows, _possible(index, shared, bars, kind), shared, kind)
        found = materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "search-found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"query long, mark long, id {kind}, score long, rank int")
    named = asked.select(F.col("number").alias("query"), F.col("item").alias("_item"))
    return out.join(named, "query").select(F.col("_item").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
