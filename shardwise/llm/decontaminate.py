"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An alignment (linear gaps, a row of the matrix at a time: the gap inside the row
is a running maximum) that reaches ``least`` of the item's own score has few
breaks, so it holds at least ``count`` of the item's ``k``-grams within a certain
number of words of the text (``needs_of``).  Leaving out ``count - HOLD`` of them,
``HOLD`` of those left are still held: so an item's seeds are its rarest k-grams,
all but the ``count - HOLD`` most frequent ones in the documents (absent ones count
as rarest), of that k from 1 to n whose seeds occur least often.  A first pass
counts the items' k-grams over all documents, a second one looks for the seeds
and aligns every place with ``HOLD`` of them in reach, unless too few of the words
around it are the item's.  So every pair that reaches ``least`` is reported, however the words
were substituted, inserted or dropped, and whatever other documents hold; the
counts decide only how many places are looked at.

The test items are what is sent to every task; they go in blocks of about
``block_words`` words (an item's block by its hash, from a written table), each
with its own two passes, so their size is bounded however large the benchmark is.
Seed tables hold no more entries than a block has words, times n.

Defined results: null and empty texts and items give no pairs; an item of fewer
than ``n`` words has one seed of all its words, looked for as such; equal documents and equal items
are each reported; null ids are carried over; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.llm.common import collect_bounded, materialise, ship, text_or_empty, text_slices
from shardwise.llm.textvec import SLICE_CHARS, U, Words, shingles, words

N = 3  # words in a seed, at most
LEAST = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
HOLD = 2  # rare seeds that every alignment holds, where it holds as many k-grams
BLOCK_WORDS = 500_000
FILTER_BITS = 22
HITS = 4_000_000  # of items' seeds in texts, handled at once in a task


class Items(NamedTuple):
    ids: list  # of each item
    words: list[np.ndarray]  # hashes of its words
    grams: np.ndarray  # distinct n-gram hashes of the block, sorted
    of: list[np.ndarray]  # positions in ``grams`` of each item's n-grams, by place
    n: int  # words in an n-gram


def items_of(rows: list[tuple], n: int) -> Items:
    w = words([t or "" for _, t in rows])
    g = shingles(w, n)
    grams = np.unique(g.hashes)
    split = lambda x: [x.hashes[a:b] for a, b in zip(x.bounds[:-1], x.bounds[1:], strict=True)]
    return Items([i for i, _ in rows], split(w), grams, [np.searchsorted(grams, x) for x in split(g)], n)


def bits_of(grams: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[grams >> U(64 - FILTER_BITS)] = True
    return bits


def found(hashes: np.ndarray, grams: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are in ``grams``, and where in ``grams``."""
    at = np.flatnonzero(bits[hashes >> U(64 - FILTER_BITS)])
    where = np.searchsorted(grams, hashes[at])
    ok = where < len(grams)
    ok[ok] = grams[where[ok]] == hashes[at[ok]]
    return at[ok], where[ok]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, start and end (exclusive) in the passage."""
    m = len(passage)
    steps = np.arange(m + 1) * GAP
    h = np.zeros(m + 1, dtype=np.int64)
    origin = np.arange(m + 1)  # where the alignment ending in a cell starts
    best = (0, 0, 0)
    for w in item:
        hit = np.where(passage == w, MATCH, MISMATCH)
        diagonal, above = h[:-1] + hit, h[1:] + GAP
        new = np.maximum(np.maximum(diagonal, above), 0)
        start = np.where(new == 0, np.arange(1, m + 1), np.where(diagonal >= above, origin[:-1], origin[1:]))
        row = np.concatenate([[0], new])
        from_left = np.maximum.accumulate(row - steps)  # score of the best cell to the left, gaps taken off later
        leader = np.maximum.accumulate(np.where(row - steps == from_left, np.arange(m + 1), 0))
        origin = np.concatenate([[0], start])[leader]
        h = from_left + steps
        j = int(h.argmax())
        if h[j] > best[0]:
            best = (int(h[j]), int(origin[j]), j)
    return best


def needs_of(size: int, k: int, least: float) -> tuple[int, int]:
    """(count, span) for an item of ``size`` words: an alignment that reaches
    ``least`` holds at least ``count`` of its k-grams and is at most ``span`` words
    of the text long.

    With m matches and b breaks (a mismatch or a gap, each costs 1) the score
    2m - b reaches c = 2 * least * size, so b <= 2m - c.  The matches lie in at
    most b + 1 runs, which hold m - (k - 1)(b + 1) k-grams or more: for k > 1
    fewest with m = size, for k = 1 with m = c / 2.  The span is m + b at most."""
    c = MATCH * least * size
    span = int((1 + MATCH) * size - c + 1e-6)
    if k == 1:
        return max(1, int(np.ceil(c / MATCH - 1e-6))), span
    return int(np.ceil(size - (k - 1) * (MATCH * size - c + 1) - 1e-6)), span


def needs(size: int, n: int, least: float) -> tuple[int, int, int]:
    """(k, count, span) with the largest k up to n whose count is above 0; an
    item of fewer than n words is one gram of all of them."""
    if size < n:
        return size, 1, size
    for k in range(n, 0, -1):
        count, span = needs_of(size, k, least)
        if count > 0:
            return k, count, span
    raise ValueError("an item of one word has a need")


class Seeds(NamedTuple):
    """Items by n-gram: those of gram g are item[start[g]:start[g + 1]]."""

    start: np.ndarray
    item: np.ndarray

    def part(self, r: int, parts: int) -> Seeds:
        keep = self.item % parts == r
        return Seeds(np.concatenate([[0], np.cumsum(keep)])[self.start], self.item[keep])


def seeds_of(items: Items, kept: list[np.ndarray] | None = None) -> Seeds:
    """The n-grams of every item, each once per item: all, or those ``kept``."""
    own = [np.unique(of) for of in items.of] if kept is None else kept
    gram, item = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
    order = np.argsort(gram, kind="stable")
    return Seeds(np.searchsorted(gram[order], np.arange(len(items.grams) + 1)), item[order])


def rarest(of: np.ndarray, frequency: np.ndarray, count: int, hold: int = HOLD) -> tuple[np.ndarray, int]:
    """An item's grams (of: by place) without the most frequent ones that take
    up ``count - hold`` places or fewer; how many of the rest an alignment holds."""
    grams, places = np.unique(of, return_counts=True)
    order = np.lexsort((grams, -frequency[grams]))
    gone = np.cumsum(places[order]) <= max(0, count - hold)
    # the first that does not fit ends it: what follows is rarer
    n = int(np.argmin(gone)) if not gone.all() else len(gone) - 1
    return np.sort(grams[order[n:]]), count - int(places[order[:n]].sum())


def _match(w: Words, bounds: np.ndarray, at: np.ndarray, where: np.ndarray, items: Items, seeds: Seeds, need: np.ndarray, least: float) -> Iterator[tuple]:
    """Items aligned with some texts: (text, (item, score, start, end, seeds)).
    ``at`` are the places of found n-grams in all texts, ``bounds`` the texts'
    first places."""
    sizes = np.diff(seeds.start)[where]
    if sizes.sum() > HITS:
        text = np.searchsorted(bounds, at, side="right") - 1
        if text[0] < text[-1]:  # halves of the texts, then parts of the items
            half = np.searchsorted(text, (text[0] + text[-1]) // 2, side="right")
            for own in (slice(0, half), slice(half, None)):
                yield from _match(w, bounds, at[own], where[own], items, seeds, need, least)
            return
        parts = int(min(-(-sizes.sum() // HITS) + 1, len(items.words)))
        if parts > 1 and len(np.unique(seeds.item)) > 1:
            for r in range(parts):
                yield from _match_items(w, bounds, at, where, items, seeds.part(r, parts), need, least)
            return
    yield from _match_items(w, bounds, at, where, items, seeds, need, least)


def _match_items(w: Words, bounds: np.ndarray, at: np.ndarray, where: np.ndarray, items: Items, seeds: Seeds, need: np.ndarray, least: float) -> Iterator[tuple]:
    sizes = np.diff(seeds.start)[where]
    place = np.repeat(at, sizes)
    item = seeds.item[np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(seeds.start[where], sizes)]
    order = np.lexsort((place, item))
    place, item = place[order], item[order]
    text = np.searchsorted(bounds, place, side="right") - 1
    count, span = need[item, 0], need[item, 1]
    last = np.arange(len(place)) + count - 1
    ok = last < len(place)
    last = np.where(ok, last, 0)
    ok &= (item[last] == item) & (text[last] == text) & (place[last] - place <= span - items.n)
    best: dict[tuple[int, int], tuple] = {}
    first = np.flatnonzero(ok)
    if not len(first):
        return
    apart = (np.diff(item[first]) != 0) | (np.diff(text[first]) != 0) | (np.diff(place[first]) > 2 * span[first][1:] + items.n)
    for group in np.split(first, np.flatnonzero(apart) + 1):
        i, t = int(item[group[0]]), int(text[group[0]])
        own, reach = items.words[i], int(span[group[0]])
        hashes = w.hashes[w.bounds[t] : w.bounds[t + 1]]
        lo = max(0, int(place[group[0]] - bounds[t]) - reach)
        hi = min(len(hashes), int(place[group[-1]] - bounds[t]) + reach + items.n)
        passage = hashes[lo:hi]
        same = np.concatenate([[0], np.cumsum(np.isin(passage, own))])
        # an alignment's matches all lie within some ``reach`` words
        near = min(reach, len(passage))
        if (same[near:] - same[: len(same) - near]).max() < least * len(own) - 1e-6:
            continue
        score, a, b = align(own, passage)
        if score >= least * MATCH * len(own) and score > best.get((t, i), (0,))[0]:
            mine = place[slice(*np.searchsorted(item, [i, i + 1]))] - bounds[t]
            hits = int(((mine >= lo + a) & (mine < lo + b)).sum())
            best[t, i] = (score, lo + a, lo + b, hits)
    for (t, i), (score, a, b, hits) in best.items():
        yield t, (i, score / (MATCH * len(items.words[i])), a, b, hits)


HIT = T.StructType([T.StructField(n, t) for n, t in (("item", T.LongType()), ("score", T.DoubleType()), ("start", T.LongType()), ("end", T.LongType()), ("seeds", T.LongType()))])
_HIT_ARROW = pa.list_(pa.struct([("item", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("seeds", pa.int64())]))


class Group(NamedTuple):
    """Items with seeds of one k; item i of it is number first + i of the block."""

    items: Items
    seeds: Seeds
    need: np.ndarray  # count and span of each item
    first: int


def frequencies(docs: DataFrame, text: str, tables: list[Items]) -> list[np.ndarray]:
    """Places in all documents of each table's grams: counts per task, then sums."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast([(t.n, t.grams) for t in tables])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [(n, grams, bits_of(grams), np.zeros(len(grams), dtype=np.int64)) for n, grams in shared.value]
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0), SLICE_CHARS):
                w = words(texts)
                for n, grams, bits, total in wanted:
                    _, where = found(shingles(w, n).hashes, grams, bits)
                    total += np.bincount(where, minlength=len(grams))
        for i, (*_, total) in enumerate(wanted):
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i)), pa.array(some), pa.array(total[some])], names=["table", "gram", "n"])

    rows = docs.select(text_or_empty(text).alias("_text")).mapInArrow(count, "table long, gram long, n long").groupBy("table", "gram").agg(F.sum("n").alias("n"))
    out = [np.zeros(len(t.grams), dtype=np.int64) for t in tables]
    for r in collect_bounded(rows, sum(len(t.grams) for t in tables), "grams of a block"):
        out[r["table"]][r["gram"]] = r["n"]
    shared.unpersist()
    return out


def seeded(docs: DataFrame, text: str, rows: list[tuple], n: int, least: float) -> tuple[list[Group], list]:
    """The items of a block by the k of their seeds, and the items' ids by number."""
    size = [len(words([t]).hashes) for _, t in rows]
    # items below n words are one gram; the others may choose among the k that have a need
    small: dict[int, list[int]] = {}
    for i, m in enumerate(size):
        if m < n:
            small.setdefault(m, []).append(i)
    choice = {k: [i for i, m in enumerate(size) if m >= n and needs_of(m, k, least)[0] > 0] for k in range(1, n + 1)}
    choice = {k: own for k, own in choice.items() if own}
    tables = {k: items_of([rows[i] for i in own], k) for k, own in choice.items()}
    counted = dict(zip(tables, frequencies(docs, text, list(tables.values())) if tables else [], strict=True))
    best: dict[int, tuple] = {}
    for k, own in choice.items():
        for place, i in enumerate(own):
            count, span = needs_of(size[i], k, least)
            kept, left = rarest(tables[k].of[place], counted[k], count)
            cost = int(counted[k][kept].sum())
            if i not in best or (cost, -k) < best[i][:2]:
                best[i] = (cost, -k, tables[k].grams[kept], left, span)
    groups, ids = [], []
    for k, own in sorted(small.items()):
        items = items_of([rows[i] for i in own], k)
        groups.append(Group(items, seeds_of(items), np.array([[1, k]] * len(own), dtype=np.int64), len(ids)))
        ids += [rows[i][0] for i in own]
    for k in choice:
        own = [i for i in choice[k] if best[i][1] == -k]
        if own:
            items = items_of([rows[i] for i in own], k)
            seeds = seeds_of(items, [np.searchsorted(items.grams, best[i][2]) for i in own])
            groups.append(Group(items, seeds, np.array([best[i][3:] for i in own], dtype=np.int64), len(ids)))
            ids += [rows[i][0] for i in own]
    return groups, ids


HIT = T.StructType([T.StructField(n, t) for n, t in (("item", T.LongType()), ("score", T.DoubleType()), ("start", T.LongType()), ("end", T.LongType()), ("seeds", T.LongType()))])
_HIT_ARROW = pa.list_(pa.struct([("item", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("seeds", pa.int64())]))


def mark(docs: DataFrame, groups: list[Group], text: str, out: str, least: float) -> DataFrame:
    """``docs`` with ``out``: an array of the block's items found in the text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(groups)

    @F.arrow_udf(T.ArrayType(HIT))
    def find(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # a group's grams that are seeds of some item: what is looked up in the texts
        wanted = []
        for g in shared.value:
            used = np.flatnonzero(np.diff(g.seeds.start))
            wanted.append((g, used, g.items.grams[used], bits_of(g.items.grams[used])))
        for column in it:
            rows: list[list[dict]] = []
            for a, b, texts in text_slices(column, SLICE_CHARS):
                w = words(texts)
                rows += [[] for _ in range(b - a)]
                for g, used, grams, bits in wanted:
                    s = shingles(w, g.items.n)
                    at, where = found(s.hashes, grams, bits)
                    if len(at):
                        for i, (item, *hit) in _match(w, s.bounds, at, used[where], g.items, g.seeds, g.need, least):
                            rows[a + i].append(dict(zip(("item", "score", "start", "end", "seeds"), (g.first + item, *hit), strict=True)))
            yield pa.array(rows, type=_HIT_ARROW)

    return docs.withColumn(out, find(text_or_empty(text)))


def blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple]]:
    """(id, text) of the items with words, in blocks of about ``block_words``
    words: an item's block follows from its number's hash."""
    ship(benchmark.sparkSession)
    kind = benchmark.schema[item_id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(words([t]).hashes) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], names=["number", "id", "text", "size"])

    rows = benchmark.select(F.monotonically_increasing_id().alias("number"), F.col(item_id).alias("id"), text_or_empty(text).alias("text"))
    rows = materialise(rows.mapInArrow(count, f"number long, id {kind}, text string, size long").where("size > 0"), "benchmark-items")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = -(-total // block_words)
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == part).select("number", "id", "text")
        got = sorted(collect_bounded(own, 4 * block_words + 1000, "items of a block"), key=lambda r: r["number"])
        if got:
            yield [(r["id"], r["text"]) for r in got]


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", n: int = N, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row and test item in it: doc_id, item_id, score (1:
    the whole item), first and end word of the passage, the item's seeds in it."""
    spark = docs.sparkSession
    id_type = benchmark.schema[item_id].dataType
    out = None
    for rows in blocks(benchmark, item_id, text, block_words):
        groups, numbers = seeded(docs, text, rows, n, least)
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], T.StructType([T.StructField("item", T.LongType()), T.StructField(item_id, id_type)]))
        hits = mark(docs.select(F.col(doc_id), F.col(text)), groups, text, "_hits", least).select(F.col(doc_id), F.explode("_hits").alias("_hit"))
        # the ids of one block, bounded by block_words
        part = hits.select(F.col(doc_id), "_hit.*").join(F.broadcast(ids), "item").select(doc_id, item_id, "score", F.col("start").alias("first_word"), F.col("end").alias("end_word"), "seeds")
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = T.StructType([docs.schema[doc_id], benchmark.schema[item_id], T.StructField("score", T.DoubleType()), *[T.StructField(c, T.LongType()) for c in ("first_word", "end_word", "seeds")]])
        out = spark.createDataFrame([], kind)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", n: int = N, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    source = benchmark.select(F.col(item_id), F.col(item_text).alias(text))
    out = docs
    for rows in blocks(source, item_id, text, block_words):
        groups, _ = seeded(docs, text, rows, n, least)
        out = mark(out, groups, text, "__hits", least).where(F.size("__hits") == 0).drop("__hits")
    return out
