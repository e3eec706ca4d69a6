"""Periodic runs of words, found by online dyadic square catching.

Over the words of a text, every completed block of ``2**k`` words at a multiple
of its size has a catcher for the periods q with ``2**k <= q < 2**(k + 1)``: it
compares itself with the suffix of its own size after each appended word, for
one such block's length, so a word advances one comparison of each size.  A
suffix that equals the block, q words after it, is a square in the making; its
extent is found by comparing further dyadic blocks to both sides.  A run of
period q and at least three periods holds two periods of words that equal those
q further on, hence a whole block, so none is missed.  Blocks that follow one
another with the same q belong to one run and are extended once; a catch inside
a run of a smaller period is that run again and is dropped.  So a text of n
words costs about n log n comparisons, however repetitive it is.

The comparisons are numpy operations over all words of a slice of texts: the
catchers of one size advance together.  Memory is 8 log2(n) bytes a word of the
longest text.

A run is a stretch of words whose smallest period is q, of ``least`` words and
``times`` periods or more, that neither neighbour extends.  Collapsing keeps the
words outside runs and the first period of every run.

Defined results: a null or empty text has no runs and collapses to the empty
text; words are separated by blanks (0x20, 0x09 to 0x0D) and compared as they
are; repeated rows give repeated results; only the id column is carried over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardwise.llm.bytewords import PLAIN, binary, slices, words
from shardwise.llm.common import ship
from shardwise.llm.textvec import P, U, mix

LEAST = 24
TIMES = 3
SLICE_BYTES = 500_000
RESULT = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _tables(hashes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Entry k: hashes of the ``2**k`` words from each place (those that leave
    their text are never asked for)."""
    out = [hashes]
    while 2 << (len(out) - 1) <= longest:
        half, prev = 1 << (len(out) - 1), out[-1]
        both = np.zeros_like(prev)
        both[:-half] = mix(prev[:-half] * P + prev[half:])
        out.append(both)
    return out


def _forward(tables: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words from a equal those from b, up to ``end`` (of b)."""
    a, b, start = a.copy(), b.copy(), b
    for k in reversed(range(len(tables))):
        fit = np.flatnonzero(b + (1 << k) <= end)
        same = fit[tables[k][a[fit]] == tables[k][b[fit]]]
        a[same] += 1 << k
        b[same] += 1 << k
    return b - start


def _backward(tables: list[np.ndarray], a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many words before a equal those before b, down to ``begin`` (of a)."""
    a, b, start = a.copy(), b.copy(), a
    for k in reversed(range(len(tables))):
        fit = np.flatnonzero(a - (1 << k) >= begin)
        same = fit[tables[k][a[fit] - (1 << k)] == tables[k][b[fit] - (1 << k)]]
        a[same] -= 1 << k
        b[same] -= 1 << k
    return start - a


def runs_of(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs of texts
    whose words stand one after the other; starts count over all of them."""
    if times < 3:
        raise ValueError("a run has three periods at least")
    size = np.diff(bounds)
    n, longest = len(hashes), int(size.max(initial=0))
    found = np.zeros((0, 3), dtype=np.int64)
    if longest < max(least, times):
        return found
    begin, end = np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size)
    here = np.arange(n)
    place, left = here - begin, end - here
    tables = _tables(hashes, longest)
    reach = np.zeros(n, dtype=np.int64)  # the end of the known runs that start here or before
    k = 0
    while times << k <= longest:
        block = 1 << k
        caught = (place >= block) & (left >= block)
        period = (place & (block - 1)) + block
        source = here - period
        at = np.flatnonzero(caught)
        at = at[tables[k][at] == tables[k][source[at]]]
        # blocks in a row with one period: the first stands for them
        caught = np.zeros(n, dtype=bool)
        caught[at] = True
        follows = (place[at] >= 2 * block) & caught[np.maximum(at - block, 0)]
        at = at[~follows]
        at = at[reach[source[at]] < at + block]
        if len(at):
            s, p = source[at], at
            right = _forward(tables, s + block, p + block, end[at])
            before = _backward(tables, s, p, begin[at])
            start, q = s - before, period[at]
            length = p + block + right - start
            new = np.column_stack([start, length, q])[length >= np.maximum(least, times * q)]
            if len(new):
                new = np.unique(new, axis=0)
                found = np.concatenate([found, new])
                np.maximum.at(reach, new[:, 0], new[:, 0] + new[:, 1])
                reach = np.maximum.accumulate(reach)
        k += 1
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that stay: those in no run beyond its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def find(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """id_col, n_words, runs (array of start, length and period in words, by
    start and period) and collapsed (the kept words joined by one blank)."""
    ship(df.sparkSession)

    @F.arrow_udf(f"n_words bigint, runs {RESULT}, collapsed string")
    def scan(texts: pa.Array) -> pa.Array:
        counts, rows, sizes, left = [], [np.zeros((0, 3), dtype=np.int64)], [], []
        blobs = binary(texts)
        for a, b in slices(blobs, SLICE_BYTES):
            part = blobs.slice(a, b - a)
            w = words(part, PLAIN)
            runs = runs_of(w.hashes, w.bounds, least, times)
            owner = np.searchsorted(w.bounds, runs[:, 0], side="right") - 1
            runs[:, 0] -= w.bounds[owner]
            per_text = np.bincount(owner, minlength=b - a)
            counts.append(np.diff(w.bounds))
            rows.append(runs)
            sizes.append(per_text)
            at = 0
            for blob, n, m in zip(part.to_pylist(), counts[-1].tolist(), per_text.tolist(), strict=True):
                tokens = blob.split()  # the same blanks
                if m:
                    keep = kept_words(n, runs[at : at + m])
                    tokens = [t for t, k in zip(tokens, keep.tolist(), strict=True) if k]
                    at += m
                left.append(b" ".join(tokens))
        rows = np.concatenate(rows)
        runs = pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names=["start", "length", "period"])
        starts = np.concatenate([[0], *[np.asarray(s) for s in sizes]]).cumsum().astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64)), pa.ListArray.from_arrays(pa.array(starts), runs), pa.array(left, pa.binary()).cast(pa.string())],
            names=["n_words", "runs", "collapsed"])

    return df.select(F.col(id_col), scan(F.col(text)).alias("_found")).select(id_col, "_found.n_words", "_found.runs", "_found.collapsed")
