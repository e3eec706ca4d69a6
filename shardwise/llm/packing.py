"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids (its tokens and one closing id) are cut into full sequences
and a remainder.  Lengths fall into reciprocal-capacity classes: class ``c``
holds pieces of at most ``c = capacity // k`` ids, and ``capacity // c`` of them
fill a sequence.  A remainder within ``slack`` of its class's size stays whole;
otherwise a piece exactly as long as the next smaller class is cut off, and the
rest is classed again (the rest shrinks quadratically, so few cuts are made).

Every task fills its own sequences, a fixed number of pieces per class, without
talking to other tasks.  What is left in a task's last, unfilled sequence of
each class (fewer pieces than fill one) is numbered across tasks by running
counts per class (a table of tasks x classes) and fills further sequences; the
one unfilled sequence that each class still has is best-fitted with the others
(at most one row per class reaches the driver).

Ids come from tiktoken with the public rank file of the same vocabulary as
``byte_bpe_50k.json`` (equal ids, checked by a test).  As that json says, a text
is split at its added tokens first; parts with white space too long for
tiktoken's pattern go to ``tokenizers``.  Pieces are written once to the shared checkpoint
folder, so task numbers and positions stay fixed if an executor is lost.

Defined results: a null text counts as empty (one piece: the closing id); texts
are read whole; equal rows are packed each; only the id column is carried over.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardwise.llm.common import collect_bounded, materialise, ship, text_or_empty, text_slices

CAPACITY = 1024
END_ID = 0
SLACK = 0.01
TAIL = 1 << 60  # sequence ids of pieces gathered across tasks start here

LONG_SPACE = 100_000  # tiktoken's pattern runs out of stack at about 1,000,000 white-space characters

_encoder = None


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts as the vocabulary's json gives them: the file of the same
    name beside the rank file (without one there are no added tokens)."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json = os.path.splitext(path)[0] + ".json"
        self.exact = None
        self.added: dict[str, int] = {}
        if os.path.exists(self.json):
            with open(self.json, encoding="utf-8") as f:
                tokens = json.load(f)["added_tokens"]
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
                raise ValueError(f"added tokens of {self.json} are not plain strings")
            self.added = {t["content"]: t["id"] for t in tokens}
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def _ordinary(self, text: str) -> np.ndarray:
        if len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in re.finditer(r"\s+", text)):
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.json)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.fast.encode_to_numpy(text), dtype="<u4")

    def encode_ordinary(self, text: str) -> list[int]:
        """Ids of a text in which added tokens' strings are ordinary text."""
        return self.fast.encode_ordinary(text)

    def encode(self, text: str) -> np.ndarray:
        if self.split is None or not self.split.search(text):
            return self._ordinary(text)
        parts = self.split.split(text)  # text, token, text, ..., text
        return np.concatenate([np.array([self.added[x]], dtype="<u4") if i % 2 else self._ordinary(x) for i, x in enumerate(parts)])


def encoder(path: str) -> Encoder:
    """One encoder per process and path."""
    global _encoder
    if _encoder is None or _encoder[0] != path:
        _encoder = (path, Encoder(path))
    return _encoder[1]


def classes(capacity: int) -> np.ndarray:
    """Sizes capacity // k, ascending, without repeats."""
    return np.unique(capacity // np.arange(1, capacity + 1))


def cuts(capacity: int = CAPACITY, slack: float = SLACK) -> list[list[tuple[int, int]]]:
    """For each remainder below the capacity: its pieces as (length, class)."""
    sizes = classes(capacity)
    out: list[list[tuple[int, int]]] = [[]]
    for r in range(1, capacity):
        c = int(sizes[np.searchsorted(sizes, r)])
        if r >= (1 - slack) * c:
            out.append([(r, c)])
        else:
            below = int(sizes[np.searchsorted(sizes, r) - 1])
            out.append([(below, below), *out[r - below]])
    return out


PIECES = "_id {id}, start long, length long, ids binary, doc_tokens long, class int, task long, place long, sequence_id long, offset long"


def pieces(df: DataFrame, id_col: str, text: str, capacity: int, end_id: int, slack: float, path: str) -> DataFrame:
    """Tokenise, cut and fill each task's own sequences.  ``sequence_id`` is
    null for what its task could not fill; ``place`` counts those per class."""
    ship(df.sparkSession)
    plan = cuts(capacity, slack)
    id_type = df.schema[id_col].dataType

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        task = TaskContext.get().partitionId()
        sequences = 0
        open_: dict[int, list[list]] = {}

        def table(rows: list[list]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                names = ("start", "length", "ids", "doc_tokens", "class", "task", "place", "sequence_id", "offset")
                schema = pa.schema([("_id", batch.schema.field(0).type), *zip(names, kinds, strict=True)])
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b, part in text_slices(texts, 2_000_000):
                rows: list[list] = []
                for key, t in zip(keys[a:b], part, strict=True):
                    ids = np.append(enc.encode(t), np.uint32(end_id)).astype("<u4")
                    n, at = len(ids), 0
                    raw = ids.tobytes()
                    for length, c in [(capacity, capacity)] * (n // capacity) + plan[n % capacity]:
                        row = [key, at, length, raw[4 * at : 4 * (at + length)], n, c, task, None, None, None]
                        at += length
                        waiting = open_.setdefault(c, [])
                        waiting.append(row)
                        if len(waiting) == capacity // c:
                            offset = 0
                            for r in waiting:
                                r[8], r[9] = (task << 32) + sequences, offset
                                offset += r[2]
                            sequences += 1
                            rows += waiting
                            open_[c] = []
                if rows:
                    yield table(rows)
        rest = []
        for waiting in open_.values():
            for i, r in enumerate(waiting):
                r[7] = i
                rest.append(r)
        if rest:
            yield table(rest)

    source = df.select(F.col(id_col).alias("_id"), text_or_empty(text).alias("_text"))
    return source.mapInArrow(fill, PIECES.format(id=id_type.simpleString()))


def best_fit(fills: dict[int, int], capacity: int) -> dict[int, int]:
    """Class -> joint sequence of its unfilled one: best fit, largest first."""
    room: list[int] = []
    out = {}
    for c, n in sorted(fills.items(), key=lambda x: (-x[1], x[0])):
        fits = [i for i, r in enumerate(room) if r >= n]
        i = min(fits, key=lambda i: room[i]) if fits else len(room)
        if i == len(room):
            room.append(capacity)
        room[i] -= n
        out[c] = i
    return out


def pack(df: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents: id_col, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset."""
    made = materialise(pieces(df, id_col, text, capacity, end_id, slack, ranks or default_ranks()), "packing-pieces")
    tail = made.where("sequence_id is null")
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = tail.groupBy("task", "class").agg(F.count("*").alias("n"))
    counts = counts.select("task", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    tail = tail.join(counts, ["task", "class"]).withColumn("place", F.col("place") + F.col("before")).drop("before")
    fixed = F.lit(capacity) / F.col("class")
    tail = tail.withColumn("bin", F.floor(F.col("place") / F.floor(fixed)).cast("long"))
    bins = tail.groupBy("class", "bin").agg(F.count("*").alias("n"), F.sum("length").alias("ids"))
    unfilled = collect_bounded(bins.where(F.col("n") < F.floor(fixed)).select("class", "ids"), capacity, "unfilled sequences")
    joint = best_fit({r["class"]: r["ids"] for r in unfilled}, capacity)
    last = {r["class"] for r in unfilled}
    seq = F.lit(TAIL) + F.col("class").cast("long") * (1 << 44) + F.col("bin")
    if last:
        tops = bins.where(F.col("n") < F.floor(fixed)).select("class", F.col("bin").alias("open_bin"))
        number = F.create_map(*[F.lit(x) for c, i in joint.items() for x in (c, i)])
        tail = tail.join(F.broadcast(tops), "class", "left")  # one row per class
        seq = F.when(F.col("bin") == F.col("open_bin"), F.lit(TAIL) + number[F.col("class")].cast("long")).otherwise(seq)
    inside = Window.partitionBy("sequence_id").orderBy("class", "place").rowsBetween(Window.unboundedPreceding, -1)
    tail = tail.withColumn("sequence_id", seq).withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    cols = [F.col("_id").alias(id_col), "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return made.where("sequence_id is not null").select(cols).unionByName(tail.select(cols))
