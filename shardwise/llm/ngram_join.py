"""Word n-gram Jaccard self-join: MinHash banding, then exact verification.

A text is the set of its n-grams of words (64-bit hashes; n = 5).  Texts with
equal sets form a class, found by two order-free 64-bit sums over the set, and
only classes are compared.  A class's MinHash signature is cut into bands of
``rows`` values; ``plan`` chooses the bands and rows for a target recall at the
threshold.  Classes are shuffled on band hashes; every bucket of two or more is
verified on the full n-gram sets, and a pair that shares several buckets counts
in the first band it shares, so no pair list is built or deduplicated.

Skew: a bucket is cut into blocks of ``block`` classes and each pair of blocks
is a unit of work of its own, so a group of many near copies spreads over tasks.
Buckets with the same members in several bands are kept once.  Units yield sums
(links per class) and one edge per class to its unit's component, never pairs.

Defined results: a text without words (or null) has no n-grams, no links and is
its own class; a text of fewer than n words has one n-gram of all its words;
repeated rows count as copies; a class id is the smallest document id of the
connected group (null ids are ignored if the group has another); texts are read
whole; only the id column is carried over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardwise.llm.common import materialise, ship, text_or_empty, text_slices
from shardwise.llm.textvec import SLICE_CHARS, U, mix, shingles, words

N = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 100
BLOCK = 1024  # classes in a block of a bucket, at most
BLOCK_GRAMS = 2_000_000  # their n-grams together, about


def plan(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false candidates, with
    which ``most`` hashes reach the recall at the threshold."""
    best = None
    for rows in range(1, 33):
        share = threshold**rows
        bands = 1 if share >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-share)))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no bands reach recall {recall} with {most} hashes")
    return best


def _constants(k: int) -> tuple[np.ndarray, np.ndarray]:
    seq = mix(np.arange(1, 2 * k + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return seq[:k] | U(1), seq[k:]


def sets_of(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, sorted, one text after the other."""
    g = shingles(words(texts), n)
    doc = np.repeat(np.arange(len(texts)), np.diff(g.bounds))
    order = np.lexsort((g.hashes, doc))
    h, doc = g.hashes[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def set_keys(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums that identify a set."""
    return _sums(mix(h), bounds), _sums(mix(h ^ U(0xA5A5A5A5DEADBEEF)), bounds)


def band_hashes(h: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """int64 matrix, texts x bands (texts without n-grams: zeros)."""
    has = np.diff(bounds) > 0
    out = np.zeros((len(has), bands), dtype=np.int64)
    if not has.any():
        return out
    starts = bounds[:-1][has]
    a, c = _constants(bands * rows)
    for b in range(bands):
        acc = np.full(len(starts), U(b + 1), dtype=U)
        for k in range(b * rows, (b + 1) * rows):
            acc = mix(acc ^ (np.minimum.reduceat((h * a[k] + c[k]) >> U(32), starts) + U(0x9E3779B97F4A7C15)))
        out[has, b] = acc.view(np.int64)
    return out


def signatures(df: DataFrame, id_col: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """_id, k1, k2, n (distinct n-grams), bands (packed int64) per document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE_CHARS):
                h, bounds = sets_of(texts, n)
                k1, k2 = set_keys(h, bounds)
                sig = band_hashes(h, bounds, bands, rows)
                packed = pa.array([r.tobytes() for r in sig], type=pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(k1), pa.array(k2), pa.array(np.diff(bounds)), packed], names=["_id", "k1", "k2", "n", "bands"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("_id"), text_or_empty(text).alias("_text")).mapInArrow(sign, f"_id {kind}, k1 long, k2 long, n long, bands binary")


def class_sets(df: DataFrame, text: str, n: int) -> DataFrame:
    """k1, k2 and the packed set of each text with n-grams."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0), SLICE_CHARS):
                h, bounds = sets_of(texts, n)
                k1, k2 = set_keys(h, bounds)
                packed = pa.array([h[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), packed], names=["k1", "k2", "grams"])

    return df.select(text_or_empty(text).alias("_text")).mapInArrow(pack, "k1 long, k2 long, grams binary").where(F.length("grams") > 0)


def _shared(left: list[np.ndarray], right: list[np.ndarray], width: int = 4_000_000) -> np.ndarray:
    """Sizes of all intersections left x right by products of 0/1 matrices
    over slices of the n-grams that occur on both sides."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    at = lambda sets: [np.searchsorted(both, s[np.isin(s, both, assume_unique=True)]) for s in sets]
    if not len(both):
        return out
    l_at, same = at(left), left is right
    r_at = l_at if same else at(right)
    step = max(1, width // max(len(left), len(right)))
    for lo in range(0, len(both), step):
        hi = min(lo + step, len(both))

        def dense(places: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(places), hi - lo), dtype=np.float32)
            for i, p in enumerate(places):
                m[i, p[np.searchsorted(p, lo) : np.searchsorted(p, hi)] - lo] = 1
            return m

        x = dense(l_at)
        out += x @ (x if same else dense(r_at)).T
    return out


def linked(left: tuple, right: tuple, band: int, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of one unit that reach the threshold and
    share no earlier band.  A side is (sets, band matrix); the same object on
    both sides means pairs within it."""
    (ls, lb), (rs, rb) = left, right
    ln, rn = np.array([len(s) for s in ls]), np.array([len(s) for s in rs])
    todo = np.minimum(ln[:, None], rn[None, :]) >= threshold * np.maximum(ln[:, None], rn[None, :]) - 1e-9
    for b in range(band):
        todo &= lb[:, b][:, None] != rb[:, b][None, :]
    if left is right:
        todo &= ~np.eye(len(ls), dtype=bool)
    pairs = int(todo.sum()) // (2 if left is right else 1)
    if not pairs:
        return todo
    if pairs <= 4 * (len(ls) + len(rs)):
        shared = np.zeros(todo.shape)
        for i, j in zip(*np.nonzero(todo), strict=True):
            if left is not right or i < j:
                shared[i, j] = len(np.intersect1d(ls[i], rs[j], assume_unique=True))
        if left is right:
            shared = np.maximum(shared, shared.T)
    else:
        shared = _shared(ls, rs)
    return todo & (shared * (1 + threshold) >= threshold * (ln[:, None] + rn[None, :]) - 1e-6)


def component(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index of each vertex's component in a symmetric matrix."""
    label = np.arange(len(adjacent))
    while True:
        near = np.where(adjacent, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit(rows: list[tuple], band: int, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(class, links counted with copies, class of its component) for the
    classes of one unit that have links.  rows: (cid, side, mult, bands, set)."""
    sides = []
    for side in (0, 1):
        own = [r for r in rows if r[1] == side]
        if own:
            sides.append((own, ([np.frombuffer(r[4], dtype=U) for r in own], np.array([np.frombuffer(r[3], dtype=np.int64) for r in own]))))
    (lr, left), (rr, right) = sides[0], sides[-1]
    hit = linked(left, right, band, threshold)
    if not hit.any():
        return
    links_l = hit @ np.array([r[2] for r in rr], dtype=np.int64)
    if left is right:
        ids, links, full = [r[0] for r in lr], links_l, hit
    else:
        ids = [r[0] for r in lr] + [r[0] for r in rr]
        links = np.concatenate([links_l, np.array([r[2] for r in lr], dtype=np.int64) @ hit])
        full = np.block([[np.zeros((len(lr),) * 2, dtype=bool), hit], [hit.T, np.zeros((len(rr),) * 2, dtype=bool)]])
    root = component(full)
    for i in np.flatnonzero(links):
        yield ids[i], int(links[i]), ids[root[i]]


def verify(units: DataFrame, threshold: float) -> DataFrame:
    """Rows of units (h, i, j, band, cid, side, mult, bands, grams), each unit's
    rows together in one partition, to (cid, links, root)."""
    names = ["h", "i", "j", "band", "cid", "side", "mult", "bands", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def unit() -> Iterator[tuple[int, int, int]]:
            _, i, j, band = key or (None, 0, 0, 0)
            # a pair of blocks of which one is empty has no pairs; those inside the other belong to its own unit
            return _unit(rows, band, threshold) if len({r[1] for r in rows}) == (1 if i == j else 2) else iter(())

        def done() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["cid", "links", "root"])
                out.clear()

        for batch in batches:
            for *k, cid, side, mult, bands, grams in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != key:
                    out += unit()
                    key, rows = k, []
                rows.append((cid, side, mult, bands, grams))
            if len(out) > 50_000:
                yield from done()
        out += unit()
        yield from done()

    return units.select(names).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(run, "cid long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every vertex of the edges (a, b): label is the smallest
    vertex of its component.  Every round takes the smallest label around, then
    jumps to the label's label; rounds are written tables, ended by a count."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    both = materialise(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "join-edges")
    labels = materialise(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("label")), "join-labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("u"), F.col("label").alias("l")), "u").groupBy("v").agg(F.min("l").alias("l"))
        near = labels.join(around, "v").select("v", F.least("label", "l").alias("near"), F.col("label").alias("before"))
        jump = near.join(labels.select(F.col("v").alias("near"), F.col("label").alias("far")), "near")
        new = materialise(jump.select("v", F.least("near", "far").alias("label"), "before"), "join-labels")
        if new.where("label <> before").limit(1).count() == 0:
            return new.select("v", "label")
        labels = new.select("v", "label")


def _classes(df: DataFrame, id_col: str, text: str, n: int, threshold: float, recall: float, most_hashes: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(document rows with their class keys, classes with links and group)."""
    ship(df.sparkSession)
    bands, rows = plan(threshold, recall, most_hashes)
    docs = materialise(signatures(df, id_col, text, n, bands, rows), "join-signatures")
    by_id = docs.where("n > 0").groupBy("k1", "k2", "_id").agg(F.count("*").alias("c"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    # copies per id first, so that a class of very many rows is summed up in steps
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id")))
    grouped = by_id.groupBy("k1", "k2").agg(F.sum("c").alias("mult"), best.alias("rep"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    classes = materialise(grouped.select("k1", "k2", "mult", F.col("rep.id").alias("rep"), "n", "bands", F.monotonically_increasing_id().alias("cid")), "join-classes")

    # band b as a number: eight bytes of the packed signature, whose order does not matter here
    part = lambda b: F.substring("bands", 8 * b + 1, 8)
    exploded = classes.select("cid", "n", F.posexplode(F.array(*[part(b) for b in range(bands)])).alias("band", "h"))
    one, two = F.bit_xor(F.xxhash64("cid")).alias("f1"), F.bit_xor(F.xxhash64("cid", F.lit("second"))).alias("f2")
    buckets = exploded.groupBy("band", "h").agg(F.count("*").alias("size"), F.sum("n").alias("grams"), one, two).where("size > 1")
    buckets = buckets.groupBy("size", "grams", "f1", "f2").agg(F.min(F.struct("band", "h")).alias("first")).select("first.band", "first.h", "size", "grams")
    members = exploded.drop("n").join(buckets, ["band", "h"])
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(block)), F.ceil(F.col("grams") / F.lit(BLOCK_GRAMS)))
    own = F.pmod(F.xxhash64("cid", F.lit("block")), blocks)
    members = materialise(members.select("cid", "band", "h", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")), "join-members")
    units = members.select("cid", "band", "h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", "k1", "k2", "mult", "bands")
    sets = class_sets(df, text, n).join(wanted, ["k1", "k2"]).groupBy("cid").agg(F.first("mult").alias("mult"), F.first("bands").alias("bands"), F.first("grams").alias("grams"))
    found = materialise(verify(units.join(sets, "cid"), threshold), "join-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    out = classes.drop("bands").join(links, "cid", "left").join(groups.withColumnRenamed("v", "cid"), "cid", "left")
    out = out.withColumn("label", F.coalesce("label", "cid")).withColumn("links", F.coalesce("links", F.lit(0).cast("long")))
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("cid").alias("cid"))).alias("head")
    return docs.drop("bands"), materialise(out.join(out.groupBy("label").agg(first), "label").select("k1", "k2", "cid", "mult", "rep", "links", F.col("head.id").alias("class_id"), (F.col("head.cid") == F.col("cid")).alias("is_head")), "join-result")


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES, block: int = BLOCK) -> DataFrame:
    """One row per document: id_col, class_id (the smallest id of its connected
    group), copies (documents with the same n-grams, itself included) and
    n_links (other documents with Jaccard similarity >= threshold)."""
    docs, classes = _classes(df, id_col, text, n, threshold, recall, most_hashes, block)
    got = docs.join(classes, ["k1", "k2"], "left")
    alone = F.col("n") == 0
    return got.select(
        F.col("_id").alias(id_col), F.when(alone, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("mult")).cast("long").alias("copies"), F.when(alone, F.lit(0)).otherwise(F.col("links") + F.col("mult") - 1).cast("long").alias("n_links"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES, block: int = BLOCK) -> DataFrame:
    """``df`` with one row of each connected group (one with the group's
    smallest id); rows without words all stay.  The join key holds the id, so
    copies of one text do not meet in one task."""
    _, classes = _classes(df, id_col, text, n, threshold, recall, most_hashes, block)
    same = [F.coalesce(F.col("_i").cast("string"), F.lit("")).alias("__i"), F.col("_i").isNull().alias("__none")]
    heads = classes.where("is_head").select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("rep").alias("_i")).select("__k1", "__k2", *same, F.lit(True).alias("__head"))

    @F.arrow_udf("k1 long, k2 long, n long")
    def key_of(texts: pa.Array) -> pa.Array:
        parts = [np.zeros((0, 3), dtype=np.int64)]
        for _, _, items in text_slices(texts, SLICE_CHARS):
            h, bounds = sets_of(items, n)
            parts.append(np.column_stack([*set_keys(h, bounds), np.diff(bounds)]))
        return pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(parts).T], names=["k1", "k2", "n"])

    keyed = df.withColumn("__key", key_of(text_or_empty(text)))
    number = F.when(F.col("__key.n") > 0, F.col("__key.k1")).otherwise(F.xxhash64(F.col(id_col)))  # spreads rows without words
    keyed = keyed.withColumns({"__k1": number, "__k2": F.col("__key.k2"), "__n": F.col("__key.n"), "__i": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "__none": F.col(id_col).isNull()}).drop("__key")
    key = ["__k1", "__k2", "__i", "__none"]
    repeat = F.row_number().over(Window.partitionBy(*key).orderBy("__n"))
    out = keyed.join(heads, key, "left").withColumn("__repeat", repeat)
    return out.where("__n = 0 or (__head and __repeat = 1)").select(df.columns)
