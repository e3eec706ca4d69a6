"""Near-duplicate groups by a chosen-path set similarity join.

A text is the set of its shingles of ``n`` words; texts of equal sets form a
class.  A class has ``POSITIONS`` minwise values, each of which two sets share
with the probability of their Jaccard similarity.  A tree puts all classes into
its root; a node chooses positions, the same for all its members, 1 / threshold
of them on average, and has a child for every value found there.  Two sets at
the threshold thus meet in one child of a node on average.  A node of ``limit``
members or fewer is compared exhaustively; a larger one branches on, and what is
still larger after ``depth`` levels is compared in blocks.  ``plan`` gives the
number of independent trees that reach the target recall at the threshold,
from the extinction probability of this branching process.

Comparing a node: byte sketches of the minwise values first (a pair at the
threshold passes with 0.99998), then the full sets of those that remain, where
pairs already connected are skipped, since only groups are asked for.

Skew: large nodes of the first trees are compared with a few of their own
members (pivots) before the trees grow, in chunks of ``block`` members.  The
groups found label the classes, and a node whose members have one label is done:
it cannot connect anything new.  In a large node, the members of a label of more
than ``limit`` are compared with all others at once, block by block, and leave
the node; they are not compared with one another.  A class whose sketch is near
one of a label of more than ``limit`` classes is compared with all of that label,
once, instead of in every node where they meet.  So a group of any number of
copies costs rows in proportion to its size, and no task holds more than two
blocks.  Nodes with the same members are compared once, and so are equal sets of
candidates from several trees.

Defined results: words are separated by blanks, A-Z lower-cased; a text of fewer
than n words has one shingle of them all; null and empty texts have none and are
linked with nothing; repeated rows are copies; a component's id is the smallest
document id in it (null ids are ignored if it has another); whole texts are
read; other columns are not carried over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardwise.llm.bytewords import FOLDED, binary, shingle_sets, slices, words
from shardwise.llm.common import materialise, ship
from shardwise.llm.ngram_join import components
from shardwise.llm.textvec import U, mix

N = 4
PERCENT = 80
RECALL = 0.9999
POSITIONS = 96
LIMIT = 32  # members of a node that is compared exhaustively
DEPTH = 4
BLOCK = 256  # members compared with another block's at once
STAR_TREES = 2
PIVOTS = 3
SLICE_BYTES = 500_000
PAIRS = 100_000  # sketch comparisons held at once


def plan(share: float, recall: float, depth: int) -> list[int]:
    """Positions chosen at the root of each tree: enough trees that a pair of
    similarity ``share`` meets in a node of level ``depth`` of one of them with
    probability ``recall``."""
    most = math.ceil(1 / share)
    extra = 1 / share - most + 1  # share of nodes that choose ``most``, the others one less
    survive = 1.0
    for _ in range(depth - 1):
        lost = 1 - share * survive
        survive = 1 - (1 - extra) * lost ** (most - 1) - extra * lost**most
    roots, fail, owed = [], 1.0, 0.0
    while fail > 1 - recall:
        owed += extra
        roots.append(most if owed >= 1 else most - 1)
        owed -= owed >= 1
        fail *= (1 - share * survive) ** roots[-1]
    return roots


def sketch_bar(share: float, positions: int) -> int:
    """Equal bytes that a pair at the threshold has but for a chance of 2e-5."""
    at_least, tail = positions, 0.0
    while at_least > 0:
        tail += math.comb(positions, at_least) * share**at_least * (1 - share) ** (positions - at_least)
        if 1 - tail <= 2e-5:
            return at_least
        at_least -= 1
    return 0


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def minwise(h: np.ndarray, bounds: np.ndarray, positions: int) -> np.ndarray:
    """uint32 matrix, texts x positions (texts without shingles: zeros)."""
    has = np.diff(bounds) > 0
    out = np.zeros((len(has), positions), dtype=np.uint32)
    if has.any():
        seq = mix(np.arange(1, 2 * positions + 1, dtype=U) * U(0xD1B54A32D192ED03))
        starts = bounds[:-1][has]
        for k in range(positions):
            out[has, k] = np.minimum.reduceat((h * (seq[k] | U(1)) + seq[positions + k]) >> U(32), starts).astype(np.uint32)
    return out


def signatures(df: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """_id, _mark (the text's hash), k1, k2, n (shingles) and the packed
    minwise values and sketch of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = binary(batch.column(2))
            for a, b in slices(blobs, SLICE_BYTES):
                h, bounds = shingle_sets(words(blobs.slice(a, b - a), FOLDED), n)
                values = minwise(h, bounds, POSITIONS)
                sketch = ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
                keys = [pa.array(_sums(mix(h), bounds)), pa.array(_sums(mix(h ^ U(0xA5A5A5A5DEADBEEF)), bounds))]
                packed = [pa.array([r.tobytes() for r in m], type=pa.binary()) for m in (values, sketch)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *keys, pa.array(np.diff(bounds)), *packed],
                                                 names=["_id", "_mark", "k1", "k2", "n", "minwise", "sketch"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text"))
    return rows.mapInArrow(sign, f"_id {kind}, _mark long, k1 long, k2 long, n long, minwise binary, sketch binary")


def sets_of(df: DataFrame, id_col: str, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """cid and packed set of the wanted classes (cid, _id, _mark)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = binary(batch.column(1))
            for a, b in slices(blobs, SLICE_BYTES):
                h, bounds = shingle_sets(words(blobs.slice(a, b - a), FOLDED), n)
                packed = pa.array([h[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), packed], names=["cid", "grams"])

    rows = df.select(F.col(id_col).alias("_i"), F.xxhash64(text).alias("_m"), F.col(text).alias("_text"))
    rows = rows.join(wanted, (F.col("_m") == F.col("_mark")) & F.col("_i").eqNullSafe(F.col("_id")))
    # rows that repeat id and text give one set
    return rows.select("cid", "_text").mapInArrow(pack, "cid long, grams binary").groupBy("cid").agg(F.first("grams").alias("grams"))


def _pairs(side: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to compare in units of rows (unit u: starts[u]:starts[u + 1]),
    about PAIRS at a time: rows of side 2 with the later ones of their unit, rows
    of side 0 with those of side 1."""
    end = np.repeat(starts[1:], np.diff(starts))
    here = np.arange(len(side))
    # rows stand by side inside a unit
    ones = np.add.reduceat((side == 1).astype(np.int64), starts[:-1])
    many = np.where(side == 2, end - here - 1, np.where(side == 0, np.repeat(ones, np.diff(starts)), 0))
    ends = np.cumsum(many)
    at = 0
    while at < len(side):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        left = np.repeat(here[at:to], many[at:to])
        nth = np.arange(len(left)) - np.repeat(ends[at:to] - many[at:to] - (ends[at - 1] if at else 0), many[at:to])
        yield left, np.where(side[left] == 2, left + 1 + nth, end[left] - many[left] + nth)
        at = to


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place of each one's component under the edges (a, b)."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    return root


def candidates(units: DataFrame, bar: int) -> DataFrame:
    """Rows of units (u, cid, label, heavy, side, n, sketch) to (u, cid, against).

    Pairs count whose sketches agree in ``bar`` bytes, whose sizes allow the
    threshold and whose labels differ.  Members of light labels give the rows of
    each component of such pairs, u naming the component.  A member near a heavy
    label gives one row with that label in ``against``: it is to be compared with
    the whole label, once, wherever they met."""
    names = ["u", "side", "cid", "label", "heavy", "n", "sketch"]

    def some(rows: list[np.ndarray], sketch: np.ndarray) -> pa.RecordBatch | None:
        u, side, cid, label, heavy, n = rows
        starts = np.append(np.flatnonzero(np.diff(u, prepend=u[0] - 1 if u[0] > -(2**63) else u[0] + 1)), len(u))
        lefts, rights = [], []
        for a, b in _pairs(side, starts):
            ok = (label[a] != label[b]) & (100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b]))
            a, b = a[ok], b[ok]
            near = (sketch[a] == sketch[b]).sum(axis=1) >= bar
            lefts.append(a[near])
            rights.append(b[near])
        a, b = np.concatenate(lefts), np.concatenate(rights)
        if not len(a):
            return None
        # of a pair with a heavy label, the heavy one second; of two heavy ones, that of the smaller label
        swap = (heavy[a] > heavy[b]) | ((heavy[a] == heavy[b]) & (label[a] < label[b]))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        whole = heavy[b] > 0
        asked = np.unique(np.column_stack([cid[a[whole]], label[b[whole]]]), axis=0)
        a, b = a[~whole], b[~whole]
        root = _roots(len(u), a, b)
        used = np.unique(np.concatenate([a, b]))
        name = mix(u[used].view(U) + mix(root[used].astype(U) - starts[np.searchsorted(starts, root[used], side="right") - 1].astype(U)))
        none = pa.nulls(len(used), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(name.view(np.int64)), pa.array(asked[:, 1])]), pa.concat_arrays([pa.array(cid[used]), pa.array(asked[:, 0])]), pa.concat_arrays([none, pa.array(asked[:, 1])])],
            names=["u", "cid", "against"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if not held:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            u = t["u"].to_numpy()
            cut = len(u) if last else int(np.searchsorted(u, u[-1]))  # the last unit may go on
            if cut:
                part = t.slice(0, cut)
                joined = part["sketch"].combine_chunks()
                sketch = np.frombuffer(b"".join(joined.to_pylist()), dtype=np.uint8).reshape(cut, -1)
                out = some([part[c].to_numpy() for c in names[:-1]], sketch)
                if out is not None:
                    yield out
            held = t.slice(cut).to_batches()
            size = len(u) - cut

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > 20_000:
                yield from ready(False)
        yield from ready(True)

    return units.select(names).repartition("u").sortWithinPartitions("u", "side").mapInArrow(run, "u long, cid long, against long")


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest place of each set's component under the similarity: every set is
    compared with all that are not connected with it yet."""
    root = np.arange(len(sets))
    open_ = list(range(len(sets)))
    while open_:
        first = open_.pop(0)
        queue = [first]
        while queue and open_:
            own = sets[queue.pop(0)]
            size = np.array([len(sets[i]) for i in open_])
            fit = np.flatnonzero(100 * np.minimum(size, len(own)) >= percent * np.maximum(size, len(own)))
            if not len(fit):
                continue
            every = np.concatenate([sets[open_[i]] for i in fit])
            at = np.minimum(np.searchsorted(own, every), len(own) - 1)
            shared = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(size[fit]) - size[fit])
            hits = [open_[i] for i in fit[100 * shared >= percent * (size[fit] + len(own) - shared)]]
            root[hits] = first
            queue += hits
            gone = set(hits)
            open_ = [i for i in open_ if i not in gone]
    return root


def verify(units: DataFrame, percent: int) -> DataFrame:
    """Rows (u, cid, grams) to edges (a, b) between a class and the first of its
    component by full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets, out = None, [], [], []

        def done() -> list[tuple[int, int]]:
            root = linked(sets, percent) if len(sets) > 1 else np.arange(len(sets))
            return [(ids[i], ids[r]) for i, r in enumerate(root.tolist()) if r != i]

        for batch in batches:
            for u, cid, grams in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if u != key:
                    out += done()
                    key, ids, sets = u, [], []
                ids.append(cid)
                sets.append(np.frombuffer(grams, dtype=U))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b"])
                out = []
        out += done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b"])

    return units.select("u", "cid", "grams").repartition("u").sortWithinPartitions("u").mapInArrow(run, "a long, b long")


def _members(key: str) -> list[Column]:
    """Fingerprint of the classes of a group."""
    return [F.count("*").alias("size"), F.bit_xor(F.xxhash64(key)).alias("f1"), F.bit_xor(F.xxhash64(key, F.lit("second"))).alias("f2")]


class _Join:
    def __init__(self, df: DataFrame, id_col: str, text: str, n: int, percent: int, classes: DataFrame, limit: int, block: int):
        self.df, self.id_col, self.text, self.n, self.percent = df, id_col, text, n, percent
        self.classes, self.limit, self.block = classes, limit, block

    def near(self, units: DataFrame) -> DataFrame:
        """``candidates`` of units (u, cid, label, heavy, side), written."""
        rows = units.join(self.classes.select("cid", "n", "sketch"), "cid")
        return materialise(candidates(rows, sketch_bar(self.percent / 100, POSITIONS)), "paths-candidates")

    def edges(self, near: DataFrame) -> DataFrame:
        """Edges by full sets between members of units (u, cid)."""
        once = near.groupBy("u").agg(*_members("cid")).groupBy("size", "f1", "f2").agg(F.min("u").alias("u")).select("u")
        near = near.join(once, "u")
        wanted = self.classes.join(near.select("cid").distinct(), "cid", "left_semi").select("cid", F.col("first.id").alias("_id"), F.col("first.mark").alias("_mark"))
        sets = sets_of(self.df, self.id_col, self.text, self.n, wanted)
        return materialise(verify(near.join(sets, "cid"), self.percent), "paths-edges")

    def against(self, asked: DataFrame, groups: DataFrame) -> DataFrame:
        """Units that compare each asked class (cid, against) with all members
        of the label, block by block."""
        asked = materialise(asked.distinct(), "paths-against")
        sizes = asked.groupBy(F.col("against").alias("label")).agg(F.ceil(F.count("*") / F.lit(self.block)).alias("askers"))
        sizes = sizes.join(groups.groupBy("label").agg(F.ceil(F.count("*") / F.lit(self.block)).alias("holders")), "label")
        block = lambda many: F.pmod(F.xxhash64("cid", F.lit("against")), F.col(many))
        every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))
        left = asked.withColumnRenamed("against", "label").join(sizes, "label").select("label", "cid", block("askers").alias("i"), every("holders").alias("j"), F.lit(0).alias("side"))
        right = groups.select(F.col("v").alias("cid"), "label").join(sizes, "label").select("label", "cid", every("askers").alias("i"), block("holders").alias("j"), F.lit(1).alias("side"))
        units = left.unionByName(right).select(F.xxhash64("label", "i", "j").alias("u"), "cid", "side")
        return _labelled(units.withColumn("label", F.lit(0)), groups).withColumn("heavy", F.lit(0))

    def children(self, rows: DataFrame, choose: Column) -> DataFrame:
        """(node, cid, label) of the children of rows (node, cid, label)."""
        rows = rows.join(self.classes.select("cid", "minwise"), "cid")
        value = F.expr(f"transform(sequence(1, chosen), j -> xxhash64(node, j, substring(minwise, 4 * pmod(xxhash64(node, j), {POSITIONS}) + 1, 4)))")
        return rows.withColumn("chosen", choose).select("cid", "label", F.explode(value).alias("node"))

    def star(self, rows: DataFrame) -> DataFrame:
        """Edges between the members of large nodes and a few pivots of them."""
        pivots = [F.min_by("cid", F.xxhash64("cid", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
        nodes = rows.groupBy("node").agg(*_members("cid"), *pivots).where(F.col("size") > self.limit)
        nodes = nodes.groupBy("size", "f1", "f2").agg(F.min_by(F.struct("node", *[f"p{i}" for i in range(PIVOTS)]), "node").alias("x")).select("size", "x.*")
        chunks = F.ceil(F.col("size") / F.lit(self.block))
        own = rows.join(nodes.select("node", chunks.alias("chunks")), "node").select("node", "cid", F.pmod(F.xxhash64("cid", F.lit("chunk")), "chunks").alias("chunk"), F.lit(1).alias("side"))
        head = nodes.select("node", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("cid"), chunks.alias("chunks"))
        head = head.select("node", "cid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("side"))
        units = own.unionByName(head).select(F.xxhash64("node", "chunk").alias("u"), "cid", F.col("cid").alias("label"), F.lit(0).alias("heavy"), "side")
        return self.edges(self.near(units).select("u", "cid"))

    def parted(self, rows: DataFrame) -> DataFrame:
        """Members (node, cid, label) of large nodes with ``part``: a label of more
        than ``limit`` members is a part of its own, all others are part 0."""
        count = rows.groupBy("node", "label").agg(F.count("*").alias("own"))
        heavy = count.where(F.col("own") > self.limit).select("node", "label", F.lit(True).alias("heavy"))
        rows = rows.join(heavy, ["node", "label"], "left")
        return materialise(rows.select("node", "cid", "label", F.when(F.col("heavy"), F.col("label") + 1).otherwise(0).alias("part")), "paths-large")

    def blocks(self, rows: DataFrame) -> DataFrame:
        """Units of the members (node, cid, label, part, last) of large nodes:
        pairs of blocks of two parts, and of part 0 within itself if the node
        does not branch on (``last``)."""
        parts = rows.groupBy("node", "part").agg(F.ceil(F.count("*") / F.lit(self.block)).alias("many"), F.first("last").alias("last"))
        every = parts.select("node", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("many") - 1), lambda i: F.struct(F.col("part"), i.alias("i")))).alias("b"))
        every = every.groupBy("node").agg(F.collect_list("b").alias("all"))  # one entry for each block of a node
        others = parts.join(every, "node").select("node", "part", "many", F.expr("filter(all, b -> b.part <> part or (last and part = 0))").alias("others"))
        got = rows.join(others, ["node", "part"]).withColumn("own", F.struct("part", F.pmod(F.xxhash64("cid", F.lit("block")), "many").alias("i")))
        got = got.select("node", "cid", "label", "own", F.explode("others").alias("other"))
        side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
        return got.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("u"), "cid", "label", side.alias("side"))


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.select(F.col("v").alias("cid"), F.col("label").alias("_l"))
    return rows.join(named, "cid", "left").select(*[c for c in rows.columns if c != "label"], F.coalesce("_l", "cid").alias("label"))


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT, recall: float = RECALL,
         limit: int = LIMIT, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id and kept."""
    if not 51 <= percent <= 100:
        raise ValueError("a threshold between 51 and 100 percent")
    ship(df.sparkSession)
    docs = materialise(signatures(df, id_col, text, n), "paths-signatures")
    # copies per id first, so that a class of very many rows is summed up in steps
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_mark").alias("mark"))).alias("first")
    same = [F.first(c).alias(c) for c in ("n", "minwise", "sketch")]
    by_id = docs.where("n > 0").groupBy("k1", "k2", "_id").agg(F.min("_mark").alias("_mark"), *same)
    classes = by_id.groupBy("k1", "k2").agg(first, *same)
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "paths-classes")
    work = _Join(df, id_col, text, n, percent, classes, limit, block)

    roots = plan(percent / 100, recall, depth)
    most = math.ceil(100 / percent)
    chosen = [(tree, p) for tree, many in enumerate(roots) for p in range(many)]
    order = np.argsort(mix(np.arange(POSITIONS, dtype=U))).tolist()  # the roots share no position as long as there are enough
    level = F.array(*[F.struct(F.lit(tree).alias("tree"), F.xxhash64(F.lit(tree), F.lit(i), F.substring("minwise", 4 * order[i % POSITIONS] + 1, 4)).alias("node")) for i, (tree, _) in enumerate(chosen)])
    rows = classes.select("cid", F.explode(level).alias("x")).select("x.tree", "x.node", "cid")
    edges = work.star(rows.where(F.col("tree") < STAR_TREES).drop("tree"))
    groups = components(edges)
    rows = _labelled(rows.drop("tree"), groups)
    leaves = wide = None
    choose = F.when(F.pmod(F.xxhash64("node", F.lit("branches")), F.lit(1_000_000)) < round(1_000_000 * (100 / percent - most + 1)), most).otherwise(most - 1)
    for at in range(1, depth + 1):
        nodes = rows.groupBy("node").agg(*_members("cid"), F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("size > 1 and _lo <> _hi")
        large = F.col("size") > limit
        nodes = nodes.groupBy("size", "f1", "f2", F.when(large, F.col("node")).alias("_own")).agg(F.min("node").alias("node"))
        members = materialise(rows.join(nodes.select("node", large.alias("large")), "node"), "paths-members")
        small = members.where("not large").select(F.xxhash64("node", F.lit(at)).alias("u"), "cid", "label", F.lit(2).alias("side"))
        leaves = small if leaves is None else leaves.unionByName(small)
        rest = members.where("large").drop("large")
        if rest.limit(1).count() == 0:
            break
        rest = work.parted(rest)
        marked = rest.select(F.xxhash64("node", F.lit(at)).alias("node"), "cid", "label", "part", F.lit(at == depth).alias("last"))
        wide = marked if wide is None else wide.unionByName(marked)
        if at < depth:
            # what was compared with the whole node leaves it; the others branch on if they are still many
            light = rest.where("part = 0").drop("part")
            light = light.join(light.groupBy("node").agg(F.count("*").alias("size")), "node")
            leaves = leaves.unionByName(light.where(F.col("size") <= limit).select(F.xxhash64("node", F.lit(at), F.lit("light")).alias("u"), "cid", "label", F.lit(2).alias("side")))
            rows = work.children(light.where(F.col("size") > limit).drop("size"), choose)
    if wide is not None:
        leaves = leaves.unionByName(work.blocks(wide))
    large = groups.groupBy("label").agg(F.count("*").alias("held")).where(F.col("held") > limit).select("label", F.lit(1).alias("heavy"))
    near = work.near(leaves.join(large, "label", "left").withColumn("heavy", F.coalesce("heavy", F.lit(0))))
    whole = work.near(work.against(near.where("against is not null").select("cid", "against"), groups))
    edges = edges.unionByName(work.edges(near.where("against is null").select("u", "cid").unionByName(whole.select("u", "cid"))))
    groups = components(edges)
    out = _labelled(classes.select("cid", "k1", "k2", F.col("first.none").alias("none"), F.col("first.id").alias("id")), groups)
    least = out.groupBy("label").agg(F.min(F.struct("none", "id")).alias("least"))
    named = materialise(out.join(least, "label").select("k1", "k2", F.col("least.id").alias("component")), "paths-result")
    got = docs.select("_id", "k1", "k2", "n").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component"))
    return got.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))
