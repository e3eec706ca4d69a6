"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (documents of equal text) are packed in two tiers.  First, each of many
hash parts of the group table packs its groups, largest first, into bins of a
fixed capacity (total / (shards x fineness)), each group into the open bin with
the tightest remaining capacity, found in a two-level B-tree of capacities; a
group larger than that capacity is a bin of its own.  Then the bins (at most
3 x shards x fineness plus one per part, a part being 200,000 groups) are packed
the same way into the shards, whose capacity is the fair share of what oversized
groups leave; a bin that fits nowhere goes to the roomiest shard.  Shards
therefore differ by about one bin, unless one group exceeds the fair share.

Positions in a shard are counts per (shard, hash slice of the id) summed up plus
the row number inside the slice, so no task numbers a whole shard.

Defined results: a null text has no bytes and is grouped with the empty text;
equal rows take one position each; an empty table gives an empty result; other
columns are not carried over.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardwise.llm.common import collect_bounded, materialise, ship, text_or_empty

FINENESS = 1000
PART_GROUPS = 200_000
SLICE_ROWS = 20_000  # rows numbered by one window partition, about


class Capacities:
    """(remaining, bin) pairs in sorted blocks under a sorted list of block
    maxima: a B-tree of two levels, whose full blocks split in half."""

    def __init__(self, width: int = 256):
        self.width, self.blocks, self.tops = width, [], []

    def add(self, item: tuple[int, int]) -> None:
        i = min(bisect_left(self.tops, item), len(self.blocks) - 1)
        if i < 0:
            self.blocks, self.tops = [[item]], [item]
            return
        block = self.blocks[i]
        insort(block, item)
        if len(block) > self.width:
            self.blocks[i : i + 1] = [block[: self.width // 2], block[self.width // 2 :]]
            self.tops[i : i + 1] = [self.blocks[i][-1], self.blocks[i + 1][-1]]
        else:
            self.tops[i] = block[-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least remaining >= size."""
        i = bisect_left(self.tops, (size, -1))
        if i == len(self.blocks):
            return None
        block = self.blocks[i]
        item = block.pop(bisect_left(block, (size, -1)))
        if block:
            self.tops[i] = block[-1]
        else:
            del self.blocks[i], self.tops[i]
        return item


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size (a size above the capacity gets a bin of its own)."""
    out, room, n = [0] * len(sizes), Capacities(), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = room.take_tightest(sizes[i])
        if found is None:
            found, n = (capacity, n), n + 1
        out[i] = found[1]
        if found[0] > sizes[i]:
            room.add((found[0] - sizes[i], found[1]))
    return out


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """Shard of each bin: best fit, largest first, under the fair share; a bin
    over the fair share of the shards still empty takes one of them alone."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    total, out, alone = sum(sizes), [0] * len(sizes), 0
    while alone < min(shards - 1, len(order)) and sizes[order[alone]] * (shards - alone) > total:
        total -= sizes[order[alone]]
        out[order[alone]] = alone
        alone += 1
    fair = -(-total // (shards - alone))
    room = sorted((fair, s) for s in range(alone, shards))
    for i in order[alone:]:
        at = min(bisect_left(room, (sizes[i], -1)), len(room) - 1)  # tightest that fits, else roomiest
        left, s = room.pop(at)
        out[i] = s
        insort(room, (left - sizes[i], s))
    return out


def shard(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text: str = "text", extra_bytes: int = 8, fineness: int = FINENESS, part_groups: int = PART_GROUPS) -> DataFrame:
    """Columns id_col, size, text_crc32, law ('bytes'), shard, slot."""
    spark = df.sparkSession
    ship(spark)
    t = text_or_empty(text)
    docs = materialise(df.select(
        F.col(id_col).alias("_id"), (F.octet_length(t) + F.lit(extra_bytes)).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.unhex(F.md5(t.cast("binary"))).alias("_key"),
    ), "sharding-rows")
    groups = materialise(docs.groupBy("_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "sharding-groups")
    stats = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("rows"), F.lit(0)).alias("r"), F.count("*").alias("g")).first()
    capacity = max(1, -(-stats["b"] // (shards * fineness)))
    parts = max(1, -(-stats["g"] // part_groups))

    def pack_part(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["_key", "part", "bytes"]].assign(bin=best_fit_decreasing(pdf["bytes"].tolist(), capacity))

    part = F.pmod(F.xxhash64("_key"), F.lit(parts))
    members = materialise(groups.withColumn("part", part).groupBy("part").applyInPandas(pack_part, "_key binary, part long, bytes long, bin long"), "sharding-bins")
    bins = members.groupBy("part", "bin").agg(F.sum("bytes").alias("bytes"))
    # bins above half their capacity: at most 2 x shards x fineness; others: one per part
    rows = sorted(collect_bounded(bins, 3 * shards * fineness + parts, "bins"), key=lambda r: (r["part"], r["bin"]))
    chosen = into_shards([r["bytes"] for r in rows], shards)
    places = pd.DataFrame({"part": [r["part"] for r in rows], "bin": [r["bin"] for r in rows], "shard": chosen})
    place = spark.createDataFrame(places, "part long, bin long, shard int")
    sharded = members.join(place, ["part", "bin"]).select("_key", "shard")
    n_slices = max(1, -(-stats["r"] // (shards * SLICE_ROWS)))
    slot_of = F.pmod(F.xxhash64("_id", "text_crc32"), F.lit(n_slices))
    placed = materialise(docs.join(sharded, "_key").select("_id", "size", "text_crc32", "shard", slot_of.alias("_slice")), "sharding-placed")
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_slice").agg(F.count("*").alias("n")).select("shard", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_slice").orderBy("_id", "text_crc32")
    numbered = placed.withColumn("_n", F.row_number().over(inside)).join(starts, ["shard", "_slice"])
    return numbered.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_before") + F.col("_n") - 1).cast("long").alias("slot"))
