"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts are never divided. Groups of one size are interchangeable, so the
instance is a histogram of sizes: each group is packed as itself, whatever their number, and
the driver's knowledge of the corpus is bounded. Sizes are exact up to 2**12 bytes and rounded
up to 12 binary digits beyond, which leaves 110,000 sizes at most. Sizes, largest first, enter
the bin with the tightest sufficient rest, found by successor search in a balanced tree: as
many groups of the size as fit, which is where they would go one by one. A group finds its
bin by its rank among the groups of its size.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.common import materialize

#: A group above one in so many of a shard's bytes has its rows placed by a broadcast of its shard.
PER_SHARD = 1000
#: Binary digits of a size that are kept.
DIGITS = 12
#: Parts in which rows or groups are numbered, at least, and rows meant for a part.
PARTS, PER_PART = 256, 1 << 20

#: (size, first rank, groups, bin): groups of one size that go to one bin.
Run = tuple[int, int, int, int]


class RestTree:
    """Bins by (rest, bin) in a treap: balanced by hashed priorities, so reruns agree."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None  # [key, priority, left, right]

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return hash((key[1] * 0x9E3779B97F4A7C15 ^ key[0]) * 0xBF58476D1CE4E5B9 & 0x7FFFFFFFFFFFFFFF)

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            a, b = self._split(node[3], key)
            node[3] = a
            return node, b
        a, b = self._split(node[2], key)
        node[2] = b
        return a, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, rest: int, bin_: int) -> None:
        key = (rest, bin_)
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, [key, self._priority(key), None, None]), b)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the smallest (rest, bin) with rest >= size."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            a, b = self._split(self.root, best)
            _, b = self._split(b, (best[0], best[1] + 1))
            self.root = self._merge(a, b)
        return best


def best_fit_counts(counts: list[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[Run], int] | None:
    """Runs for (size, groups) with the largest size first, and how many bins there are; None if there would be more than `most`."""
    runs, tree, used = [], RestTree(), 0
    for size, n in counts:
        if size > capacity:
            raise ValueError(f"size {size} exceeds the capacity {capacity}")
        rank = 0
        while rank < n:
            found = tree.take_tightest(size)
            if found is None:
                if used == most:
                    return None
                found, used = (capacity, used), used + 1
            # a bin stays the tightest one while it takes groups of this size
            q = min(n - rank, found[0] // size) if size else n - rank
            runs.append((size, rank, q, found[1]))
            rank += q
            tree.add(found[0] - q * size, found[1])
    return runs, used


def shard_counts(counts: dict[int, int], shards: int) -> list[Run]:
    """Runs over the bins 0 to shards - 1 at the least capacity found at which best fit needs no more bins.

    A group beyond an even share takes a bin alone; the rest share the other bins evenly.
    """
    left, total, runs = dict(sorted(counts.items(), reverse=True)), sum(s * n for s, n in counts.items()), []
    while left and len(runs) < shards - 1:
        size = next(iter(left))
        if not size * (shards - len(runs)) >= total > 0:
            break
        runs.append((size, counts[size] - left[size], 1, len(runs)))
        total -= size
        left[size] -= 1
        if not left[size]:
            del left[size]
    if not left:
        return runs
    alone, bins = len(runs), shards - len(runs)
    taken = {size: counts[size] - n for size, n in left.items()}  # only the largest size left can have some
    least = max(-(-total // bins), next(iter(left)))
    step, grown = max(1, total // bins >> 14), 0
    while (found := best_fit_counts(list(left.items()), least + grown, bins)) is None:
        grown = grown * 2 or step
    return runs + [(size, rank + taken[size], n, alone + b) for size, rank, n, b in found[0]]


def _by_item(sizes: list[int], runs: list[Run]) -> list[int]:
    """The bin of each of the sizes; of equal ones, the first has rank 0."""
    places: dict[int, list[int]] = {}
    for size, _, n, b in sorted(runs):
        places.setdefault(size, []).extend([b] * n)
    nth: Counter = Counter()
    out = []
    for size in sizes:
        out.append(places[size][nth[size]])
        nth[size] += 1
    return out


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each size, and how many bins there are. No size may exceed capacity."""
    runs, used = best_fit_counts(sorted(Counter(sizes).items(), reverse=True), capacity)
    return _by_item(sizes, runs), used


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size; see shard_counts."""
    return _by_item(sizes, shard_counts(Counter(sizes), shards))


def rounded(size: Column) -> Column:
    """The size, rounded up to DIGITS binary digits."""
    shift = F.greatest(F.length(F.bin(size)) - DIGITS, F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.call_function("shiftleft", F.call_function("shiftright", size + unit - 1, shift), shift)


def numbered(rows: DataFrame, n: int, group: str, key: str, *order: str) -> DataFrame:
    """rows with `rank` (from 0) among those of their group, counted in parts by hash of the key, so that a large group isn't one task's."""
    parts = max(PARTS, n // PER_PART)
    parted = rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    counts = parted.groupBy(group, "part").agg(F.count(F.lit(1)).alias("held"))
    before = F.coalesce(F.sum("held").over(W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(W.partitionBy(group, "part").orderBy(*order)) - 1
    out = parted.withColumn("within", within).join(counts.select(group, "part", before.alias("before")), [group, "part"])
    return out.withColumn("rank", (F.col("within") + F.col("before")).cast("long")).drop("part", "within", "before")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", per_shard: int = PER_SHARD) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus 8; a null text counts as empty and is in one group
    with empty texts. Equal texts share a shard; shards have near equal bytes (law 'bytes')
    as far as groups can be kept whole. slot numbers a shard's rows without gaps, in parts by
    hash of the id, there by id, checksum and size; rows repeated entirely get distinct slots.
    grown_shard is null. Empty table: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("g"),
        )
    )
    groups = materialize(rows.groupBy("g").agg(F.sum("size").alias("held")).withColumn("class", rounded(F.col("held"))))
    counts = {r[0]: r[1] for r in groups.groupBy("class").agg(F.count(F.lit(1))).collect()}  # bounded by DIGITS
    sums = groups.agg(F.count(F.lit(1)), F.sum("held")).first()
    runs = spark.createDataFrame(shard_counts(counts, shards), "class long, first long, n long, shard int")
    ranked = numbered(groups, sums[0], "class", "g", "g").join(F.broadcast(runs), "class")
    ranked = materialize(ranked.filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))).select("g", "held", "shard"))
    # rows of groups that may be large find their shard where they stand; the others' groups are small
    large = F.col("held") > (sums[1] or 0) // (shards * per_shard)
    near = rows.join(F.broadcast(ranked.filter(large).select("g", "shard")), "g", "left")  # fewer than shards * per_shard
    far = near.filter("shard is null").drop("shard").join(ranked.filter(~large).select("g", "shard"), "g")
    placed = near.filter("shard is not null").unionByName(far).drop("g")
    n = rows.count()
    placed = numbered(placed, n, "shard", "doc_id", "doc_id", "text_crc32", "size")
    return placed.select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
