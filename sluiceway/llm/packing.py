"""Packing documents into sequences: Martello-Toth dominance reduction, then best fit.

Lengths are integers up to the sequence length, so the whole instance is a histogram of at
most that many numbers, whatever the corpus. The reduction and the packing work on counts
("so many sequences of this content") in the driver; a piece finds its place by its rank
among the pieces of its length. Ranks are counted in salted parts, so that a length which a
third of all pieces share is not ordered in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.common import blocks, long_id, materialize
from sluiceway.llm.tokens import tokenizer_path, with_end, worker_tokenizer

RANK_PARTS = 256
#: Chunks that a worker keeps, and text bytes that it encodes at once: both small, for memory.
CACHED_CHUNKS, BLOCK = 600_000, 2 << 20

#: A pattern: [(length, times), ...] and the number of sequences of this content.
Pattern = tuple[list[tuple[int, int]], int]


class Stock:
    """A multiset of lengths as counts, with the distinct lengths in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {s: n for s, n in counts.items() if n}
        self.sizes = sorted(self.counts)

    def take(self, items: list[int], times: int) -> None:
        for s in items:
            self.counts[s] -= times
            if not self.counts[s]:
                del self.counts[s]
                self.sizes.pop(bisect_left(self.sizes, s))

    def times(self, items: list[int]) -> int:
        """How often the items can be taken together."""
        return min(self.counts.get(s, 0) // items.count(s) for s in items)

    def largest(self, most: int, without: list[int]) -> int | None:
        """The largest length up to most that is left when `without` is taken."""
        for i in range(bisect_right(self.sizes, most) - 1, -1, -1):
            if self.counts[self.sizes[i]] > without.count(self.sizes[i]):
                return self.sizes[i]
        return None

    def smallest(self, n: int, without: list[int], above: int = 0) -> list[int]:
        """The n smallest lengths over `above` that are left when `without` is taken, or fewer."""
        out: list[int] = []
        for i in range(bisect_right(self.sizes, above), len(self.sizes)):
            s = self.sizes[i]
            out += [s] * min(n - len(out), self.counts[s] - without.count(s))
            if len(out) == n:
                break
        return out


def reduce_by_dominance(stock: Stock, capacity: int) -> list[Pattern]:
    """Takes from the stock the sequences that some best packing is sure to contain.

    For a length s, a set {s, ...} of up to three items is fixed when it dominates every
    other feasible set with s: the others' items can be dealt to its items so that each
    share fits into the item that stands for it (Martello and Toth).
    """
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for s in sorted(stock.sizes, reverse=True):
            while stock.counts.get(s):
                rest = capacity - s
                k = stock.largest(rest, [s])
                if k is None:
                    chosen = [s]
                else:
                    low = stock.smallest(3, [s])
                    if k == rest or len(low) < 2 or low[0] + low[1] > rest:
                        chosen = [s, k]
                    elif len(low) < 3 or sum(low) > rest:  # two more items at most
                        b = stock.largest(rest - k, [s, k])
                        pair = [] if b is None else stock.smallest(2, [s], above=b)
                        if b is None or len(pair) == 2 and sum(pair) <= rest:
                            break  # a pair with both items over b isn't dominated
                        chosen = [s, k, b]
                    else:
                        break
                times = stock.times(chosen)
                stock.take(chosen, times)
                fixed.append(([(x, 1) for x in chosen], times))
                changed = True
    return fixed


def best_fit(stock: Stock, capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counts; the same sequences as piece by piece."""
    groups: dict[int, list[list]] = {}  # rest -> [[content, sequences], ...]
    rests: list[int] = []

    def put(rest: int, content: list[tuple[int, int]], n: int) -> None:
        if n:
            if rest not in groups:
                groups[rest] = []
                insort(rests, rest)
            groups[rest].append([content, n])

    for s in reversed(stock.sizes):
        n = stock.counts[s]
        while n:
            i = bisect_left(rests, s)
            if i == len(rests):
                q = capacity // s
                put(capacity - q * s, [(s, q)], n // q)
                put(capacity - n % q * s, [(s, n % q)], 1 if n % q else 0)
                break
            rest = rests[i]
            content, m = groups[rest].pop()
            if not groups[rest]:
                del groups[rest]
                rests.pop(i)
            q = rest // s
            full = min(m, n // q)
            put(rest - q * s, [*content, (s, q)], full)
            n, m = n - full * q, m - full
            if m and n:
                put(rest - n * s, [*content, (s, n)], 1)
                n, m = 0, m - 1
            put(rest, content, m)
    return [(content, n) for rest in rests for content, n in groups[rest]]


def pack_counts(counts: dict[int, int], capacity: int) -> list[Pattern]:
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("lengths must be 1 to the capacity")
    stock = Stock(counts)
    fixed = reduce_by_dominance(stock, capacity)
    return fixed + best_fit(stock, capacity)


def placement(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, times, first sequence, offset), ordered by length and rank.

    A piece of that length and rank first + k goes to sequence first + k // times, at
    offset + k % times * length.
    """
    rows, sequence, ranks = [], 0, {}
    for content, n in patterns:
        offset = 0
        for size, times in content:
            rank = ranks.get(size, 0)
            rows.append((size, rank, times, sequence, offset))
            ranks[size] = rank + n * times
            offset += size * times
        sequence += n
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(docs: DataFrame, tokenizer: str, kind: str, end: int, capacity: int, id_col: str, text_col: str, special_as_text: bool = False) -> DataFrame:
    """A row per piece (PIECES). Only texts longer than the capacity are cut."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = worker_tokenizer(tokenizer_path(tokenizer), kind, CACHED_CHUNKS, special_as_text)
        for batch in blocks(batches, limit=BLOCK):
            ids, lengths = with_end(*tk.encode(batch.column(1)), end)
            data = memoryview(ids.astype("<u4")).cast("B")
            n = -(-lengths // capacity)
            row = np.repeat(np.arange(len(lengths)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, lengths[row] - start)
            first = 4 * ((np.cumsum(lengths) - lengths)[row] + start)
            crc = [zlib.crc32(data[a:b]) for a, b in zip(first.tolist(), (first + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(long_id(docs, id_col), F.col(text_col).alias("text")).mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", kind: str = "spaceless", end: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    special_as_text: whether a special token's string in a text is ordinary text; if not, it is
    that token, as the tokenizers library has it. Ids must be integers (else TypeError).

    A null or empty text is one piece with the end id alone. Only documents longer than the
    capacity are cut, into full pieces and a last one. Rows repeated entirely are packed each
    for itself; equal lengths are interchangeable, and which piece takes which place follows
    a hash of the id. Empty table: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = materialize(tokenize_pieces(docs, tokenizer, kind, end, capacity, id_col, text_col, special_as_text))
    counts = dict(map(tuple, pieces.groupBy("length").agg(F.count(F.lit(1))).collect()))  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(placement(pack_counts(counts, capacity)))  # bounded by the lengths, not by the corpus
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_PARTS)).cast("int"))
    held = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("held"))
    before = F.coalesce(F.sum("held").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = parted.withColumn("within", within).join(held.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("within") + F.col("before")).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        order = rows[:, 0] << 48 | rows[:, 1]
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = rows[np.searchsorted(order, length << 48 | rank, "right") - 1] if len(rank) else rows[:0]
            k = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(at[:, 3] + k // at[:, 2]), pa.array(at[:, 4] + k % at[:, 2] * length)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    out = ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)
