"""Blocks of documents and the exchange of n-gram statistics between blocks and shards.

Counting n-grams as rows would shuffle every n-gram of the corpus with a row's overhead.
Here each block of documents sends a shard the sorted distinct n-grams of that shard's part
of the hash range as one packed array, and gets back an array in the same order. A block is
a written row, so that it has the same content each time it is read.

A block sends 2**FAN rows at most. With more shards, a row goes to a range of shards, and a
relay puts the rows of many blocks for one range together and sorts them by shard, so that
the rows of an exchange grow with the input and not with its square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import SPACES, blocks, give_back, long_id, materialize

BLOCKS = "block long, doc_ids array<long>, marks array<long>, sizes array<int>, n_bytes long, text binary"
#: Text bytes hashed at once.
HASHED = 1 << 20
#: Distinct n-grams that a shard is meant to get from all blocks.
PER_SHARD = 1 << 20
#: Binary digits of the shards that one shuffle of an exchange tells apart. Two shuffles tell all 24 apart.
FAN = 12

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def pack_numbers(a: np.ndarray) -> bytes:
    """32-bit numbers, their first bytes together, then their second ones, and so on, which packs better."""
    return pack(a.astype("<u4").view("u1").reshape(-1, 4).T)


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(data, "u1").reshape(4, -1).T).view("<u4").ravel()


#: How numbers of 32 bits that pack_numbers packed are named among the kinds of arrays.
NUMBERS = "numbers"


def _pack(a: np.ndarray, kind: str) -> bytes:
    return pack_numbers(a) if kind == NUMBERS else pack(a.astype(kind))


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return unpack_numbers(data) if kind == NUMBERS else unpack(data, kind)


@dataclass(frozen=True)
class Layout:
    """The packed columns of an exchange.

    levels: the kinds of a request's columns by level; entries of a level belong to those of the
    level before, whose column in `below` says how many each has. answers: (level, kind) of an
    answer's columns, which have an entry for each of the level's.
    """

    levels: tuple[dict[str, str], ...]
    below: tuple[str, ...]
    answers: dict[str, tuple[int, str]]


def _levels(requests: pd.DataFrame, layout: Layout) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Of rows for one range of shards: the shards that occur, and for each level the order of its entries by shard,
    where each row's entries start before that, and where each shard's start after it, both with the end."""
    parts = [unpack_numbers(x) for x in requests["shards"]]
    shards = np.concatenate(parts)
    order = np.argsort(shards, kind="stable")
    rows, starts = np.unique(shards[order], return_index=True)
    out = [(order, np.cumsum([0, *map(len, parts)]), np.append(starts, len(shards)))]
    for name, level in zip(layout.below, layout.levels, strict=False):
        order, ends, cuts = out[-1]
        counts = np.concatenate([_unpack(x, level[name]) for x in requests[name]]).astype(np.int64)
        shards = np.repeat(shards, counts)
        upto = lambda c, at: np.append(0, np.cumsum(c))[at]
        out.append((np.argsort(shards, kind="stable"), upto(counts, ends), upto(counts[order], cuts)))
    return rows, out


def exchange(requests: DataFrame, bits: int, layout: Layout, answer: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The answers to all requests (shard int, block long, shards binary, and the layout's columns).

    A request is for the shard whose first digits are `shard`, min(bits, FAN) of them; `shards` has
    the whole shard of each entry of the first level, in ascending order, where that is not all of
    them. `answer` gets all rows of one whole shard and returns a row for each, in the schema, and
    rows of a negative block that only speak of the shard. The result has an answer for each request,
    under its shard, and those rows.
    """
    if bits <= FAN:
        return requests.groupBy("shard").applyInPandas(answer, schema)
    columns = {c: (i, kind) for i, level in enumerate(layout.levels) for c, kind in level.items()}
    requests = materialize(requests, "none")
    groups = max(1, requests.count() >> 2 * FAN)  # of blocks: 2**FAN blocks with 2**FAN rows each
    grouped = requests.withColumn("bundle", F.pmod(F.xxhash64("block"), F.lit(groups)))

    def forward(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        rows, levels = _levels(pdf, layout)
        out = {"shard": rows.astype(np.int32), "block": np.full(len(rows), key[1], np.int64)}
        for name, (i, kind) in columns.items():
            order, _, cuts = levels[i]
            values = np.concatenate([_unpack(x, kind) for x in pdf[name]])[order]
            out[name] = [_pack(values[a:b], kind) for a, b in zip(cuts, cuts[1:], strict=False)]
        give_back()
        return pd.DataFrame(out)

    def back(asked: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            raise AssertionError("answers without requests")
        asked, got = asked.sort_values("block"), got.sort_values("whole")
        _, levels = _levels(asked, layout)
        out = dict.fromkeys(names) | {"shard": asked["shard"].to_numpy(), "block": asked["block"].to_numpy()}
        for name, (i, kind) in layout.answers.items():
            order, ends, _ = levels[i]
            values = np.empty(len(order), "<u4" if kind == NUMBERS else kind)
            values[order] = np.concatenate([_unpack(x, kind) for x in got[name]])
            out[name] = [_pack(values[a:b], kind) for a, b in zip(ends, ends[1:], strict=False)]
        give_back()
        return pd.DataFrame(out)

    passed = grouped.groupBy("shard", "bundle").applyInPandas(forward, "shard int, block long, " + ", ".join(f"{c} binary" for c in columns))
    answers = materialize(passed.groupBy("shard").applyInPandas(answer, schema), "none")
    names = answers.columns
    first = F.shiftright("shard", bits - FAN)
    ranges = answers.filter("block >= 0").withColumns({"whole": F.col("shard"), "shard": first})
    returned = grouped.groupBy("shard", "bundle").cogroup(ranges.groupBy("shard", "block")).applyInPandas(back, schema)
    return returned.unionByName(answers.filter("block < 0"))


def write_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """The documents as written blocks of at most common.BLOCK_BYTES of text, or one document. mark: a long kept for each."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        zip_ = zstandard.ZstdCompressor(level=3).compress
        for i, batch in enumerate(blocks(batches)):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = list(map(len, texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + i]), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([batch.column(2).to_pylist()], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([sum(sizes)]), pa.array([zip_(b"".join(texts))], pa.binary())],
                names=["block", "doc_ids", "marks", "sizes", "n_bytes", "text"],
            )

    rows = docs.select(long_id(docs, id_col), F.col(text_col).alias("text"), (F.lit(0).cast("long") if mark is None else mark).alias("mark"))
    return materialize(rows.mapInArrow(put, BLOCKS), "none")


def block_texts(row: dict) -> list[bytes]:
    data, out, at = zstandard.ZstdDecompressor().decompress(row["text"]), [], 0
    for n in row["sizes"]:
        out.append(data[at : at + n])
        at += n
    return out


def shard_bits(table: DataFrame) -> int:
    """Binary digits of the number of shards, 6 to 24, from the bytes of all blocks (a word has about 6): up to 100 TB, a shard gets about PER_SHARD."""
    n = table.agg(F.sum("n_bytes")).first()[0] or 0
    return min(24, max(6, (n // 6 // PER_SHARD).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n + 1, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of other characters than SPACES, A-Z in lower case), and words in each text."""
    out, counts, i = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= HASHED):
            held += len(texts[j]) + 1
            j += 1
        data = np.frombuffer(b" ".join(texts[i:j]).translate(_LOWER) + b" ", np.uint8)
        space = _SPACE[data]
        change = np.flatnonzero(np.diff(space, prepend=True))
        starts, ends = change[::2], change[1::2]
        power, inverse = _powers(len(data))
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        borders = np.cumsum(np.fromiter(map(len, texts[i:j]), np.int64, j - i) + 1)
        counts.append(np.diff(np.searchsorted(starts, borders), prepend=0))
        i = j
    return np.concatenate(out), np.concatenate(counts)


def chain_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of sequences, from the hashes of their members in order."""
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + p)
    return h


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; of the whole sequence if it has fewer words."""
    words, counts = word_hashes(texts)
    n = len(words)
    all_ = chain_hashes([words[i : n - k + 1 + i] for i in range(k)]) if n >= k else words[:0]
    out, at = [], 0
    for c in counts.tolist():
        if c >= k:
            h = np.sort(all_[at : at + c - k + 1])
            out.append(h[np.append(True, h[1:] != h[:-1])])
        elif c:
            out.append(chain_hashes([words[at + i : at + i + 1] for i in range(c)]))
        else:
            out.append(words[:0])
        at += c
    return out


def by_shard(keys: np.ndarray, bits: int, fan: int) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Sorted 64-bit keys, whose first bits are their shard: see cut_shards."""
    return cut_shards((keys >> np.uint64(64 - bits)).astype(np.int64), bits, fan)


def cut_shards(shards: np.ndarray, bits: int, fan: int) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """The entries' sorted shards: the `shard` and `shards` of the requests for an exchange, and where each one's entries start, with the end."""
    first = shards >> max(bits - fan, 0)
    starts = np.flatnonzero(np.diff(first, prepend=-1))
    at = np.append(starts, len(shards))
    whole = [pack_numbers(shards[a:b]) for a, b in zip(at, at[1:], strict=False)] if bits > fan else [None] * len(starts)
    return first[starts], at, whole
