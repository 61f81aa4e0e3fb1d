"""Token-id files compressed with Re-Pair grammars.

A shard is a run of whole documents in ascending id order. In each shard, frequent pairs of
neighbouring ids are replaced by nonterminals, round after round, until no pair occurs LEAST
times; pairs never cross the end of a document. A shard stores its rules, the length of each rule's expansion, and where
each document's symbols begin, so one document is decoded without its neighbours.

Layout of a shard (little-endian): magic, then uint64 counts (documents, symbols, rules,
base), then zstd frames, each after its uint64 length: document ids (int64, and a byte each
that is 1 for null), symbols per document (uint32), ids per document (uint32), rule sides
(uint32, left then right), expansion lengths (uint32), symbols (uint16, or uint32 if the
base and the rules need it). Shards are stored as rows of a Parquet table, so any file
system that Spark knows can hold them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.common import blocks, long_id, scratch
from sluiceway.llm.tokens import gather, tokenizer_path, with_end, worker_tokenizer

MAGIC = b"SLWYRP01"
#: A pair that occurs less often in a shard is not replaced: its rule would take more room than it saves.
LEAST = 16
#: A round replaces the pairs that occur at least 1 / TOGETHER as often as the most frequent one.
TOGETHER = 4
#: Binary digits of the hash by which pairs are counted before those that may be frequent are sorted.
PAIR_BITS = 20


def _frequent_pairs(seq: np.ndarray, last: np.ndarray, known: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int] | None:
    """(places of pairs that may be frequent, the distinct ones, which of these each is, their counts, the threshold); None if no pair occurs `least` times.

    A pair is no more frequent than its hash, so only places whose hash is frequent are sorted; all pairs are counted.
    """
    h = seq.view(np.uint32)
    hashed = (h[:-1] * np.uint32(0x9E3779B1) + h[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - PAIR_BITS)
    hashed[last[:-1]] = 1 << PAIR_BITS
    counts = np.bincount(hashed, minlength=(1 << PAIR_BITS) + 1)
    counts[-1] = 0
    most = int(counts.max())
    while most >= least:
        threshold = max(least, most // TOGETHER)
        at = np.flatnonzero((counts >= threshold)[hashed])
        pairs, which, n = np.unique(seq[at].astype(np.int64) * known + seq[at + 1], return_inverse=True, return_counts=True)
        most = int(n.max())
        if most >= threshold:
            return at, pairs, which, n, max(least, most // TOGETHER)
    return None


def _apart(hits: np.ndarray) -> np.ndarray:
    """Which of the ascending places to replace: of overlapping pairs, every other one from the left."""
    where = np.arange(len(hits))
    begins = np.where(np.diff(hits, prepend=-2) != 1, where, 0)
    return (where - np.maximum.accumulate(begins)) % 2 == 0


def re_pair(ids: np.ndarray, lengths: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbols per document, rules as rows of two symbols); rule i is symbol base + i.

    In the result no pair of neighbours within a document occurs `least` times (2 at least).
    Pairs of a round that are rarely replaced, since they overlap others, wait for a later one;
    if all are, the most frequent pair is replaced alone.
    """
    seq = ids.astype(np.int32)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    rules: list[np.ndarray] = []
    known = base
    while len(seq) > 1 and (found := _frequent_pairs(seq, last, known, max(least, 2))):
        at, pairs, which, n, threshold = found
        for chosen in (n >= threshold, np.arange(len(n)) == n.argmax()):
            hit = chosen[which]
            hits, of = at[hit], which[hit]
            apart = _apart(hits)
            hits, of = hits[apart], of[apart]
            worth = np.bincount(of, minlength=len(pairs)) >= max(2, threshold // TOGETHER)
            if worth.any():
                break
        else:
            worth = chosen  # a pair that overlaps itself only, so at least one place is replaced
        name = np.where(worth, np.cumsum(worth) - 1 + known, -1)
        new = name[of]
        hits, new = hits[new >= 0], new[new >= 0]
        rules.append(np.stack([pairs[worth] // known, pairs[worth] % known], 1))
        known += int(worth.sum())
        seq[hits] = new
        last[hits] = last[hits + 1]
        kept = np.ones(len(seq), bool)
        kept[hits + 1] = False
        seq, last = seq[kept], last[kept]
    per_doc = np.zeros(len(lengths), np.int64)
    per_doc[lengths > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    return seq, per_doc, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, starts, lengths): the ids of every symbol, plain ids included."""
    flat, starts, lengths = [np.arange(base, dtype=np.uint32)], [np.arange(base)], [np.ones(base, np.int64)]
    done, have = 0, base
    while done < len(rules):
        # the rules whose sides are all known by now are expanded at once
        ready = int(np.searchsorted(np.maximum.accumulate(rules[done:].max(1)), have))
        all_flat, all_starts, all_lengths = np.concatenate(flat), np.concatenate(starts), np.concatenate(lengths)
        sides = rules[done : done + ready].ravel()
        flat, starts, lengths = [all_flat, gather(all_flat, all_starts[sides], all_lengths[sides])], [all_starts], [all_lengths]
        size = all_lengths[sides].reshape(-1, 2).sum(1)
        starts.append(len(all_flat) + np.cumsum(size) - size)
        lengths.append(size)
        done, have = done + ready, have + ready
    return np.concatenate(flat), np.concatenate(starts), np.concatenate(lengths)


def encode_shard(doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, lengths: np.ndarray, base: int) -> bytes:
    symbols, per_doc, rules = re_pair(ids, lengths, base)
    sizes = expansions(rules, base)[2][base:]
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    zip_ = zstandard.ZstdCompressor(level=1).compress
    parts = [doc_ids.astype("<i8"), nulls.astype("u1"), per_doc.astype("<u4"), lengths.astype("<u4"), rules.astype("<u4"), sizes.astype("<u4"), symbols.astype(kind)]
    frames = [zip_(p.tobytes()) for p in parts]
    return b"".join([MAGIC, struct.pack("<4Q", len(doc_ids), len(symbols), len(rules), base), *(struct.pack("<Q", len(f)) + f for f in frames)])


class Shard:
    """Reads a stored shard; decode(i) gives one document's ids, all() those of every document."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        n, _, rules, self.base = struct.unpack_from("<4Q", data, 8)
        at, parts = 40, []
        for kind in ("<i8", "u1", "<u4", "<u4", "<u4", "<u4", "<u2" if self.base + rules <= 1 << 16 else "<u4"):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size]), kind))
            at += 8 + size
        self.doc_ids, nulls, per_doc, lengths, rules, self.sizes, self.symbols = parts
        self.nulls, self.lengths, self.rules = nulls.astype(bool), lengths.astype(np.int64), rules.reshape(-1, 2).astype(np.int64)
        self.borders = np.append(0, np.cumsum(per_doc, dtype=np.int64))

    def decode(self, i: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start to end of document i; symbols outside of them are skipped by their lengths."""
        end = int(self.lengths[i]) if end is None else end
        out: list[int] = []
        at = 0
        for symbol in self.symbols[self.borders[i] : self.borders[i + 1]].tolist():
            stack = [symbol]
            while stack:
                s = stack.pop()
                size = 1 if s < self.base else int(self.sizes[s - self.base])
                if at + size <= start or at >= end:
                    at += size
                elif s < self.base:
                    out.append(s)
                    at += 1
                else:
                    left, right = self.rules[s - self.base]
                    stack += [int(right), int(left)]
        return np.array(out, np.uint32)

    def all(self) -> np.ndarray:
        flat, starts, lengths = expansions(self.rules, self.base)
        return gather(flat, starts[self.symbols], lengths[self.symbols])


SHARDS = "part int, block int, n_docs long, n_ids long, data binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, kind: str, end: int, id_col: str, text_col: str, special_as_text: bool = False) -> DataFrame:
    """Tokenizes the documents in ascending id order into shards under path; the table of shards.

    One document that is longer than a block makes a shard alone. Null ids come first.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = worker_tokenizer(tokenizer_path(tokenizer), kind, special_as_text=special_as_text)
        base, part = tk.tokenizer.get_vocab_size(), TaskContext.get().partitionId()
        for i, batch in enumerate(blocks(batches)):
            ids, lengths = with_end(*tk.encode(batch.column(1)), end)
            key = batch.column(0)
            data = encode_shard(key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), ids, lengths, base)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([i], pa.int32()), "n_docs": [batch.num_rows], "n_ids": [len(ids)], "data": pa.array([data], pa.binary())})

    rows = docs.select(long_id(docs, id_col), F.col(text_col).alias("text"))
    # ties of the id are ordered by the text, so that every run writes the same shards; one id or row may fill many tasks
    order = ("doc_id", "crc", "r")
    rows = rows.withColumns({"crc": F.crc32(F.coalesce("text", F.lit(""))), "r": F.monotonically_increasing_id()})
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(encode, SHARDS).write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(SHARDS).parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document, from the stored bytes: part, block, doc_id, start (in its shard), n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column(2)[row].as_py())
                ids = memoryview(shard.all().astype("<u4")).cast("B")
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(c)[row].as_py(), np.int32)) for c in (0, 1)] + [pa.array(shard.doc_ids.astype(np.int64), mask=shard.nulls), pa.array(starts), pa.array(shard.lengths), pa.array(crc, pa.int64())],
                    names=["part", "block", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.select("part", "block", "data").mapInArrow(decode, "part int, block int, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", kind: str = "byte_level", end: int = 2, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, special_as_text: bool = False) -> DataFrame:
    """Writes the documents' ids and returns, from the files: id, start, n_tokens, ids_crc32.

    special_as_text: whether a special token's string in a text is ordinary text; if not, it is
    that token, as the tokenizers library has it. Ids must be integers (else TypeError).

    A null text is empty: it has the end id alone. Repeated ids follow each other, ordered
    by a checksum of the text. Empty table: no rows. Other columns are ignored.
    """
    shards = write_shards(docs, path or scratch(docs.sparkSession), tokenizer, kind, end, id_col, text_col, special_as_text)
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("held"))  # a row per writing task
    parts = sums.select("part", F.coalesce(F.sum("held").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = shards.select("part", "block", within.alias("within")).join(parts, "part").select("part", "block", (F.col("within") + F.col("before")).alias("offset"))
    return read_shards(shards).join(offsets, ["part", "block"]).select(F.col("doc_id").alias(id_col), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
