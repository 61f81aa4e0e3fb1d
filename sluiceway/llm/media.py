"""Media columns: text payloads as 8-bit samples in a content-defined chunk store.

A rolling gear hash cuts each payload where its last 32 bytes say so, hence equal passages
give equal chunks wherever they stand. Spark joins on chunk digests find the chunks that are
used more than once. The store keeps, once per distinct text, the ordered list of its chunk
digests with the bytes of its own chunks, and once per shared chunk its bytes. Reading puts
each medium together from its list and verifies every chunk and the whole by their digests. Only digests and
shared chunks are shuffled for that, besides one shuffle of compressed payloads.

The stored form of a medium is a WAV file: a RIFF header, which is the first chunk of its
list, then the payload as mono samples of 8 bits. Parquet compresses the bytes of many media
together, which takes less room than each by itself.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import blocks, materialize, release, scratch

UNIT = 192
RATE = 8000
LEAST_CHUNK, MOST_CHUNK, CHUNK_BITS = 512, 8192, 11
DIGEST = 16
#: One 32-bit number per byte value, by the rule of hashing it.
GEAR = np.array([int.from_bytes(hashlib.sha256(b"gear" + bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def as_payload(text: bytes) -> bytes:
    """The text with spaces up to a positive multiple of UNIT bytes."""
    return text + b" " * (-len(text) % UNIT if text else UNIT)


def wav_header(n: int) -> bytes:
    """RIFF header of n 8-bit mono samples (n is even, so no byte of padding follows them)."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n & 0xFFFFFFFF)


def cuts(payloads: list[bytes]) -> list[list[int]]:
    """For each payload, the ends of its chunks."""
    h = GEAR[np.frombuffer(b"".join(payloads), np.uint8)]
    for k in (1, 2, 4, 8, 16):  # after these, h[i] is the sum of GEAR[byte i - j] << j over j < 32
        h[k:] += h[:-k] << np.uint32(k)
    marks = (np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1).tolist()
    out, begin = [], 0
    for p in payloads:
        ends, at, end = [], begin, begin + len(p)
        while end - at > LEAST_CHUNK:
            # LEAST_CHUNK exceeds the hash's window, so only this payload's bytes decide
            i = bisect_left(marks, at + LEAST_CHUNK)
            at = min(marks[i] if i < len(marks) else end, at + MOST_CHUNK, end)
            ends.append(at - begin)
        if not ends or ends[-1] < len(p):
            ends.append(len(p))
        out.append(ends)
        begin = end
    return out


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:DIGEST]


def _distinct(batch: pa.RecordBatch) -> dict[bytes, bytes]:
    """Payloads by the digest of their text."""
    texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
    return {digest(t): t for t in texts}


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        texts = _distinct(batch)
        payloads = [as_payload(t) for t in texts.values()]
        out: tuple[list, list, list] = ([], [], [])
        for key, payload, ends in zip(texts, payloads, cuts(payloads), strict=True):
            for seq, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                out[0].append(digest(payload[a:b]))
                out[1].append(key)
                out[2].append(seq)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int32())], names=["d", "key", "seq"])


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=6).compress
    for batch in blocks(batches):
        texts = _distinct(batch)
        yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array([len(t) for t in texts.values()], pa.int64()), pa.array([zip_(as_payload(t)) for t in texts.values()], pa.binary())], names=["key", "n_bytes", "data"])


STORE = "kind int, key binary, n_bytes long, digests array<binary>, lengths array<int>, away array<int>, data binary"
_ARROW = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("n_bytes", pa.int64()), ("digests", pa.list_(pa.binary())), ("lengths", pa.list_(pa.int32())), ("away", pa.list_(pa.int32())), ("data", pa.binary())])


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a text's list of chunks and the bytes of those not `away`. Kind 1: a shared chunk. Chunk 0 is the header."""
    unzip = zstandard.ZstdDecompressor().decompress
    for batch in blocks(batches, "data", 1 << 20):
        rows, out = batch.to_pylist(), []
        payloads = [unzip(r["data"]) for r in rows]
        for r, payload, ends in zip(rows, payloads, cuts(payloads), strict=True):
            parts = [wav_header(len(payload)), *(payload[a:b] for a, b in zip([0, *ends], ends, strict=False))]
            shared = {u["seq"] + 1: u["own"] for u in r["uses"] or ()}
            digests = [digest(p) for p in parts]
            data = b"".join(p for i, p in enumerate(parts) if i not in shared)
            out.append((0, r["key"], r["n_bytes"], digests, list(map(len, parts)), sorted(shared), data))
            out += [(1, digests[i], None, None, None, None, parts[i]) for i, own in shared.items() if own]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def write_store(docs: DataFrame, path: str, text_col: str) -> DataFrame:
    """Stores the distinct payloads under path; the table of the store (STORE)."""
    texts = docs.select(F.col(text_col).alias("text"))
    chunks = materialize(texts.mapInArrow(_chunked, "d binary, key binary, seq int").distinct())
    owners = chunks.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "seq")).alias("owner")).filter("n > 1")
    uses = chunks.join(owners, "d").select("key", F.struct("seq", (F.struct("key", "seq") == F.col("owner")).alias("own")).alias("use"))
    uses = materialize(uses.groupBy("key").agg(F.collect_list("use").alias("uses")))  # a text's chunks at most
    release(docs.sparkSession, chunks)
    payloads = texts.mapInArrow(_compressed, "key binary, n_bytes long, data binary")
    payloads = payloads.groupBy("key").agg(F.first("n_bytes").alias("n_bytes"), F.first("data").alias("data"))
    payloads.join(uses, "key", "left").mapInArrow(_stored, STORE).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    release(docs.sparkSession, uses)  # and the payloads' shuffle
    return docs.sparkSession.read.schema(STORE).parquet(path)


def feature(samples: np.ndarray) -> str:
    """Level and roughness of 8-bit samples around 128, in whole numbers, so that reruns agree."""
    s = samples.astype(np.int32) - 128
    return f"n={len(s)};sum={int(s.sum())};energy={int((s.astype(np.int64) ** 2).sum())};crossings={int(np.count_nonzero((s[1:] < 0) != (s[:-1] < 0)))}"


MEDIA = "key binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_MEDIA_ARROW = pa.schema([("key", pa.binary()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def assemble(key: bytes, n_bytes: int, own: bytes, digests: list[bytes], lengths: list[int], away: dict[int, bytes]) -> bytes:
    """The medium of an ordered chunk list.

    Raises where a chunk isn't what its digest says, or the whole isn't the medium of the text of that key.
    """
    parts, at = [], 0
    for i, (d, n) in enumerate(zip(digests, lengths, strict=True)):
        if i in away:
            part = away[i]
        else:
            part, at = own[at : at + n], at + n
        if len(part) != n or digest(part) != d:
            raise ValueError(f"chunk {d.hex()} is damaged")
        parts.append(part)
    payload = b"".join(parts[1:])
    if digest(payload[:n_bytes]) != key or as_payload(payload[:n_bytes]) != payload or parts[0] != wav_header(len(payload)):
        raise ValueError(f"the list of {key.hex()} is damaged")
    return parts[0] + payload


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "data", 2 << 20):
        out = []
        for r in batch.to_pylist():
            away = {p["seq"]: p["data"] for p in r.get("parts") or ()}
            medium = assemble(r["key"], r["n_bytes"], r["data"], r["digests"], r["lengths"], away)
            payload = medium[r["lengths"][0] :]
            out.append((r["key"], r["n_bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(medium), hashlib.sha256(medium).hexdigest(), feature(np.frombuffer(payload, np.uint8))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _MEDIA_ARROW.types, strict=True)], schema=_MEDIA_ARROW)


def read_store(store: DataFrame) -> DataFrame:
    """Features of every stored medium (MEDIA), from the bytes read back."""
    lists = store.filter("kind = 0").select("key", "n_bytes", "digests", "lengths", "away", "data")
    chunks = store.filter("kind = 1").select(F.col("key").alias("d"), F.col("data").alias("part"))
    whole = lists.filter(F.size("away") == 0)
    parted = lists.filter(F.size("away") > 0)
    wanted = parted.select("key", F.explode("away").alias("seq"), "digests").select("key", "seq", F.element_at("digests", F.col("seq") + 1).alias("d"))
    parts = wanted.join(chunks, "d").groupBy("key").agg(F.collect_list(F.struct("seq", F.col("part").alias("data"))).alias("parts"))
    return whole.drop("away").mapInArrow(_read, MEDIA).unionByName(parted.drop("away").join(parts, "key").mapInArrow(_read, MEDIA))


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Stores every text as a medium and returns, per input row, what the stored bytes give.

    Columns: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature. A null text is an empty one: 192 spaces. Equal texts are stored
    once and have equal values; repeated rows stay repeated. Empty table: no rows. Other
    columns are ignored.
    """
    store = write_store(docs, path or scratch(docs.sparkSession), text_col)
    media = materialize(read_store(store))
    key = F.unhex(F.substring(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), 1, 2 * DIGEST))
    return docs.select(F.col(id_col).alias("doc_id"), key.alias("key")).join(media, "key").drop("key").withColumnRenamed("doc_id", id_col)
