"""N-gram Jaccard join by prefix trees.

1. Every block of documents makes its shingle sets and learns, by an exchange with shards of
   the hash range, in how many sets each shingle is. That gives the global order: rarest
   first, then by hash. The counts are exact and cover the corpus.
2. A set of n shingles can only link with one that shares a shingle of its prefix, the first
   n - ceil(n * threshold) + 1 of the order. Shingles of one set only are left out, and with
   them most sets: only sets with a shared shingle in their prefix are kept.
3. Sets are verified in prefix trees, in units of bounded size. First each set is joined
   with a center of its prefix groups, the least edited set, in a few rounds, which connects
   groups of near copies without comparing all their pairs. Then the groups that still have
   unconnected sets are joined fully, large ones in pairs of blocks. Pairs that are
   connected already are passed over, so components are exact although not all links are
   listed.

A set's id is the first 64 bits of its digest: sets with equal ids count as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import give_back, join_by_key, materialize, pick_rows, release, row_hash, scratch
from sluiceway.llm.components import components
from sluiceway.llm import corpus_blocks
from sluiceway.llm.corpus_blocks import Layout, block_texts, by_shard, exchange, pack, shard_bits, shingle_sets, unpack, write_blocks
from sluiceway.llm.prefix_tree import connecting_links, links_with

#: Sets in a unit of the join, about.
UNIT = 256
#: Groups of more sets take part in the later rounds of centers, with so many centers each.
LARGE, CENTERS = 16, 6
#: Levels up to this one are exact counts of sets, later ones eighths of a doubling.
EXACT = 127


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.sha256(tokens.tobytes()).digest()[:8], "little", signed=True)


def to_levels(counts: np.ndarray) -> np.ndarray:
    high = EXACT + 1 + np.floor(8 * np.log2(np.maximum(counts, 1) / (EXACT + 1))).astype(np.int64)
    return np.minimum(np.where(counts <= EXACT, counts, high), 255).astype(np.uint8)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


REQUESTS = "shard int, block long, shards binary, keys binary, counts binary"
RESPONSES = "shard int, block long, levels binary"
LAYOUT = Layout(({"keys": "<u4", "counts": "<u4"},), (), {"levels": (0, "u1")})


def _distinct_sets(texts: list[bytes], k: int) -> tuple[list[int], dict[int, np.ndarray]]:
    sets = shingle_sets(texts, k)
    ids = [set_id(s) for s in sets]
    return ids, dict(zip(ids, sets, strict=True))


def _keys(sets: dict[int, np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, the first bits + 32 of the tokens, and how many of the sets have each."""
    every = np.sort(np.concatenate([np.zeros(0, np.uint64), *sets.values()])) >> np.uint64(32 - bits) << np.uint64(32 - bits)
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[starts], np.diff(np.append(starts, len(every)))


def shingle_levels(table: DataFrame, k: int, bits: int) -> DataFrame:
    """For each block and shard, or range of shards (RESPONSES), the levels of the block's keys there, in the keys' order."""
    fan = corpus_blocks.FAN

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _keys(_distinct_sets(block_texts(row), k)[1], bits)
                shards, at, whole = by_shard(keys, bits, fan)
                parts = list(zip(at, at[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shards, pa.int32()),
                        pa.array(np.full(len(shards), row["block"])),
                        pa.array(whole, pa.binary()),
                        pa.array([pack((keys[a:b] >> np.uint64(32 - bits)).astype("<u4")) for a, b in parts], pa.binary()),
                        pa.array([pack(counts[a:b].astype("<u4")) for a, b in parts], pa.binary()),
                    ],
                    names=["shard", "block", "shards", "keys", "counts"],
                )
                give_back()

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack(x, "<u4") for x in pdf["keys"]]
        known, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate([unpack(x, "<u4") for x in pdf["counts"]]), len(known))
        levels, ends = to_levels(totals)[inverse], np.cumsum([0, *map(len, asked)])
        return pdf[["shard", "block"]].assign(levels=[pack(levels[a:b]) for a, b in zip(ends, ends[1:], strict=False)])

    return exchange(table.select("block", "sizes", "text").mapInArrow(ask, REQUESTS), bits, LAYOUT, answer, RESPONSES)


#: kind 0: a document; kind 1: a shared token in a set's prefix, n is how common the set's
#: tokens are; kind 2: a set that has one, its shared tokens in `data` (64 bits each, then a
#: level each).
FOUND = "kind int, doc_id long, id long, n int, token long, data binary"  # token of a document: its row's hash
_FOUND = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("token", pa.int64()), ("data", pa.binary())])


def prefixes(table: DataFrame, levels: DataFrame, k: int, bits: int, num: int, den: int) -> DataFrame:
    """The documents, prefix tokens and sets of all blocks (FOUND)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = block_texts(row)
                ids, sets = _distinct_sets(texts, k)
                keys, _ = _keys(sets, bits)
                level = np.concatenate([np.zeros(0, np.uint8)] + [unpack(x["levels"], "u1") for x in sorted(row["parts"] or (), key=lambda x: x["shard"])])
                docs = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(ids), np.int32)), pa.array(row["doc_ids"], pa.int64()), pa.array(ids, pa.int64()), pa.array([len(sets[i]) for i in ids], pa.int32()), pa.array(row["marks"], pa.int64()), pa.nulls(len(ids), pa.binary())], schema=_FOUND)
                yield docs
                tokens, owners, commons, kept = [], [], [], []
                for i, s in sets.items():
                    own = level[np.searchsorted(keys, s >> np.uint64(32 - bits) << np.uint64(32 - bits))]
                    shared = np.flatnonzero(own > 1)
                    first = prefix_length(len(s), num, den) - (len(s) - len(shared))  # prefix tokens that others have
                    if not len(shared) or first <= 0:
                        continue
                    shared = shared[np.lexsort((s[shared], own[shared]))]
                    tokens.append(s[shared[:first]].view(np.int64))
                    owners.append(np.full(len(tokens[-1]), i, np.int64))
                    commons.append(np.full(len(tokens[-1]), int(own.mean() * 1000), np.int32))
                    kept.append((i, len(s), s[shared].tobytes() + own[shared].tobytes()))
                if kept:
                    t, o, common = np.concatenate(tokens), np.concatenate(owners), np.concatenate(commons)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(t), np.int32)), pa.nulls(len(t), pa.int64()), pa.array(o), pa.array(common), pa.array(t), pa.nulls(len(t), pa.binary())], schema=_FOUND)
                    n = len(kept)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, 2, np.int32)), pa.nulls(n, pa.int64()), pa.array([x[0] for x in kept], pa.int64()), pa.array([x[1] for x in kept], pa.int32()), pa.nulls(n, pa.int64()), pa.array([x[2] for x in kept], pa.binary())], schema=_FOUND)
                give_back()

    parts = levels.groupBy("block").agg(F.collect_list(F.struct("shard", "levels")).alias("parts"))  # a row per shard at most
    path = scratch(table.sparkSession)
    table.select("block", "doc_ids", "marks", "sizes", "text").join(parts, "block", "left").mapInArrow(find, FOUND).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(FOUND).parquet(path)


def _unpack_sets(pdf: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    tokens = [np.frombuffer(d, "<u8", len(d) // 9) for d in pdf["data"]]
    levels = [np.frombuffer(d, "u1", offset=len(d) // 9 * 8) for d in pdf["data"]]
    return tokens, levels, pdf["n"].tolist()


LINKS = "a long, b long"


def star_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (id, m) that link. A center m with many others is joined with UNIT of them at a time."""
    chunks = F.ceil(F.col("others") / UNIT)
    degrees = pairs.groupBy("m").agg(F.count(F.lit(1)).alias("others"))
    dealt = pairs.join(degrees, "m").select("m", F.pmod(F.xxhash64("id"), chunks).alias("chunk"), "id")
    centers = degrees.select("m", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), F.col("m").alias("id"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        center = np.flatnonzero(pdf["id"] == pdf["m"])
        if not len(center):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        found = links_with(int(center[0]), *_unpack_sets(pdf), num, den)
        return pd.DataFrame({"a": pdf["id"].iloc[found].to_numpy(np.int64), "b": np.full(len(found), pdf["m"].iloc[0], np.int64)})

    return dealt.unionByName(centers).join(sets, "id").groupBy("m", "chunk").applyInPandas(verify, LINKS)


def center_pairs(groups: DataFrame, classes: int = 1, seed: int = 0) -> DataFrame:
    """(id, m): each set with the centers of its groups, one in each hash class, that aren't in its component.

    A center is the set of its class whose tokens are the most common: of near copies, the
    least edited one, which links with most of the others. A set gets one center of a class,
    whatever the number of its groups.
    """
    dealt = groups.withColumn("class", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(classes)))
    best = F.min(F.struct((-F.col("common")).alias("common"), F.col("id").alias("id"), F.col("root").alias("root"))).alias("c")
    centers = dealt.groupBy("token", "class").agg(best, F.count(F.lit(1)).alias("held"))
    pairs = join_by_key(groups, materialize(centers), "token", "held").filter(F.col("root") != F.col("c.root"))
    return pairs.groupBy("id", "class").agg(F.min("c.id").alias("m")).select("id", "m").distinct()


def rest_links(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between sets of one token that aren't connected yet. groups: (token, id, root).

    Small groups that hang together by their sets are one unit, so each set is read once; where
    that would be too large, each group is a unit, and groups of the same sets are one. Of a
    large group, the sets outside its largest component ask, UNIT at a time, all of the group,
    UNIT at a time.
    """
    parts = materialize(groups.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n")))
    main = F.max(F.struct("n", "root"))
    split = materialize(parts.groupBy("token").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("roots"), main["root"].alias("main"), main["n"].alias("most")).filter("roots > 1"))
    small = materialize(groups.join(split.filter(F.col("held") <= UNIT).select("token"), "token").select("token", "id"))
    near = components(small.join(small.groupBy("token").agg(F.min("id").alias("b")), "token").select(F.col("id").alias("a"), "b"))
    cluster = rooted(small.select("id").distinct(), near).withColumnRenamed("root", "cluster")
    cluster = materialize(cluster.join(cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("held")), "cluster"))
    whole = cluster.filter(F.col("held") <= UNIT).select(F.concat_ws("|", F.lit("c"), "cluster").alias("unit"), "id")
    alike = small.join(cluster.filter(F.col("held") > UNIT).select("id"), "id").groupBy("token").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    alike = alike.select("ids").distinct().select(F.concat(F.lit("s"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)).alias("unit"), F.explode("ids").alias("id"))
    small = whole.unionByName(alike)
    asked, askers = F.ceil(F.col("held") / UNIT), F.ceil((F.col("held") - F.col("most")) / UNIT)
    large = groups.join(split.filter(F.col("held") > UNIT), "token").withColumns({"asked": asked, "askers": askers, "hash": F.xxhash64("id")})
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    near = large.withColumn("x", F.pmod("hash", "asked")).withColumn("y", every("askers"))
    far = large.filter("root <> main").withColumn("y", F.pmod("hash", "askers")).withColumn("x", every("asked"))
    large = near.unionByName(far).select(F.concat_ws("|", F.lit("l"), "token", "x", "y").alias("unit"), "id")
    roots = groups.select("id", "root").distinct()

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values("id").reset_index(drop=True)
        ids = pdf["id"].tolist()
        found = connecting_links(*_unpack_sets(pdf), pdf["root"].tolist(), num, den) if pdf["root"].nunique() > 1 else []
        return pd.DataFrame({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, dtype="int64")

    return small.unionByName(large).join(sets.join(roots, "id"), "id").groupBy("unit").applyInPandas(verify, LINKS)


def rooted(df: DataFrame, roots: DataFrame) -> DataFrame:
    """df with the root of each id, which is the id itself where it is linked with nothing."""
    return df.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", star_rounds: int = 4) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, row_hash (of all columns), kept (one row of each component).

    A text's set has its distinct shingles of k words (runs of other characters than
    [\\x20\\x09-\\x0D], A-Z in lower case), or the whole sequence of fewer words; a null text
    or one without words has an empty set, linked with nothing, and is a component alone.
    Two rows link when den * intersection >= num * union. component_id is the smallest id
    that links reach (null only if all are); its row is kept, or of several that with the
    smallest row_hash (of rows repeated entirely, all of these). Equal sets link; repeated ids are one component only if their sets
    say so, but share the id. Empty table: no rows. Other columns only count
    in the row_hash. Ids must be integers (else TypeError).
    """
    table = write_blocks(docs, id_col, text_col, row_hash(docs))
    bits = shard_bits(table)
    found = prefixes(table, shingle_levels(table, k, bits), k, bits, num, den)
    release(docs.sparkSession, table)
    base = found.filter("kind = 0").select("doc_id", "id", "n", F.col("token").alias("hash"))
    prefix = found.filter("kind = 1").select("token", "id", F.col("n").alias("common"))
    shared = materialize(prefix.groupBy("token").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("held")).filter("least < most").select("token", "held"))
    groups = materialize(join_by_key(prefix, shared, "token", "held").drop("held").distinct())
    sets = found.filter("kind = 2").select("id", "n", "data").join(groups.select("id").distinct(), "id", "left_semi")
    sets = materialize(sets.groupBy("id").agg(F.first("n").alias("n"), F.first("data").alias("data")), "none")
    release(docs.sparkSession, found, but="kind=0")  # the documents are read once more

    links = materialize(star_links(center_pairs(groups.withColumn("root", F.col("id"))), sets, num, den))
    roots = components(links)
    for i in range(1, star_rounds):
        placed = rooted(groups, roots)
        large = placed.groupBy("token").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter((F.col("held") > LARGE) & (F.col("lo") < F.col("hi")))
        pairs = materialize(center_pairs(placed.join(large.select("token"), "token"), CENTERS, i))
        if pairs.isEmpty():
            break
        links = links.unionByName(materialize(star_links(pairs, sets, num, den)))
        roots = components(links)
    rest = materialize(rest_links(rooted(groups.select("token", "id"), roots), sets, num, den))
    roots = components(links.unionByName(rest))

    placed = materialize(rooted(base, roots))
    row = F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("id"), F.col("hash").alias("hash"))
    least = placed.filter("n > 0").groupBy("root").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("held"))
    whole = join_by_key(placed.filter("n > 0"), least, "root", "held").withColumn("kept", row == F.col("least")).withColumn("least", F.col("least.id"))
    alone = placed.filter("n = 0").withColumn("kept", F.lit(True)).withColumn("least", F.col("doc_id"))
    columns = [F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"), F.col("hash").alias("row_hash"), "kept"]
    return whole.select(columns).unionByName(alone.select(columns))


def keep_one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, that with the smallest id, with all its columns."""
    return pick_rows(docs, jaccard_components(docs, k, num, den, id_col, text_col).filter("kept"))
