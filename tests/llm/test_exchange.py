"""Exchanges of n-grams between blocks and shards, with and without a relay."""

import collections

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from sluiceway.llm import corpus_blocks, lm_scoring
from sluiceway.llm.corpus_blocks import NUMBERS, Layout, cut_shards, exchange, pack, pack_numbers, unpack, unpack_numbers
from sluiceway.llm.jaccard_join import REQUESTS, jaccard_components, shingle_levels
from sluiceway.llm.lm_scoring import score_texts

from . import brute

LAYOUT = Layout(({"keys": NUMBERS, "numbers": "<u4"}, {"words": "<u8"}), ("numbers",), {"sums": (0, "<u8"), "times": (1, "<u4")})
ASKED = "shard int, block long, shards binary, keys binary, numbers binary, words binary"


def _block(i):
    """A block's sorted shards of 6 digits, keys, numbers of words and words; some blocks have few entries, one has none."""
    draw = np.random.default_rng(i)
    shards = np.sort(draw.integers(0, 64, [0, 1, 3, 200][i % 4]))
    numbers = draw.integers(0, 4, len(shards))
    return shards, draw.integers(0, 50, len(shards)), numbers, draw.integers(0, 9, numbers.sum())


@pytest.mark.parametrize("fan", [12, 3])
def test_exchange_answers_in_the_order_of_the_entries(spark, monkeypatch, fan):
    """Each key gets the sum of all its words in all blocks, each word how often its shard has it."""
    monkeypatch.setattr(corpus_blocks, "FAN", fan)
    blocks = 300  # so that a relay has several bundles

    def ask(pdfs):
        for pdf in pdfs:
            for i in pdf["id"].tolist():
                shards, keys, numbers, words = _block(i)
                first, at, whole = cut_shards(shards, 6, fan)
                ends = np.append(0, np.cumsum(numbers))
                cut = list(zip(at, at[1:], strict=False))
                yield pd.DataFrame({"shard": first.astype(np.int32), "block": i, "shards": whole, "keys": [pack_numbers(keys[a:b]) for a, b in cut], "numbers": [pack(numbers[a:b].astype("<u4")) for a, b in cut], "words": [pack(words[ends[a] : ends[b]].astype("<u8")) for a, b in cut]})

    def answer(pdf):
        keys, numbers = [unpack_numbers(x) for x in pdf["keys"]], [unpack(x, "<u4") for x in pdf["numbers"]]
        words = [unpack(x, "<u8") for x in pdf["words"]]
        sums, times = collections.Counter(), collections.Counter(np.concatenate(words).tolist())
        for k, n, w in zip(keys, numbers, words, strict=True):
            for a, b in zip(np.repeat(k, n).tolist(), w.tolist(), strict=True):
                sums[a] += b
        out = pdf[["shard", "block"]].assign(sums=[pack(np.array([sums[x] for x in k.tolist()], "<u8")) for k in keys], times=[pack(np.array([times[x] for x in w.tolist()], "<u4")) for w in words])
        return pd.concat([out, pd.DataFrame({"shard": pdf["shard"][:1], "block": -1, "sums": [b""], "times": [b""]})])

    asked = spark.range(blocks, numPartitions=4).mapInPandas(ask, ASKED)
    out = exchange(asked, 6, LAYOUT, answer, "shard int, block long, sums binary, times binary").collect()
    every = [_block(i) for i in range(blocks)]
    sums, times = collections.Counter(), collections.Counter()
    for shards, keys, numbers, words in every:
        for s, k, w in zip(np.repeat(shards, numbers).tolist(), np.repeat(keys, numbers).tolist(), words.tolist(), strict=True):
            sums[s, k] += w
            times[s, w] += 1
    got = collections.defaultdict(list)
    for r in sorted((r for r in out if r.block >= 0), key=lambda r: r.shard):
        got[r.block].append((unpack(r.sums, "<u8"), unpack(r.times, "<u4")))
    assert sorted(r.shard for r in out if r.block < 0) == sorted({s for b in every for s in b[0].tolist()})
    assert sorted(got) == [i for i in range(blocks) if len(every[i][0])]
    for i, parts in got.items():
        shards, keys, numbers, words = every[i]
        assert np.concatenate([x for x, _ in parts]).tolist() == [sums[p] for p in zip(shards.tolist(), keys.tolist(), strict=True)]
        assert np.concatenate([x for _, x in parts]).tolist() == [times[p] for p in zip(np.repeat(shards, numbers).tolist(), words.tolist(), strict=True)]


def test_operators_through_a_relay(spark, documents, local_docs, monkeypatch):
    """With 3 of 6 digits at once and small blocks, scores and components are what they are without a relay."""
    docs = documents.repartition(3)
    want = {r.doc_id: r for r in score_texts(docs).collect()}
    monkeypatch.setattr(corpus_blocks, "FAN", 3)
    got = {r.doc_id: r for r in score_texts(docs).collect()}
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert got[i][:5] == r[:5] and got[i].base_score == pytest.approx(r.base_score, rel=1e-12) and got[i].score == pytest.approx(r.score, rel=1e-9)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 4, 85, 100).collect()}
    assert found == {i: x for (i, _), x in zip(local_docs, brute.jaccard_components(local_docs, 4, 85, 100), strict=True)}


def test_operators_through_a_relay_on_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(corpus_blocks, "FAN", 3)
    assert score_texts(odd).count() == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = collections.Counter((i, *x) for (i, _), x in zip(rows, brute.jaccard_components(rows, 4, 85, 100), strict=True))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd, 4, 85, 100).collect()) == want
    assert score_texts(empty).collect() == [] and jaccard_components(empty).collect() == []


def test_rows_of_an_exchange_grow_with_the_blocks(spark, monkeypatch):
    """Eight times the shards: a block still sends 2**FAN rows at most, and no more keys of a frequent word."""
    monkeypatch.setattr(corpus_blocks, "FAN", 3)
    sent = []

    def seen(requests, bits, layout, answer, schema):
        rows = requests.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        sent.append((bits, rows.agg(F.max("n")).first()[0]))
        return exchange(requests, bits, layout, answer, schema)

    monkeypatch.setattr("sluiceway.llm.jaccard_join.exchange", seen)
    text = " ".join(f"w{i % 1777}" for i in range(20_000))
    table = corpus_blocks.write_blocks(spark.createDataFrame([(i, f"{i} {text}") for i in range(4)], "doc_id long, text string").repartition(2))
    for bits in (3, 6, 9):
        shingle_levels(table, 4, bits).count()
    assert sent == [(3, 8), (6, 8), (9, 8)] and "shards" in REQUESTS


def test_a_frequent_word_has_the_keys_that_the_block_needs():
    row = {"text": zstandard.ZstdCompressor().compress(b"the cat the dog the cat"), "sizes": [23], "doc_ids": [1]}
    t = lm_scoring.Tokens(row, 7, 2)
    counts, ids = np.full(len(t.words), 1000), np.arange(len(t.words)) << 20
    for bits in (6, 20):
        c = lm_scoring.Contexts(t, counts, ids, 1 << 30, 4000, bits)
        assert len(c.keys) <= len(c.pairs) == 6  # BEGIN the, the cat, the dog, cat the, dog the, cat END
        assert (c.known == 1000).all()
        assert c.taken(np.zeros(len(c.keys)), {int(i): 0.5 for i in c.names}).tolist().count(0.5) == 4
