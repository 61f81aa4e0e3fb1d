import collections
import hashlib
import io
import random
import wave
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.llm import tokens as tk
from sluiceway.llm.media import assemble, cuts, digest, media_columns, wav_header
from sluiceway.llm.packing import Stock, best_fit, pack, pack_counts, reduce_by_dominance
from sluiceway.llm.sharding import best_fit_decreasing, into_shards, rounded, shard, shard_counts
from sluiceway.llm.token_files import Shard, encode_shard, re_pair, token_files
from tests.llm.conftest import ODD_TEXTS


def gapless(pairs):
    """Whether each group's (offset, length) pairs fill it from 0."""
    for parts in pairs.values():
        at = 0
        for offset, length in sorted(parts):
            if offset != at:
                return False
            at += length
    return True


# Sharding.


def plain_best_fit(sizes, capacity):
    rest, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(rest) if r >= sizes[i]]
        b = min(fits)[1] if fits else len(rest)
        if not fits:
            rest.append(capacity)
        rest[b] -= sizes[i]
        out[i] = b
    return out, len(rest)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_matches_a_plain_search(sizes):
    assert best_fit_decreasing(sizes, 50) == plain_best_fit(sizes, 50)


def test_oversized_groups_stand_alone():
    bins = into_shards([1000] + [1] * 90, 4)
    loads = collections.Counter()
    for b, s in zip(bins, [1000] + [1] * 90, strict=True):
        loads[b] += s
    assert sorted(loads.values()) == [30, 30, 30, 1000]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(1, 6))
def test_counts_are_sharded_as_single_groups(sizes, shards):
    counts = collections.Counter(sizes)
    runs = shard_counts(counts, shards)
    for size, n in counts.items():
        assert gapless({size: [(first, k) for s, first, k, _ in runs if s == size]}) and sum(k for s, _, k, _ in runs if s == size) == n
    assert all(0 <= b < shards for *_, b in runs)


def test_balance_at_any_scale():
    """25 times the groups are balanced as well, since each is packed as itself; so they are one by one."""
    rng = random.Random(8)
    sizes = [int(rng.lognormvariate(6, 1.2)) + 8 for _ in range(4000)]
    spread = []
    for times in (1, 25):
        loads = collections.Counter()
        for size, _, n, b in shard_counts({s: n * times for s, n in collections.Counter(sizes).items()}, 24):
            loads[b] += size * n
        spread.append((max(loads.values()) - min(loads.values())) / sum(loads.values()) * 24)
    assert spread[1] <= spread[0] < 0.02
    capacity = -(-sum(sizes) // 24) + 50
    assert best_fit_decreasing(sizes, capacity) == plain_best_fit(sizes, capacity)


def test_sizes_keep_twelve_digits(spark):
    sizes = [1, 8, 4095, 4096, 4097, 8191, 8193, 10**6 + 1, (1 << 40) + 1, (1 << 33) - 1]
    got = [r[0] for r in spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, s long").orderBy("i").select(rounded(F.col("s"))).collect()]
    for s, r in zip(sizes, got, strict=True):
        shift = max(s.bit_length() - 12, 0)
        assert r == (s + (1 << shift) - 1 >> shift) << shift
        assert s <= r < s * (1 + 2**-10) + 1


def test_small_groups_are_packed_as_themselves(spark):
    """Far more groups than a shard's PER_SHARD, of sizes that hash bins would mix unevenly."""
    rows = [(i, f"{i:07d}" + "x" * (i * 7919 % 97)) for i in range(3000)] + [(10**6 + i, "the same text") for i in range(1500)]
    out = check_shards(shard(spark.createDataFrame(rows, "doc_id long, text string"), 4, per_shard=20), 4, len(rows))
    loads = collections.Counter()
    for r in out:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) <= 0.01 * sum(loads.values()) / 4
    assert len({r.shard for r in out if r.doc_id >= 10**6}) == 1


def check_shards(df, shards, rows):
    out = df.collect()
    assert len(out) == rows
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return out


def test_shards_hold_documents(documents, local_docs):
    out = check_shards(shard(documents, 24), 24, len(local_docs))
    text, where = dict(local_docs), collections.defaultdict(set)
    for r in out:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        where[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    loads = collections.Counter()
    for r in out:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.02 * sum(loads.values()) / 24 or max(loads.values()) == max(r.size for r in out)


def test_shards_of_odd_rows(odd, empty):
    check_shards(shard(odd, 3), 3, odd.count())
    assert shard(empty, 3).collect() == []


# Token files.


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=60), min_size=1, max_size=8))
def test_re_pair_round_trip(docs):
    ids, lengths = np.array(sum(docs, []), np.uint32), np.array(list(map(len, docs)))
    data = encode_shard(np.arange(len(docs)), np.zeros(len(docs)), ids, lengths, 10)
    stored = Shard(data)
    assert np.array_equal(stored.all(), ids)
    for i, d in enumerate(docs):
        assert stored.decode(i).tolist() == d
        assert stored.decode(i, len(d) // 3, len(d) // 2).tolist() == d[len(d) // 3 : len(d) // 2]


def test_re_pair_replaces_frequent_pairs_within_documents():
    seq, per_doc, rules = re_pair(np.array([1, 2] * 50 + [3] + [1, 2] * 50 + [3], np.uint32), np.array([101, 101]), 10)
    assert len(seq) < 60 and per_doc.tolist() == [len(seq) // 2] * 2
    assert [1, 2] in rules.tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=6), st.integers(2, 5))
def test_re_pair_leaves_no_frequent_pair(docs, least):
    ids, lengths = np.array([x for d in docs for x in d], np.uint32), np.array([len(d) for d in docs], np.int64)
    symbols, per_doc, rules = re_pair(ids, lengths, 4, least)
    expand = lambda x: [x] if x < 4 else [y for side in rules[x - 4].tolist() for y in expand(side)]
    at = np.append(0, np.cumsum(per_doc)).tolist()
    parts = [symbols[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    assert [[y for x in p for y in expand(x)] for p in parts] == docs
    left = collections.Counter(pair for p in parts for pair in zip(p, p[1:], strict=False))
    assert max(left.values(), default=0) < least
    used = collections.Counter(symbols.tolist() + rules.ravel().tolist())
    assert len(set(map(tuple, rules.tolist()))) == len(rules) and all(used[4 + i] for i in range(len(rules)))


def test_re_pair_counts_all_pairs_and_ends_a_repeat():
    rng = np.random.default_rng(5)
    noise = np.concatenate([np.repeat(np.arange(1024), 40), np.tile([5000, 5001], 40)])
    order = rng.permutation(len(noise) - 80)
    mixed = np.insert(noise[order], np.repeat(rng.integers(0, len(order), 40), 2), np.tile([5000, 5001], 40))
    _, _, rules = re_pair(mixed.astype(np.uint32), np.array([len(mixed)]), 6000)
    assert [5000, 5001] in rules.tolist()
    symbols, _, rules = re_pair(np.tile([1, 2], 131_072).astype(np.uint32), np.array([262_144]), 10)
    assert len(symbols) + len(rules) < 40


@pytest.mark.parametrize("special_as_text", [False, True])
@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte_level"), ("word_bpe_49k.json", "spaceless")])
def test_chunked_tokenizer_equals_the_library(name, kind, special_as_text, local_docs):
    t = tk.ChunkedTokenizer(tk.tokenizer_path(name), tk.KINDS[kind], 5000, special_as_text)
    rng = random.Random(3)
    signs = [" ", " ", "a", "B", "é", ".", ",", "\n", "'s", "0", "7", "\t", "́", "!", "日", "\0", "\x1c", "  "]
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts = [x or "" for x in ODD_TEXTS] + made + [x or "" for _, x in local_docs[:60]]
    texts.append("y" * 200 + " " + "y" * 199 + "z")
    assert (t.tokenizer.encode("<|endoftext|>", add_special_tokens=False).ids == [t.tokenizer.token_to_id("<|endoftext|>")]) != special_as_text
    for part in (texts[:300], texts[300:], texts[:20], texts[-5:], texts[100:400]):
        ids, lengths = t.encode(part)
        ends = np.cumsum(lengths)
        for text, a, b in zip(part, ends - lengths, ends, strict=True):
            assert ids[a:b].tolist() == t.whole(text).tolist(), text


def expected_ids(name, texts, end):
    t = tk.Tokenizer.from_file(tk.tokenizer_path(name))
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for x in texts]


def test_ids_must_be_integers(spark):
    docs = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for op in (token_files, pack):
        with pytest.raises(TypeError, match="integers"):
            op(docs)


def test_token_files(documents, local_docs):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files(documents).collect()}
    start, want = 0, {}
    for (i, _), ids in zip(local_docs, expected_ids("byte_bpe_50k.json", [t for _, t in local_docs], 2), strict=True):
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_token_files_of_odd_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    out = token_files(odd).collect()
    want = collections.Counter((r.doc_id, len(ids), zlib.crc32(ids.tobytes())) for r, ids in zip(rows, expected_ids("byte_bpe_50k.json", [r.text for r in rows], 2), strict=True))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    assert gapless({0: [(r.start, r.n_tokens) for r in out]})
    assert token_files(empty).collect() == []


# Packing.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_counts_pack_as_single_pieces(sizes):
    counts = dict(collections.Counter(sizes))
    patterns = best_fit(Stock(counts), 30)
    assert sum(n for _, n in patterns) == plain_best_fit(sizes, 30)[1]
    total = collections.Counter()
    for content, n in pack_counts(counts, 30):
        assert sum(s * q for s, q in content) <= 30
        for s, q in content:
            total[s] += q * n
    assert total == collections.Counter(sizes)


def least_bins(sizes, capacity):
    """By exhaustive search."""
    best = [len(sizes)]

    def go(i, rests):
        if len(rests) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rests)
            return
        for r in set(rests):
            if r >= sizes[i]:
                left = list(rests)
                left.remove(r)
                go(i + 1, [*left, r - sizes[i]])
        go(i + 1, [*rests, capacity - sizes[i]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_dominance_keeps_the_optimum(sizes):
    sizes = sorted(sizes, reverse=True)
    stock = Stock(dict(collections.Counter(sizes)))
    fixed = sum(n for _, n in reduce_by_dominance(stock, 12))
    rest = sorted((s for s, n in stock.counts.items() for _ in range(n)), reverse=True)
    assert fixed + least_bins(rest, 12) == least_bins(sizes, 12)


def check_packing(df, rows):
    out, want, sequences = df.collect(), collections.Counter(), collections.defaultdict(list)
    for r, ids in zip(rows, expected_ids("word_bpe_49k.json", [r[1] for r in rows], 1), strict=True):
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[r[0], k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert gapless(sequences) and all(sum(x for _, x in v) <= 4096 for v in sequences.values())
    return len(sequences), sum(r.length for r in out)


def test_pack(documents, local_docs):
    sequences, ids = check_packing(pack(documents), local_docs)
    assert sequences <= -(-ids // 4096) + 1


def test_pack_of_odd_rows(odd, empty):
    check_packing(pack(odd), [(r.doc_id, r.text) for r in odd.collect()])
    assert pack(empty).collect() == []


# Media.


def payload(text):
    data = (text or "").encode()
    return data, data + b" " * (-len(data) % 192 if data else 192)


def check_media(df, rows):
    out, want = df.collect(), collections.Counter()
    for i, t in rows:
        data, p = payload(t)
        want[i, len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(p) + 44] += 1
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) for r in out) == want
    values = collections.defaultdict(set)
    for r in out:
        values[r.payload_sha256, r.n_bytes].add((r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in values.values())


def test_media(documents, local_docs):
    check_media(media_columns(documents), local_docs)


def test_media_of_odd_rows(odd, empty):
    check_media(media_columns(odd), [(r.doc_id, r.text) for r in odd.collect()])
    assert media_columns(empty).collect() == []


def test_shared_passages_are_stored_once(spark, tmp_path):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    docs = spark.createDataFrame([(i, f"{i} " * 700 + shared) for i in range(6)], "doc_id long, text string")
    from sluiceway.llm.media import write_store

    store = write_store(docs, str(tmp_path / "store"), "text")
    assert store.filter("kind = 1").count() > 10
    assert store.filter("kind = 1").groupBy("key").count().filter("count > 1").isEmpty()
    assert all(len(r.away) > 10 for r in store.filter("kind = 0").collect())
    check_media(media_columns(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_chunks_depend_on_content_only():
    rng = random.Random(2)
    a = bytes(rng.randrange(256) for _ in range(40_000))
    alone, after = cuts([a]), cuts([b"x" * 5000, a])
    assert alone[0] == after[1]
    moved = cuts([b"inserted" + a])[0]
    assert len({e - 8 for e in moved} & set(alone[0])) > len(alone[0]) // 2


def medium_of(text):
    """The stored form and its feature, in plain Python: a WAV file of 8-bit mono samples at 8000 a second."""
    _, p = payload(text)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(8000)
        w.writeframes(p)
    s = [b - 128 for b in p]
    crossings = sum((a < 0) != (b < 0) for a, b in zip(s, s[1:], strict=False))
    return hashlib.sha256(out.getvalue()).hexdigest(), f"n={len(s)};sum={sum(s)};energy={sum(x * x for x in s)};crossings={crossings}"


def test_stored_forms_and_features(documents, local_docs):
    want = {i: medium_of(t) for i, t in local_docs}
    assert {r.doc_id: (r.media_sha256, r.feature) for r in media_columns(documents).collect()} == want


def test_damage_is_found():
    text = b"".join(bytes([65 + i % 26]) * 96 for i in range(6))
    parts = [wav_header(len(text)), text[:192], text[192:384], text[384:]]
    whole = digest(text), len(text), b"".join(parts), [digest(p) for p in parts], [len(p) for p in parts]
    assert assemble(*whole, {}) == b"".join(parts)
    with pytest.raises(ValueError, match="chunk .* damaged"):
        assemble(*whole[:2], whole[2][:-1] + b"?", *whole[3:], {})
    swapped = [parts[0], parts[2], parts[1], parts[3]]
    with pytest.raises(ValueError, match="list .* damaged"):
        assemble(*whole[:2], b"".join(swapped), [digest(p) for p in swapped], [len(p) for p in swapped], {})
