import collections
import math
import re
import zlib

import numpy as np
import pytest

from sluiceway.llm.corpus_blocks import word_hashes
from sluiceway.llm.lm_scoring import BEGIN, END, LEAST, STEP, Trie, build_trie, encode_shares, fit_weights, score_texts


def test_scores_know_two_words_before(spark):
    """After b come c and d as often, but c only after a, and d only after x."""
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    train = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 != 2][:80]
    rows = [(i, ("a b c", "x b d")[k % 2]) for k, i in enumerate(train)] + list(zip(held, ["a b c", "a b d"], strict=True))
    out = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[held[0]] > out[held[1]] + 1


def test_search_down_the_trie(tmp_path):
    pairs = np.array([5 << 32 | 7, 5 << 32 | 9, 8 << 32 | 7], np.uint64)
    triples, counts = np.array([0 << 32 | 1, 0 << 32 | 4, 2 << 32 | 1], np.uint64), np.array([30, 10, 20])
    trie = Trie(build_trie(pairs, np.array([40, 15, 20]), {}, np.full(3, 1e-3), triples, counts, 1e-6, 5, str(tmp_path)))
    numbers_2 = np.array([3, 1, 1, 1])
    ctx, numbers, words = np.array([5, 6, 8], np.uint64), np.array([2, 1, 1]), np.array([7, 9, 7, 7], np.uint64)
    codes, weights, codes_2, weights_2 = trie.look_up(ctx, numbers, words, numbers_2, np.array([1, 2, 4, 1, 1, 1], np.uint64))
    assert (codes > 0).tolist() == [True, True, False, True] and (weights > 0).tolist() == [True, False, True]
    assert (codes_2 > 0).tolist() == [True, False, True, False, False, True]
    assert (weights_2 > 0).tolist() == [True, True, False, True]
    assert (int(codes_2[0]) - int(codes_2[2])) * STEP == pytest.approx(math.log10(3), abs=STEP)


def brute_scores(rows):
    """Scores by the model's definition, with dictionaries: no blocks, no trie, no searches."""
    words = lambda t: [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", t.lower()) if w]
    texts = {i: [*words(t), 0] for i, t in rows}
    own = lambda w: int(END) if w == 0 else int(BEGIN) if w == 1 else int(word_hashes([w.encode()])[0][0])
    hashes = {w: own(w) for t in texts.values() for w in t} | {1: own(1)}
    trained = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    one = collections.Counter(w for t in trained for w in t)
    number, ranks = {}, collections.Counter()
    for w in sorted((w for w in hashes if w != 1), key=lambda w: (-one[w], hashes[w])):  # the rank in its shard, then the shard
        number[w] = ranks[hashes[w] >> 58] << 6 | hashes[w] >> 58
        ranks[hashes[w] >> 58] += 1
    two = collections.Counter(p for t in trained for p in zip([1, *t], t, strict=False))
    three = collections.Counter(p for t in trained for p in zip([1, *t], t, t[1:], strict=False))
    n, v = sum(one.values()), len(one)
    total = lambda u: one[0] if u == 1 else one[u]
    shard = lambda u, w: (hashes[u] >> 58) + (number[w] & 63 if total(u) * 1024 > n else 0) & 63
    cut = lambda x: 0.0 if (code := int(encode_shares(np.array([x]))[0])) == 0 else 10 ** (LEAST + STEP * (code - 1))
    size = lambda x: math.frexp(float(x))[1]
    share, taken, share2, taken2 = {}, collections.Counter(), {}, {}
    for k in range(64):
        mine = [p for p in two if shard(*p) == k]
        if not mine:
            continue
        plain = [2.0 ** (min(round(8 * math.log2(one[w] + 1)), 255) / 8) / (n + v + 1) for _, w in mine]
        weight = fit_weights(np.array([two[p] for p in mine]), np.array([total(u) for u, _ in mine]), np.array(plain))
        held = collections.Counter()
        for u, w in mine:
            share[u, w] = cut(weight[size(total(u))] * two[u, w] / total(u))
            held[u] += two[u, w]
        for u, c in held.items():
            taken[u] += min(math.ceil(weight[size(total(u))] * c / total(u) * 65535), 65534) / 65535
        below = [p for p in three if shard(p[0], p[1]) == k]
        weight = fit_weights(np.array([three[p] for p in below]), np.array([two[p[:2]] for p in below]), np.full(len(below), 1 / (n + v + 1))) if below else np.zeros(64)
        share2 |= {p: cut(weight[size(two[p[:2]])] * three[p] / two[p[:2]]) for p in below}
        taken2 |= {p: min(math.ceil(weight[size(two[p])] * 255), 254) / 255 for p in mine}
    out = {}
    for i, t in texts.items():
        out[i] = 0.0
        for a, b, w in zip([None, 1, *t], [1, *t], t, strict=False):
            p = share.get((b, w), 0.0) + (1 - min(taken[b], 0.999999)) * (one[w] + 1) / (n + v + 1)
            if a is not None:
                p = share2.get((a, b, w), 0.0) + (1 - taken2.get((a, b), 0.0)) * p
            out[i] += math.log10(p)
    return out


def test_scores_equal_the_definition(spark, documents):
    rows = [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect() if len(r.text or "") < 3000 and (r.text or "").isascii()]
    rows += [(10**6 + i, "to be or not to be that is the question") for i in range(30)]
    got = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = brute_scores(rows)
    assert got.keys() == want.keys() and len(want) > 100
    for i, score in want.items():
        assert got[i] == pytest.approx(score, rel=1e-9), i
