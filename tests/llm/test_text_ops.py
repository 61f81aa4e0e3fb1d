import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import language_id
from sluiceway.llm.components import components
from sluiceway.llm.corpus_blocks import word_hashes
from sluiceway.llm.elias_fano import EliasFano, encode
from sluiceway.llm.exact_dedup import drop_copies, exact_dedup
from sluiceway.llm.jaccard_join import jaccard_components, keep_one_of_each
from sluiceway.llm.language_id import Ftrl, fit_temperature, identify_languages, keep_identified
from sluiceway.llm.line_dedup import drop_boilerplate
from sluiceway.llm.lm_scoring import score_texts
from sluiceway.llm.mixing import draw, mix, n_words
from sluiceway.llm.prefix_tree import connecting_links
from tests.llm import brute


# Exact deduplication.


def check_exact(df, rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        t = t or ""
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()].append((-len(t), i is None, i))
    kept = collections.Counter()
    out = df.collect()
    assert len(out) == len(rows)
    for r in out:
        group = groups[r.text_sha256]
        best = min(group, key=lambda x: (x[0], x[1], x[2] or 0))
        assert (r.keep_id, r.group_size) == (best[2], len(group))
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


@pytest.mark.parametrize("hot_rows", [2, 64])
def test_exact_dedup(documents, local_docs, hot_rows):
    check_exact(exact_dedup(documents, hot_rows=hot_rows), local_docs)


def test_exact_dedup_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check_exact(exact_dedup(odd, hot_rows=2), rows)
    check_exact(exact_dedup(odd), rows)
    assert exact_dedup(empty).collect() == []
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    assert drop_copies(empty).collect() == []


# Line deduplication.


def check_lines(df, pages, ratio=0.2, least=2):
    def lines(text):
        plain = re.sub(r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "", text or "")
        plain = re.sub(r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer|title|body|head|html|blockquote|pre|aside|main|form)(?:[\s/][^>]*)?>", "\n", plain)
        return [x for x in (y.strip(" \t\r\x0b\x0c") for y in re.sub(r"<[^>]*>", "", plain).split("\n")) if x]

    def site(url):
        m = re.search(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        return m[1].lower() if m else ""

    total, seen = collections.Counter(), collections.Counter()
    for i, url, text in set(pages):
        total[site(url)] += 1
        seen.update({(site(url), x) for x in lines(text)})
    want = collections.Counter()
    for i, url, text in pages:
        own, h = lines(text), site(url)
        kept = [x for x in own if not (seen[h, x] >= least and seen[h, x] > ratio * total[h])]
        want[i, h, len(own), len(own) - len(kept), "\n".join(kept)] += 1
    assert collections.Counter((r.page_id, r.host, r.n_lines, r.n_dropped, r.text) for r in df.collect()) == want
    return sum(w[3] for w in want)


def test_boilerplate_lines(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    check_lines(drop_boilerplate(df), [(r.page_id, r.url, r.html) for r in df.collect()])


def test_boilerplate_of_odd_pages(spark):
    pages = [(i, f"https://User@Site.example:80/{i}", f"<nav>Menu</nav><p>Text {i}</p><div>Legal</div>{'<br>Often' if i % 4 == 0 else ''}") for i in range(12)]
    pages += [(20 + i, f"http://small.example/{i}", "Menu\nOnly") for i in range(2)]
    pages += [(30, None, None), (31, "", ""), (32, "no url", "<script>x\n</script>a <b>b</b>\n\n<!-- c\nd -->e"), pages[0], pages[0], (None, None, "x"), (40, "http://long.example", "<p>" + "y\n" * 50_000)]
    df = spark.createDataFrame([(*p, 1, "h") for p in pages], "page_id long, url string, html string, pos int, host string")
    assert check_lines(drop_boilerplate(df), pages) > 24
    assert drop_boilerplate(df.filter("false")).collect() == []


# Mixing.


def check_mix(df, rows):
    size = {}
    totals = collections.Counter()
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        size.setdefault((i, s), n)
        totals[s] += n
    order = sorted((s for s in totals if s is not None)) + ([None] if None in totals else [])
    targets = brute.water_fill(totals, {s: float(k % 3 + 1) for k, s in enumerate(order)}) if sum(totals.values()) else {}
    taken = collections.Counter()
    by_id = {i: s for i, _, s in rows}
    out = df.collect()
    assert len(out) == len(rows)
    for r in out:
        s = by_id[r.doc_id]
        assert r.source_size == totals[s] and r.target == pytest.approx(targets.get(s, 0))
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in totals:
        assert taken[s] == int(targets.get(s, 0) + 1e-6)


def test_mix(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check_mix(mix(documents), rows)
    assert sorted(mix(documents).collect()) == sorted(mix(documents.repartition(3)).collect())


def test_many_lines_of_a_page_are_dropped_at_once(spark):
    """In proportion to the page's lines, not to their square."""
    lines = [f"line {i}" for i in range(40_000)]
    pages = spark.createDataFrame([(p, f"http://h/{p}", "\n".join([*lines, f"own {p}"])) for p in range(4)], "page_id long, url string, html string")
    out = drop_boilerplate(pages, is_html=False).collect()
    assert [(r.text, r.n_lines, r.n_dropped) for r in sorted(out)] == [(f"own {p}", 40_001, 40_000) for p in range(4)]


def test_mix_of_odd_rows(odd, empty):
    one_source = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_mix(mix(one_source), [(r.doc_id, r.text, r.source) for r in one_source.collect()])
    assert mix(odd).count() == odd.count()
    assert mix(empty).collect() == []
    assert draw(empty).collect() == []
    assert draw(odd).columns == odd.columns


def test_draw_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 10 else "b") for i in range(40)], "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken for r in mix(docs).collect()}
    copies = collections.Counter(r.doc_id for r in draw(docs).collect())
    assert all(abs(copies[i] * 10 - n) <= 5 for i, n in taken.items())


def test_n_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\x0bc\xa0d \n",)], "text string")
    assert [r[0] for r in df.select(n_words(df.text)).collect()] == [0, 0, 3]


# Language identification.


def test_languages(documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    out = identify_languages(documents).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in out if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_languages_of_odd_rows(odd, empty):
    out = identify_languages(odd).collect()
    text = {r.doc_id: r.text for r in odd.filter("doc_id is not null").collect()}
    assert len(out) == odd.count()
    for r in out:
        if r.doc_id is not None:
            letters = any(c.isalpha() for c in text[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not letters) and (r.score == 0) == (not letters)
    same = {(r.lang_pred, r.score) for r in out if r.doc_id in (5, 8)}
    assert len(same) == 1
    assert identify_languages(empty).collect() == []
    assert keep_identified(empty).collect() == []
    kept = keep_identified(odd, 0.0)
    assert kept.columns == odd.columns and kept.filter("text is null").isEmpty()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify_languages(docs).collect()] == [("und", 0.0)]


def test_sample_is_bounded_without_ids(spark):
    rows = [(None, f"text {'abcdefgh'[i % 8] * (i % 50 + 1)} {i}", "en") for i in range(3000)] + [(None, "the same", "de")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    seen = []
    real = language_id.train
    try:
        language_id.train = lambda languages, sample, *a: seen.append(len(sample)) or real(languages, sample, *a)
        assert identify_languages(docs, per_language=20).count() == 6000
        assert language_id.learn_model(docs, most_languages=1).languages in (["de"], ["en"])
    finally:
        language_id.train = real
    assert 5 <= seen[0] <= 60


def test_training_equals_plain_formulas():
    """TF-IDF, hashed n-grams and FTRL-proximal, each in plain Python."""

    def grams(text):
        out = collections.Counter()
        low = text.lower()
        for n in (1, 2, 3):
            for i in range(len(low) - n + 1):
                h = 0
                for k, c in enumerate(low[i : i + n]):
                    h = (h * 0x01000193 + ord(c) + k + 1) & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0x85EBCA6B & 0xFFFFFFFF
                out[((h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF) >> 17] += 1
        return out

    texts = ["Hello World", "hallo welt", "helo", "Wörld x"] * 3
    found = list(language_id.ngram_counts(texts))
    idf = np.linspace(1, 3, language_id.DIMS).astype(np.float32)
    z, n2 = collections.defaultdict(float), collections.defaultdict(float)
    ftrl = Ftrl(language_id.DIMS, 2)

    def weight(key):
        v = z[key]
        return 0.0 if abs(v) <= 0.02 else -(v - math.copysign(0.02, v)) / ((1 + math.sqrt(n2[key])) + 1e-3)

    for k, (text, (at, tf)) in enumerate(zip(texts, found, strict=True)):
        plain = grams(text)
        assert dict(zip(at.tolist(), tf.tolist(), strict=True)) == plain
        raw = {g: (1 + math.log(c)) * float(idf[g]) for g, c in plain.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        x = {g: v / norm for g, v in raw.items()}
        got = language_id.tf_idf(at, tf, idf)
        assert got == pytest.approx([x[g] for g in at.tolist()], rel=1e-5)
        ftrl.learn(at, got, k % 2)
        logits = [sum(v * weight((g, c)) for g, v in x.items()) for c in (0, 1)]
        p = [math.exp(v) / sum(map(math.exp, logits)) for v in logits]
        old = {(g, c): weight((g, c)) for g in x for c in (0, 1)}
        for g, v in x.items():
            for c in (0, 1):
                grad = v * (p[c] - (c == k % 2))
                z[g, c] += grad - (math.sqrt(n2[g, c] + grad * grad) - math.sqrt(n2[g, c])) * old[g, c]
                n2[g, c] += grad * grad
    have = ftrl.weights(slice(None))
    assert all(have[g, c] == pytest.approx(weight((g, c)), abs=1e-5) for g, c in list(z))


def test_l1_keeps_weights_sparse():
    rng = np.random.default_rng(0)
    sparse, dense = Ftrl(50, 2, l1=0.5), Ftrl(50, 2, l1=0.0)
    for _ in range(400):
        label = int(rng.integers(2))
        found = np.append(label, rng.choice(np.arange(2, 50), 5, replace=False))
        for f in (sparse, dense):
            f.learn(found, np.ones(6), label)
    assert np.count_nonzero(sparse.weights(slice(None))) < np.count_nonzero(dense.weights(slice(None)))
    assert sparse.weights(np.array([0]))[0].argmax() == 0


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3))
    p = np.exp(true) / np.exp(true).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert fit_temperature(true * 5, labels) == pytest.approx(5, rel=0.15)


# Language-model scores.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(5001, 1 << 40))
def test_elias_fano(values, universe):
    v = np.array(sorted(values), np.uint64)
    ef = EliasFano(*encode(v, universe))
    assert ef.get(np.arange(len(v))).tolist() == v.tolist()
    asked = np.arange(0, 5001, 7).astype(np.uint64)
    assert ef.successor(asked).tolist() == np.searchsorted(v, asked).tolist()
    first = np.searchsorted(v, asked)
    assert ef.find(asked).tolist() == [i if i < len(v) and v[i] == x else -1 for i, x in zip(first.tolist(), asked.tolist(), strict=True)]


def check_scores(df, docs):
    want, out = brute.unigram_scores(docs), df.collect()
    assert len(out) == len(docs)
    for r in out:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    return out


def test_scores(documents, local_docs):
    out = check_scores(score_texts(documents), local_docs)
    for held in (True, False):
        part = [r for r in out if r.held_out == held]
        assert sum(r.score for r in part) > sum(r.base_score for r in part)


def test_scores_of_odd_rows(odd, empty):
    once = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_scores(score_texts(once), [(r.doc_id, r.text) for r in once.collect()])
    assert score_texts(odd).count() == odd.count()
    assert score_texts(empty).collect() == []


def test_probabilities_sum_to_at_most_one(spark):
    """Over the texts without or with one word: p(end) + sum of p(word) p(end | word)."""
    names = [f"w{i}" for i in range(6)]
    rng = np.random.default_rng(5)
    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 7 == 2][: len(names) + 1]
    rows = [(10_000 + i, " ".join(rng.choice(names, 12))) for i in range(60)] + list(zip(held, [*names, ""], strict=True))
    out = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(10 ** out[i] for i in held) <= 1.0


# N-gram Jaccard join.


def near_copies(seed, n=40, length=80):
    rng = np.random.default_rng(seed)
    base = [f"t{i}" for i in rng.integers(0, 500, length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(int(rng.integers(0, 6))):
            w[int(rng.integers(len(w)))] = f"x{int(rng.integers(10_000))}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80)])
def test_jaccard_components(spark, documents, local_docs, k, num):
    passage = " ".join(f"p{i}" for i in range(50))
    more = near_copies(1) + near_copies(2, 300, 60) + [f"{passage} {t}" for t in near_copies(3, 20, 200)] + [" ".join(passage.split()[: 3 + i]) for i in range(12)]
    docs = local_docs + [(10_000 + i, t) for i, t in enumerate(more)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k, num, 100).collect()}
    assert got == {i: x for (i, _), x in zip(docs, brute.jaccard_components(docs, k, num, 100), strict=True)}
    assert len({c for _, c in got.values()}) < len(docs)


def test_jaccard_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = collections.Counter((i, *x) for (i, _), x in zip(rows, brute.jaccard_components(rows, 4, 85, 100), strict=True))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd, 4, 85, 100).collect()) == want
    assert jaccard_components(empty).collect() == []
    kept = keep_one_of_each(odd, 4, 85, 100)
    assert kept.columns == odd.columns
    sets = [brute.shingles(t, 4) for _, t in rows]
    texts = {(i, t) for i, t in rows}
    assert len({c for i, n, c in want if n}) <= kept.count() <= len(texts)
    assert kept.filter("text is null").count() == 2 and any(sets)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=14), min_size=1, max_size=14), st.sampled_from([(85, 100), (80, 100), (1, 2)]))
def test_prefix_tree_connects_what_links(sets, threshold):
    num, den = threshold
    tokens = [np.array(sorted(s), np.uint64) for s in sets]
    df = collections.Counter(x for s in sets for x in s)
    found = connecting_links(tokens, [np.array([df[int(x)] for x in t], np.uint8) for t in tokens], list(map(len, sets)), list(range(len(sets))), num, den)

    def labels(links):
        p = list(range(len(sets)))
        for _ in sets:
            for a, b in links:
                p[a] = p[b] = min(p[a], p[b])
        return p

    every = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and den * len(a & b) >= num * len(a | b)]
    assert {tuple(sorted(x)) for x in found} <= set(every)
    assert labels(found) == labels(every)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 300), (7, 7)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 31)} | {200: 100, 300: 100} | {1000 + i: 1000 for i in range(1, 50)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_are_hashed_by_content():
    hashes, counts = word_hashes([b"Ab c", b"", b" ab\tC\n", b"\xc3\xa9 \xc3\x89"])
    assert counts.tolist() == [2, 0, 2, 2]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and len(set(hashes[:2].tolist() + hashes[4:].tolist())) == 4
