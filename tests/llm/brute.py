"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import collections
import math
import re
import zlib

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    return frozenset([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else [])


def jaccard_components(docs, k, num, den):
    """{row number: (set size, component)} of (id, text) rows, by comparing all pairs of distinct sets."""
    sets = [shingles(t, k) for _, t in docs]
    distinct = list({s for s in sets if s})
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            both = len(a & distinct[j])
            if both and den * both >= num * (len(a) + len(distinct[j]) - both):
                parent[find(i)] = find(j)
    root = {s: find(i) for i, s in enumerate(distinct)}
    least = {}
    for (i, _), s in zip(docs, sets, strict=True):
        if s and i is not None:
            least[root[s]] = min(least.get(root[s], i), i)
    return [(len(s), least.get(root[s]) if s else i) for (i, _), s in zip(docs, sets, strict=True)]


def unigram_scores(docs, parts=7, held=2):
    tokens = {i: [*words(t), None] for i, t in docs}
    trains = {i: zlib.crc32(str(i).encode()) % parts != held for i, _ in docs}
    counts = collections.Counter(w for i, t in tokens.items() if trains[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    return {i: (not trains[i], len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for i, t in tokens.items()}


def water_fill(sizes, weights, most=3):
    """{source: target} by repeated sharing of what exceeds `most` times a source's size."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in sizes if s not in capped]
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: float(most * sizes[s]) for s in over}
