"""A prefix tree of ordered sets, for joins by Jaccard similarity.

The sets' tokens have one global order (rarest first). Sets that start alike share a path,
so an overlap counted along it is counted once for all of them. A subtree is left out when
what remains of its sets and of the probe can't bring any overlap to the threshold.
"""

from __future__ import annotations

import numpy as np


class Groups:
    """Union-find over 0 to n - 1, started from labels."""

    def __init__(self, labels: list) -> None:
        first: dict = {}
        self.parent = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def union(self, a: int, b: int) -> None:
        self.parent[self.find(b)] = self.find(a)


class PrefixTree:
    """Sets as ascending arrays of ranks. sizes may exceed their lengths by tokens that no other set has."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], num: int, den: int) -> None:
        self.sets, self.sizes, self.num, self.den = sets, sizes, num, den
        self.share = num / (num + den)  # overlap >= share * (both sizes)
        keys = [s.astype(">i4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=lambda i: keys[i])
        self.root = self._build(0, len(sets), 0) if sets else None

    def _build(self, lo: int, hi: int, depth: int) -> tuple:
        """(ranks of the edge to it, depth after it, sets that end there, children, largest slack, least size, a set, whether alone)"""
        a, b = self.sets[self.order[lo]], self.sets[self.order[hi - 1]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:m] != b[depth:m]) if hi - lo > 1 else ()
        end = len(a) if hi - lo == 1 else depth + int(differ[0]) if len(differ) else m
        ends, at = [], lo
        while at < hi and len(self.sets[self.order[at]]) == end:
            ends.append(self.order[at])
            at += 1
        children = []
        while at < hi:
            token, to = self.sets[self.order[at]][end], at + 1
            while to < hi and self.sets[self.order[to]][end] == token:
                to += 1
            children.append(self._build(at, to, end))
            at = to
        slack = max([len(self.sets[i]) - self.share * self.sizes[i] for i in ends] + [c[4] for c in children])
        least = min([self.sizes[i] for i in ends] + [c[5] for c in children])
        return a[depth:end], end, ends, children, slack, least, self.order[lo:hi]

    def probe(self, ranks: np.ndarray, size: int, mark: np.ndarray, skip) -> list[int]:
        """Sets that link with the probe. mark: False for all ranks, and again afterwards. skip(sets): whether none of them is wanted."""
        found: list[int] = []
        if self.root is None or not size:
            return found
        mark[ranks] = True
        need = self.share * size - 1e-6
        stack = [(self.root, 0)]
        while stack:
            (edge, depth, ends, children, slack, least, under), overlap = stack.pop()
            if skip(under):
                continue
            if len(edge):
                overlap += int(np.count_nonzero(mark[edge]))
                left = len(ranks) - int(np.searchsorted(ranks, edge[-1], "right"))
                if overlap + left < self.share * least + need:
                    continue
            if overlap - depth + slack < need:
                continue
            found += [i for i in ends if overlap * (self.num + self.den) >= self.num * (self.sizes[i] + size)]
            stack += [(c, overlap) for c in children]
        mark[ranks] = False
        return found


def to_ranks(tokens: list[np.ndarray], levels: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Each set's tokens as ascending ranks in the order of (level, token), and the number of ranks."""
    if not tokens:
        return [], 0
    flat, at = np.concatenate(tokens), np.cumsum([0, *map(len, tokens)])
    known, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
    order = np.lexsort((known, np.concatenate(levels)[first]))
    rank = np.empty(len(known), np.int32)
    rank[order] = np.arange(len(known), dtype=np.int32)
    ranks = rank[inverse]
    return [np.sort(ranks[a:b]) for a, b in zip(at, at[1:], strict=False)], len(known)


def links_with(center: int, tokens: list[np.ndarray], levels: list[np.ndarray], sizes: list[int], num: int, den: int) -> list[int]:
    """Indexes of the other sets that link with the center's."""
    ranks, n = to_ranks(tokens, levels)
    others = [i for i in range(len(ranks)) if i != center]
    tree = PrefixTree([ranks[i] for i in others], [sizes[i] for i in others], num, den)
    return [others[i] for i in tree.probe(ranks[center], sizes[center], np.zeros(n, bool), lambda under: False)]


def connecting_links(tokens: list[np.ndarray], levels: list[np.ndarray], sizes: list[int], groups: list, num: int, den: int) -> list[tuple[int, int]]:
    """Links enough to connect all that link, where sets of one group count as connected."""
    ranks, n = to_ranks(tokens, levels)
    tree, mark, known, out = PrefixTree(ranks, sizes, num, den), np.zeros(n, bool), Groups(groups), []
    for i in range(len(ranks)):
        mine = known.find(i)
        for j in tree.probe(ranks[i], sizes[i], mark, lambda under, mine=mine: all(known.find(k) == mine for k in under) if len(under) <= 16 else False):
            if known.find(i) != known.find(j):
                known.union(i, j)
                out.append((i, j))
    return out
