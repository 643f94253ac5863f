"""A trie of restricted term vectors, searched depth first under bounds.

A document's vector holds the query terms it has, most frequent term of the corpus first, so
that vectors share their beginnings. Documents sorted by vector are the leaves of the trie in
order and a subtree is a range of them. Paths without a fork aren't kept, and subtrees of at
most ``LEAF`` documents are one leaf.
"""

import numpy as np

#: Documents of a leaf, scored at once.
LEAF = 128


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 20 * m); grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Node:
    """A subtree: its terms, and for each child the tf maxima of these terms and the least m.

    For a leaf the children are documents: their tf are the maxima, and the bounds are scores.
    """

    def __init__(self, terms, tops, m, children=None, at=0):
        self.terms, self.tops, self.m, self.children, self.at = terms, tops, m, children, at

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The most that a document below each child can score."""
        places = np.searchsorted(self.terms, terms)
        places[places == len(self.terms)] = 0
        here = self.terms[places] == terms
        if not here.any():
            return np.zeros(len(self.m), np.int64)
        return weights[here] @ saturated(self.tops[places[here]].astype(np.int64), self.m)


class Trie:
    """Over documents given as one array of vectors, with ``offsets`` into it."""

    def __init__(self, offsets: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray):
        """``terms`` are numbered by falling frequency and sorted within each document."""
        keys, sizes = terms.astype(">u4").tobytes(), np.diff(offsets)
        self.order = np.array(
            sorted(range(len(m)), key=lambda i: keys[4 * offsets[i] : 4 * offsets[i + 1]]), np.int64
        )
        sizes = sizes[self.order]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.repeat(offsets[:-1][self.order] - self.offsets[:-1], sizes) + np.arange(self.offsets[-1])
        self.terms, self.tf, self.sizes, self.m = terms[taken], tf[taken], sizes, m[self.order]
        self.root = self._subtree(0, len(m), 0) if len(m) else None

    def _leaf(self, low: int, high: int) -> Node:
        part = slice(self.offsets[low], self.offsets[high])
        terms, rows = np.unique(self.terms[part], return_inverse=True)
        tops = np.zeros((len(terms), high - low), np.int32)
        tops[rows, np.repeat(np.arange(high - low), self.sizes[low:high])] = self.tf[part]
        return Node(terms, tops, self.m[low:high], at=low)

    def _ranges(self, low: int, high: int, depth: int) -> tuple[int, list[tuple[int, int]]]:
        """The ranges below the first fork at or under ``depth``, small neighbours joined."""
        while True:
            ends = self.sizes[low:high] <= depth
            if ends.all():  # the same vector: any cut will do
                cuts = range(low, high, LEAF)
                return depth, [(a, min(a + LEAF, high)) for a in cuts]
            column = np.full(high - low, -1, np.int64)
            column[~ends] = self.terms[self.offsets[low:high][~ends] + depth]
            cuts = np.flatnonzero(np.diff(column)) + 1 + low
            if len(cuts):
                break
            depth += 1
        found: list[tuple[int, int]] = []
        for a, b in zip([low, *cuts.tolist()], [*cuts.tolist(), high], strict=True):
            if found and b - found[-1][0] <= LEAF:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
        return depth, found

    def _subtree(self, low: int, high: int, depth: int) -> Node:
        if high - low <= LEAF:
            return self._leaf(low, high)
        depth, ranges = self._ranges(low, high, depth)
        children = [self._subtree(a, b, depth) if b - a > LEAF else self._leaf(a, b) for a, b in ranges]
        if len(children) == 1:
            return children[0]
        terms = np.unique(np.concatenate([c.terms for c in children]))
        tops = np.zeros((len(terms), len(children)), np.int32)
        for i, child in enumerate(children):
            if len(child.terms):
                tops[np.searchsorted(terms, child.terms), i] = child.tops.max(axis=1)
        return Node(terms, tops, np.array([c.m.min() for c in children]), children)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: "Best", ids: "list") -> None:
        """Offer all documents that may enter ``best``; ``ids`` names them in their given order."""
        if self.root is None or not len(terms):
            return
        stack = [(None, self.root)]
        while stack:
            bound, node = stack.pop()
            if bound is not None and bound < best.least:
                continue
            bounds = node.bounds(terms, weights)
            hopeful = np.flatnonzero(bounds >= best.least)
            if node.children is None:
                places = self.order[node.at + hopeful]
                best.offer([(-int(s), *ids[p]) for s, p in zip(bounds[hopeful], places, strict=True)])
            else:  # the most hopeful child is looked at first
                for i in hopeful[np.argsort(bounds[hopeful], kind="stable")]:
                    stack.append((bounds[i], node.children[i]))


class Best:
    """The ``size`` least tuples (minus score, ...) met so far."""

    def __init__(self, size: int):
        self.size, self.found = size, []
        #: Documents of a lower score can't enter; only scores above 0 count.
        self.least = 1

    def offer(self, rows: list[tuple]) -> None:
        if rows:
            self.found = sorted(self.found + rows)[: self.size]
            if len(self.found) == self.size:
                self.least = -self.found[-1][0]
