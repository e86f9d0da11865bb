"""A run-compressed Burrows-Wheeler index of many short strings, and the
matching statistics it gives.

The strings stand one after another, each closed by a symbol below all bytes.
The transform is kept as its runs; the suffix array only at both ends of each
run, with the length that the suffixes on either side of a run boundary have
in common.  Walking a text position forward shortens the match with its
neighbour in suffix order by exactly one until the next sampled position, so
the samples alone give, in one pass over the text, how far every position
matches the nearest other place of the collection.
"""

from __future__ import annotations

import numpy as np

#: Symbols in the first sort key: base-258 numbers of this length fit 64 bits.
_FIRST = 7


class RunIndex:
    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1].astype(np.int64)
        n = int((self.sizes + 1).sum())
        symbols = np.zeros(n + _FIRST, np.int64)
        flat = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        inside = np.ones(n, bool)
        inside[self.begins + self.sizes] = False
        symbols[:n][inside] = flat
        self.symbols = symbols
        #: symbols left in the string from each position on
        self.left = np.repeat(self.begins + self.sizes, self.sizes + 1) - np.arange(n)
        order, self.ranks = self._sorted(n)
        self._sample(order, n)

    def _sorted(self, n: int):
        """Suffix order by prefix doubling; also the ranks by the first 7, 14,
        28, ... symbols, which later compare any two places."""
        # what lies behind the text sorts below the symbol that closes strings,
        # so no two suffixes are equal once width reaches n
        sorting = np.append(self.symbols[:n] + 1, np.zeros(_FIRST, np.int64))
        key = np.zeros(n, np.int64)
        for k in range(_FIRST):
            key = key * 258 + sorting[k:k + n]
        ranks, width = [], _FIRST
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(n, bool)
            new[0] = False
            np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(new)
            ranks.append((width, rank))
            if int(rank[order[-1]]) == n - 1:
                return order, ranks
            if width >= n:
                raise RuntimeError("suffixes not told apart by their whole length")
            after = np.zeros(n, np.int64)
            after[:-width] = rank[width:].astype(np.int64) + 1
            key = rank.astype(np.int64) * (n + 1) + after
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols places a and b have in common, within their strings."""
        n = len(self.left)
        length = np.zeros(len(a), np.int64)
        most = np.minimum(self.left[a], self.left[b])
        for width, rank in reversed(self.ranks):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            length += np.where((length < most) & (rank[x] == rank[y]), width, 0)
        for _ in range(_FIRST - 1):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            length += (length < most) & (self.symbols[x] == self.symbols[y])
        return np.minimum(length, most)

    def _sample(self, order: np.ndarray, n: int) -> None:
        before = np.where(order > 0, self.symbols[order - 1], 0)
        # string ends must not join runs: what stands before them is another string
        edge = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0)) + 1
        self.run_heads, self.run_symbols = np.concatenate([[0], edge]), before[np.concatenate([[0], edge])]
        common = self._common(order[edge - 1], order[edge])
        # (place, length in common with the suffix before it) at run heads,
        # (place, length in common with the suffix after it) at run tails
        self.heads = self._by_place(np.append(order[edge], order[0]), np.append(common, 0))
        self.tails = self._by_place(np.append(order[edge - 1], order[n - 1]), np.append(common, 0))

    @staticmethod
    def _by_place(place: np.ndarray, length: np.ndarray):
        order = np.argsort(place)
        return place[order], length[order]

    def matching_statistics(self) -> np.ndarray:
        """For every text place, the longest match with another place."""
        places = np.arange(len(self.left))
        out = np.zeros(len(places), np.int64)
        for sample, length in (self.heads, self.tails):
            at = np.searchsorted(sample, places, "right") - 1
            out = np.maximum(out, np.where(at >= 0, length[at] - (places - sample[at]), 0))
        return np.minimum(out, self.left)

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, begin, end): the maximal runs of symbols covered by
        matches of ``least`` symbols with another place."""
        hit = np.flatnonzero(self.matching_statistics() >= least)
        if not len(hit):
            return (np.zeros(0, np.int64),) * 3
        string = np.searchsorted(self.begins, hit, "right") - 1
        new = np.ones(len(hit), bool)
        new[1:] = (string[1:] != string[:-1]) | (hit[1:] > hit[:-1] + least)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1
        own = string[first]
        return own, hit[first] - self.begins[own], hit[last] - self.begins[own] + least
