"""Signature tree over sets: OR-combined element bitmaps and size ranges (operator 1).

A leaf is a set of 64-bit elements with a bitmap of their hashes; a node joins
eight neighbours (in the order of their smallest elements, so that similar sets
lie together) by OR of the bitmaps, the range of sizes, and the largest excess
of a set's size over its bitmap's bits. Two sets share at most the common bits
of their nodes plus the smaller excess, and two similar sets share at least
num / (num + den) of their sizes' sum. A dual traversal goes down pairs of
nodes and drops those that can't hold a similar pair, and pairs whose sets are
all in one component already. Pairs of leaves that are left are compared
exactly.
"""

from __future__ import annotations

import numpy as np

FAN = 8
#: Node pairs whose children are compared at once.
STEP = 512


class SignatureTree:
    """``sets`` are sorted arrays of distinct elements; ``labels`` say which belong together already."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, num: int, den: int):
        self.order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        self.label = np.unique(labels, return_inverse=True)[1][self.order]
        self.num, self.den = num, den
        sizes = np.array([len(s) for s in self.sets], np.int64)
        bits = 1 << int(np.clip(np.ceil(np.log2(8 * max(1, np.percentile(sizes, 75)))), 9, 14))
        maps = np.zeros((len(sets), bits // 8), np.uint8)
        for i, s in enumerate(self.sets):
            at = ((s >> np.uint64(17)) % np.uint64(bits)).astype(np.int64)
            np.bitwise_or.at(maps[i], at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        maps = maps.view(np.uint64)
        excess = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, excess = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of nodes that may hold a similar pair of sets."""
        maps, low, high, excess = self.levels[level]
        ok = (high[i] * self.den >= low[j] * self.num) & (high[j] * self.den >= low[i] * self.num)
        i, j = i[ok], j[ok]
        common = np.bitwise_count(maps[i] & maps[j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(common + np.minimum(excess[i], excess[j]), np.minimum(high[i], high[j]))
        ok[ok] = most * (self.num + self.den) >= (low[i] + low[j]) * self.num
        return ok

    def _apart(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of nodes whose sets aren't all in one component."""
        at = np.arange(0, len(self.label), FAN ** level)
        low, high = np.minimum.reduceat(self.label, at), np.maximum.reduceat(self.label, at)
        return (low[i] != high[i]) | (low[j] != high[j]) | (low[i] != low[j])

    def similar(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        shared = int((b[at] == a).sum())
        return shared * self.den >= self.num * (len(a) + len(b) - shared)

    def link(self) -> np.ndarray:
        """A component's number for each set, in the order they were given."""
        zero = np.zeros(1, np.int64)
        todo = [(len(self.levels) - 1, zero, zero)] if self.sets else []
        while todo:
            level, i, j = todo.pop()
            if len(i) > STEP:
                todo += [(level, i[at:at + STEP], j[at:at + STEP]) for at in range(0, len(i), STEP)][::-1]
                continue
            keep = self._apart(level, i, j)
            i, j = i[keep], j[keep]
            if level == 0:
                self._compare(i, j)
                continue
            child = np.arange(FAN)
            a = np.repeat((i[:, None] * FAN + child), FAN, axis=1).ravel()
            b = np.tile((j[:, None] * FAN + child), (1, FAN)).ravel()
            n = len(self.levels[level - 1][0])
            real = (a < n) & (b < n) & ((a < b) if level == 1 else (a <= b))
            a, b = a[real], b[real]
            keep = self._apart(level - 1, a, b)
            a, b = a[keep], b[keep]
            keep = self._possible(level - 1, a, b)
            if keep.any():
                a, b = a[keep], b[keep]
                near = np.argsort(b - a, kind="stable")  # near neighbours first: their links save comparisons
                todo.append((level - 1, a[near], b[near]))
        out = np.empty(len(self.sets), np.int64)
        out[self.order] = self.label
        return out

    def _compare(self, i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = self.label[a], self.label[b]
            if x != y and self.similar(a, b):
                self.label[self.label == y] = x
