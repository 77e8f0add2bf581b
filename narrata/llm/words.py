"""Words of many texts at once: spans and 64-bit hashes by numpy over UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_ARITY = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if _powers.get("n", np.zeros(0)).size < n + 1:
        size = max(n + 1, 1 << 18)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = np.uint64(_BASE), np.uint64(_INV)
        _powers["n"], _powers["inv"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["n"], _powers["inv"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, segment: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of ``codes[start:end]`` for each span; spans are ascending and disjoint.

    A polynomial prefix hash over segments of bounded length, then scrambled
    together with the span's length.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = int(np.searchsorted(ends, lo + segment, "right"))
        to = max(to, at + 1)
        hi = int(ends[to - 1])
        up, down = _power_tables(hi - lo)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((codes[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=total[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(_ARITY)
        at = to
    return mix64(out)


def separators(pattern_bytes: bytes) -> np.ndarray:
    """Table of 256: True where a byte separates words."""
    table = np.zeros(256, bool)
    table[np.frombuffer(pattern_bytes, np.uint8)] = True
    return table


#: Fixed values of the contracts: white space, and all ASCII but letters and digits.
WHITE_SPACE = separators(bytes([0x20, *range(0x09, 0x0E)]))
NOT_WORD = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def split_words(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a row's end ends its word too."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~sep[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of rows with ``counts`` words each, and each row's number of them.

    A row of fewer than k words, but not none, has its whole sequence as one shingle.
    """
    weights = mix64(np.arange(1, k + 1, dtype=np.uint64))
    weights |= np.uint64(1)
    first = np.cumsum(counts) - counts
    n_sh = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    total = int(n_sh.sum())
    begin = np.repeat(first - (np.cumsum(n_sh) - n_sh), n_sh) + np.arange(total)
    have = np.minimum(np.repeat(counts, n_sh), k)
    acc = have.astype(np.uint64) * np.uint64(_ARITY)
    for j in range(k):
        inside = have > j
        at = np.minimum(begin + j, max(len(words) - 1, 0))
        if total:
            acc += np.where(inside, words[at] * weights[j], np.uint64(0))
    return mix64(acc), n_sh
