"""Exact candidate signatures for set similarity: which parts of two sets must be equal.

Sets whose Jaccard similarity is num/den or more differ in at most H elements.
Dealing a set's elements into P > H parts by their hashes leaves at least
m = P - H parts equal, so two such sets share the signature of a part. Sizes
are cut into classes, each with its own P, so that a pair lies in one class or
in two neighbours; a set signs for its own class and for the class below.

Parts with few rare elements say little: frequent elements (a set Z, any set
does) don't count, and a part with fewer than w others is weak. Equal parts
are weak in both sets or in neither, so a set with fewer than m weak parts
signs the strong ones only and still shares one with every similar set. A set
with more signs all its parts, the empty ones only if m or more are empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from narrata.llm.words import mix64


@dataclass(frozen=True)
class SizeClass:
    low: int
    high: int
    differ: int  # the most elements in which a pair whose smaller set is of this class may differ
    parts: int
    least: int  # rare elements that make a part strong


def _few(rate: float, least: int) -> float:
    """Poisson probability of fewer than ``least``."""
    return math.exp(-rate) * sum(rate ** i / math.factorial(i) for i in range(least))


def _parts(low: int, differ: int) -> tuple[int, int]:
    """P and w: the strictest w whose weak parts cost at most a quarter more parts."""
    for least in (3, 2, 1):
        parts = differ + 2
        for _ in range(50):
            p = _few(low / parts, least)
            more = differ + 1 + math.ceil(parts * p + 1.5 * math.sqrt(parts * p * (1 - p)))
            if more <= parts:
                break
            parts = more
        if parts <= 1.25 * (differ + 1) + 1 or least == 1:
            return min(parts, 2 * differ + 4), least
    raise AssertionError


#: A class's largest size over its smallest, at least (similar sets never differ by more than one class). Wide
#: classes need more parts, but fewer sets sign for the class below; this is about the least number in all.
WIDTH = 1.35


@lru_cache(maxsize=None)
def _class_at(low: int, num: int, den: int) -> SizeClass:
    high = max(low * den // num, int(low * WIDTH) if low * den // num > low else low)
    differ = (den - num) * (high + high * den // num) // (den + num)
    parts, least = _parts(low, differ) if differ else (0, 0)
    return SizeClass(low, high, differ, parts, least)


def size_classes(largest: int, num: int, den: int) -> list[SizeClass]:
    """The classes of sizes 1 to ``largest``; a similar pair's larger set is in the same class or the next."""
    out, low = [], 1
    while low <= largest:
        out.append(_class_at(low, num, den))
        low = out[-1].high + 1
    return out


def signatures(elements: np.ndarray, counts: np.ndarray, frequent: np.ndarray, num: int, den: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets (distinct hashes, one set after another) and the set of each signature."""
    classes = size_classes(int(counts.max(initial=1)), num, den)
    lows, highs = np.array([c.low for c in classes]), np.array([c.high for c in classes], np.int64)
    own = np.searchsorted(lows, counts, "right") - 1
    rare = np.ones(len(elements), bool)
    if len(frequent):
        rare = frequent[np.minimum(np.searchsorted(frequent, elements), len(frequent) - 1)] != elements
    value = mix64(elements ^ np.uint64(0xA0761D6478BD642F))
    parts_of = np.array([c.parts for c in classes], np.int64)
    least_of = np.array([c.least for c in classes], np.int64)
    equal_of = parts_of - np.array([c.differ for c in classes], np.int64)
    sigs, sets = [], []
    for below in (0, 1):
        cls = own - below
        live = (counts > 0) & (cls >= 0)
        cls = np.where(live, cls, 0)
        if below:  # only sets that can be similar to one of the class below
            live &= counts * num <= highs[cls] * den
        parts = np.where(live, parts_of[cls], 0)
        if not parts.any():
            continue
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        many = np.repeat(parts, counts)
        inside = many > 0
        at = np.repeat(base, counts)[inside] + (elements[inside] % many[inside].astype(np.uint64)).astype(np.int64)
        content = np.zeros(total, np.uint64)
        np.add.at(content, at, value[inside])
        filled = np.bincount(at, minlength=total)
        strong = np.bincount(at[rare[inside]], minlength=total) >= np.repeat(least_of[cls], parts)
        of = np.repeat(np.arange(len(counts)), parts)
        weak = np.bincount(of[~strong], minlength=len(counts))
        empty = np.bincount(of[filled == 0], minlength=len(counts))
        equal = equal_of[cls]
        keep = strong | ((weak >= equal)[of] & (filled > 0)) | ((empty >= equal)[of] & (filled == 0))
        number = (np.arange(total) - base[of])[keep].astype(np.uint64)
        key = content[keep] + mix64(number * np.uint64(0x9E3779B1) + (cls[of][keep].astype(np.uint64) << np.uint64(40)))
        sigs.append(mix64(key + filled[keep].astype(np.uint64)))
        sets.append(of[keep])
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(sets)
