"""The published suffix-stripping rules for English (Porter 1980), applied once per worker to each distinct word."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as TY

# ---------------------------------------------------------------------------
# The suffix tables of the published rules, in their order.
_STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
           "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
           "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
           "ous", "ive", "ize"]
SHORTEST = 4   # shorter words are left alone in summary scores
# ---------------------------------------------------------------------------

_GROUPS = re.compile("v+c+")


def _kinds(word: str) -> str:
    """``c`` or ``v`` for every letter; y is a vowel behind a consonant."""
    out = ""
    for c in word:
        vowel = c in "aeiou" or c == "y" and out[-1:] == "c"
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(_GROUPS.findall(_kinds(stem)))


def _short_end(word: str) -> bool:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return _kinds(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay as they are."""
    if len(word) <= 2:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        if _measure(word[:-3]):
            word = word[:-1]
    else:
        cut = word.removesuffix("ed") if word.endswith("ed") else word.removesuffix("ing")
        if cut != word and "v" in _kinds(cut):
            word = cut
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif word[-1:] == word[-2:-1] and _kinds(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    if word.endswith("y") and "v" in _kinds(word[:-1]):
        word = word[:-1] + "i"

    for table in (_STEP_2, _STEP_3):
        suffix = _longest(word, table)
        if suffix and _measure(word.removesuffix(suffix)):
            word = word.removesuffix(suffix) + table[suffix]
    suffix = _longest(word, _STEP_4)
    cut = word.removesuffix(suffix)
    if suffix and _measure(cut) > 1 and (suffix != "ion" or cut[-1:] in ("s", "t")):
        word = cut

    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _short_end(word[:-1]):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@functools.lru_cache(maxsize=1 << 18)
def _known(word: str) -> str:
    return stem(word)


def _stem_lists(lists: pa.Array) -> pa.Array:
    coded = lists.flatten().dictionary_encode()
    known = pa.array([w if w is None or len(w) < SHORTEST else _known(w) for w in coded.dictionary.to_pylist()], pa.string())
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(ends, known.take(coded.indices), mask=lists.is_null())


@F.arrow_udf(TY.ArrayType(TY.StringType()))
def _stems(words: pa.Array) -> pa.Array:
    return _stem_lists(words)


def stems(words: Column) -> Column:
    """The words of an array, each of ``SHORTEST`` letters or more by its stem (Arrow batches, no shuffle)."""
    return _stems(words)
