"""Column -> Column text functions (all JVM-side, no Python UDF).

Regular expressions are written so that Java (Spark) gives the same result
as Python's Unicode ``re`` on the constructs the cleaning rules use:
``\\w`` becomes ``[\\p{L}\\p{N}_]`` and Python's ``str.split()`` whitespace
becomes an explicit class, because Java's ``\\w`` and ``\\s`` are ASCII-only.
"""

from __future__ import annotations

import functools
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the reference behaviour).
# Whitespace recognised by Python's str.split(): \t..\r, \x1c..\x1f, space,
# \x85 and the Unicode separator categories (Zs, Zl, Zp).
PY_WS_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"
PY_WS = "[" + PY_WS_CLASS + "]"
# Python's Unicode word character: letters, numbers, underscore.
WORD_CLASS = r"\p{L}\p{N}_"
# Separator placed between sentences before splitting (never in text).
SENTENCE_MARK = "\u0001"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add computed columns that later filters will test, evaluated once.

    A filter on a projected column is pushed below the projection by the
    optimizer with the expression substituted, so an expensive expression
    (the cleaning regexes) would run twice: once in the filter and once in
    the projection. Producing the columns from a one-row generator keeps the
    filter above it, so each expression runs once per row.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def normalize_whitespace(c) -> Column:
    """Strip ends and collapse every whitespace run (newlines too) to one space; single spaces are passed over, not replaced."""
    runs = "[" + PY_WS_CLASS + "&&[^ ]]" + PY_WS + "*| " + PY_WS + "+"
    return F.trim(F.regexp_replace(_col(c), runs, " "))


def spaced_count(c) -> Column:
    """The number of words of a text whose words are parted by single spaces, without spaces at its ends."""
    c = _col(c)
    return F.when(c == "", 0).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)


def spaced(c) -> Column:
    """The words of a text as one string with single spaces, which takes a third of a list's bytes in an exchange."""
    return normalize_whitespace(c)


def spaced_words(c) -> Column:
    """The words of a string of :func:`spaced`; a null has none."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), " "), lambda x: x != "")


def clean_narrative(c, spaced: bool = False) -> Column:
    """Narrative cleaning, steps in the reference order (``spaced``: white space is normalised already).

    trim -> newline to space -> collapse spaces -> lower -> drop punctuation
    -> drop legal references ``<1-5 digits> usc`` -> drop masks ``xx..``.
    Spaces are collapsed *before* the removals, so removals leave double and
    trailing spaces, exactly as the reference does. A lookahead for the first
    characters rules out most places before the lookbehind is tried.
    """
    t = F.lower(_col(c) if spaced else normalize_whitespace(c))
    t = F.regexp_replace(t, r"[^" + WORD_CLASS + r"\s]", "")
    t = F.regexp_replace(
        t, r"(?=\p{Nd})(?<![" + WORD_CLASS + r"])\p{Nd}{1,5}\s+usc(?![" + WORD_CLASS + r"])", "")
    t = F.regexp_replace(t, r"(?=xx)(?<![" + WORD_CLASS + r"])x{2,}(?![" + WORD_CLASS + r"])", "")
    return t


def words(c) -> Column:
    """Whitespace tokens (Python ``str.split()`` semantics: no empty tokens)."""
    return F.filter(F.split(_col(c), PY_WS + "+"), lambda x: x != "")


def word_count(c) -> Column:
    """``len(str(x).split())`` as BIGINT; NULL text stays NULL."""
    return F.when(_col(c).isNotNull(), F.size(words(c)).cast("bigint"))


def exploded(df: DataFrame, words_: Column, *keep: str, name: str = "token") -> DataFrame:
    """``keep`` columns and a row for every element of an array, which is computed once.

    The optimizer puts a filter on the exploded array below the explode, where
    the expression that makes the array would run again.
    """
    return with_computed(df, _words=words_).select(*keep, F.explode("_words").alias(name))


@functools.lru_cache(maxsize=1)
def default_stopwords() -> tuple[str, ...]:
    """Spark MLlib's default English stop words, from the package data file.

    The list ``StopWordsRemover.loadDefaultStopWords("english")`` returns. Read
    as a package resource on first use: no jar, no JVM and no folder is touched
    when the module is imported, and it works from a zipped package.
    """
    raw = resources.files("narrata.data").joinpath("stopwords_en.txt").read_text(encoding="utf-8")
    return tuple(w for w in raw.split("\n") if w)


def letters_only_stopwords(stopwords=None) -> list[str]:
    """Stop words as they look after letters-only cleaning (``don't`` -> ``dont``)."""
    import re

    words_ = default_stopwords() if stopwords is None else stopwords
    out = []
    for w in words_:
        s = re.sub(r"[^a-z]", "", w.lower())
        if s and s not in out:
            out.append(s)
    return out


def strip_stopwords(c, stopwords=None) -> Column:
    """Letters-only cleaning, lower case, tokenise, drop stop words, rejoin."""
    stops = letters_only_stopwords(stopwords)
    t = F.lower(F.regexp_replace(_col(c), "[^a-zA-Z" + PY_WS_CLASS + "]", ""))
    kept = F.filter(words(t), lambda x: ~x.isin(*stops))
    return F.array_join(kept, " ")


def stopword_count(c, stopwords=None) -> Column:
    """Number of whitespace tokens (lower-cased) that are stop words."""
    stops = list(default_stopwords() if stopwords is None else stopwords)
    return F.size(F.filter(words(c), lambda x: F.lower(x).isin(*stops))).cast("bigint")


def sentences(c) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; no empty sentence."""
    t = F.regexp_replace(normalize_whitespace(c), r"([.!?]) ", "$1" + SENTENCE_MARK)
    return F.filter(F.transform(F.split(t, SENTENCE_MARK), lambda s: F.trim(s)),
                    lambda s: s != "")


def dedupe_sentences(c) -> Column:
    """Drop repeated sentences (first occurrence kept, order kept), rejoin with a space."""
    return F.array_join(F.array_distinct(sentences(c)), " ")


def build_text(cols, nulls: str = "empty", sep: str = " ", labels=None) -> Column:
    """Concatenate text parts under one of three null policies.

    ``empty``: any NULL part makes the whole text ``""``.
    ``blank``: a NULL part counts as ``""``; separators stay.
    ``skip``: NULL or empty parts are left out; the rest joined by ``sep``;
        with ``labels`` each part is written ``"<label>: <value>"``.
    """
    parts = [_col(c).cast("string") for c in cols]
    if nulls == "empty":
        return F.coalesce(_concat_sep(parts, sep), F.lit(""))
    if nulls == "blank":
        return _concat_sep([F.coalesce(p, F.lit("")) for p in parts], sep)
    if nulls == "skip":
        if labels is None:
            labels = [None] * len(parts)
        shown = []
        for p, lab in zip(parts, labels):
            v = p if lab is None else F.concat(F.lit(f"{lab}: "), p)
            shown.append(F.when(p.isNotNull() & (p != ""), v))
        return F.concat_ws(sep, *shown)
    raise ValueError(f"unknown null policy {nulls!r}")


def _concat_sep(parts, sep):
    items = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(p)
    return F.concat(*items)


def rouge_tokens(c) -> Column:
    """ROUGE tokens: lower case, runs of ``[a-z0-9]`` (no stemming)."""
    return F.filter(F.split(F.lower(_col(c)), "[^a-z0-9]+"), lambda x: x != "")
