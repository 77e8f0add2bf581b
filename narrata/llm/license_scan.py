"""License scans: Dice coefficient of word bigrams against templates (operator 2).

A text is normalised (A-Z to lower case; words are runs of letters, digits and
non-ASCII characters) and compared with every template through the windows as
long as the template: a window's score is the Dice coefficient of the two sets
of word bigrams. Size bounds prune: a score of d needs at least
d / (2 - d) of the template's bigrams, so a text or window with fewer of them
is never compared.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import resources
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from narrata.llm.batches import map_texts, row_chunks, text_buffer
from narrata.llm.words import LOWER, NOT_WORD, shingle_hashes, span_hashes, split_words

#: Least score, as a fraction of whole numbers.
LEAST = (9, 10)


def _default_templates() -> tuple[tuple[str, str, str], ...]:
    raw = resources.files("narrata.llm").joinpath("licenses.json").read_text(encoding="utf-8")
    return tuple((x["license"], x["name"], x["text"]) for x in json.loads(raw))


#: Public license notices and texts of the package data: (license, name of the text, text).
TEMPLATES = _default_templates()


@dataclass
class Compiled:
    """Templates as bigrams: ``member[b, t]`` says that bigram ``bigrams[b]`` is one of template t."""

    templates: list[tuple[str, str, str]]
    bigrams: np.ndarray
    member: np.ndarray
    windows: np.ndarray
    sizes: np.ndarray
    least: tuple[int, int]

    @property
    def need(self) -> np.ndarray:
        """The fewest bigrams of each template in a window that scores enough."""
        num, den = self.least
        return -(-(num * self.sizes) // (2 * den - num))


def _bigrams(texts: pa.Array):
    raw, offsets = text_buffer(texts)
    lower = LOWER[raw]
    starts, ends, rows = split_words(lower, offsets, NOT_WORD)
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    hashes, counts = shingle_hashes(span_hashes(lower, starts, ends), n_words, 2)
    # a single word has no bigram
    single = np.repeat(n_words == 1, counts)
    return hashes[~single], np.where(n_words == 1, 0, counts), starts, ends, n_words, raw, offsets


def compile_templates(templates=TEMPLATES, least: tuple[int, int] = LEAST) -> Compiled:
    """Templates of fewer than two words can't match and are left out."""
    hashes, counts, *_ = _bigrams(pa.array([t for *_, t in templates], pa.string()))
    kept = [i for i, n in enumerate(counts) if n]
    ends = np.cumsum(counts)
    own = {i: np.unique(hashes[ends[i] - counts[i]:ends[i]]) for i in kept}
    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *own.values()]))
    member = np.zeros((len(every), len(kept)), bool)
    for t, i in enumerate(kept):
        member[np.searchsorted(every, own[i]), t] = True
    return Compiled([tuple(templates[i]) for i in kept], every, member, counts[kept].astype(np.int64),
                    member.sum(axis=0), least)


def _distinct_ahead(values: np.ndarray, places: np.ndarray, length: int, n: int) -> np.ndarray:
    """How many distinct ``values`` (at ascending ``places`` of 0..n-1) each window of ``length`` from 0..n-1 on holds."""
    order = np.argsort(values, kind="stable")
    again = values[order[1:]] == values[order[:-1]]
    before = np.full(len(values), -1)
    before[order[1:][again]] = places[order[:-1][again]]
    # a value counts at its first place of a window: for windows that begin behind its place before, and hold it
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.maximum(before, places - length) + 1, 1)
    np.add.at(steps, places + 1, -1)
    return np.cumsum(steps)[:n]


def scoring_windows(bigrams: np.ndarray, hits: np.ndarray, template: int, c: Compiled) -> list[tuple[int, int, int]]:
    """(shared, both sizes, first bigram) of all windows of a text that score enough.

    Windows begin at a bigram of the template and are as long as the template,
    or end with the text. All windows are counted in one pass, in the time of
    sorting the text's bigrams, however often the text repeats a template.
    """
    num, den = c.least
    places = np.flatnonzero(hits >= 0)
    places = places[c.member[hits[places], template]]
    n, length = len(bigrams), int(c.windows[template])
    shared = _distinct_ahead(hits[places], places, length, n)[places]
    places, shared = places[shared >= c.need[template]], shared[shared >= c.need[template]]
    if not len(places):
        return []
    both = _distinct_ahead(bigrams, np.arange(n), length, n)[places] + int(c.sizes[template])
    good = 2 * shared * den >= num * both
    return list(zip(shared[good].tolist(), both[good].tolist(), places[good].tolist(), strict=True))


def best_window(windows: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The first of the best windows."""
    best = None
    for w in windows:
        if best is None or w[0] * best[1] > best[0] * w[1]:
            best = w
    return best


def unexplained(found: list[tuple[int, list[tuple[int, int, int]]]], hits: np.ndarray, c: Compiled) -> set[int]:
    """Templates with a window that no better match explains (``found``: templates with their windows).

    Windows go by descending score. One of which more than half of the matched
    bigrams lie in better windows that stay is the same notice again, seen
    through a similar template; windows of equal scores all stay.
    """
    # sizes are far below 2**25, so different fractions are different doubles
    every = sorted(((w[0] / w[1], t, w[2]) for t, own in found for w in own), reverse=True)
    explained = np.zeros(len(hits), bool)
    out = set()
    for _, group in groupby(every, key=lambda x: x[0]):
        stay = []
        for _, t, first in group:
            own = hits[first:first + c.windows[t]]
            places = first + np.flatnonzero((own >= 0) & c.member[own, t])
            if 2 * explained[places].sum() <= len(places):
                out.add(t)
                stay.append(places)
        for places in stay:
            explained[places] = True
    return out


def _scan(c: Compiled, text: str, keep: list[str], added: list[str], best_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_chunks(batches, text):
            bigrams, counts, starts, ends, n_words, raw, offsets = _bigrams(rows.column(text))
            hits = np.full(len(bigrams), -1)
            if len(c.bigrams):
                at = np.minimum(np.searchsorted(c.bigrams, bigrams), len(c.bigrams) - 1)
                hits = np.where(c.bigrams[at] == bigrams, at, -1)
            of = np.repeat(np.arange(len(counts)), counts)
            found = np.flatnonzero(hits >= 0)
            pairs = np.unique(of[found] * max(1, len(c.bigrams)) + hits[found])
            shared = np.zeros((len(counts), len(c.templates)), np.int32)
            np.add.at(shared, pairs // max(1, len(c.bigrams)), c.member[pairs % max(1, len(c.bigrams))])
            results: list[list[tuple]] = [[] for _ in counts]
            windows: list[list[tuple]] = [[] for _ in counts]
            first, word = np.cumsum(counts) - counts, np.cumsum(n_words) - n_words
            for row, t in zip(*np.nonzero(shared >= c.need), strict=True):
                own = slice(first[row], first[row] + counts[row])
                scoring = scoring_windows(bigrams[own], hits[own], t, c)
                if (best := best_window(scoring)) is None:
                    continue
                windows[row].append((t, scoring))
                begins = np.cumsum((raw[offsets[row]:offsets[row + 1]] & 0xC0) != 0x80)
                a = word[row] + best[2]
                b = min(a + c.windows[t], word[row] + n_words[row] - 1)
                results[row].append((c.templates[t], 2 * best[0] / best[1],
                                     int(begins[starts[a] - offsets[row]]) - 1,
                                     int(begins[ends[b] - 1 - offsets[row]])))
            tops = [min(r, key=lambda x: (-x[1], x[2], x[0][1])) if r else None for r in results]
            licenses = [{x[0][0] for x in r} for r in results]
            for row, own in enumerate(licenses):
                if best_only and len(own) > 1:
                    stay = unexplained(windows[row], hits[first[row]:first[row] + counts[row]], c)
                    licenses[row] = {c.templates[t][0] for t in stay}
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(k) for k in keep), pa.array(counts, pa.int64()),
                 pa.array([sorted(x) for x in licenses], pa.list_(pa.string())),
                 pa.array([t and t[0][1] for t in tops], pa.string()),
                 pa.array([t and t[1] for t in tops], pa.float64()),
                 pa.array([t and t[2] for t in tops], pa.int64()), pa.array([t and t[3] for t in tops], pa.int64())],
                names=[*keep, *added])
    return run


def scan(docs: DataFrame, templates=TEMPLATES, least: tuple[int, int] = LEAST, keep: list[str] | None = None,
         text: str = "text", best_only: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the licenses found in each text.

    Adds ``n_bigrams`` (the text's word bigrams), ``licenses`` (sorted, of all
    templates that score enough), and of the best template ``template``,
    ``dice``, ``match_start`` and ``match_end`` (characters of the original
    text); ties go to the earlier match, then by name. Columns of ``docs`` by
    these names are replaced. Texts that are null, empty or a single word have
    no bigrams and no licenses. The templates are the caller's and go to the
    tasks with the code.

    Templates of different licenses may differ in a word. With ``best_only``
    the best match of a place counts alone (ties: all of them), see
    :func:`unexplained`; without, ``licenses`` holds every license whose
    template scores enough.
    """
    added = ["n_bigrams", "licenses", "template", "dice", "match_start", "match_end"]
    keep = [c for c in (keep or docs.columns) if c not in added]
    types = [LongType(), ArrayType(StringType()), StringType(), DoubleType(), LongType(), LongType()]
    schema = StructType([*(docs.schema[c] for c in keep),
                         *(StructField(n, t) for n, t in zip(added, types, strict=True))])
    return map_texts(docs.select(*dict.fromkeys([*keep, text])),
                     _scan(compile_templates(templates, least), text, keep, added, best_only), schema)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document, the best match at each place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, keep=["doc_id"], best_only=True)
