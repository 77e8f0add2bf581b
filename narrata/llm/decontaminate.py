"""Benchmark decontamination with an Aho-Corasick automaton over words (operator 5).

The normalised test texts are cut into windows of 13 words, and one automaton
holds the windows of all items. Its alphabet is the benchmark's vocabulary:
every word of a text becomes one symbol (words that no item has share one), so
a text is scanned once, a step a word, and a window is matched at all its
places. Matches are runs of words; the words' places in the original text turn
them into character offsets.

The benchmark's items are cut into stretches of bounded size on Spark and
gathered in parts of at most ``MAX_WINDOWS`` windows and ``MAX_WORDS`` words.
A part is what the driver holds, broadcasts, and a worker's automaton is built
from; a larger benchmark has several, which the texts pass one after another,
carrying the runs found so far. After every ``PARTS_AT_ONCE`` parts the texts
are written, so that no more parts than these are held anywhere at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from narrata.llm.batches import map_texts, row_chunks, text_buffer
from narrata.llm.words import LOWER, NOT_WORD, span_hashes, split_words
from narrata.sources import io as IO

WINDOW = 13
#: Windows of one automaton (some 150 MB at most on each worker).
MAX_WINDOWS = 200_000
#: Words of an automaton's items: each is a symbol, and symbols are code points.
MAX_WORDS = 1_000_000
PARTS_AT_ONCE = 4
#: Code points of symbols: 0 is any word that no item has.
_SURROGATES, _GAP = 0xD800, 0x800


def words_of(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Hash, start byte, end byte and row of every normalised word; and the bytes and the rows' offsets."""
    raw, offsets = text_buffer(texts)
    lower = LOWER[raw]
    starts, ends, rows = split_words(lower, offsets, NOT_WORD)
    return span_hashes(lower, starts, ends), starts, ends, rows, raw, offsets


class Automaton:
    """The windows of some items; ``find`` gives their places among a text's words."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        hashes, _, _, rows, _, _ = words_of(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = np.unique(hashes)
        symbols = self._symbols(hashes)
        owners: dict[str, set[int]] = {}
        for i, (item_id, _) in enumerate(items):
            text = self._string(symbols[slice(*np.searchsorted(rows, [i, i + 1]))])
            size = min(window, len(text))
            for at in range(len(text) - size + 1 if text else 0):
                owners.setdefault(text[at:at + size], set()).add(item_id)
        self.automaton = ahocorasick.Automaton()
        for key, own in owners.items():
            self.automaton.add_word(key, (len(key), tuple(own)))
        if owners:
            self.automaton.make_automaton()

    def _symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        code = at + 1 + _GAP * (at + 1 >= _SURROGATES)
        return np.where(self.vocabulary[at] == hashes, code, 0).astype(np.uint32)

    @staticmethod
    def _string(symbols: np.ndarray) -> str:
        return symbols.astype("<u4").tobytes().decode("utf-32-le")

    def find(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int, tuple[int, ...]]]:
        """(row, first word, last word, items) of each window's place; words count over all rows."""
        if len(self.automaton):
            for last, (size, items) in self.automaton.iter(self._string(self._symbols(hashes))):
                first = last - size + 1
                if rows[first] == rows[last]:
                    yield int(rows[last]), first, last, items


_automata: dict[str, Automaton] = {}


def _automaton(key: str, items, window: int) -> Automaton:
    """This worker's automaton of a broadcast list of items."""
    if key not in _automata:
        _automata.clear()
        _automata[key] = Automaton(items.value, window)
    return _automata[key]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _scan(items, window: int, text: str, keep: list[str], added: list[str],
          before: tuple[str, str] | None):
    """Task code: adds to each row its number of words, runs of hit words, spans and items."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, items, window)
        for rows in row_chunks(batches, text):
            n = rows.num_rows
            hashes, starts, ends, of, raw, offsets = words_of(rows.column(text))
            n_words = np.bincount(of, minlength=n)
            base = np.cumsum(n_words) - n_words
            runs: list[list[tuple[int, int]]] = [[] for _ in range(n)]
            found: list[set[int]] = [set() for _ in range(n)]
            if before:
                for i, (r, own) in enumerate(zip(rows.column(before[0]).to_pylist(),
                                                 rows.column(before[1]).to_pylist(), strict=True)):
                    runs[i], found[i] = list(zip(r[::2], r[1::2], strict=True)), set(own)
            for row, first, last, own in automaton.find(hashes, of):
                runs[row].append((first - int(base[row]), last - int(base[row])))
                found[row].update(own)
            runs = [_merged(r) for r in runs]
            spans: list[list[int]] = []
            for i, own in enumerate(runs):
                spans.append([])
                if own:  # a character begins at each byte that continues none
                    begins = np.cumsum((raw[offsets[i]:offsets[i + 1]] & 0xC0) != 0x80)
                    for a, b in own:
                        spans[-1] += [int(begins[starts[base[i] + a] - offsets[i]]) - 1,
                                      int(begins[ends[base[i] + b] - 1 - offsets[i]])]
            flat = [[x for pair in own for x in pair] for own in runs]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(n_words, pa.int64()),
                 pa.array([sum(b - a + 1 for a, b in own) for own in runs], pa.int64()), pa.array(flat, pa.list_(pa.int64())),
                 pa.array(spans, pa.list_(pa.int64())), pa.array([sorted(f) for f in found], pa.list_(pa.int64()))],
                names=[*keep, *added])
    return run


def _cut(window: int):
    """Items to stretches, and each to a part of bounded size within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, windows, words = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for stretch, size, many in _stretches(text, window):
                    if windows and (windows + size > MAX_WINDOWS or words + many > MAX_WORDS):
                        part, windows, words = part + 1, 0, 0
                    windows, words = windows + size, words + many
                    yield pa.RecordBatch.from_pydict(
                        {"task": [task], "part": [part], "item_id": [item], "stretch": [stretch], "windows": [size],
                         "words": [many]}, schema=_STRETCHES)
    return run


_STRETCHES = pa.schema([("task", pa.int32()), ("part", pa.int32()), ("item_id", pa.int64()), ("stretch", pa.string()),
                        ("windows", pa.int64()), ("words", pa.int64())])


def _parts(benchmark: DataFrame, window: int) -> tuple[DataFrame, list[list[str]]]:
    """The benchmark's written stretches, and their parts of at most ``MAX_WINDOWS`` windows and ``MAX_WORDS`` words.

    Only the sizes of the tasks' own parts (a row for each) come to the driver.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    cut = IO.materialize(items.mapInArrow(
        _cut(window), "task int, part int, item_id long, stretch string, windows long, words long"),
        benchmark.sparkSession, "benchmark-stretches").withColumn("key", F.concat_ws(":", "task", "part"))
    parts: list[list[str]] = [[]]
    windows = words = 0
    for r in cut.groupBy("task", "part", "key").agg(F.sum("windows").alias("windows"), F.sum("words").alias("words")).orderBy(
            "task", "part").collect():
        if windows and (windows + r.windows > MAX_WINDOWS or words + r.words > MAX_WORDS):
            parts.append([])
            windows = words = 0
        parts[-1].append(r.key)
        windows, words = windows + r.windows, words + r.words
    return cut, parts


def _stretches(text: str, window: int) -> list[tuple[str, int, int]]:
    """(stretch, windows, words) of an item; one of more than ``MAX_WINDOWS`` words is cut into overlapping stretches."""
    _, starts, ends, _, raw, _ = words_of(pa.array([text], pa.string()))
    n = len(starts)
    if n <= MAX_WINDOWS:
        return [(text, max(n - window + 1, 1), n)] if n else []
    out = []
    for at in range(0, n - window + 1, MAX_WINDOWS):
        last = min(at + MAX_WINDOWS + window - 1, n)
        out.append((raw[starts[at]:ends[last - 1]].tobytes().decode(), last - at - window + 1, last - at))
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW,
             text: str = "text") -> DataFrame:
    """``docs`` (or its columns ``keep``) with what the benchmark has in common with each text.

    Adds ``n_words``, ``n_hit`` (hit words), ``hit_runs`` (first and last word of each run of hit
    words, flat), ``spans`` (the runs' begin and end as character offsets in
    the original text, flat) and ``items`` (the item_ids whose windows occur).
    A column of ``docs`` by one of these names is replaced. Null texts have no
    words and no hits. Items with a null id or text, or without a word, are no
    items; an item_id that occurs twice is one item with both texts. Rows stay
    rows: repeated and null doc_ids are kept as they are.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "hit_runs", "spans", "items"]
    keep = [c for c in (keep or docs.columns) if c not in added]
    cut, parts = _parts(benchmark, window)
    out, before = docs.select(*dict.fromkeys([*keep, text])), None
    for i, part in enumerate(parts):
        if i and i % PARTS_AT_ONCE == 0:
            out = IO.materialize(out, spark, "decontaminate")
        items = [(r.item_id, r.stretch) for r in cut.filter(F.col("key").isin(part)).select("item_id", "stretch").collect()]
        held = [c for c in out.columns if c not in added] if i < len(parts) - 1 else keep
        fields = [out.schema[c] for c in held]
        schema = StructType([*fields, *(StructField(c, LongType()) for c in added[:2]),
                             *(StructField(c, ArrayType(LongType())) for c in added[2:])])
        out = map_texts(out, _scan(spark.sparkContext.broadcast(items), window, text, held, added, before), schema)
        before = ("hit_runs", "items")
    return out


def contaminated() -> Column:
    """A twentieth of a text's words at least, and one word at least, are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents, with its own columns."""
    keep = {c: f"kept_{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in keep.items()))
    found = annotate(named, benchmark, text=keep["text"]).filter(~contaminated())
    return found.select(*(F.col(k).alias(c) for c, k in keep.items()))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document shares with the benchmark's windows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = annotate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), contaminated().alias("contaminated"))


SQL = r"""
WITH norm AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
items AS (SELECT id, w, least(13, len(w)) AS k FROM norm WHERE kind = 'i' AND len(w) > 0),
iw AS (SELECT DISTINCT id, k, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM items)),
ks AS (SELECT DISTINCT k FROM items),
dw AS (SELECT id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT n.id, n.w, ks.k, unnest(range(1, len(n.w) - ks.k + 2)) AS p FROM norm n, ks
             WHERE n.kind = 'd' AND len(n.w) >= ks.k)),
hits AS (SELECT dw.id, dw.k, dw.p, iw.id AS item FROM dw JOIN iw ON iw.k = dw.k AND iw.win = dw.win),
words AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY id),
found AS (SELECT id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS s FROM hits) GROUP BY id)
SELECT n.id AS doc_id, CAST(len(n.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(found.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(found.ids, '')) AS items_sha256,
  coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= len(n.w) AS contaminated
FROM norm n LEFT JOIN words ON words.id = n.id LEFT JOIN found ON found.id = n.id WHERE n.kind = 'd'
"""
