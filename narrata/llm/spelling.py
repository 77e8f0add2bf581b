"""Grouping of spelling variants by dense prefix-suffix tiling (operator 12).

Two words are near if one edit (a code point inserted, deleted or replaced)
turns one into the other; that is so exactly if their common prefix and their
common suffix together reach the longer word's length minus one. Words are
compared as padded code-point matrices, a block against a block at once.

Blocks meet only where an edit is possible. If the longer word has m code
points and the edit lies at place p (the common prefix's length) within
[lo, hi), both words share the first lo and the last m - hi code points. So
words of m and of m - 1 code points are dealt by (m, lo, hi, shared ends),
first with [0, m/2) and [m/2, m). A group of more than ``BLOCK`` words deals
its words again by both halves of its interval, down to a single place, where
a group can't be larger than the alphabet. A pair has one place p, so it is
found in one group; only tallies of each word leave a task.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm.batches import map_texts, row_chunks
from narrata.sources import io as IO

#: Words of a group that are compared in one tile; larger groups are dealt again.
BLOCK = 192
#: Elements of a tile's comparison (code points x words x words) held at once.
TILE_ELEMENTS = 1 << 23
#: Rows and characters taken into padded matrices at once.
ROWS, CHARACTERS = 20_000, 4_000_000
#: Distinct words counted in a task before it hands on its counts.
HELD_WORDS = 400_000

#: Fixed values of the contract: letters of words, and every 97th occurrence loses a code point.
_LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
MISSPELT = 97
_RUNS = bytes((c + 0x20 if 0x41 <= c <= 0x5A else c) if c in _LETTERS else 0x20 for c in range(256))


# --- counting words ---------------------------------------------------------------

def _count_task(text: str, doc_id: str, shortest: int, misspelt: int | None):
    def batch(total: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for rows in row_chunks(batches, text):
            for one, key in zip(rows.column(text).to_pylist(), rows.column(doc_id).to_pylist(), strict=True):
                if not one:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                # a code point beyond Latin-1 becomes one that is no letter, so runs and places stay the same
                runs = Counter(one.encode("latin-1", "replace").translate(_RUNS).split())
                for word, n in runs.items():
                    size = len(word)
                    if size < shortest:
                        continue
                    if misspelt:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % misspelt == 0:
                            at = h % size
                            word = word[:at] + word[at + 1:]
                            if size == shortest:
                                continue
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD_WORDS:
                    yield batch(total)
                    total = {}
        if total:
            yield batch(total)
    return run


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = 5, least: int = 3,
                misspelt: int | None = None) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points and at least ``least`` occurrences.

    A word is a maximal run of Latin letters (``[A-Za-z\\u00C0-\\u00FF]+``), A-Z lower-cased. With ``misspelt``, the run's
    code point h % length is left out wherever ``misspelt`` divides h, the crc32 of ``<doc_id>:<run>`` (a null id counts as
    no characters). A null or empty text has no words; repeated rows count each. Counted in the tasks first, so that
    frequent words are a row for each task.
    """
    counted = map_texts(docs.select(F.col(doc_id), F.col(text)), _count_task(text, doc_id, shortest, misspelt),
                        "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# --- dense tiles --------------------------------------------------------------------

def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points padded at the end, padded at the front, and the words' sizes."""
    sizes = np.array([len(w) for w in words], np.int64)
    cps = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32) + 1
    if len(cps) and cps.max() < 256:
        cps = cps.astype(np.uint8)
    width = int(sizes.max(initial=0))
    row = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(cps)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = np.zeros((len(words), width), cps.dtype), np.zeros((len(words), width), cps.dtype)
    left[row, at] = cps
    right[row, width - sizes[row] + at] = cps
    return left, right[:, ::-1].copy(), sizes


def _tile(x, y, m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which words of block ``x`` are near which of block ``y``, for a stack of block pairs.

    Blocks are (ends padded, fronts padded, sizes) of shape (stack, words, width) and (stack, words); only pairs whose
    longer word has ``m`` code points and whose edit lies in [lo, hi) count.
    """
    (xl, xr, xs), (yl, yr, ys) = x, y
    shorter = np.minimum(xs[:, :, None], ys[:, None, :])
    longer = np.maximum(xs[:, :, None], ys[:, None, :])
    differ = xl[:, :, None, :] != yl[:, None, :, :]
    same = differ.argmax(-1)
    distinct = np.take_along_axis(differ, same[..., None], -1)[..., 0]
    prefix = np.minimum(same, shorter)
    suffix = np.minimum((xr[:, :, None, :] != yr[:, None, :, :]).argmax(-1), shorter)
    place = slice(None), None, None
    return (distinct & (longer == m[place]) & (shorter >= longer - 1) & (prefix + suffix >= longer - 1)
            & (prefix >= lo[place]) & (prefix < hi[place]))


def _tally(words: list[str], n: np.ndarray, starts: np.ndarray, m, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """For each word of groups that begin at ``starts``: near words in its group, and the first of them (or -1).

    Groups of like size are stacked; a group too large for a stack is compared block by block.
    """
    left, right, sizes = _matrices(words)
    width = max(left.shape[1], 1)
    near, first = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    many = np.diff(np.append(starts, len(words)))
    kind = np.ceil(np.log2(np.maximum(many, 1))).astype(np.int64)

    def block(rows: np.ndarray, real: np.ndarray):
        return left[rows], right[rows], np.where(real, sizes[rows], -2)  # a filler is near nothing

    for k in np.unique(kind[many > 1]).tolist():
        own = np.flatnonzero((kind == k) & (many > 1))
        side = int(many[own].max())
        step = int(min(side, max(1, (TILE_ELEMENTS // width) ** 0.5)))
        depth = max(1, TILE_ELEMENTS // (width * step * step))
        for g in range(0, len(own), depth):
            part = own[g:g + depth]
            for a in range(0, side, step):
                xs = np.arange(a, min(a + step, side))
                x_real = xs[None, :] < many[part][:, None]
                x_rows = np.where(x_real, starts[part][:, None] + xs, starts[part][:, None])
                for b in range(0, side, step):
                    ys = np.arange(b, min(b + step, side))
                    y_real = ys[None, :] < many[part][:, None]
                    y_rows = np.where(y_real, starts[part][:, None] + ys, starts[part][:, None])
                    hit = _tile(block(x_rows, x_real), block(y_rows, y_real), m[part], lo[part], hi[part])
                    some = hit.any(-1) & x_real
                    rows = x_rows[some]
                    near[rows] += hit.sum(-1)[some]
                    best = np.take_along_axis(y_rows, hit.argmax(-1), 1)[some]
                    first[rows] = np.where(first[rows] < 0, best, first[rows])  # blocks come in the words' order
    return near, first


NEAR_SCHEMA = "word string, n_near long, near_n long, near string"


def _near_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, then by n descending and word: tallies of the words that have near words in their group."""
    def work(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("word").to_pylist()
        n = rows.column("n").to_numpy()
        key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("k", "m", "lo", "hi")])
        starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))
        near, first = _tally(words, n, starts, key[1][starts], key[2][starts], key[3][starts])
        hit = np.flatnonzero(near)
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in hit.tolist()], pa.string()), pa.array(near[hit]), pa.array(n[first[hit]]),
             pa.array([words[i] for i in first[hit].tolist()], pa.string())], names=["word", "n_near", "near_n", "near"])

    held: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        if held.num_rows >= ROWS or held.nbytes >= CHARACTERS:
            k = held.column("k").to_numpy()
            whole = int(np.count_nonzero(k != k[-1]))  # rows are sorted by k; the last group may go on
            if whole:
                yield work(held.slice(0, whole).combine_chunks())
                held = held.slice(whole).combine_chunks()
    if held is not None and held.num_rows:
        yield work(held.combine_chunks())


# --- groups ---------------------------------------------------------------------------

def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of both halves of their interval, with the group's key."""
    middle = F.expr("CAST((lo + hi) DIV 2 AS INT)")
    halves = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    rows = rows.select("word", "n", "m", F.explode(halves).alias("half")).select(
        "word", "n", "m", "half.lo", "half.hi").filter("hi > lo")
    ends = [F.expr("substring(word, 1, lo)"), F.expr("substring(word, length(word) - (m - hi) + 1, m - hi)")]
    return rows.withColumn("k", F.xxhash64("m", "lo", "hi", *ends))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, near_n, near) of the words that have a near word; ``near`` is the one of largest n (ties: the
    smallest in code-point order). ``words`` holds distinct words and their n."""
    spark, run = words.sparkSession, f"spelling-{uuid.uuid4().hex}"
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi"))
    ready, level = [], 0
    while True:
        rows = IO.materialize(_dealt(rows), spark, f"{run}/groups-{level}")
        hot = IO.materialize(rows.groupBy("k").agg(F.count("*").alias("many"), F.max(F.expr("hi - lo")).alias("wide"))
                             .filter((F.col("many") > block) & (F.col("wide") > 1)).select("k"), spark, f"{run}/hot-{level}")
        if hot.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(hot, "k", "left_anti"))
        rows = rows.join(hot, "k", "left_semi")
        level += 1
    groups = _union(ready).repartition("k").sortWithinPartitions("k", "m", "lo", "hi", F.desc("n"), "word")
    tallies = groups.mapInArrow(_near_task, NEAR_SCHEMA)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return tallies.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): forms followed to the last, by doubling.

    n doubles at least from a word to its form, so a chain has 63 steps at most and the loop some six rounds.
    """
    spark, run = forms.sparkSession, f"spelling-{uuid.uuid4().hex}"
    links = IO.materialize(forms.select("word", F.col("form").alias("root")), spark, f"{run}/roots")
    steps, done = links, []
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = IO.materialize(links.join(onward, "root", "left"), spark, f"{run}/roots")
        done.append(joined.filter("next IS NULL").select("word", "root"))
        links = joined.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if links.isEmpty():
            return _union(done)
        steps = _union([links, *done])


def group_variants(words: DataFrame, ratio: int = 2, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of rows (word, n) of distinct words.

    A word's form is its near word of largest n (ties: smallest in code-point order), if that n is ``ratio`` (2 at
    least) times its own or more; else null. Its root is the end of the chain of forms, itself where it has none.
    Columns beside ``word`` and ``n`` are left out; rows without word or n are left out; an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, so that chains of forms end")
    spark = words.sparkSession
    words = IO.materialize(words.select("word", "n").dropna(), spark, "spelling-words")
    found = words.join(near_words(words, block), "word", "left")
    good = F.col("near_n") >= ratio * F.col("n")
    forms = IO.materialize(found.select(
        "word", F.when(good, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("near_n")).alias("form_n")), spark, "spelling-forms")
    roots = _roots(forms.filter("form IS NOT NULL"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of ``documents``, with every 97th occurrence misspelt."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_variants(word_counts(docs, misspelt=MISSPELT))
