"""Phrase collocations by set-oriented relational mining (operator 11).

The occurrences of words are written once as a relation sorted by (piece,
position). Phrases grow by one word at a time: the relation is first reduced
to the occurrences that lie in a frequent shorter phrase (semi-join), written,
and merge-joined with itself by piece and adjacent position; the joined
occurrences are counted in groups, and the frequent groups are the phrases of
the next length. A phrase can be frequent only if all phrases inside it are.

A relation's row is a block of consecutive occurrences in their order: the
distinct words of the block, a code for each occurrence, and the lengths of
its runs (a run is a piece, or what the semi-join left of it), so that piece
and position follow from the place and both sides of the merge-join lie in one
row. Words are 64-bit ids of (language, word); two of n words share one with
odds of about n*n/2**65. The semi-join uses a bitmap of the frequent groups of
at most 16 MB: it never loses an occurrence, and what it keeps beyond them
falls to the count of the groups.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm.batches import map_texts, row_chunks, text_buffer
from narrata.llm.ngram_join import _in_bitmap, bitmap
from narrata.llm.words import LOWER, mix64, separators, span_hashes, split_words
from narrata.sources import io as IO

#: Fixed values of the contract: what ends a piece, and what separates words within it.
PIECE_END = separators(b".,;:!?\x0a\x0b\x0c\x0d")
WORD_END = PIECE_END | separators(b" \x09")
#: Distinct words, and phrase occurrences, counted in a task before it hands on its counts; and rows handed on at once.
HELD_WORDS, HELD_PHRASES = 250_000, 3 << 18
ROWS = 1 << 16
_LONG_WORD = 64

RELATION = "lang string, id long, word string, n long, ids binary, codes binary, runs binary"


def _text_hash(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def joined_ids(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The id of a phrase from the id of all its words but the last, and that of the last."""
    return mix64(mix64(first.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + last.view(np.uint64))


# --- the relation of occurrences ----------------------------------------------------

def _block(words: np.ndarray, runs: np.ndarray) -> tuple[bytes, bytes, bytes]:
    ids, codes = np.unique(words, return_inverse=True)
    return ids.tobytes(), codes.astype("<u2" if len(ids) <= 1 << 16 else "<u4").tobytes(), runs.astype("<u4").tobytes()


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and run lengths of each block."""
    for batch in batches:
        for ids, codes, runs in zip(*(batch.column(c).to_pylist() for c in ("ids", "codes", "runs")), strict=True):
            ids = np.frombuffer(ids, np.uint64)
            yield ids[np.frombuffer(codes, "<u2" if len(ids) <= 1 << 16 else "<u4")], np.frombuffer(runs, "<u4").astype(np.int64)


def _occurrences(text: str, lang: str):
    """Blocks of occurrences, and partial counts of words."""
    names = ["lang", "id", "word", "n", "ids", "codes", "runs"]

    def counts(found: dict[int, list]) -> Iterator[pa.RecordBatch]:
        ids = np.fromiter(found, np.uint64, len(found)).view(np.int64)
        rows = list(found.values())
        for a in range(0, len(rows), ROWS):
            langs, words, n = zip(*rows[a:a + ROWS], strict=True)
            none = pa.nulls(len(n), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ids[a:a + ROWS]),
                                              pa.array([w.decode() for w in words], pa.string()),
                                              pa.array(n, pa.int64()), none, none, none], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for rows in row_chunks(batches, text):
            raw, offsets = text_buffer(rows.column(text))
            low = LOWER[raw]
            starts, ends, row = split_words(low, offsets, WORD_END)
            if not len(starts):
                continue
            langs = rows.column(lang).fill_null("und").to_pylist()
            ids = span_hashes(low, starts, ends)
            whole = low.tobytes()
            for i in np.flatnonzero(ends - starts > _LONG_WORD).tolist():  # too long to trust a polynomial hash
                ids[i] = _text_hash(whole[starts[i]:ends[i]])
            known = {x: _text_hash(x.encode()) for x in set(langs)}
            ids = mix64(ids ^ np.array([known[x] for x in langs], np.uint64)[row])
            piece = np.cumsum(PIECE_END[low])[starts]
            new = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])))
            none = pa.nulls(1, pa.string())
            block = _block(ids, np.diff(np.append(new, len(ids))))
            yield pa.RecordBatch.from_arrays([none, pa.nulls(1, pa.int64()), none, pa.nulls(1, pa.int64()),
                                              *(pa.array([x], pa.binary()) for x in block)], names=names)
            values, at, n = np.unique(ids, return_index=True, return_counts=True)
            for x, i, many in zip(values.tolist(), at.tolist(), n.tolist(), strict=True):
                if x in found:
                    found[x][2] += many
                else:
                    found[x] = [langs[row[i]], whole[starts[i]:ends[i]], many]
            if len(found) > HELD_WORDS:
                yield from counts(found)
                found = {}
        if found:
            yield from counts(found)
    return run


def _phrase_ids(words: np.ndarray, runs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The id of the ``k`` words from each place on, and whether they lie in one run."""
    n = len(words)
    left = np.repeat(np.cumsum(runs), runs) - np.arange(n)  # words from here to the end of the run
    ids = words
    for j in range(1, k):
        ids = joined_ids(ids[:n - j], words[j:]) if n > j else words[:0]
    return ids, left[:len(ids)] >= k


def _semi_join(k: int, frequent):
    """Blocks of what is left: places that lie in a frequent ``k``-word phrase, in runs of more than ``k`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, runs in _read_blocks(batches):
            ids, inside = _phrase_ids(words, runs, k)
            good = inside & _in_bitmap(frequent.value, ids)
            # consecutive good places make a run of so many words and k - 1 more
            edge = np.diff(np.concatenate([[False], good, [False]]).astype(np.int8))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            piece = np.repeat(np.arange(len(runs)), runs)[:len(good)]
            cut = np.flatnonzero(good[1:] & good[:-1] & (piece[1:] != piece[:-1])) + 1
            first, last = np.sort(np.append(first, cut)), np.sort(np.append(last, cut))
            long = last - first >= 2
            first, sizes = first[long], last[long] - first[long] + k - 1
            if not len(first):
                continue
            at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in _block(words[at], sizes)],
                                             names=["ids", "codes", "runs"])
    return run


def _count(k: int):
    """Partial counts of the ``k``-word phrases: the relation joined with itself by piece and adjacent position."""
    def counts(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        ids, first, last = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        _, at, n = np.unique(ids, return_index=True, return_counts=True)
        for a in range(0, len(at), ROWS):
            part = at[a:a + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[part].view(np.int64)), pa.array(last[part].view(np.int64)),
                 pa.array(n[a:a + ROWS].astype(np.int64))], names=["first", "last", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for words, runs in _read_blocks(batches):
            shorter, _ = _phrase_ids(words, runs, k - 1)
            ids, inside = _phrase_ids(words, runs, k)
            at = np.flatnonzero(inside)
            if len(at):
                held.append((ids[at], shorter[at], words[at + k - 1]))
                size += len(at)
            if size >= HELD_PHRASES:
                yield from counts(held)
                size = 0
        if held:
            yield from counts(held)
    return run


def _ids_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrase's id, and the ids of its first 1, 2, ... and of its other words, for rows of as many words' ids."""
    def ids(part: np.ndarray) -> np.ndarray:
        out = part[:, 0].copy()
        for j in range(1, part.shape[1]):
            out = joined_ids(out, part[:, j].copy())
        return out.view(np.int64)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        words = batch.column("words").flatten().to_numpy().view(np.uint64).reshape(n, -1)
        k = words.shape[1]
        cut = np.tile(np.arange(1, k, dtype=np.int32), n)
        heads, tails = (np.stack(x, axis=1).ravel() for x in zip(
            *((ids(words[:, :j]), ids(words[:, j:])) for j in range(1, k)), strict=True))
        cuts = pa.ListArray.from_arrays(np.arange(0, n * (k - 1) + 1, k - 1, dtype=np.int32), pa.StructArray.from_arrays(
            [pa.array(cut), pa.array(heads), pa.array(tails)], ["cut", "head", "tail"]))
        yield pa.RecordBatch.from_arrays([pa.array(ids(words)), batch.column("words"), cuts, batch.column("n")],
                                         names=["id", "words", "cuts", "n"])


def _zstd(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = IO.scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, text: str = "text", lang: str = "lang"
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (id, lang, word, n), frequent phrases of 2 to ``longest`` words (id, words, cuts, n), and all
    word occurrences of each language (lang, total).

    ``words`` holds word ids; ``cuts`` the ids of the first ``cut`` words and of the rest. Null texts are empty, a null
    language is ``und``. All tables are written to the shared folder.
    """
    spark, run = docs.sparkSession, f"collocations-{uuid.uuid4().hex}"
    both = _zstd(map_texts(docs.select(F.col(text), F.col(lang)), _occurrences(text, lang), RELATION),
                 spark, f"{run}/occurrences")
    counted = both.filter("n IS NOT NULL").groupBy("id").agg(
        F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n"))
    totals = IO.materialize(both.filter("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("total")), spark, f"{run}/totals")
    words = IO.materialize(counted.filter(F.col("n") >= least), spark, f"{run}/words")
    shorter = words.select("id", F.array("id").alias("words"))
    relation = both.filter("codes IS NOT NULL").select("ids", "codes", "runs")
    phrases = None
    for k in range(2, longest + 1):
        held = spark.sparkContext.broadcast(bitmap(shorter, "id"))
        relation = _zstd(relation.mapInArrow(_semi_join(k - 1, held), "ids binary, codes binary, runs binary"),
                         spark, f"{run}/runs-{k}")
        groups = (relation.mapInArrow(_count(k), "first long, last long, n long")
                  .groupBy("first", "last").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
        groups = IO.materialize(groups, spark, f"{run}/groups-{k}")
        grown = groups.join(shorter.select(F.col("id").alias("first"), "words"), "first").select(
            F.concat("words", F.array("last")).alias("words"), "n")
        found = IO.materialize(grown.mapInArrow(
            _ids_of_parts, "id long, words array<long>, cuts array<struct<cut:int,head:long,tail:long>>, n long"),
            spark, f"{run}/phrases-{k}")
        phrases = found if phrases is None else phrases.unionByName(found)
        shorter = found
    return words, phrases, totals


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int | None = 2000,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of 2 to ``longest`` words, the strongest of each language first.

    Pieces of a text end at ``.,;:!?`` and line ends, their words at blanks and tabs; A-Z are lower-cased. A candidate
    occurs ``least`` times (a) or more in its language. Of its cuts into two parts with l and r occurrences the one of
    the lowest floor(1000000 * a * a / (l * r)) counts (ties: the first); n counts the language's words. Candidates of
    which a longer candidate around them has ``covered`` percent or more go. Ranks are by score and a, both falling,
    then by phrase; ``top`` rows of each language are reported (None: all). Null texts are empty, a null language is
    ``und``, repeated rows count each, an empty table gives no rows; other columns are not read.
    """
    if longest < 2:
        raise ValueError("longest must be 2 at least")
    spark, run = docs.sparkSession, f"collocations-{uuid.uuid4().hex}"
    words, phrases, totals = frequent_phrases(docs, longest, least, text, lang)
    counts = IO.materialize(words.select("id", "n").unionByName(phrases.select("id", "n")), spark, f"{run}/counts")
    cuts = phrases.select("id", F.col("n").alias("a"), F.inline("cuts"))
    cuts = (cuts.join(counts.select(F.col("id").alias("head"), F.col("n").alias("l")), "head")
            .join(counts.select(F.col("id").alias("tail"), F.col("n").alias("r")), "tail"))
    whole = "CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0))"
    score = F.expr(f"({whole}) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = cuts.groupBy("id").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    ends = phrases.filter(F.size("words") > 2).select("n", F.explode(F.array(
        F.col("cuts")[F.size("cuts") - 1]["head"], F.col("cuts")[0]["tail"])).alias("id"))
    around = ends.groupBy("id").agg(F.max("n").alias("longer"))
    kept = (phrases.select("id", "words", F.col("n").alias("a")).join(around, "id", "left")
            .filter(F.coalesce(F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a"), F.lit(True)))
            .join(scored, "id").select("id", "words", "a", "best.*"))
    kept = IO.materialize(kept, spark, f"{run}/kept")
    spelt = (kept.select("id", F.posexplode("words").alias("place", "word_id"))
             .join(words.select(F.col("id").alias("word_id"), "word", "lang"), "word_id")
             .groupBy("id").agg(F.min("lang").alias("lang"),
                                F.array_sort(F.collect_list(F.struct("place", "word")))["word"].alias("parts")))
    rows = kept.join(spelt, "id").select("lang", F.array_join("parts", " ").alias("phrase"), "a", "l", "r", "score")
    rows = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    if top is not None:
        rows = rows.filter(F.col("rank") <= top)
    return rows.join(totals.withColumnRenamed("total", "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two and three words of each language of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
      FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY lang, k, w[i:i + k - 1]),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, k, g, f AS a, unnest(range(1, k)) AS j FROM cand),
scored AS (
  SELECT c.lang, c.k, c.g, c.a, c.j, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.j] JOIN f r ON r.lang = c.lang AND r.g = c.g[c.j + 1:c.k]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.j) = 1),
longer AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, g[1:2] AS p, f FROM cand WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM cand WHERE k = 3)
  GROUP BY lang, p),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer b ON b.lang = s.lang AND b.p = s.g
         WHERE b.f IS NULL OR 100 * b.f < 50 * s.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, array_to_string(k.g, ' ')) AS rank,
  array_to_string(k.g, ' ') AS phrase, k.a, k.l, k.r, CAST(t.n AS BIGINT) AS n, CAST(k.score AS BIGINT) AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
