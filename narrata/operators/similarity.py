"""Summary quality metrics (G7-G9): ROUGE-N, ROUGE-L, embedding match.

ROUGE-N counts the n-gram overlap of a pair within its row, over Arrow
batches of token lists whose words are numbered. ROUGE-L needs a longest
common subsequence per pair, which no built-in computes, so it runs in an
Arrow UDF with a bit-parallel LCS over whole token lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from narrata.functions import text as T
from narrata.functions import vectors as V
from narrata.functions.numeric import round6
from narrata.functions.stem import stems

#: Pairs whose words a task numbers at once.
ROWS_AT_ONCE = 256


def _grams(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of numbered words that lie row after row, as numbers, and their rows; a row shorter than n has none."""
    grams = words
    for d in range(1, n):
        grams = grams[:max(0, len(words) - d)] * (int(words.max(initial=0)) + 1) + words[d:]
        grams = np.unique(grams, return_inverse=True)[1]  # numbers stay small, however long the n-grams
    inside = rows[:len(grams)] == rows[n - 1:] if len(grams) else np.zeros(0, bool)
    return grams[inside], rows[:len(grams)][inside]


def _numbered(g: pa.ListArray, r: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, rows) of two columns of token lists; equal words have one number in both."""
    lists = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (g, r)]
    words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode().indices.to_numpy().astype(np.int64)
    rows = [np.repeat(np.arange(len(x)), pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)) for x in lists]
    return [(words[:len(rows[0])], rows[0]), (words[len(rows[0]):], rows[1])]


def _overlap(g: tuple[np.ndarray, np.ndarray], r: tuple[np.ndarray, np.ndarray], many: int) -> list[np.ndarray]:
    """For each of ``many`` rows, the n-grams in common (the smaller count of each) and those of both sides."""
    width = int(max(g[0].max(initial=0), r[0].max(initial=0))) + 1
    (a, of_a), (b, of_b) = (np.unique(rows * width + grams, return_counts=True) for grams, rows in (g, r))
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.zeros(many, np.int64)
    np.add.at(shared, both // width, np.minimum(of_a[i], of_b[j]))
    return [shared, np.bincount(g[1], minlength=many), np.bincount(r[1], minlength=many)]


def _slices(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE))


def _overlaps(ns: list[int]):
    """Batches of (id, g, r), token lists, as (id, n, ov, gg, rr): for each n the n-grams in common and those of both sides."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            many = batch.num_rows
            g, r = _numbered(batch.column("g"), batch.column("r"))
            sums = []
            for n in ns:
                # both sides' n-grams are numbered together, the rows of r behind those of g
                grams, rows = _grams(np.concatenate([g[0], r[0]]), np.concatenate([g[1], r[1] + many]), n)
                of_r = rows >= many
                sums.append(_overlap((grams[~of_r], rows[~of_r]), (grams[of_r], rows[of_r] - many), many))
            # a row for each id and n, those of an id together
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(many), len(ns))))
            columns = [np.tile(np.array(ns), many), *(np.stack([s[c] for s in sums], 1).ravel() for c in range(3))]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int32()) for c in columns)],
                schema=pa.schema([batch.schema.field("id"), *((c, pa.int32()) for c in ("n", "ov", "gg", "rr"))]))
    return counted


def _fmeasure(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _valid_pairs(df: DataFrame, gen_col: str, ref_col: str) -> DataFrame:
    return df.filter(F.col(gen_col).isNotNull() & (F.col(gen_col) != "")
                     & F.col(ref_col).isNotNull() & (F.col(ref_col) != ""))


def pair_tokens(df: DataFrame, id_col: str, gen_col: str, ref_col: str, stem: bool = False) -> DataFrame:
    """``df``'s id and, under the same names, the token lists of valid pairs, stemmed if asked for.

    The other operators take such columns in place of the texts, so that pairs
    that several of them read are cut and stemmed once.
    """
    return _pair_tokens(df, id_col, gen_col, ref_col, stem).toDF(id_col, gen_col, ref_col)


def _pair_tokens(df: DataFrame, id_col: str, gen_col: str, ref_col: str, stem: bool) -> DataFrame:
    """(id, g, r): the token lists of valid pairs, stemmed if asked for; columns that hold lists are taken as they are."""
    if isinstance(df.schema[gen_col].dataType, TY.ArrayType):
        toks = df.filter(F.col(gen_col).isNotNull() & F.col(ref_col).isNotNull()).select(
            F.col(id_col).alias("id"), F.col(gen_col).alias("g"), F.col(ref_col).alias("r"))
    else:
        pairs = _valid_pairs(df, gen_col, ref_col).select(F.col(id_col).alias("id"), F.col(gen_col).alias("gen"),
                                                          F.col(ref_col).alias("ref"))
        toks = T.with_computed(pairs, g=T.rouge_tokens("gen"), r=T.rouge_tokens("ref")).select("id", "g", "r")
    return toks.select("id", stems(F.col("g")).alias("g"), stems(F.col("r")).alias("r")) if stem else toks


def rouge_n_pairs(df: DataFrame, id_col: str, gen_col: str, ref_col: str, ns=(1, 2), stem: bool = False) -> DataFrame:
    """Per pair and n: ``(id, n, p, r, f)``; pairs with a NULL or empty side are skipped.

    Both texts are in one row, so the overlap is counted there, the smaller
    count of every n-gram, and nothing is shuffled. With ``stem``, words of
    four letters and more count by their stems.
    """
    ns = [int(n) for n in (ns if isinstance(ns, (list, tuple)) else [ns])]
    toks = _pair_tokens(df, id_col, gen_col, ref_col, stem)
    rows = toks.mapInArrow(_overlaps(ns), f"id {dict(toks.dtypes)['id']}, n int, ov int, gg int, rr int")
    p = F.col("ov") / F.greatest("gg", F.lit(1))
    r = F.col("ov") / F.greatest("rr", F.lit(1))
    return rows.select(F.col("id").alias(id_col), "n", p.alias("p"), r.alias("r"), _fmeasure(p, r).alias("f"))


def rouge_n(df: DataFrame, id_col: str, gen_col: str, ref_col: str, ns=(1, 2), stem: bool = False) -> DataFrame:
    """Mean ROUGE-N precision, recall and F over all valid pairs, one column set per n."""
    per = rouge_n_pairs(df, id_col, gen_col, ref_col, ns, stem)
    aggs = [F.count_if(F.col("n") == ns[0]).alias("n_pairs")]
    for n in ns:
        for m in ("p", "r", "f"):
            aggs.append(round6(F.avg(F.when(F.col("n") == n, F.col(m)))).alias(f"rouge{n}_{m}"))
    return per.agg(*aggs)


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence of two token sequences.

    Bit-parallel form: one machine-word operation per token of ``b`` over a
    bit set as long as ``a`` (Python integers), i.e. O(len(a) * len(b) / 64).
    """
    if len(a) == 0 or len(b) == 0:
        return 0
    match = dict.fromkeys(b, 0)
    for i, tok in enumerate(a):
        if tok in match:
            match[tok] |= 1 << i
    mask = (1 << len(a)) - 1
    v = mask
    for tok in b:
        u = v & match[tok]
        v = ((v + u) | (v - u)) & mask
    return len(a) - bin(v).count("1")


@F.arrow_udf(TY.StructType([TY.StructField("p", TY.DoubleType()),
                            TY.StructField("r", TY.DoubleType()),
                            TY.StructField("f", TY.DoubleType())]))
def _rouge_l_udf(gen: pa.Array, ref: pa.Array) -> pa.Array:
    sides = [(w.tolist(), np.searchsorted(rows, np.arange(len(gen) + 1)).tolist()) for w, rows in _numbered(gen, ref)]
    out = []
    for i in range(len(gen)):
        g, r = (words[at[i]:at[i + 1]] for words, at in sides)
        lcs = lcs_length(r, g)
        p = lcs / len(g) if g else 0.0
        rec = lcs / len(r) if r else 0.0
        out.append((p, rec, 2 * p * rec / (p + rec) if p + rec > 0 else 0.0))
    columns = list(zip(*out, strict=True)) or [[]] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], ["p", "r", "f"])


def rouge_l_pairs(df: DataFrame, id_col: str, gen_col: str, ref_col: str, stem: bool = False) -> DataFrame:
    """Per pair ROUGE-L ``(id, p, r, f)`` over whole token lists (their stems with ``stem``)."""
    pairs = _pair_tokens(df, id_col, gen_col, ref_col, stem)
    return pairs.select(F.col("id").alias(id_col), _rouge_l_udf("g", "r").alias("s")).select(id_col, "s.p", "s.r", "s.f")


def embedding_match(df: DataFrame, vec_col: str, model: str) -> DataFrame:
    """Greedy cosine matching between a vector set and a bounded reference set.

    Precision: mean over the vectors of their best cosine to any reference
    vector; recall: mean over reference vectors of their best cosine to any
    vector; F is their harmonic mean. ``model`` names a column that
    holds the reference set as one array value (``scoring.model_column``); a row yields one number for each
    reference vector, which a partial aggregate reduces at once, so no pairs
    of rows are made.
    """
    rows = T.with_computed(df.select(vec_col, model), _c=F.transform(model, lambda c: V.cosine(vec_col, c["vec"])))
    each = rows.select(F.array_max("_c").alias("_best"), F.posexplode("_c").alias("_ref", "_x"))
    a = (each.groupBy("_ref").agg(F.avg("_best").alias("_p"), F.max("_x").alias("_m"))
         .agg(F.max("_p").alias("p"), F.avg("_m").alias("r")))
    return a.select(round6("p").alias("precision"), round6("r").alias("recall"),
                    round6(_fmeasure(F.col("p"), F.col("r"))).alias("f1"))
