"""Sentence borders with abbreviations learned from the corpus (T10).

A word is an abbreviation if it stands with a period more often than chance:
Dunning's log-likelihood ratio of the word and a following period, weighted by
the published factors of unsupervised border detection (Kiss and Strunk 2006):
short words, words with inner periods, and words that are rarely seen without
a final period. The counts are two sums a word over the whole corpus. The
splitter uses the resulting table: no border after an abbreviation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.lookup import RowTable, row_table
from narrata.sources import io as IO

# ---------------------------------------------------------------------------
# Fixed values of the published method.
ABBREVIATION_AT = 0.3    # least score of an abbreviation
PERIOD_GIVEN = 0.99      # chance of a period after an abbreviation
# ---------------------------------------------------------------------------


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """ln of the chance of k periods in n places; the chance is kept away from 0 and 1."""
    q = F.greatest(F.least(p, F.lit(1 - 1e-12)), F.lit(1e-12))
    return k * F.log(q) + (n - k) * F.log(1 - q)


def word_periods(df: DataFrame, text_col: str) -> DataFrame:
    """(token, with_period, without): lower-cased words without their final period, and how often they stand with one.

    Only words that hold a letter count; null texts have none.
    """
    rows = df.select(F.explode(T.words(text_col)).alias("w")).select(F.lower("w").alias("w"))
    ends = F.col("w").endswith(".")
    token = F.when(ends, F.expr("substring(w, 1, length(w) - 1)")).otherwise(F.col("w"))
    return (rows.select(token.alias("token"), ends.alias("ends")).filter(F.col("token").rlike(r"\p{L}"))
            .groupBy("token").agg(F.count_if(F.col("ends")).alias("with_period"), F.count_if(~F.col("ends")).alias("without")))


def abbreviations(df: DataFrame, text_col: str, least: float = ABBREVIATION_AT) -> DataFrame:
    """(token, with_period, without, score) of the words whose score is ``least`` or more, rounded to six places.

    score = log-likelihood ratio x e^-(letters) x (inner periods + 1) x letters^-(times without a period); letters are
    the characters that are no period.
    """
    counts = IO.materialize(word_periods(df, text_col), df.sparkSession, "word-periods")
    sums = counts.agg(F.sum(F.col("with_period") + F.col("without")).alias("words"), F.sum("with_period").alias("periods")).first()
    words, periods = float(sums.words or 0), float(sums.periods or 0)
    n = (F.col("with_period") + F.col("without")).cast("double")
    k = F.col("with_period").cast("double")
    ratio = -2 * (_log_likelihood(k, n, F.lit(periods / words if words else 0.0)) - _log_likelihood(k, n, F.lit(PERIOD_GIVEN)))
    inner = (F.length("token") - F.length(F.replace("token", F.lit("."), F.lit("")))).cast("double")
    letters = F.length("token").cast("double") - inner
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("without").cast("double"))
    rounded = F.floor(score * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
    return counts.filter("with_period > 0").withColumn("score", rounded).filter(F.col("score") >= least)


def abbreviation_table(found: DataFrame) -> RowTable:
    """The abbreviations as a value of the plan; scores fall with e to the length, so they are short and few."""
    table = row_table(IO.materialize(found.select("token", F.lit(True).alias("known")), found.sparkSession, "abbreviations"),
                      ["known"])
    if table is None:
        raise ValueError("more abbreviations than fit the plan: raise the least score")
    return table


def with_sentences(df: DataFrame, text_col: str, table: RowTable, out_col: str = "sentences") -> DataFrame:
    """``df`` with its texts' sentences: a border follows a word that ends in ``.``, ``!`` or ``?``, unless it is an
    abbreviation.

    White space is collapsed; a null text gives null, an empty one no
    sentence. Words and borders are computed once a row, and texts are cut in
    time linear in their length. An ``out_col`` that exists is an error.
    """
    if out_col in df.columns:
        raise ValueError(f"the table has a column {out_col!r} already")
    own = F.struct(*[F.col(c) for c in df.columns]).alias("row")

    def border(w: Column) -> Column:
        body = F.lower(F.regexp_replace(w, r"\.$", ""))
        return w.rlike("[.!?]$") & ~(w.endswith(".") & table.of(body).isNotNull())
    rows = T.with_computed(df.select(own, F.col(text_col).alias("text")), words=T.words("text")).drop("text")
    placed = F.filter(F.transform("words", lambda w, i: F.when(border(w), i + 1)), lambda i: i.isNotNull())
    rows = T.with_computed(rows, ends=F.array_distinct(F.concat(F.array(F.lit(0)), placed, F.array(F.size("words")))))
    cut = F.transform("ends", lambda e, j: F.when(j > 0, F.array_join(F.slice(
        "words", F.get("ends", j - 1) + 1, e - F.get("ends", j - 1)), " ")))
    return rows.select("row.*", F.filter(cut, lambda s: s != "").alias(out_col))
