"""Readers for the parquet tables and the derived complaint views.

All reads are plain ``spark.read.parquet`` so Catalyst prunes columns and
pushes filters into the scan; nothing is cached or collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.sources import io as IO

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

#: Session setting: into how many partitions ``documents`` is dealt after the scan. Unset by default; for inputs of
#: fewer row groups than cores (one small file), whose texts would all be worked on by one task.
SPREAD = "spark.narrata.documents.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spread = spark.conf.get(SPREAD, None)
    return df.repartition(int(spread)) if spread and name == "documents" else df


def stream_path(sf_dir: str, name: str) -> str:
    """A table's path for a file stream: a pattern of one name, as a stream's plain path must be a folder, and a table may be
    one file or a folder of parts."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir}/{{{name}.parquet}}"


def complaints(spark: SparkSession, sf_dir: str, with_response: bool = True) -> DataFrame:
    """Complaint view over ``documents`` left-joined to ``labels``.

    complaint_id, narrative, product, company, issue, response (NULL when the
    document has no label row). ``labels`` is joined on the key without a
    hint: AQE broadcasts it when its runtime size is small and keeps a
    sort-merge join otherwise.
    """
    d = table(spark, sf_dir, "documents")
    cols = [F.col("doc_id").alias("complaint_id"),
            F.col("text").alias("narrative"),
            F.col("lang").alias("product"),
            F.col("source").alias("company"),
            F.concat(F.lit("issue_"), (F.col("doc_id") % 7).cast("string")).alias("issue")]
    if not with_response:
        return d.select(*cols)
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (d.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("complaint_id"),
                    F.col("text").alias("narrative"),
                    F.col("lang").alias("product"),
                    F.col("source").alias("company"),
                    F.concat(F.lit("issue_"), (F.col("doc_id") % 7).cast("string")).alias("issue"),
                    F.concat(F.lit("q"), F.col("quality").cast("string"),
                             F.lit("t"), F.col("toxic").cast("string")).alias("response")))


def cleaned_complaints(spark: SparkSession, sf_dir: str, with_response: bool = True) -> DataFrame:
    """Complaints with ``clean`` text; texts cleaned to nothing are dropped
    (the reference loses them when the empty string re-reads as a null)."""
    c = complaints(spark, sf_dir, with_response)
    return T.with_computed(c, clean=T.clean_narrative("narrative")).filter(F.col("clean") != "")


def written_clean(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """``cols`` and ``clean`` of the cleaned complaints, written once, for queries that read the texts several times."""
    c = cleaned_complaints(spark, sf_dir, with_response=False)
    return IO.materialize(c.select("complaint_id", *cols, "clean"), spark, "cleaned")


def vocabulary_tokens(docs: DataFrame, col: str = "clean") -> DataFrame:
    """Distinct whitespace tokens of a text column (one shuffle, map-side dedup)."""
    return T.exploded(docs, T.words(col)).distinct()


def _lexicon_from(toks: DataFrame) -> DataFrame:
    d = F.substring(F.md5("token"), 1, 1)
    return (toks.select("token", F.when(d.isin("0", "1"), F.lit(1.5))
                        .when(d.isin("2", "3"), F.lit(-1.5)).alias("valence"))
            .filter(F.col("valence").isNotNull()))


def test_lexicon(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Valence table derived from the corpus so an SQL engine can rebuild it.

    token -> +1.5 when the first md5 hex digit is 0-1, -1.5 when 2-3, else no
    entry. Stands in for a caller-supplied sentiment lexicon. ``docs``: the
    cleaned complaints, where the caller has them written.
    """
    docs = cleaned_complaints(spark, sf_dir, with_response=False) if docs is None else docs
    return _lexicon_from(vocabulary_tokens(docs))


def test_word_roles(spark: SparkSession, sf_dir: str):
    """Lexicon, negator and booster tables plus the contrast word, from one vocabulary.

    Negators: first md5 hex digit 4; boosters: digit 5; contrast word: the
    token with the smallest md5 (a one-row aggregate used as a scalar). The
    vocabulary is derived once and written to the shared folder, so the four
    tables do not each re-read and re-clean the corpus.
    """
    toks = vocabulary_tokens(cleaned_complaints(spark, sf_dir, with_response=False))
    toks = IO.materialize(toks, spark, "vocabulary")
    d = F.substring(F.md5("token"), 1, 1)
    negators = toks.filter(d == "4")
    boosters = toks.filter(d == "5")
    contrast = toks.agg(F.min_by("token", F.md5("token")).alias("token"))
    return _lexicon_from(toks), negators, boosters, contrast
