"""Common words by broadcast, rare ones by an exchange: the same results wherever the border lies."""

import json
import random

import pytest
from pyspark.sql import functions as F

from narrata.operators import classify as CL
from narrata.operators import common_words as CW
from narrata.operators import sentiment as S
from narrata.operators import similarity as SI
from narrata.operators import summarize as SU
from narrata.operators import word_bayes as WB
from narrata.operators import word_vectors as WV
from narrata.sources import io as IO
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, n=60):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    rows = [(i % 50, ". ".join(" ".join(rng.choices(words, weights, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 5))),
             rng.choice("ab"), i % 3) for i in range(n)]
    return IO.materialize(spark.createDataFrame([*rows, (7, None, "a", 1), (8, "", "b", 2)], "id long, t string, y string, fold int"),
                          spark, "common-words-test")


def everything(spark, docs):
    lexicon = spark.createDataFrame([(f"w{i}", (i % 5 - 2) * 0.7) for i in range(0, 40, 2)], "token string, valence double")
    neg = spark.createDataFrame([("w3",), ("w4",), ("w31",)], "token string")
    bst = spark.createDataFrame([("w5",), ("w6",), ("w33",)], "token string")
    plain = docs.select("id", F.regexp_replace("t", r"\.", "").alias("t"), "y", "fold")
    model = WB.fit(plain.filter("id < 30"), "t", "y")
    vectors = IO.materialize(WV.word_vectors(plain, "t"), spark, "common-words-vectors")
    pairs = plain.withColumn("s", F.substring("t", 1, 20))
    found = [S.lexicon_sentiment(plain, "id", "t", lexicon), S.lexicon_sentiment_context(plain, "id", "t", lexicon, neg, bst, "w2"),
             SU.extractive_summary(docs, "id", "t"), SU.chunked_summary(docs, "id", "t"), WB.score(plain, "t", model, ["id"]),
             WB.cross_validate(plain, "fold", "t", "y", ["id"]), WV.pair_similarity(pairs, "s", "t", vectors, docs.count(), ["id"])]
    return [sorted(map(str, df.collect())) for df in found]


def test_the_border_between_common_and_rare_words_changes_nothing(spark, monkeypatch):
    """All words common, some, and none; with lexicons that are joined."""
    docs = texts(spark)
    monkeypatch.setattr(S, "MAX_LEXICON_BYTES", -1)
    found = []
    for parts in (1 << 18, 30, 1):
        monkeypatch.setattr(CW, "COMMON_PARTS", parts)
        found.append(everything(spark, docs))
    monkeypatch.setattr(S, "MAX_LEXICON_BYTES", 16 << 20)
    assert everything(spark, docs)[:2] == found[0][:2]
    for other in found[1:]:
        for a, b in zip(found[0], other, strict=True):
            assert a == b


def test_a_lexicon_of_many_words_is_no_value_of_the_plan(spark):
    """100,000 words: the driver held several copies of some 5 MB of literals."""
    lexicon = spark.range(100_000).select(F.concat(F.lit("word"), "id").alias("token"), F.lit(1.5).alias("valence"))
    docs = spark.createDataFrame([(1, "word7 word99999 other"), (2, None)], "id long, t string")
    scored = S.lexicon_sentiment(docs, "id", "t", lexicon)
    assert len(scored._jdf.queryExecution().toString()) < 1 << 20
    assert sorted((r.id, r.valence_sum) for r in scored.collect()) == [(1, 3.0), (2, 0.0)]


def test_words_go_alone_through_the_exchange(spark):
    """Kept columns and all other words stay where they are: the words' rows hold a number and no kept column."""
    docs = texts(spark).select("id", F.regexp_replace("t", r"\.", "").alias("t"), "y")
    model = WB.fit(docs, "t", "y")
    for df in (WB.score(docs, "t", model, ["id"]), S.lexicon_sentiment(docs, "id", "t", spark.range(100_000).select(
            F.concat(F.lit("w"), "id").alias("token"), F.lit(1.5).alias("valence")))):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" in p
        aggregates = [line for line in p.splitlines() if "Aggregate [row#" in line]
        assert aggregates and not [line for line in aggregates if "keep" in line], p


def test_rouge_counts_without_sorting_all_grams(spark):
    df = spark.createDataFrame([(1, "a b a", "a a b c"), (2, "x", "y"), (3, "", "a")], "id long, g string, r string")
    per = SI.rouge_n_pairs(df, "id", "g", "r", (1, 2))
    assert "array_sort" not in plan(per) and "Exchange" not in plan(per)
    got = {(r.id, r.n): (round(r.p, 6), round(r.r, 6)) for r in per.collect()}
    assert got == {(1, 1): (1.0, 0.75), (1, 2): (0.5, 0.333333), (2, 1): (0.0, 0.0), (2, 2): (0.0, 0.0)}


def test_training_rows_of_trees_are_dealt_to_partitions_of_bounded_bins(spark, monkeypatch):
    """A tree family holds four bytes for every feature of every row; one partition had them all, however many."""
    rows = spark.range(100, numPartitions=1)
    assert CL.dealt(rows, 1 << 15).rdd.getNumPartitions() == 1
    monkeypatch.setattr(CL, "BINNED_BYTES", 1 << 20)
    many = CL.dealt(rows, 1 << 15)
    assert many.rdd.getNumPartitions() == 13 and many.count() == 100


@pytest.mark.parametrize("name", ["stream_score", "stream_classify"])
def test_streams_read_a_table_that_is_a_folder_of_parts(spark, name):
    """A table of several files; the stream looked for one file of the table's name and found none."""
    import __spark_entry__ as E
    folder = IO.scratch_path(spark, f"parts-{name}")
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{table}.parquet").repartition(3).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    query = E.queries()[name]
    parts, one = ([json.dumps(r.asDict(), sort_keys=True) for r in query(spark, d).collect()] for d in (folder, SF_SMALL))
    assert len(parts) == len(one) > 0 and sorted(parts) == sorted(one)
