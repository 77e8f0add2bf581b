"""Lexicon scorer rules on inline rows."""

import math

import pytest
from pyspark.sql import functions as F

from narrata.operators import sentiment as S


@pytest.mark.parametrize("c,label", [(0.05, 2), (-0.05, 0), (0.049, 1), (0.0, 1)])
def test_label_bounds(spark, c, label):
    df = spark.createDataFrame([(c,)], "c double")
    assert df.select(S.sentiment_label("c")).first()[0] == label


def lex(spark):
    return spark.createDataFrame([("good", 1.5), ("bad", -1.5)], "token string, valence double")


@pytest.fixture(params=["in the row", "joined"])
def way(request, monkeypatch):
    """Both ways of scoring: with a lexicon that fits the plan, and with one that doesn't."""
    if request.param == "joined":
        monkeypatch.setattr(S, "MAX_LEXICON_BYTES", -1)
    return request.param


def test_rows_stay_rows_and_names_may_clash(spark, way):
    docs = spark.createDataFrame([(1, "good", "a", 5), (1, "good", "a", 5), (1, "bad bad", "b", 6), (None, None, None, None),
                                  (2, "good " * 30_000, "c", 7)], "id long, t string, tok string, row long")
    lexicon = spark.createDataFrame([("good", 1.5), ("bad", -1.0), ("bad", -0.5), (None, 9.0), ("bare", None)],
                                    "token string, valence double")
    none = spark.createDataFrame([], "token string")
    for scored in (S.lexicon_sentiment(docs, "id", "t", lexicon, ["tok", "row"]),
                   S.lexicon_sentiment_context(docs, "id", "t", lexicon, none, none, "but", ["tok", "row"])):
        got = sorted(((r.id or 0), r.tok or "", r.row or 0, r.valence_sum, r.sentiment) for r in scored.collect())
        assert got == [(0, "", 0, 0.0, 1), (1, "a", 5, 1.5, 2), (1, "a", 5, 1.5, 2), (1, "b", 6, -3.0, 0), (2, "c", 7, 45000.0, 2)]
        assert scored.limit(0).collect() == []
    assert S.lexicon_sentiment(docs, "id", "t", lexicon.limit(0)).filter("valence_sum <> 0").count() == 0


def test_both_ways_give_the_same(spark, monkeypatch):
    import random
    rng = random.Random(8)
    words = ["good", "bad", "not", "very", "but", "the", "été", 'quo"te', "back\\slash", "both"]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=rng.randint(0, 14)))) for i in range(300)], "id long, t string")
    lexicon = spark.createDataFrame([("good", 1.5), ("bad", -1.3), ("été", 0.7), ('quo"te', 0.1), ("back\\slash", -0.2), ("both", 0.4)],
                                    "token string, valence double")
    neg = spark.createDataFrame([("not",), ("both",), ("not",)], "token string")
    bst = spark.createDataFrame([("very",), ("both",)], "token string")
    found = []
    for limit in (16 << 20, -1):
        monkeypatch.setattr(S, "MAX_LEXICON_BYTES", limit)
        plain = S.lexicon_sentiment(docs, "id", "t", lexicon)
        ruled = S.lexicon_sentiment_context(docs, "id", "t", lexicon, neg, bst, "but")
        for df in (plain, ruled):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert ("Exchange" in plan) == (limit < 0)
        found.append([sorted(tuple(r) for r in df.collect()) for df in (plain, ruled)])
    assert found[0] == found[1]


def test_no_lexicon_word_is_neutral(spark, way):
    docs = spark.createDataFrame([(1, "nothing here"), (2, "")], "id long, t string")
    out = {r["id"]: (r["valence_sum"], r["sentiment"]) for r in
           S.lexicon_sentiment(docs, "id", "t", lex(spark)).collect()}
    assert out == {1: (0.0, 1), 2: (0.0, 1)}


def test_compound(spark, way):
    docs = spark.createDataFrame([(1, "good good bad good")], "id long, t string")
    r = S.lexicon_sentiment(docs, "id", "t", lex(spark)).first()
    assert r["valence_sum"] == 3.0
    assert abs(r["compound"] - 3 / math.sqrt(9 + 15)) < 1e-12


def context(spark, text):
    docs = spark.createDataFrame([(1, text)], "id long, t string")
    neg = spark.createDataFrame([("not",)], "token string")
    bst = spark.createDataFrame([("very",)], "token string")
    return S.lexicon_sentiment_context(docs, "id", "t", lex(spark), neg, bst, "but").first()["valence_sum"]


def test_context_rules(spark, way):
    assert abs(context(spark, "good") - 1.5) < 1e-9
    assert abs(context(spark, "not good") - 1.5 * -0.74) < 1e-9
    assert abs(context(spark, "not x y good") - 1.5 * -0.74) < 1e-9                # negator 3 back
    assert abs(context(spark, "not very nice good") - (1.5 + 0.293 * 0.95) * -0.74) < 1e-9
    assert abs(context(spark, "very good") - (1.5 + 0.293)) < 1e-9
    assert abs(context(spark, "very x good") - (1.5 + 0.293 * 0.95)) < 1e-9
    assert abs(context(spark, "very bad") - (-1.5 - 0.293)) < 1e-9
    assert abs(context(spark, "a b c d not good") - 1.5 * -0.74) < 1e-9
    assert abs(context(spark, "not a b c good") - 1.5) < 1e-9                       # 4 back: no effect
    assert abs(context(spark, "good but bad") - (1.5 * 0.5 - 1.5 * 1.5)) < 1e-9


def test_sentiment_by_product_nulls(spark):
    scored = spark.createDataFrame([("a", 0), ("a", 2), ("b", 1)], "product string, sentiment int")
    out = {r["product"]: (r["negative"], r["neutral"], r["positive"])
           for r in S.sentiment_by_product(scored).collect()}
    assert out == {"a": (0.5, None, 0.5), "b": (None, 1.0, None)}


def test_models_side_by_side_keep_rows(spark):
    from narrata.operators import scoring as SC

    df = spark.createDataFrame([(1, "Good", "bad"), (1, "bad", None), (None, "", "good")], "id int, a string, b string")
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    models = {"one": lambda d: S.lexicon_sentiment(d, "id", "text", lex, keep=["input"]).select("id", "input", "sentiment"),
              "none": lambda d: d.select("id", "input", F.lit(9).alias("sentiment"))}
    out = SC.compare_models(df, "id", {"a": F.col("a"), "b": F.col("b")}, models, F.lower)
    got = [(r.id, r.input, r.sentiment) for r in out.collect() if r.model == "one"]
    assert sorted(got, key=str) == sorted([(1, "a", 2), (1, "a", 0), (None, "a", 1), (1, "b", 0), (1, "b", 1), (None, "b", 2)], key=str)
    assert out.filter("model = 'none'").count() == 6
