"""Texts are cleaned and cut into words once."""

from narrata.functions import text as T
from narrata.plans import queries as Q
from narrata.sources import tables as TB
from tests.conftest import SF_SMALL


def test_exploded_words_are_cut_once(spark):
    """The filter that the optimizer puts below an explode cut every text two more times."""
    docs = spark.createDataFrame([(1, "a b  a"), (2, ""), (3, None)], "id long, clean string")
    words = TB.vocabulary_tokens(docs)
    assert words._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted(r.token for r in words.collect()) == ["a", "b"]
    rows = T.exploded(docs, T.words("clean"), "id")
    assert sorted(map(tuple, rows.collect())) == [(1, "a"), (1, "a"), (1, "b")]


def test_runs_of_whitespace_and_masks_at_every_place(spark):
    texts = ["  a \t b", "\n\n", "a   b ", " a  b\tc ", "xx", "axx xxx xxa 12 usc 123456 usc a1 usc 7 \n uscx 7 usc", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = {r.id: (r.w, r.c) for r in docs.select("id", T.normalize_whitespace("t").alias("w"), T.clean_narrative("t").alias("c")).collect()}
    assert [got[i][0] for i in range(len(texts))] == [None if t is None else " ".join(t.split()) for t in texts]
    assert [got[i][1] for i in (4, 5)] == ["", "axx  xxa  123456 usc a1 usc 7 uscx "]


def test_lexicon_queries_clean_the_texts_once(spark, monkeypatch):
    """Once for the lexicon and for the scores; each cleaned the texts for itself."""
    calls, whole = [], TB.cleaned_complaints
    monkeypatch.setattr(TB, "cleaned_complaints", lambda *a, **k: calls.append(a) or whole(*a, **k))
    for name in ("sentiment_by_product", "lexicon_sentiment", "examples_per_class", "label_names"):
        calls.clear()
        Q.REGISTRY[name](spark, SF_SMALL)
        assert len(calls) == 1, name
