"""Rows that are exchanged hold their words as one string, and tokens are counted by one exchange."""

import pytest

from narrata.operators import sentiment as S
from narrata.operators import word_bayes as WB
from narrata.operators import word_vectors as WV
from narrata.sources import io as IO


@pytest.fixture
def written(monkeypatch):
    """Written tables by the last part of their name, as they were before writing."""
    out, kept = {}, IO.materialize

    def spy(df, spark, name):
        out[name.split("/")[-1]] = df
        return kept(df, spark, name)
    monkeypatch.setattr(IO, "materialize", spy)
    return out


TEXTS = [(1, "a b a\tc", "x"), (2, "b  b c d", "y"), (3, "", "x"), (4, None, "y"), (5, "d a", None), (1, "a b a\tc", "x")]


@pytest.mark.parametrize("pairs", [False, True])
def test_naive_bayes_counts_by_one_exchange(spark, written, pairs):
    df = spark.createDataFrame(TEXTS, "id long, text string, label string")
    model = WB.fit(df, "text", "label", pairs)
    plan = written["counts"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    want = {}
    for _, text, label in TEXTS:
        w = (text or "").split() if label else []
        for t in ([f"{a} {b}" for a, b in zip(w, w[1:], strict=False)] if pairs else w):
            want.setdefault(t, {"x": 0, "y": 0})[label] += 1
    assert {r.token: (r.n, r.seen) for r in written["counts"].collect()} == {
        t: (sum(c.values()), [c["x"], c["y"]]) for t, c in want.items()}
    # two models read one written table
    rows = WB.numbered(df, "text", ["id"])
    assert rows.schema["words"].dataType.simpleString() == "string"
    assert sorted(WB.score(df, "text", model, ["id"], rows).collect()) == sorted(WB.score(df, "text", model, ["id"]).collect())


def test_pairs_of_texts_are_strings(spark, written):
    df = spark.createDataFrame([(1, "a  b\tzz", "b c q"), (2, "c", " c "), (3, "a", "  ")], "id long, s string, t string")
    vectors = spark.createDataFrame([("a", 1, [1] * 16 + [0] * 16), ("b", 2, [1] * 32), ("c", 2, [0] * 31 + [1])],
                                    "token string, docs long, vec array<smallint>")
    got = {r.id: (r.p, r.r) for r in WV.pair_similarity(df, "s", "t", vectors, 3, ["id"]).collect()}
    assert written["rows"].schema["texts"].dataType.simpleString() == "array<string>"
    assert got[2] == (1.0, 1.0) and got[3] == (0.0, 0.0) and 0 < got[1][0] < 1 and 0 < got[1][1] < 1


def test_scorers_share_the_written_words(spark, written, monkeypatch):
    monkeypatch.setattr(S, "MAX_LEXICON_BYTES", 0)
    df = spark.createDataFrame([r[:2] for r in TEXTS], "id long, text string")
    lexicon = spark.createDataFrame([("a", 1.5), ("c", -1.5)], "token string, valence double")
    neg, bst = (spark.createDataFrame([(t,)], "token string") for t in "bd")
    alone = [S.lexicon_sentiment(df, "id", "text", lexicon), S.lexicon_sentiment_context(df, "id", "text", lexicon, neg, bst, "c")]
    words = S.TextWords(df, "id", "text")
    names = []
    kept = IO.materialize
    monkeypatch.setattr(IO, "materialize", lambda d, s, name: names.append(name.split("/")[-1]) or kept(d, s, name))
    shared = [S.lexicon_sentiment(df, "id", "text", lexicon, words=words),
              S.lexicon_sentiment_context(df, "id", "text", lexicon, neg, bst, "c", words=words)]
    assert names.count("rows") == names.count("counts") == 1 and words.rows.schema["words"].dataType.simpleString() == "string"
    assert [sorted(x.collect()) for x in shared] == [sorted(x.collect()) for x in alone]
