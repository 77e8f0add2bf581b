"""Pinned edge rows (FIXTURES.md section 3) and Python-parity of the text rules."""

import re

import pytest
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.operators import summarize as SU


def one(spark, value, fn, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(fn("t").alias("o")).first()["o"]


@pytest.mark.parametrize("raw,expected", [
    ("On XX/XX/2020 paid XXXX per 15 U.S.C. 1681 and 15 USC", "on xxxx2020 paid  per  1681 and "),
    ("XXXX", ""),
    ("naïve xx é xxé xx.", "naïve  é xxé "),
    ("a xx xx xx b", "a    b"),
    ("1 usc 2 usc", " "),
    ("123456 usc", "123456 usc"),
])
def test_clean_narrative_pinned(spark, raw, expected):
    assert one(spark, raw, T.clean_narrative) == expected


def _python_rule(text):
    """The cleaning rule written with Python's Unicode ``re`` (the spec)."""
    out = " ".join(text.strip().replace("\n", " ").split()).lower()
    out = re.sub(r"[^\w\s]", "", out)
    out = re.sub(r"\b\d{1,5}\s+usc\b", "", out, flags=re.IGNORECASE)
    return re.sub(r"\b[x]{2,}\b", "", out)


def test_clean_matches_python_on_fixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = ["a b\x1cc\x85d　e", "Tab\there  new\nline", "ÉCOLE 12 usc x_x xx_ 99 USC."]
    inline = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    got = {r[0]: r[1] for r in docs.unionByName(inline).select(
        "doc_id", T.clean_narrative("text")).collect()}
    want = {r[0]: _python_rule(r[1]) for r in docs.unionByName(inline).collect()}
    assert got == want


def test_exotic_whitespace_is_one_space(spark):
    s = "a b\x1cc\x85d　e"
    assert one(spark, s, T.normalize_whitespace) == "a b c d e"
    assert one(spark, s, lambda c: F.size(T.words(c))) == len(s.split())


def test_word_count_empty_and_null(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("a b",)], "t string")
    assert [r[0] for r in df.select(T.word_count("t")).collect()] == [0, 0, None, 2]


def test_dedupe_sentences(spark):
    assert one(spark, "A. B. A.", T.dedupe_sentences) == "A. B."


def test_sentences_split(spark):
    got = one(spark, "One two. Three?  Four!\nFive", T.sentences)
    assert got == ["One two.", "Three?", "Four!", "Five"]


def test_build_text_policies(spark):
    df = spark.createDataFrame([("a", None, "c", "d")], "a string, b string, c string, d string")
    r = df.select(T.build_text(["a", "b", "c", "d"], "empty").alias("e"),
                  T.build_text(["a", "b", "c", "d"], "blank").alias("b"),
                  T.build_text(["a", "b", "c", "d"], "skip", sep=" | ", labels=["A", "B", "C", "D"]).alias("s")
                  ).first()
    assert r["e"] == ""
    assert r["b"] == "a  c d"
    assert r["s"] == "A: a | C: c | D: d"


def test_strip_stopwords(spark):
    assert one(spark, "I don't like THIS bank's fee 123!", T.strip_stopwords) == "like banks fee"


def test_chunk_oversized_first_sentence(spark):
    long_first = " ".join(["w"] * 600) + ". Short one."
    df = spark.createDataFrame([(1, long_first)], "id long, t string")
    chunks = [r["chunk"] for r in SU.chunk_sentences(df, "id", "t", 512).orderBy("chunk_index").collect()]
    assert len(chunks) == 2 and all(chunks)
    assert chunks[1] == "Short one."


def test_chunk_packs_greedily(spark):
    text = "a b c. d e. f g h i."
    df = spark.createDataFrame([(1, text)], "id long, t string")
    got = [r["chunk"] for r in SU.chunk_sentences(df, "id", "t", 5).orderBy("chunk_index").collect()]
    assert got == ["a b c. d e.", "f g h i."]


@pytest.mark.parametrize("n,expected", [(9, (None, None)), (30, (30, 30)), (80, (50, 80)), (500, (50, 120))])
def test_summary_budget(spark, n, expected):
    df = spark.createDataFrame([(n,)], "n long")
    lo, hi = SU.summary_budget("n")
    r = df.select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r["lo"], r["hi"]) == expected


def test_summaries_of_rows_that_share_an_id(spark):
    from narrata.operators import summarize as SU
    a = "Alpha fee was charged twice. " + "The bank never answered my letters about it. " * 4 + "Done here."
    b = "Beta loan papers were lost. " + "Nobody could tell where they had gone to. " * 4 + "Over now."
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (2, "too short", "x"), (None, None, "x"), (3, "", "x"), (4, "... !!! ???", "x")]
    df = spark.createDataFrame(rows, "id long, text string, row string")
    for fn in (SU.extractive_summary, SU.chunked_summary):
        got = fn(df, "id", "text").collect()
        assert sorted((r.id or 0) for r in got) == [0, 1, 1, 1, 2, 3, 4]
        own = sorted(r.summary for r in got if r.id == 1)
        assert len(set(own)) == 2 and "Alpha" in own[0] and "Beta" not in own[0] and own[1] == own[2]
        assert [r.summary for r in got if r.id != 1] == [""] * 4
        assert fn(df.limit(0), "id", "text").collect() == []


def test_chunks_equal_a_plain_fold(spark):
    import random
    from narrata.operators import summarize as SU
    rng = random.Random(2)
    texts = [" ".join(" ".join(["w"] * rng.randint(1, 9)) + "." for _ in range(rng.randint(0, 30))) for _ in range(40)]
    got = {}
    for r in SU.chunk_sentences(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t", 7).collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.chunk))
    for i, t in enumerate(texts):
        done, cur, n = [], "", 0
        for s in [x.strip() + "." for x in t.split(".") if x.strip()]:
            m = len(s.split())
            if n + m <= 7:
                cur, n = (s if not cur else f"{cur} {s}"), n + m
            else:
                done, cur, n = [*done, cur], s, m
        want = [c for c in [*done, cur] if c]
        assert [c for _, c in sorted(got.get(i, []))] == want


@pytest.mark.parametrize("limit", [16 << 20, -1])  # looked up in the row, and joined
def test_rows_that_share_an_id_are_encoded_alone(spark, monkeypatch, limit):
    from narrata.operators import tokens as TK
    monkeypatch.setattr(TK, "MAX_VOCABULARY_BYTES", limit)
    vocab = spark.createDataFrame([("a", 1000), ("b", 1001), (None, 1002)], "token string, token_id int")
    rows = [(1, "a b c a b", "w"), (1, "b", "w"), (1, "b", "w"), (2, None, "w"), (3, "", "w"), (4, "a " * 7, "w")]
    df = spark.createDataFrame(rows, "id int, words string, token string")
    got = sorted((r.id, r.window_index, r.input_ids, r.attention_mask) for r in TK.encode_tokens(df, "id", "words", vocab, 6).collect())
    assert got == [(1, 0, [101, 1000, 1001, 100, 1000, 102], [1] * 6), (1, 0, [101, 1001, 102, 0, 0, 0], [1, 1, 1, 0, 0, 0]),
                   (1, 0, [101, 1001, 102, 0, 0, 0], [1, 1, 1, 0, 0, 0]), (1, 1, [101, 1001, 102, 0, 0, 0], [1, 1, 1, 0, 0, 0]),
                   (2, 0, [101, 102, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0]), (3, 0, [101, 102, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0]),
                   (4, 0, [101, 1000, 1000, 1000, 1000, 102], [1] * 6), (4, 1, [101, 1000, 1000, 1000, 102, 0], [1, 1, 1, 1, 1, 0])]
    assert TK.encode_tokens(df.limit(0), "id", "words", vocab, 6).collect() == []
    with pytest.raises(ValueError, match="window"):
        TK.encode_tokens(df, "id", "words", vocab, 2)
