"""Exact quantiles against sorting, and learned sentence borders against plain counting."""

import math
import random

import numpy as np
import pytest

from narrata.functions import text as T
from narrata.operators import borders as BO
from narrata.operators import quantiles as QT
from narrata.operators.profile import describe

PS = [0.0, 0.001, 0.25, 0.5, 0.731, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("kind", ["distinct", "ties", "hot", "whole", "few"])
def test_quantiles_equal_sorting(spark, monkeypatch, kind):
    monkeypatch.setattr(QT, "REST", 20)
    monkeypatch.setattr(QT, "ACCURACY", 50)
    rng = random.Random(kind)
    values = {"distinct": [rng.gauss(0, 1e6) for _ in range(6000)], "ties": [float(rng.randint(0, 9)) for _ in range(4000)],
              "hot": [7.0] * 2000 + [rng.random() * 14 for _ in range(4000)], "whole": list(range(5000)), "few": [3.5, -1.0]}[kind]
    rows = [(float(v), "a") for v in values] + [(None, "b"), (float("nan"), "c")]
    df = spark.createDataFrame(rows, "v double, x string").repartition(4)
    got = QT.quantile_values(df, "v", PS)
    assert np.allclose(got, np.quantile(np.array(values, float), PS), rtol=1e-12, atol=1e-9)
    assert [tuple(r) for r in QT.quantiles(df, "v", [0.5]).collect()] == [(0.5, got[3])]


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert QT.quantile_values(df, "v", [0.5]) == [None] and QT.quantile_values(df.limit(0), "v", [0.1, 1.0]) == [None, None]
    r = describe(spark.createDataFrame([(None,)], "v int"), "v").first()
    assert (r["count"], r.p25, r.p50, r.max) == (0, None, None, None)
    with pytest.raises(ValueError, match="between"):
        QT.quantile_values(df, "v", [1.5])


CORPUS = (["Mr. Smith paid a fee. He left.", "The U.S. bank sold acct. no. 7 to Mr. Jones. It closed.",
           "mr. Brown called. He asked about acct. no. 9. Nobody knew.", "He said no way. We paid."] * 30
          + [f"Plain words here {i} end. Other words came {i} back." for i in range(60)]
          + ["the fee he left knew end back closed jones paid way brown 7 came"] * 40 + [None, ""])


def test_abbreviations_are_no_borders(spark):
    df = spark.createDataFrame([(t, "w") for t in CORPUS], "t string, w string")
    found = {r.token: r for r in BO.abbreviations(df, "t").collect()}
    assert {"mr", "u.s", "acct"} <= set(found) and not {"fee", "he", "end", "left", "knew", "bank"} & set(found)
    table = BO.abbreviation_table(BO.abbreviations(df, "t"))

    def cut(text):
        return spark.createDataFrame([(text,)], "t string").transform(
            lambda d: BO.with_sentences(d, "t", table)).first()["sentences"]
    assert cut("Mr. Smith of the U.S. bank called.  Was acct. 7 closed?\nYes! It was") == [
        "Mr. Smith of the U.S. bank called.", "Was acct. 7 closed?", "Yes!", "It was"]
    assert cut("") == [] and cut(" \n ") == [] and cut(None) is None and cut("...") == ["..."]
    long = "Mr. X paid. " * 20_000
    assert len(cut(long)) == 20_000
    with pytest.raises(ValueError, match="already"):
        BO.with_sentences(df, "t", table, "w")
    none = BO.abbreviation_table(BO.abbreviations(df.limit(0), "t"))
    text = "Mr. A came. He left! Why? no one knows"
    plain = spark.createDataFrame([(text,)], "t string")
    assert BO.with_sentences(plain, "t", none).first()["sentences"] == plain.select(T.sentences("t")).first()[0]


def test_scores_equal_plain_counting(spark):
    from collections import Counter
    df = spark.createDataFrame([(t,) for t in CORPUS], "t string")
    with_p, without = Counter(), Counter()
    for t in CORPUS:
        for w in (t or "").lower().split():
            (with_p if w.endswith(".") else without)[w[:-1] if w.endswith(".") else w] += 1
    words = {w for w in {*with_p, *without} if any(c.isalpha() for c in w)}
    n_all, p_all = sum(with_p[w] + without[w] for w in words), sum(with_p[w] for w in words)

    def ll(k, n, p):
        return k * math.log(p) + (n - k) * math.log(1 - p)
    want = {}
    for w in words:
        k, n = with_p[w], with_p[w] + without[w]
        inner = w.count(".")
        size = len(w) - inner
        if k:
            score = -2 * (ll(k, n, p_all / n_all) - ll(k, n, 0.99)) * math.exp(-size) * (inner + 1) * size ** -without[w]
            if score >= 0.3:
                want[w] = score
    got = {r.token: r.score for r in BO.abbreviations(df, "t").collect()}
    assert set(got) == set(want) and all(abs(got[w] - want[w]) < 1e-5 for w in want)
