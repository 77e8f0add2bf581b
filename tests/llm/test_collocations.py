"""Operator 11 against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from narrata.llm import collocations
from tests.conftest import rows


def brute_force(docs, longest=3, least=10, covered=50, top=2000):
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, g), a in candidates.items():
        cuts = [(10 ** 6 * a * a // (f[lang, g[:j]] * f[lang, g[j:]]), j, f[lang, g[:j]], f[lang, g[j:]])
                for j in range(1, len(g))]
        longer = [b for (other, h), b in candidates.items() if other == lang and len(h) > len(g)
                  and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if any(100 * b >= covered * a for b in longer):
            continue
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i + 1, g.decode(), -a, left, right, total[lang], -score) for lang, own in found.items()
                  for i, (score, a, g, left, right) in enumerate(sorted(own)[:top]))


def random_docs(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "été", "x", "日本", "a-b"]
    for i in range(n):
        text = "".join(rng.choices(words, [8, 5, 3, 3, 2, 2, 1, 1])[0] + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n"])
                       for _ in range(rng.randint(0, 120)))
        yield text, rng.choice(["en", "en", "fr", None, "und"])


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_all_phrases(spark, longest):
    docs = list(random_docs(longest))
    table = spark.createDataFrame(docs, "text string, lang string")
    got = collocations.collocations(table, longest=longest, least=4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(rows(got)) == brute_force(docs, longest, least=4)


def test_ties_repeated_rows_nulls_and_clashing_columns(spark):
    docs = [("b a. a b. c d, d c. " * 5, "en")] * 3 + [(None, "en"), ("", None), ("e e e e e " * 4, None), ("one " * 50_000, "x")]
    table = spark.createDataFrame([(*d, 1, "w", b"c") for d in docs], "text string, lang string, id long, word string, codes binary")
    got = collocations.collocations(table, top=3)
    expected = brute_force(docs, top=3)
    assert sorted(rows(got)) == expected and [r[2] for r in expected if r[0] == "en"] == ["a b", "b a", "c d"]
    assert rows(collocations.collocations(table.limit(0))) == []
    assert rows(collocations.collocations(table.filter("text = ''"))) == []


def test_counts_are_exact_beyond_64_bits(spark):
    a, left, right = 10 ** 12 - 7, 10 ** 12 - 3, 10 ** 12 - 1
    whole = f"CAST(1000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(19,0)) * CAST({a} AS DECIMAL(19,0))"
    got = spark.sql(f"SELECT ({whole}) DIV (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))").first()[0]
    assert got == 10 ** 6 * a * a // (left * right)


def test_semi_join_keeps_runs_of_frequent_phrases():
    words = np.arange(1, 11, dtype=np.uint64)
    runs = np.array([4, 6], np.int64)
    for k in (1, 2, 3):
        ids, inside = collocations._phrase_ids(words, runs, k)
        assert inside.tolist() == [i + k <= 4 or i >= 4 and i + k <= 10 for i in range(len(ids))]
    ids, _ = collocations._phrase_ids(words, runs, 3)
    pair, _ = collocations._phrase_ids(words, runs, 2)
    assert (collocations.joined_ids(pair[:8], words[2:]) == ids).all()


def test_tasks_hand_on_counts(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "HELD_WORDS", 2)
    batch = pa.RecordBatch.from_pydict({"text": ["a b a", "c " * 5, None], "lang": ["en", None, "fr"]})
    out = [r for b in collocations._occurrences("text", "lang")(iter([batch])) for r in b.to_pylist()]
    counts = Counter()
    for r in out:
        if r["n"] is not None:
            counts[r["lang"], r["word"]] += r["n"]
    assert counts == {("en", "a"): 2, ("en", "b"): 1, ("und", "c"): 5}
