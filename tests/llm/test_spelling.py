"""Operator 12 against plain edit checks over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from narrata.llm import spelling
from tests.conftest import SF_SMALL, rows


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(counts, ratio=2):
    forms, many = {}, {}
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    for w in counts:
        near = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if one_edit(w, v)]
        many[w] = len(near)
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, many[w], counts[forms[w]] if forms[w] is not None else None))
    return sorted(out, key=repr)


def grouped(spark, counts, **more):
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    out = spelling.group_variants(table, **more)
    assert out.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"),
                          ("n_near", "bigint"), ("form_n", "bigint")]
    return sorted(rows(out), key=repr)


@pytest.mark.parametrize("block", [2, 7, 192])
def test_all_near_words_whatever_the_block(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(500)}
    counts = {w: int(2 ** rng.uniform(0, 12)) for w in words}
    assert grouped(spark, counts, block=block) == brute_force(counts)


def test_hot_group_ties_chains_and_other_alphabets(spark):
    hot = {f"prefix{a}{b}" for a in "abcdefghij" for b in "abcdefghij"}
    counts = {w: 3 for w in hot} | {"aaaaa": 4, "aaaa": 9, "aaa": 40, "aa": 90, "a": 200, "": 7, "日本語": 1, "日本": 5,
                                    "😀x": 2, "😀": 4, "ba": 90, "z" * 5000: 8, "z" * 5001: 3, "z" * 2499 + "y" * 2502: 6}
    got = grouped(spark, counts, block=16)
    assert got == brute_force(counts)
    found = {r[0]: r for r in got}
    assert found["aaaaa"][2] == "a" and found["aaa"][1] == "aa"
    assert found["a"][1] is None and found["z" * 5001][1] == "z" * 5000


def test_a_tile_compares_blocks_of_a_large_group(monkeypatch):
    monkeypatch.setattr(spelling, "TILE_ELEMENTS", 64)
    words = sorted({"".join(random.Random(i).choices("ab", k=6)) for i in range(60)})
    n = np.arange(len(words), 0, -1)
    one = np.zeros(1, np.int64)
    near, first = spelling._tally(words, n, one, one + 6, one, one + 6)
    for i, w in enumerate(words):
        own = [j for j, v in enumerate(words) if one_edit(w, v)]
        assert near[i] == len(own) and first[i] == (own[0] if own else -1)


def test_counts_with_nulls_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "Ärger ärger ARGERLICH×y", "w"), (1, "Ärger ärger ARGERLICH×y", "w"), (None, "argerlich×y 日本argerlich×y", None),
                                  (3, None, "x"), (4, "", "y"), (5, "abc abc abc", "z")], "doc_id long, text string, word string")
    out = spelling.word_counts(docs, least=1)
    assert sorted(rows(out)) == [("argerlich×y", 4), ("Ärger", 2), ("ärger", 2)]
    assert spelling.word_counts(docs).count() == 1
    empty = spelling.word_counts(docs.limit(0))
    assert rows(empty) == [] and rows(spelling.group_variants(empty)) == []
    with pytest.raises(ValueError, match="ratio"):
        spelling.group_variants(empty, ratio=1)


def test_held_words_are_handed_on(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "alpha betas alpha " * 3), (2, "alpha gammas " * 9)], "doc_id long, text string")
    task = spelling._count_task("text", "doc_id", 5, None)
    whole = sum((Counter(dict(zip(*b.to_pydict().values()))) for b in task(iter(docs.toArrow().to_batches()))), Counter())
    assert whole == {"alpha": 15, "betas": 3, "gammas": 9}


def test_query_on_documents(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    got = sorted(rows(spelling.op12_spelling_variants(spark, SF_SMALL)), key=repr)
    assert got == brute_force(counts) and any(r[1] for r in got)
