"""Decontamination against brute force on words, and spans in the original text."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from narrata.llm import decontaminate as DC
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(text, benchmark):
    w, hit, found = words(text), set(), set()
    for item_id, item in benchmark:
        own = words(item)
        if item_id is None or not own:
            continue
        k = min(13, len(own))
        windows = {tuple(own[i:i + k]) for i in range(len(own) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(item_id)
    return len(w), hit, sorted(found)


def check(spark, docs, benchmark):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame(benchmark, "item_id long, text string")
    out = DC.annotate(d, b).withColumn("bad", DC.contaminated()).collect()
    assert len(out) == len(docs)
    for r in out:
        n, hit, found = expected(r.text, benchmark)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, len(hit), found), r.text
        assert r.bad == (len(hit) > 0 and 20 * len(hit) >= n)
        got = [w for a, e in zip(r.spans[::2], r.spans[1::2]) for w in words(r.text[a:e])]
        assert got == [words(r.text)[i] for i in sorted(hit)]


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "What is Été?"), (2, "second text"), (10, "w3 w4"), (None, "null id"), (4, None), (5, "?!"),
         (6, " ".join(f"w{i}" for i in range(5, 25)))]
DOCS = [LONG.upper() + "!", "so, what is... ÉTÉ? what is Été, " * 3, None, "", "null id", "x " * 50 + "w3-w4",
        "w3 w4 w3 w4", " ".join(f"w{i}" for i in range(12)), " ".join(f"w{i}" for i in range(2, 15)),
        "a—second\ttext second", "漢字 second text 漢字", "w3 w4\x7f" * 2000]


def test_edge_rows(spark):
    check(spark, DOCS, ITEMS)


def test_several_automata(spark, monkeypatch):
    monkeypatch.setattr(DC, "MAX_WINDOWS", 4)
    check(spark, DOCS, ITEMS)


def test_empty_tables(spark):
    check(spark, DOCS, [])
    d = spark.createDataFrame([], "doc_id long, text string")
    assert DC.annotate(d, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_filter_keeps_columns(spark):
    d = spark.createDataFrame([(1, LONG, "a", 3), (2, "clean text", "b", 4), (None, None, None, None)],
                              "doc_id long, text string, items string, n_words int")
    out = DC.decontaminate(d, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert out.dtypes == d.dtypes
    assert sorted(out.collect(), key=str) == sorted([r for r in d.collect() if r.doc_id != 1], key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(F.length("text") < 6000)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    check(spark, [r.text for r in docs.collect()], bench)


def test_query_digest(spark):
    out = DC.op5_benchmark_decontamination(spark, SF_SMALL)
    assert out.columns[:6] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = out.collect()
    assert any(r.contaminated for r in rows)
    assert {r.items_sha256 for r in rows if r.n_items == 0} == {hashlib.sha256(b"").hexdigest()}
    one = next(r for r in rows if r.n_items == 1)
    assert re.fullmatch("[0-9a-f]{64}", one.items_sha256)


@pytest.mark.parametrize("n", [0, 1, 12, 13, 14])
def test_short_items(spark, n):
    text = " ".join(f"v{i}" for i in range(n))
    check(spark, [text, "z " + text + " z", text[:-1]], [(1, text)])


def test_many_short_items_are_cut_by_their_words(spark, monkeypatch):
    """More distinct words than code points: the parts are bounded by words as well as by windows."""
    n = 100_000
    items = spark.range(n).selectExpr("id AS item_id", "concat_ws(' ', transform(sequence(0, 11), i -> concat('w', id * 12 + i))) AS text")
    texts = [(1, " ".join(f"w{12 * 5 + i}" for i in range(12)) + " x"), (2, " ".join(f"w{12 * (n - 1) + i}" for i in range(12))),
             (3, " ".join(f"w{12 * 7 + i}" for i in range(11)))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert len(DC._parts(items, 13)[1]) > 1
    got = {r.doc_id: (r.n_hit, r["items"]) for r in DC.annotate(docs, items, keep=["doc_id"]).collect()}
    assert got == {1: (12, [5]), 2: (12, [n - 1]), 3: (0, [])}


def test_more_parts_than_are_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(DC, "MAX_WORDS", 8)
    monkeypatch.setattr(DC, "PARTS_AT_ONCE", 2)
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(12)], "item_id long, text string").coalesce(1)
    docs = spark.createDataFrame([(i, f"x a{i} b{i} c{i}", "t") for i in range(13)], "doc_id long, text string, task string")
    assert len(DC._parts(items, 3)[1]) == 6
    got = {r.doc_id: (r.n_hit, r["items"], r.task) for r in DC.annotate(docs, items, window=3).collect()}
    assert got == {i: (3, [i], "t") if i < 12 else (0, [], "t") for i in range(13)}
