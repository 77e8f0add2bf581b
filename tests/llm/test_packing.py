"""Packing: each id in one piece, gapless windows, target mixture in every window."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm import packing as PK
from narrata.llm.bpe import encoder
from tests.conftest import SF_SMALL


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=6), st.data())
def test_mixture_is_whole_and_monotone(totals, data):
    weights = data.draw(st.one_of(st.none(), st.lists(
        st.integers(0, 9).map(float), min_size=len(totals), max_size=len(totals))))
    mix = PK.Mixture(totals, weights)
    if not mix.total:
        return
    given_ = mix.given(np.arange(mix.total + 1))
    assert (given_.sum(axis=1) == np.arange(mix.total + 1)).all()
    assert (np.diff(given_, axis=0) >= 0).all()
    assert given_[-1].tolist() == totals


def test_mixture_beyond_64_bits():
    totals = [3 * 10**12, 5 * 10**12, 10**12 + 7]
    mix = PK.Mixture(totals)
    m = np.array([0, 2048, 10**12, sum(totals)], np.int64)
    got = mix.given(m)
    assert (got.sum(axis=1) == m).all() and got[-1].tolist() == totals
    assert abs(int(got[1, 0]) - 2048 * totals[0] // sum(totals)) <= 1


def check(rows, pieces, window=PK.WINDOW):
    """Brute force over all pieces; returns ids of each sequence by queue."""
    docs = defaultdict(list)
    for doc_id, text in rows:
        docs[doc_id].append(encoder().tok.encode(text or "", add_special_tokens=False).ids + [PK.END_ID])
    total = sum(len(d) for own in docs.values() for d in own)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(docs)
    for doc_id, own in by_doc.items():
        if len(docs[doc_id]) == 1:
            ids, at = docs[doc_id][0], 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)
    assert sum(p.length for p in pieces) == total
    n_seq = -(-total // window)
    assert sorted(by_seq) == list(range(n_seq))
    for seq, own in by_seq.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window if seq < n_seq - 1 else at == total - window * (n_seq - 1)
    return by_seq


def test_documents_keep_the_mixture(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = PK.pack(docs).collect()
    by_seq = check(rows, pieces)
    share = defaultdict(int)
    for p in pieces:
        share[p.queue] += p.length
    total = sum(share.values())
    for seq, own in by_seq.items():
        if seq < max(by_seq):
            got = defaultdict(int)
            for p in own:
                got[p.queue] += p.length
            for q, n in share.items():
                assert abs(got[q] - 2048 * n / total) <= 2


def test_weights_and_edge_rows(spark):
    rows = [(1, "red cat " * 900, "a"), (2, "blue dog " * 300, "b"), (3, None, "a"), (4, "", None), (5, "x", "c"),
            (6, "dup", "a"), (6, "dup", "a"), (None, "no id", "b"), (8, "long " * 30_000, "a")]
    docs = spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows)],
                                 "doc_id long, text string, source string, queue int, part int").repartition(3)
    pieces = PK.pack(docs, weights={"a": 1.0, "b": 1.0}, window=64).collect()
    by_seq = check([r[:2] for r in rows], pieces, 64)
    for seq in range(3):
        got = defaultdict(int)
        for p in by_seq[seq]:
            got[p.queue] += p.length
        assert got["sa"] == got["sb"] == 32


def test_empty_table_and_many_sources(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert PK.pack(empty).collect() == []
    rows = [(i, f"text {i}", f"s{i}") for i in range(400)]
    many = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check([r[:2] for r in rows], PK.pack(many, window=128).collect(), 128)


def by_queue(by_seq, seq):
    got = defaultdict(int)
    for p in by_seq[seq]:
        got[p.queue] += p.length
    return got


def test_four_hundred_sources_one_of_them_hot(spark, monkeypatch):
    """Every window holds every source at its share, and weights hold too."""
    rows = [(i, f"word{i} and some more text here " * 6, f"s{i % 400}") for i in range(800)]
    rows += [(1000 + i, "a hot source gives a third of all ids " * 12, "hot") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    pieces = PK.pack(docs).collect()
    by_seq = check([r[:2] for r in rows], pieces)
    share = defaultdict(int)
    for p in pieces:
        share[p.queue] += p.length
    total, last = sum(share.values()), max(by_seq)
    assert len(share) == 401 and share["shot"] > total / 4
    for seq in range(last):
        got = by_queue(by_seq, seq)
        for q, n in share.items():  # within a few ids: a halving rounds at each of nine levels
            assert abs(got[q] - 2048 * n / total) <= 5
    weighted = check([r[:2] for r in rows], PK.pack(docs, weights={"hot": 3.0, "s7": 1.0}, window=64).collect(), 64)
    assert dict(by_queue(weighted, 0)) == {"shot": 48, "ss7": 16}
    tail = by_queue(weighted, max(weighted) // 2)
    assert "ss7" not in tail
    monkeypatch.setattr(PK, "MAX_SOURCES", 400)
    with pytest.raises(ValueError, match="sources"):
        PK.pack(docs)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="negative"):
        PK.pack(docs, weights={"hot": -1.0})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=40), st.dictionaries(st.integers(0, 39), st.integers(0, 5), max_size=6))
def test_pairs_equal_the_whole_table(totals, weights):
    weights = {j: float(w) for j, w in weights.items() if j < len(totals)}
    mix = PK.Mixture(totals, weights)
    m = np.arange(0, mix.total + 1, max(1, mix.total // 50))
    table = mix.given(m)
    queue = np.arange(len(m)) % len(totals)
    own, earlier = mix.given(m, queue)
    assert (own == table[np.arange(len(m)), queue]).all()
    assert (earlier == [table[i, :q].sum() for i, q in enumerate(queue)]).all()
