"""Operator 13: ids and texts equal the sentencepiece library's; a tiny model against plain merging."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from narrata.llm import piece_bpe
from tests.conftest import SF_SMALL

EDGES = ["", " ", "  ", "▁", "▁▁a", " a  b   c\t\n\n x", "\x00a\x00", "日本語テキスト😀😀 é", "<s></s><unk><0x0A>", "\n",
         "Ünïcödé—“quoted”’s", "a" * 3000, "the" * 900, " " * 700, "==--" * 90, "0123 3.14159\r\n", None]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.model_path())


def mixed_texts(library, n):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    for _ in range(n):
        yield "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))).replace("▁", rng.choice([" ", "▁"]))
        yield "".join(rng.choice("aeinotrs ▁thé\n😀日.,") for _ in range(rng.randint(1, 60)))


def test_ids_and_texts_equal_the_library(library):
    model = piece_bpe.model()
    texts = [*EDGES, *mixed_texts(library, 3000)]
    for text, ids in zip(texts, model.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text or "", add_bos=True, add_eos=True)
        assert model.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode_as_in_the_library(library):
    rng, model = random.Random(6), piece_bpe.model()
    for _ in range(5000):
        ids = [rng.randrange(rng.choice([32000, 259, 259])) for _ in range(rng.randint(0, 12))]
        assert model.decode(np.array(ids, np.uint32)) == library.decode(ids), ids
    with pytest.raises(ValueError, match="out of range"):
        model.decode(np.array([32000]))


def test_neighbours_are_checked_by_merging_again(library):
    model = piece_bpe.model()
    rng = random.Random(7)
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    for _ in range(5000):
        a, b = (rng.choice(pieces).replace("▁", " ").encode().decode("latin-1") for _ in "ab")
        symbols = piece_bpe._CHARACTER.findall(a + b)
        while True:
            scores = [model.score.get(x + y, -np.inf) for x, y in zip(symbols, symbols[1:])]
            if not scores or max(scores) == -np.inf:
                break
            i = scores.index(max(scores))
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        assert model.compatible(a, b) == (symbols == [a, b])


def test_tables_that_start_anew_give_the_same(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MAX_SEGMENTS", 50)
    monkeypatch.setattr(piece_bpe, "MAX_PAIRS", 50)
    model = piece_bpe.PieceModel(piece_bpe.model_path())
    for text in mixed_texts(library, 200):
        assert model.encode(pa.array([text]))[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_tables_with_nulls_repeated_rows_and_other_columns(spark, library):
    long = "pneumonoultra " * 60_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y"), (3, long, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, flat string")
    out = piece_bpe.decode(piece_bpe.encode(docs))
    assert out.columns == ["doc_id", "text", "flat", "ids", "decoded"]
    found = out.collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["flat"] or "") for r in found) == sorted(
        (a or 0, b or "", c or "") for a, b, c in rows)
    for r in found:
        assert r["decoded"] == (r["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"] or "", add_bos=True, add_eos=True)
    assert piece_bpe.decode(piece_bpe.encode(docs.limit(0))).collect() == []
    with pytest.raises(ValueError, match="already"):
        piece_bpe.encode(docs, ids="flat")


def test_query_on_documents(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = piece_bpe.op13_piece_bpe(spark, SF_SMALL)
    assert out.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"),
                          ("decoded_sha256", "string")]
    found = out.collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode(docs[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
