"""Piece-wise encoding equals the tokenizers library on every text."""

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm.bpe import encoder
from tests.conftest import SF_ORACLE

ALPHABET = "ab sS t'\n\r\tred vmll 12²½.,!-\x1c\x85\xa0éÀß—…“”€漢🙂 <|endoftext|>"


def expected(text):
    return encoder().tok.encode(text or "", add_special_tokens=False).ids


def check(texts):
    ids, counts = encoder().encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [expected(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=40)), min_size=1, max_size=6))
def test_odd_texts(texts):
    check(texts)


def test_contractions_and_white_space():
    check(["don't 's 'sabc we'll've \n's", "a  b   c\n\n d \n\t e  ", " ", "", None, "x'", "'", "'l", "'r", "it'd",
           "<|endoftext|> a", "漢字 and a", "a" * 300 + " " * 200, "''s", "1's"])


def test_documents():
    check([r[0] for r in duckdb.sql(f"SELECT text FROM '{SF_ORACLE}/documents.parquet'").fetchall()])
