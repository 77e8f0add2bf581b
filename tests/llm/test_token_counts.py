"""Edit-aware counts equal a fresh encoding of the edited text."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm import token_counts as TC
from narrata.llm.bpe import encoder
from tests.conftest import SF_SMALL


def fresh(text):
    return len(encoder().tok.encode(text, add_special_tokens=False).ids)


WORDS = st.lists(st.sampled_from(["red", " ", "  ", "\n", "'s", "x1", "é", "!?", "long" * 20, "\x1c", "<|endoftext|>", "漢"]),
                 max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(WORDS, st.lists(st.tuples(st.integers(0, 300), st.integers(0, 40), WORDS), max_size=6), st.integers(1, 30))
def test_edits(text, edits, least):
    old, TC.SEGMENT = TC.SEGMENT, least
    TC.cuts.__defaults__ = (least,)
    try:
        tree = TC.TokenTree(text)
        assert tree.tokens == fresh(text)
        for start, size, new in edits:
            start = min(start, len(text))
            text = text[:start] + new + text[start + size:]
            tree.edit(start, start + size, new)
            assert tree.text() == text and tree.root.chars == len(text)
            assert tree.tokens == fresh(text)
    finally:
        TC.SEGMENT = old
        TC.cuts.__defaults__ = (old,)


def test_an_edit_encodes_only_its_region():
    text = "some words of a line " * 5000
    tree = TC.TokenTree(text)
    tree.encoded = 0
    tree.edit(50_000, 50_010, "other")
    assert tree.encoded < 4 * TC.SEGMENT
    assert tree.tokens == fresh(text[:50_000] + "other" + text[50_010:])


def delete_repeats(text):
    seen, out = set(), []
    for line in text.split("\n"):
        if not (line.strip() and line in seen):
            out.append(line)
        seen.add(line)
    return "\n".join(out)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {r.doc_id: r for r in TC.recount(docs).collect()}
    rows = docs.collect()
    assert len(out) == len(rows)
    for r in rows:
        got = out[r.doc_id]
        assert (got.n_tokens, got.n_tokens_after) == (fresh(r.text), fresh(delete_repeats(r.text)))
    assert any(r.n_edits for r in out.values())


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "a\na\na", 0), (3, "\n\n\n", 0), (4, "x\ny\nx", 1), (4, "x\ny\nx", 1),
            (5, "line\n" * 20_000, 2)]
    out = TC.recount(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")).collect()
    got = sorted((r.doc_id or 0, r.n_edits, r.n_tokens_after) for r in out)
    assert got == sorted((i or 0, 0 if not t or not t.strip() else t.count("\n") - delete_repeats(t).count("\n"),
                          fresh(delete_repeats(t or ""))) for i, t, _ in rows)
    assert TC.recount(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_table_of_edits(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "kept")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "four"), (1, 1, 4, 7, None), (2, 1, None, None, "new text"),
                                   (None, 1, 0, 1, "x")],
                                  "doc_id long, seq long, start long, end long, replacement string")
    got = {r.doc_id: (r.n_tokens, r.n_edits, r.n_tokens_after) for r in TC.recount_edits(docs, edits).collect()}
    assert got == {1: (fresh("one two three"), 2, fresh("four  three")), 2: (0, 1, fresh("new text"))}


def test_many_edits_at_one_place_keep_the_tree_flat(spark):
    rng = random.Random(9)
    tree, text = TC.TokenTree("start of a text " * 40), "start of a text " * 40
    for i in range(1500):
        new = rng.choice(["a ", "bc def ", "x", " "]) * rng.randint(1, 3)
        at = 20 if i % 10 else rng.randint(0, len(text))
        end = at + (rng.randint(0, 60) if i % 7 == 0 else 0)
        tree.edit(at, end, new)
        text = text[:at] + new + text[end:]

    def depth():
        deepest, todo = 0, [(tree.root, 0)]
        while todo:
            n, d = todo.pop()
            deepest = max(deepest, d)
            if n.text is None:
                todo += [(n.left, d + 1), (n.right, d + 1)]
        return deepest
    assert tree.text() == text and depth() <= TC._deepest(tree.root.leaves)
    assert tree.tokens == TC.TokenTree(text).tokens
    docs = spark.createDataFrame([(1, "some words ")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, i, 5, 5, f"w{i} ") for i in range(1200)],
                                  "doc_id long, seq long, start long, end long, replacement string")
    r = TC.recount_edits(docs, edits).first()
    whole = "some " + "".join(f"w{i} " for i in reversed(range(1200))) + "words "
    assert (r.n_edits, r.n_tokens_after, r.n_chars) == (1200, TC.TokenTree(whole).tokens, 11)
