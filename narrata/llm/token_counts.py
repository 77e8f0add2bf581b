"""Edit-aware token counts: a segment tree of pre-tokens per document (operator 4).

A text is cut where a white-space character follows another character: no
piece of the tokenizer's splitting pattern reaches over such a place, and the
pieces on one side don't depend on the other side. Segments of a few hundred
characters between such places are the leaves of a binary tree whose nodes
hold sums of characters and tokens. An edit is found by the character sums;
only the segments it touches, with the neighbours whose border it may have
undone, are encoded again, and the sums on the way up are updated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm import bpe
from narrata.llm.batches import map_texts, row_chunks

#: Least characters of a segment.
SEGMENT = 256
Edit = tuple[int, int, str]


def cuts(text: str, least: int = SEGMENT) -> list[int]:
    """Borders of the segments of a text, from 0 to its length."""
    out, at = [0], least
    while at < len(text):
        if text[at].isspace() and not text[at - 1].isspace() and _white(text[at]) and not _white(text[at - 1]):
            out.append(at)
            at += least
        else:
            at += 1
    return [*out, len(text)] if text else [0]


def _white(c: str) -> bool:
    """White space of the splitting pattern (not the separators U+001C to U+001F)."""
    return c.isspace() and c not in "\x1c\x1d\x1e\x1f"


class Node:
    """A leaf with its text, or two subtrees; the sums of both, and the leaves with a text."""

    __slots__ = ("left", "right", "text", "chars", "tokens", "leaves")

    def __init__(self, text: str | None, tokens: int = 0, left: Node | None = None, right: Node | None = None):
        self.text, self.left, self.right = text, left, right
        if text is None:
            self.update()
        else:
            self.chars, self.tokens, self.leaves = len(text), tokens, 1 if text else 0

    def update(self) -> None:
        self.chars = self.left.chars + self.right.chars
        self.tokens = self.left.tokens + self.right.tokens
        self.leaves = self.left.leaves + self.right.leaves


def _build(leaves: list[Node]) -> Node:
    while len(leaves) > 1:
        pairs = [Node(None, 0, *leaves[i:i + 2]) for i in range(0, len(leaves) - 1, 2)]
        leaves = pairs + leaves[2 * len(pairs):]
    return leaves[0]


def _deepest(leaves: int) -> int:
    """How far a leaf may lie below a node of so many leaves before the node is built anew."""
    return 2 * leaves.bit_length() + 2


def _rebuilt(node: Node) -> Node:
    """The node's leaves that hold a text, as a balanced tree."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if n.text is None:
            todo += [n.right, n.left]
        elif n.text:
            out.append(n)
    return _build(out or [Node("")])


class TokenTree:
    """Token count of a text that is edited; ``encoded`` counts characters that were encoded."""

    def __init__(self, text: str, encoder: bpe.PieceEncoder | None = None, counts: list[int] | None = None):
        self.encoder = encoder or bpe.encoder()
        self.encoded = 0
        self.root = _build(self._leaves(text, counts))

    def _leaves(self, text: str, counts: list[int] | None = None) -> list[Node]:
        border = cuts(text)
        parts = [text[a:b] for a, b in zip(border, border[1:])] or [""]
        if counts is None:
            counts = self.encoder.encode(parts)[1].tolist()
            self.encoded += len(text)
        return [Node(p, n) for p, n in zip(parts, counts, strict=True)]

    @property
    def tokens(self) -> int:
        return self.root.tokens

    def text(self) -> str:
        out, todo = [], [self.root]
        while todo:
            n = todo.pop()
            if n.text is not None:
                out.append(n.text)
            else:
                todo += [n.right, n.left]
        return "".join(out)

    def _take(self, first: int, last: int) -> tuple[str, int]:
        """Empty the leaves that hold characters ``first`` to ``last``; their text and where it began."""
        taken: list[str] = []
        begin = [0]

        def visit(n: Node, at: int) -> None:
            if n.chars == 0 or at > last or at + n.chars <= first:
                return
            if n.text is not None:
                if not taken:
                    begin[0] = at
                taken.append(n.text)
                n.text, n.chars, n.tokens, n.leaves = "", 0, 0, 0
                return
            chars = n.left.chars
            visit(n.left, at)
            visit(n.right, at + chars)
            n.update()
        visit(self.root, 0)
        return "".join(taken), begin[0]

    def _put(self, at: int, leaves: list[Node]) -> None:
        """Insert leaves before the character ``at``, at a border of segments."""
        path, n = [], self.root
        while n.text is None:
            path.append(n)
            if at <= n.left.chars:
                n = n.left
            else:
                at -= n.left.chars
                n = n.right
        new = _build(([] if n.chars == 0 else [Node(n.text, n.tokens)] if at else []) + leaves
                     + ([Node(n.text, n.tokens)] if n.chars and not at else []))
        below, deep = n, (new.leaves - 1).bit_length()
        for above in reversed(path):
            if above.left is below:
                above.left = new
            else:
                above.right = new
            above.update()
            below, new, deep = above, above, deep + 1
            if deep > _deepest(above.leaves):  # edits at one place, or emptied leaves
                new = _rebuilt(above)
                deep = (new.leaves - 1).bit_length() if new.leaves else 0
        self.root = new

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` (exclusive); places beyond the text mean its end."""
        size = self.root.chars
        start = max(0, min(start, size))
        end = max(start, min(end, size))
        # the character before and the one behind may make or undo a border with the edit
        old, begin = self._take(max(0, start - 1), min(end, size - 1))
        changed = old[:start - begin] + new + old[end - begin:]
        if changed:
            self._put(begin, self._leaves(changed))


def repeated_line_edits(text: str) -> list[Edit]:
    """Edits that delete every line that occurred before in the text, last first."""
    seen: set[str] = set()
    out, at = [], 0
    for line in text.split("\n"):
        end = at + len(line)
        if line.strip() and line in seen:
            out.append((at - 1, end, ""))
        seen.add(line)
        at = end + 1
    return out[::-1]


RECOUNT_SCHEMA = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars long, reencoded_chars long"


def _segment_counts(enc: bpe.PieceEncoder, texts: list[str]) -> list[list[int]]:
    """Token counts of the segments of many texts, encoded together."""
    parts, many = [], []
    for t in texts:
        border = cuts(t)
        own = [t[a:b] for a, b in zip(border, border[1:])] or [""]
        parts += own
        many.append(len(own))
    counts = enc.encode(parts)[1].tolist()
    ends = np.cumsum(many).tolist()
    return [counts[e - n:e] for e, n in zip(ends, many, strict=True)]


def _recount(path: str | None, edits_of: Callable[[str], list[Edit]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        for rows in row_chunks(batches, "text"):
            texts = [t or "" for t in rows.column("text").to_pylist()]
            columns: list[list[int]] = [[] for _ in range(5)]
            for text, counts in zip(texts, _segment_counts(enc, texts), strict=True):
                edits, before = edits_of(text), sum(counts)
                after, encoded = before, 0
                if edits:
                    tree = TokenTree(text, enc, counts)
                    for e in edits:
                        tree.edit(*e)
                    after, encoded = tree.tokens, tree.encoded
                for c, v in zip(columns, (before, len(edits), after, len(text), encoded), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                             names=[c.split()[0] for c in RECOUNT_SCHEMA.split(", ")])
    return run


def recount(docs: DataFrame, edits_of: Callable[[str], list[Edit]] = repeated_line_edits,
            vocabulary: str | None = None) -> DataFrame:
    """Token counts of every document before and after the edits that a function of its text asks for.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. Each
    edit's places count in the text as the edits before have left it. Null
    texts are empty; rows stay rows, whatever their ids.
    """
    return map_texts(docs.select("doc_id", "text"), _recount(vocabulary, edits_of), RECOUNT_SCHEMA)


def _apply(path: str | None):
    def run(key, docs: pa.Table, edits: pa.Table) -> pa.Table:
        enc, rows = bpe.encoder(path), []
        order = sorted(edits.to_pylist(), key=lambda e: (e["seq"] is not None, e["seq"] or 0))
        for text in docs["text"].to_pylist():
            tree = TokenTree(text or "", enc)
            before, tree.encoded = tree.tokens, 0
            for e in order:
                tree.edit(e["start"] or 0, e["start"] or 0 if e["end"] is None else e["end"], e["replacement"] or "")
            rows.append((key[0].as_py(), before, len(order), tree.tokens, len(text or ""), tree.encoded))
        names = [c.split()[0] for c in RECOUNT_SCHEMA.split(", ")]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns, strict=True)})
    return run


def recount_edits(docs: DataFrame, edits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The same for a table of edits (doc_id, seq, start, end, replacement), applied in the order of ``seq``.

    Only documents with edits are returned (and shuffled). A null start is 0,
    a null end the start (an insertion), a null replacement a deletion.
    """
    keyed = docs.select("doc_id", "text").join(edits.select("doc_id").distinct(), "doc_id", "left_semi")
    changes = edits.select("doc_id", "seq", "start", "end", "replacement").filter(F.col("doc_id").isNotNull())
    return keyed.groupBy("doc_id").cogroup(changes.groupBy("doc_id")).applyInArrow(_apply(vocabulary), RECOUNT_SCHEMA)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents`` before and after repeated lines are deleted."""
    return recount(spark.read.parquet(f"{sf_dir}/documents.parquet"))
