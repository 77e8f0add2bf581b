"""Chat formatting with typed content parts (operator 7).

A turn's content is a list of typed parts: text, image, audio and document.
A visitor walks the parts in order and flattens them: texts are escaped, the
others become numbered placeholders, and each leaves a reference (kind,
number within the conversation's turn, address) and the tokens that it will
expand to. Turns are marked as

    <|im_start|>ROLE\\nCONTENT<|im_end|>\\n

Control strings (of this template and of other common ones) never occur in
formatted texts: a backslash goes behind the first character of each, and
one more where backslashes already stand there, so undoing is exact. In roles,
backslashes and line feeds are escaped too, as a line feed ends the role.

Turns are formatted one by one wherever they lie; a conversation's turns then
come together in order in sorted partitions that are read as a stream, so a
conversation of any length needs one turn's memory.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: control strings of this template and of other common ones ---
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<|image|>", "<|audio|>", "<|document|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# -------------------------------------------------------------------------------

_TAILS = "|".join(sorted({re.escape(c[1:]) for c in CONTROL if c[0] == "<"}, key=len, reverse=True))
_BRACKETS = "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == "[")
_PLAIN = re.compile(rf"<(?=\\*(?:{_TAILS}))|\[(?=\\*(?:{_BRACKETS}))")
_ESCAPED = re.compile(rf"<\\(?=\\*(?:{_TAILS}))|\[\\(?=\\*(?:{_BRACKETS}))")


def escape(text: str) -> str:
    """``text`` without a control string; :func:`unescape` gives it back."""
    return _PLAIN.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0], text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Expansion:
    """How many tokens a placeholder stands for."""

    image_tile: int = 512
    tokens_per_tile: int = 170
    image_base: int = 85
    audio_tokens_per_second: int = 25
    tokens_per_page: int = 700

    def image(self, part: dict) -> int:
        tiles = (math.ceil(max(1, part.get("width") or 1) / self.image_tile)
                 * math.ceil(max(1, part.get("height") or 1) / self.image_tile))
        return self.image_base + self.tokens_per_tile * tiles

    def audio(self, part: dict) -> int:
        return math.ceil(max(0.0, part.get("seconds") or 0.0) * self.audio_tokens_per_second)

    def document(self, part: dict) -> int:
        return self.tokens_per_page * max(1, part.get("pages") or 1)


@dataclass
class Flattener:
    """The visitor: a method for each kind of part, called in order."""

    expansion: Expansion = field(default_factory=Expansion)
    pieces: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)  # not escaped yet: a control string may go on in the next part
    references: list[dict] = field(default_factory=list)
    seen: dict[str, int] = field(default_factory=dict)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.expansion.image(part))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.expansion.audio(part))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.expansion.document(part))

    def visit_unknown(self, part: dict) -> None:
        """A kind that isn't known stays readable, as text."""
        self.text.append(json.dumps(part, sort_keys=True, ensure_ascii=False, default=str))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = self.seen[kind] = self.seen.get(kind, 0) + 1
        self._close_text()
        self.pieces.append(PLACEHOLDER[kind])
        self.references.append({"kind": kind, "number": number, "ref": part.get("ref"), "tokens": tokens})

    def _close_text(self) -> None:
        self.pieces.append(escape("".join(self.text)))
        self.text = []

    def content(self) -> str:
        self._close_text()
        return "".join(self.pieces)


def flatten(parts: list[dict], expansion: Expansion | None = None) -> tuple[str, list[dict]]:
    """Content and references of a turn's parts."""
    visitor = Flattener(expansion or Expansion())
    for part in parts:
        visitor.visit(part)
    return visitor.content(), visitor.references


def format_turn(role: str, content: str) -> tuple[str, int]:
    """The marked turn and where its content begins in it."""
    head = OPEN + escape_role(role) + "\n"
    return head + content + CLOSE + "\n", len(head)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and content (still escaped) of one marked turn."""
    if not formatted.startswith(OPEN) or not formatted.endswith(CLOSE + "\n"):
        raise ValueError("not a formatted turn")
    role, _, content = formatted[len(OPEN):-len(CLOSE) - 1].partition("\n")
    return unescape_role(role), content


_REFERENCES = "array<struct<kind:string,number:int,ref:string,tokens:long>>"
TURN_SCHEMA = ("conv_id long, turn long, formatted string, loss_start int, loss_length int, "
               f"tokens_expanded long, attachments {_REFERENCES}, tie long")
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int32()),
    ("loss_length", pa.int32()), ("tokens_expanded", pa.int64()),
    ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("number", pa.int32()), ("ref", pa.string()),
                                        ("tokens", pa.int64())]))), ("tie", pa.int64())])


def _format(parts: str | None, expansion: Expansion, loss_roles: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                own = [{"type": "text", "text": r["text"]}] if r["text"] is not None or not parts else []
                content, references = flatten(own + list(r[parts] or [] if parts else []), expansion)
                role = r["role"] or ""
                formatted, start = format_turn(role, content)
                rows.append({"conv_id": r["conv_id"], "turn": r["turn"], "formatted": formatted,
                             "loss_start": start, "loss_length": len(content) if role in loss_roles else 0,
                             "tokens_expanded": sum(x["tokens"] for x in references), "attachments": references,
                             "tie": r["tie"]})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
    return run


def format_turns(turns: DataFrame, parts: str | None = None, expansion: Expansion | None = None,
                 loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The formatted turn of every row, with its loss mask (a range of characters) and its attachments.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``; ``parts``
    names a column of further typed parts (array of structs with ``type``,
    ``ref`` and what the kinds need). Other columns are left out. Null texts,
    roles and lists are empty.
    """
    tie = F.xxhash64("role", "text")
    cols = ["conv_id", "turn", "role", "text", *([parts] if parts else [])]
    return turns.select(*cols, tie.alias("tie")).mapInArrow(
        _format(parts, expansion or Expansion(), loss_roles), TURN_SCHEMA)


def in_order(formatted: DataFrame) -> DataFrame:
    """Conversations together, their turns in order: by turn (nulls first), then by a hash of role and text."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie")


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, tokens_expanded long")


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.chars, self.tokens = conv_id, 0, 0, 0, 0
        self.all, self.assistant = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss_start: int, loss_length: int, tokens: int) -> None:
        """What a reader of the formatted turn and its loss mask sees."""
        role, content = parse_turn(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.tokens += tokens
        self.all.update(f"{role}\n{unescape(content)}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(formatted[loss_start:loss_start + loss_length])
        self.loss += len(learned)
        self.assistant.update(learned.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.assistant.hexdigest(), self.chars,
                self.tokens)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    types = [pa.string() if n.endswith("256") else pa.int64() for n in names]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    now, done = None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist()
                for c in ("conv_id", "formatted", "loss_start", "loss_length", "tokens_expanded")]
        for conv_id, *turn in zip(*cols, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv_id)
            now.add(*turn)
        if len(done) >= 5000:
            yield out(done)
            done = []
    if now is not None:
        yield out([*done, now.row()])


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted turns: counts and digests of turns and of the text under the loss mask.

    Turns without a conv_id are one conversation without an id.
    """
    cols = ("conv_id", "turn", "tie", "formatted", "loss_start", "loss_length", "tokens_expanded")
    return in_order(formatted.select(*cols)).mapInArrow(_digest, _DIGEST)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, and conversation -7, whose texts are another template's control strings."""
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversation_digest(format_turns(turns.unionByName(extra)))


def _sql() -> str:
    tails = [f"<(\\\\*)({_TAILS})", f"\\[(\\\\*)({_BRACKETS})"]
    escaped = "text"
    for first, pattern in zip("<[", tails, strict=True):
        escaped = f"regexp_replace({escaped}, '{pattern}', '{first}\\\\\\1\\2', 'g')"
    marks = len(OPEN) + 1 + len(CLOSE) + 1
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({marks} + length(role) + length({escaped})) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS tokens_expanded
FROM t GROUP BY conv_id
"""


SQL = _sql()
