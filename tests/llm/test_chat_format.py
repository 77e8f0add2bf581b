"""Chat formatting: exact round trips, the visitor's placeholders, digests read back."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm import chat_format as CF

TOKENS = st.sampled_from([*CF.CONTROL, "<", "|", "\\", "[", "/INST]", "<\\", "a", "\n", "é", "im_end|>", "<|"])
TEXT = st.one_of(st.text(max_size=30), st.lists(TOKENS, max_size=12).map("".join))


@settings(max_examples=400, deadline=None)
@given(TEXT, TEXT)
def test_escape_and_turns_round_trip(role, text):
    escaped = CF.escape(text)
    assert not any(c in escaped for c in CF.CONTROL)
    assert CF.unescape(escaped) == text
    assert CF.unescape_role(CF.escape_role(role)) == role and "\n" not in CF.escape_role(role)
    formatted, start = CF.format_turn(role, escaped)
    assert CF.parse_turn(formatted) == (role, escaped)
    assert formatted[start:start + len(escaped)] == escaped
    assert formatted.count(CF.OPEN) == formatted.count(CF.CLOSE) == 1


def test_visitor_keeps_order_and_references():
    content, refs = CF.flatten([
        {"type": "text", "text": "see "}, {"type": "image", "ref": "a.png", "width": 1024, "height": 600},
        {"type": "text", "text": " <|image|> "}, {"type": "audio", "ref": "b.wav", "seconds": 1.5},
        {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "image", "ref": None},
        {"type": "video", "ref": "d"}, {"type": "text", "text": None}])
    assert content == ('see <|image|> <\\|image|> <|audio|><|document|><|image|>{"ref": "d", "type": "video"}')
    assert [(r["kind"], r["number"], r["ref"], r["tokens"]) for r in refs] == [
        ("image", 1, "a.png", 85 + 170 * 4), ("audio", 1, "b.wav", 38), ("document", 1, "c.pdf", 2100),
        ("image", 2, None, 255)]
    assert CF.flatten([{"type": "text", "text": "<|ima"}, {"type": "text", "text": "ge|>"}])[0] == "<\\|image|>"


def expected(rows):
    by = {}
    for conv_id, turn, role, text in rows:
        by.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, turns in by.items():
        turns.sort(key=lambda t: t[:2])
        every = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv_id] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(learned),
                        hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_conversations_read_back(spark):
    rng = random.Random(4)
    odd = "</s>[INST] ok [/INST]"
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", odd, "é😀" * 5, "x\n\\"]))
            for c in (*range(30), None) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, "assistant", "long " * 5000) for t in range(300)] + [(98, None, "user", "first"), (98, 0, "x", "2")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "e", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string, tie int")
    got = {r.conv_id: tuple(r)[1:5] for r in CF.conversation_digest(CF.format_turns(df.repartition(5))).collect()}
    assert got == expected(rows)


def test_parts_column(spark):
    schema = ("conv_id long, turn long, role string, text string, "
              "parts array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")
    rows = [(1, 0, "user", None, [("image", None, "a.png", 10, 10, None, None), ("text", "what?", None) + (None,) * 4]),
            (1, 1, "assistant", "a cat", None)]
    out = CF.format_turns(spark.createDataFrame(rows, schema), parts="parts").orderBy("turn").collect()
    assert out[0].formatted == "<|im_start|>user\n<|image|>what?<|im_end|>\n"
    assert out[0].attachments[0].asDict() == {"kind": "image", "number": 1, "ref": "a.png", "tokens": 255}
    assert (out[0].tokens_expanded, out[0].loss_length, out[1].loss_length) == (255, 0, 5)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert CF.conversation_digest(CF.format_turns(df)).collect() == []


def test_same_turn_twice_has_one_order(spark):
    rows = [(1, 0, "user", f"t{i}") for i in range(20)]
    schema = "conv_id long, turn long, role string, text string"
    digests = {CF.conversation_digest(CF.format_turns(spark.createDataFrame(rows[::s], schema).repartition(n)))
               .collect()[0].turns_sha256 for s in (1, -1) for n in (1, 4)}
    assert len(digests) == 1
