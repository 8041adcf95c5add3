import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from plateflow.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string"


@given(st.text(), st.text(alphabet=r"<>\/turn imagedocu1" + "\n"))
def test_reading_back_gives_the_turn(role, text):
    written, start, end = c.format_turn(role, c.flatten([{"type": "text", "text": text}]))
    assert c.read_turn(written) == (role, text)
    assert c.unescape(written[start:end]) == text


def test_parts_become_placeholders():
    content = c.flatten(
        [
            {"type": "text", "text": "see <image 1> and"},
            {"type": "image", "ref": "s3://a.png", "tokens": 10},
            {"type": "audio", "ref": None},
            {"type": "document", "ref": "b.pdf"},
            {"text": None},
        ]
    )
    assert "".join(content.pieces) == r"see \<image 1> and<image 1><audio 2><document 3>"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in content.attachments] == [
        ("image", "s3://a.png", 10),
        ("audio", "", 128),
        ("document", "b.pdf", 512),
    ]
    assert content.n_tokens == 4 + 10 + 128 + 512
    with pytest.raises(ValueError):
        c.flatten([{"type": "video"}])


def test_typed_parts_of_a_table(spark):
    rows = [(1, 0, "user", None, [("text", "hi", None, None), ("image", None, "u", None)]), (1, 1, "assistant", "ok", None)]
    turns = spark.createDataFrame(
        rows, SCHEMA + ", parts array<struct<type:string,text:string,ref:string,tokens:long>>"
    )
    first, second = sorted(c.format_turns(turns).collect(), key=lambda r: r.turn)
    assert first.written == "<turn user>\nhi<image 1>\n</turn>\n" and first.loss_start is None
    assert first.attachments[0].ref == "u" and first.n_tokens == 257
    assert second.written[second.loss_start : second.loss_end] == "ok"


def test_odd_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"),
        (1, 0, None, None),
        (1, 1, "assistant", "a"),
        (1, 1, "assistant", "a"),
        (None, None, "user", "x" * 200_000),
        (2, 0, "assistant", ""),
    ]
    turns = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in c.read_back(c.format_turns(turns.selectExpr("*", "1 AS written", "2 AS parts2"))).collect()}
    digest = hashlib.sha256
    assert got[1].n_turns == 4 and got[1].loss_chars == 3
    assert got[1].loss_sha256 == digest(b"aab").hexdigest()
    assert got[1].turns_sha256 == digest(b"\n\nassistant\na\nassistant\na\nassistant\nb\n").hexdigest()
    assert got[None].n_turns == 1 and got[2].loss_sha256 == digest(b"").hexdigest()
    assert c.read_back(c.format_turns(turns.filter("false"))).count() == 0
