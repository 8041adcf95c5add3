r"""Conversations as training texts.

The method: a message is a list of typed parts: text, image, audio and document.  A visitor flattens
them in order: texts are escaped, other parts become numbered placeholders, and the visitor records an
attachment (kind, number, reference, tokens) for each and counts the tokens that placeholders expand to.

A turn is written as ``<turn role>``, a line feed, the content, a line feed, ``</turn>`` and a line feed.
In texts and roles a backslash precedes each backslash and each ``<`` (in roles also ``>``), so a marker
is the only place with a bare ``<``: whatever a text says, reading back gives the same turns.  The loss mask of a turn is
the span of an assistant's content in it.

Distribution.  A turn is formatted on its own.  The turns of a conversation are brought together in
order by one shuffle and a spilling sort, and are read as a stream: digests are updated turn by turn,
so no conversation is ever held whole, however many of the rows it has.

Defined results: null texts and roles are empty.  Turns with the same number are ordered by role and
written text, null numbers come first.  Null conversation ids are one conversation.  Repeated rows are turns.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
CLOSE = "\n</turn>\n"
# Tokens a placeholder expands to where its part doesn't say.
DEFAULT_TOKENS = {"image": 256, "audio": 128, "document": 512}

ESCAPED = r"\\\g<0>"
_SPECIAL = re.compile(r"[\\<]")
_SPECIAL_IN_ROLE = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\([\\<>])")
_TURN = re.compile(r"<turn ((?:[^\\<>]+|\\.)*)>\n((?:[^\\<]+|\\.|<(?!/turn>))*)\n</turn>\n")


def escape(text: str) -> str:
    return _SPECIAL.sub(ESCAPED, text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class FlatContent:
    """What a visitor made of a message's parts."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    n_tokens: int = 0


class PartVisitor:
    """Flattens parts, dictionaries with ``type`` and ``text`` or ``ref`` and optional ``tokens``."""

    def __init__(self) -> None:
        self.content = FlatContent()

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown part type: {kind}")
        method(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.content.pieces.append(escape(text))
        self.content.n_tokens += len(text.split())

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def _attach(self, kind: str, part: dict) -> None:
        number = len(self.content.attachments) + 1
        tokens = part.get("tokens")
        tokens = DEFAULT_TOKENS[kind] if tokens is None else int(tokens)
        self.content.pieces.append(f"<{kind} {number}>")
        self.content.attachments.append(
            {"kind": kind, "number": number, "ref": part.get("ref") or "", "tokens": tokens}
        )
        self.content.n_tokens += tokens


def flatten(parts: list[dict] | None) -> FlatContent:
    visitor = PartVisitor()
    for part in parts or []:
        visitor.visit(part)
    return visitor.content


def format_turn(role: str | None, content: FlatContent) -> tuple[str, int, int]:
    """The written turn, and the span of its content."""
    head = f"<turn {_SPECIAL_IN_ROLE.sub(ESCAPED, role or '')}>\n"
    body = "".join(content.pieces)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_turn(written: str) -> tuple[str, str]:
    """Role and content of a written turn, unescaped; placeholders stay as they are."""
    match = _TURN.fullmatch(written)
    if match is None:
        raise ValueError("not a written turn")
    return unescape(match[1]), unescape(match[2])


_ATTACHMENTS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("number", pa.int32()), ("ref", pa.string()), ("tokens", pa.int64())]
    )
)
_FORMATTED = (
    "conv_id bigint, turn bigint, role string, written string, loss_start int, loss_end int,"
    " attachments array<struct<kind:string,number:int,ref:string,tokens:bigint>>, n_tokens bigint"
)
_PART = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, parts = batch.column("role").to_pylist(), batch.column("parts").to_pylist()
        written, starts, ends, attachments, tokens = [], [], [], [], []
        for role, own in zip(roles, parts):
            content = flatten(own)
            text, start, end = format_turn(role, content)
            loss = role == LOSS_ROLE
            written.append(text)
            starts.append(start if loss else None)
            ends.append(end if loss else None)
            attachments.append(content.attachments)
            tokens.append(content.n_tokens)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                batch.column("role"),
                pa.array(written, pa.string()),
                pa.array(starts, pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array(attachments, _ATTACHMENTS),
                pa.array(tokens, pa.int64()),
            ],
            ["conv_id", "turn", "role", "written", "loss_start", "loss_end", "attachments", "n_tokens"],
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """One written turn per row of ``turns (conv_id, turn, role, text)``.

    A column ``parts`` of typed parts, where there is one, is used instead of ``text``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    alone = F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("long").alias("tokens"),
        )
    ).cast(_PART)
    parts = F.coalesce(F.col("parts").cast(_PART), alone) if "parts" in turns.columns else alone
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        parts.alias("parts"),
    ).mapInArrow(_format_batches, _FORMATTED)


_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)


class _Reading:
    """Digests of one conversation, read turn by turn."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, written: str, start: int | None, end: int | None) -> None:
        role, text = read_turn(written)
        self.n_turns += 1
        self.chars += len(written)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            masked = unescape(written[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    reading = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows), kinds)
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in columns], names)

    for batch in batches:
        done = []
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "written", "loss_start", "loss_end"))
        for conv_id, written, start, end in zip(*columns):
            if reading is None or reading.conv_id != conv_id:
                if reading is not None:
                    done.append(reading.row())
                reading = _Reading(conv_id)
            reading.add(written, start, end)
        if done:
            yield out(done)
    if reading is not None:
        yield out([reading.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation of what ``format_turns`` wrote, read from its output."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "written")
    return ordered.select("conv_id", "written", "loss_start", "loss_end").mapInArrow(
        _read_batches, _DIGESTS
    )
