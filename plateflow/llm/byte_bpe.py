"""Byte-level BPE: texts to token ids by the merge ranks of a vocabulary file, and back to bytes.

The method: bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton over all tokens
gives the longest token that starts at each byte.  A piece of text is encoded from left to right: take
the longest token whose end isn't known to fail and that is compatible with the token before it; where
none is left, mark the place as failed and step back.  Two adjacent tokens are compatible if merging
their bytes alone gives these two tokens; the test replays the merges of both and is memoised.  A sequence in which all neighbours
are compatible is what the merges give for the whole piece, and there is only one.  Each place is
entered once and left by a bounded number of tokens, so time is linear in the piece's length, whatever
its length is.

Merging follows the ranks: of all adjacent pairs whose bytes together are a token, the least rank
merges first, of equal ones the leftmost.  A piece that is itself a token is that token.  Pieces are
the matches of a pattern.  The library ``regex`` may know newer Unicode characters than tiktoken does;
those that tiktoken doesn't take for letters or numbers are taken out of the two classes.

Distribution.  Each text is a row's own work: one scan, no shuffle.  The vocabulary, below
``VOCABULARY_BYTES``, is broadcast; a task builds its automaton once.  Memos have a fixed number of
entries and are emptied when full.  Batches are handed on in slices of a few hundred rows.

Defined results: a null or empty text has no tokens.  Special tokens are ordinary text.  Repeated rows
stay.  An empty table gives an empty result.  Result columns whose names clash get a leading underscore.
"""

from __future__ import annotations

import base64
import struct
import sys
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plateflow.llm.common import fresh_names

# A vocabulary of this size at most is sent to all executors.
VOCABULARY_BYTES = 64 << 20
MEMO_PIECES = 1 << 19
MEMO_PAIRS = 1 << 20
# Longer pieces aren't memoised.
MEMO_LENGTH = 64
SLICE_ROWS = 256
NEVER = float("inf")


class Vocabulary(NamedTuple):
    """A file of ranks, the pattern of pieces, and characters outside the classes of the pattern."""

    ranks: bytes
    pattern: str
    unknown: str


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        ranks = file.read(VOCABULARY_BYTES + 1)
    if len(ranks) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    return Vocabulary(ranks, pattern, "".join(_unknown(r"\p{L}") + _unknown(r"\p{N}")))


def _unknown(kind: str) -> list[str]:
    """Characters of a class that tiktoken's tables don't have in it."""
    import tiktoken

    probe = tiktoken.Encoding(
        "probe", pat_str=kind, mergeable_ranks={bytes([k]): k for k in range(256)}, special_tokens={}
    )
    every = "".join(chr(k) for k in range(sys.maxunicode + 1) if not 0xD800 <= k < 0xE000)
    known = set(probe.decode(probe.encode_ordinary(every)))
    return [char for char in regex.findall(kind, every) if char not in known]


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def _without(pattern: str, unknown: str) -> str:
    """The pattern with the unknown characters taken out of its letters and numbers."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, unknown)):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    out = "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in spans)
    for kind in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(kind, f"[{kind}--[{out}]]")
    return f"(?V1){pattern}"


class _Pieces(dict):
    """Packed ids by piece, made when first asked for."""

    def __init__(self, encode: Callable[[bytes], list[int]]) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self._encode(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, unknown: str = "") -> None:
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._lengths = {rank: len(token) for token, rank in ranks.items()}
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self._automaton.make_automaton()
        self._shorter: dict[int, int | None] = {}
        self._fits: dict[tuple[int | None, int], bool] = {}
        self._histories: dict[int, list[tuple[float, bytes, bytes]] | None] = {}
        self._split = regex.compile(pattern).findall
        self._unknown = frozenset(unknown)
        self._careful = regex.compile(_without(pattern, unknown)).findall if unknown else self._split
        self._packed = _Pieces(self.encode_piece)

    def pieces(self, text: str) -> list[str]:
        plain = text.isascii() or self._unknown.isdisjoint(text)
        return self._split(text) if plain else self._careful(text)

    def pack(self, text: str | None) -> bytes:
        """Token ids of a text as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self._packed.__getitem__, self.pieces(text))) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.pack(text), "<u4").tolist()

    def decode(self, packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", "<u4").tolist()
        return b"".join(map(self._bytes.__getitem__, ids))

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, known = len(piece), self._lengths, self._fits
        longest = [0] * size
        for end, (before, rank) in self._automaton.iter(piece.decode("latin-1")):
            longest[end - before] = rank
        open_ends = bytearray(b"\1") * (size + 1)
        tokens: list[int | None] = [None]
        at, token = 0, longest[0]
        while at < size:
            end = at + lengths[token]
            fits = False
            if open_ends[end]:
                pair = (tokens[-1], token)
                fits = known[pair] if pair in known else self._compatible(pair)
            if fits:
                tokens.append(token)
                at = end
                token = longest[at] if at < size else token
            elif (shorter := self._longest_start(token)) is not None:
                token = shorter
            else:
                open_ends[at] = 0
                token = tokens.pop()
                at -= lengths[token]
        return tokens[1:]

    def _longest_start(self, token: int) -> int | None:
        """The longest other token that the token starts with."""
        if token not in self._shorter:
            own = self._bytes[token]
            starts = (self._ranks.get(own[:length]) for length in range(len(own) - 1, 0, -1))
            self._shorter[token] = next((rank for rank in starts if rank is not None), None)
        return self._shorter[token]

    def _compatible(self, pair: tuple[int | None, int]) -> bool:
        """Whether merging gives just these neighbours; a first token must come out of its own bytes."""
        left, right = pair
        fits = self._history(right) is not None if left is None else self._merge_apart(left, right)
        if len(self._fits) >= MEMO_PAIRS:
            self._fits.clear()
        self._fits[pair] = fits
        return fits

    def _merge_apart(self, left: int, right: int) -> bool:
        """Replay the merges of both tokens in the order of ranks; none may join their edges first."""
        lefts, rights = self._history(left), self._history(right)
        if lefts is None or rights is None:
            return False
        last, first = self._bytes[left][-1:], self._bytes[right][:1]
        done_left = done_right = 0
        while True:
            across = self._ranks.get(last + first, NEVER)
            next_left = lefts[done_left][0] if done_left < len(lefts) else NEVER
            next_right = rights[done_right][0] if done_right < len(rights) else NEVER
            if across < next_left and across <= next_right and across != NEVER:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                last = lefts[done_left][2]
                done_left += 1
            else:
                first = rights[done_right][1]
                done_right += 1

    def _history(self, token: int) -> list[tuple[float, bytes, bytes]] | None:
        """Rank, first part and last part of each merge of a token's bytes; None if they give others."""
        if token not in self._histories:
            steps: list[tuple[float, bytes, bytes]] = []
            whole = self.merge(self._bytes[token], steps) == [token]
            self._histories[token] = steps if whole else None
        return self._histories[token]

    def merge(self, piece: bytes, steps: list | None = None) -> list[int]:
        """The merges one by one, for the bytes of a token; notes each as ``_history`` has it."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        joined = [self._ranks.get(piece[k : k + 2], NEVER) for k in range(len(piece) - 1)]
        while joined and (least := min(joined)) != NEVER:
            at = joined.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = self._ranks.get(parts[at - 1] + parts[at], NEVER)
            if at < len(joined):
                joined[at] = self._ranks.get(parts[at] + parts[at + 1], NEVER)
            if steps is not None:
                steps.append((least, parts[0], parts[-1]))
        return [self._ranks[part] for part in parts]


def _coded_batches(
    batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, method: str, source: str, target: str
) -> Iterator[pa.RecordBatch]:
    ranks, pattern, unknown = vocabulary.value
    work = getattr(ByteBpe(parse_ranks(ranks), pattern, unknown), method)
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(start, SLICE_ROWS)
            made = pa.array([work(value.as_py()) for value in rows.column(source)], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, made], [*rows.schema.names, target])


def _with_coded(df: DataFrame, vocabulary: Vocabulary, method: str, source: str, target: str) -> DataFrame:
    # The class of a value that is broadcast must be known to executors, so a plain tuple is sent.
    sent = df.sparkSession.sparkContext.broadcast(tuple(vocabulary))
    target = fresh_names(df, target)[0]
    schema = T.StructType([*df.schema.fields, T.StructField(target, T.BinaryType())])
    work = partial(_coded_batches, vocabulary=sent, method=method, source=source, target=target)
    return df.mapInArrow(work, schema)


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """All columns, and ``token_ids``: the text's ids as little-endian unsigned 32-bit numbers, packed."""
    return _with_coded(docs, vocabulary, "pack", text, "token_ids")


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, token_ids: str = "token_ids") -> DataFrame:
    """All columns, and ``decoded``: the bytes of the packed ids' tokens."""
    return _with_coded(encoded, vocabulary, "decode", token_ids, "decoded")
