import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from plateflow.llm import byte_bpe as b
from plateflow.llm.queries import op11_byte_bpe

VOCABULARY = b.read_vocabulary(
    public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
)
RANKS = b.parse_ranks(VOCABULARY.ranks)
CODEC = b.ByteBpe(RANKS, VOCABULARY.pattern, VOCABULARY.unknown)
REFERENCE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_same_ids_as_the_library(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(np.array(ids, "<u4").tobytes()) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "th", " ", "  ", "\n", "é", "9", "'s", "'", "日本", "\x85", "\U00011de0", "\U000323b0", "a"])))
def test_same_pieces_as_the_library(parts):
    text = "".join(parts)
    assert CODEC.encode(text) == REFERENCE.encode_ordinary(text)


@pytest.mark.parametrize("seed", range(30))
def test_any_ranks_give_what_merging_gives(seed):
    """Invented ranks, in which some tokens can't come out of their own bytes."""
    rng = random.Random(seed)
    words = {bytes([k]) for k in range(256)}
    extra = {bytes(rng.choices(b"abc", k=rng.randint(2, 6))) for _ in range(40)}
    ranks = {token: rank for rank, token in enumerate([*sorted(words), *rng.sample(sorted(extra), len(extra))])}
    codec = b.ByteBpe(ranks, "[a-z]+")
    for _ in range(200):
        piece = bytes(rng.choices(b"abc", k=rng.randint(1, 30)))
        whole = ranks.get(piece)
        assert codec.encode_piece(piece) == ([whole] if whole is not None else codec.merge(piece))


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_000, " " * 30_000, "日本語" * 10_000, "thethe" * 10_000])
def test_long_pieces(text):
    assert CODEC.encode(text) == REFERENCE.encode_ordinary(text)


def test_full_memos_are_emptied(monkeypatch):
    monkeypatch.setattr(b, "MEMO_PIECES", 3)
    monkeypatch.setattr(b, "MEMO_PAIRS", 3)
    text = "Wherever memos overflow, nothing of the outcome changes: whereverflow."
    codec = b.ByteBpe(RANKS, VOCABULARY.pattern, VOCABULARY.unknown)
    assert [codec.encode(text) for _ in range(2)] == [REFERENCE.encode_ordinary(text)] * 2


def test_a_large_vocabulary_is_refused(monkeypatch, tmp_path):
    monkeypatch.setattr(b, "VOCABULARY_BYTES", 10)
    (tmp_path / "ranks").write_bytes(b"YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError):
        b.read_vocabulary(str(tmp_path / "ranks"), "[a-z]+")


def test_odd_documents(spark, clashing_docs):
    docs = clashing_docs.selectExpr("*", "1 AS token_ids", "2 AS decoded")
    encoded = b.encode_texts(docs, VOCABULARY)
    rows = b.decode_ids(encoded, VOCABULARY, "_token_ids").collect()
    assert len(rows) == docs.count() and {(r.token_ids, r.decoded) for r in rows} == {(1, 2)}
    for r in rows:
        assert bytes(r._decoded) == (r.text or "").encode()
        assert np.frombuffer(r._token_ids, "<u4").tolist() == REFERENCE.encode_ordinary(r.text or "")
    assert b.encode_texts(docs.filter("false"), VOCABULARY).count() == 0


def test_query_agrees_with_the_library_on_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_byte_bpe(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = REFERENCE.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
