import zlib
from collections import Counter, defaultdict

import numpy as np

from plateflow.llm.sharding import assign_shards, jump_hash, shard_manifest


def plain_jump(key, shards):
    state, shard, jump = key % 2**64, -1, 0
    while jump < shards:
        shard = jump
        state = (state * 2862933555777941757 + 1) % 2**64
        jump = int((shard + 1) * (2.0**31 / ((state >> 33) + 1)))
    return shard


def test_jump_hash_matches_the_plain_loop():
    keys = np.array([0, 1, -1, 2**62, -(2**63), *range(100, 400)], np.int64)
    for shards in (1, 2, 16, 17, 1000):
        assert jump_hash(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_one_more_shard_takes_only_into_itself():
    keys = np.arange(20_000) * 7919
    before, after = jump_hash(keys, 16), jump_hash(keys, 17)
    moved = before != after
    assert set(after[moved]) == {16}
    assert abs(moved.mean() - 1 / 17) < 0.01


def test_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    slots = defaultdict(list)
    for row in shard_manifest(docs).collect():
        text = texts.pop(row.doc_id)
        assert row["size"] == len(text) + 1 and row.text_crc32 == zlib.crc32(text) and row.law == "key"
        assert row.grown_shard in (row.shard, 16)
        slots[row.shard].append(row.slot)
    assert not texts
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_odd_documents(odd_docs, clashing_docs, no_docs):
    rows = shard_manifest(odd_docs).collect()
    assert Counter(str(r.doc_id) for r in rows)["2"] == 2
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(1, 0)}
    placed = assign_shards(clashing_docs, "doc_id")
    assert sorted(placed.columns) == sorted(clashing_docs.columns)
    assert len({(r.shard, r.slot) for r in placed.collect()}) == odd_docs.count()
    assert shard_manifest(no_docs).count() == 0
