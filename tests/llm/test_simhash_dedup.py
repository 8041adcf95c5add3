import random

import numpy as np
import pytest
import xxhash

from plateflow.llm import simhash_dedup as s


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(values, ids):
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, value in enumerate(values):
        for j in range(k):
            if bin(value ^ values[j]).count("1") <= 3:
                a, b = find(k), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for k, own in enumerate(ids):
        groups.setdefault(find(k), []).append(own)
    return {own: min(group) for group in groups.values() for own in group}


def test_same_as_comparing_all(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    values = [plain_fingerprint(r.text) for r in rows]
    want = plain_components(values, [r.doc_id for r in rows])
    got = s.near_duplicate_groups(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {r.doc_id: v for r, v in zip(rows, values)}


def near_values(count, seed, bits=3):
    """Clusters of values around a few centres, and chains between them."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    values = set()
    while len(values) < count:
        value = rnd.choice(centres)
        for _ in range(rnd.randint(0, bits)):
            value ^= 1 << rnd.randrange(64)
        values.add(value)
    return sorted(values)


def test_index_finds_all_pairs():
    values = np.array(near_values(700, 1, 5), np.uint64)
    ordered = values[np.argsort(s.gray_rank(values))]
    left, right = s.GrayIndex(ordered).links()
    got = {(int(a), int(b)) for a, b in zip(left, right) if a != b}
    differ = np.bitwise_count(ordered[:, None] ^ ordered[None, :])
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(differ <= 3)) if a < b}
    assert got == want


def test_gray_neighbours_differ_in_one_bit():
    values = np.arange(1 << 10, dtype=np.uint64)
    ordered = values[np.argsort(s.gray_rank(values))]
    assert (np.bitwise_count(ordered[1:] ^ ordered[:-1]) == 1).all()


@pytest.mark.parametrize("dense", [4096, 40])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, dense):
    """Also where buckets are dealt out again because they are dense."""
    monkeypatch.setattr(s, "DENSE", dense)
    values = near_values(500, 2, 4)
    frame = spark.createDataFrame([(s._signed(v),) for v in values], "fp long")
    want = plain_components(values, values)
    groups = {}
    for row in s.fingerprint_groups(frame).collect():
        groups.setdefault(row.root, set()).add(row.fp % 2**64)
    linked = {}
    for value, name in want.items():
        linked.setdefault(name, set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in linked.values() if len(g) > 1)


def test_odd_documents(odd_docs, clashing_docs, no_docs):
    rows = s.near_duplicate_groups(odd_docs).collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row.doc_id, set()).add((row.fingerprint, row.component_id))
    assert len(rows) == odd_docs.count()
    assert by_id[1] == {(next(iter(by_id[2]))[0], 1)} == by_id[2] and by_id[3] == by_id[4] == {("0" * 16, 3)}
    assert {name for _, name in by_id[None]} == {1, None}
    kept = s.keep_one(clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(["1", "3", "None", "5", "7"] + ["6"] * (6 in ids))
    assert s.near_duplicate_groups(no_docs).count() == 0 == s.keep_one(no_docs).count()
