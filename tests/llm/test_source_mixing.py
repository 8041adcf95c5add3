import math
from collections import Counter, defaultdict

import pytest

from plateflow.llm import source_mixing as m


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(k, "a " * 10, "big") for k in range(600)]
    rows += [(1000 + k, "b " * (5 + k % 7), "small") for k in range(60)]
    rows += [(2000 + k, "c " * 20, "tiny") for k in range(10)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def tokens_by_source(rows):
    sums = Counter()
    for row in rows:
        sums[row.source] += row.n_tokens
    return sums


def test_repetition_limit(sources):
    """No source repeats more than twice, none is left out, and each ends within a document."""
    have = {"big": 6000, "small": sum(5 + k % 7 for k in range(60)), "tiny": 200}
    rows = m.mix(sources, max_repeats=2.0).collect()
    got = tokens_by_source(rows)
    stats = m.source_tokens(
        sources.withColumn("w", m.token_count(sources["text"])), "source", "w"
    )
    targets = {r.source: r.target for r in m.mixture(stats, 2.0).collect()}
    assert all(targets[s] <= got[s] < targets[s] + 20 for s in have)
    assert max(targets[s] / have[s] for s in have) == pytest.approx(2.0, abs=0.01)
    assert targets["big"] == have["big"]
    assert {r.doc_id for r in rows} == {r.doc_id for r in sources.collect()}


def test_passes_are_permutations_in_blocks(sources):
    passes = defaultdict(Counter)
    for row in m.mix(sources, max_repeats=4.0).collect():
        passes[row.source, row.pass_no][row.doc_id] += 1
    assert all(set(own.values()) == {1} for own in passes.values())
    assert len(passes["tiny", 0]) == 10


def test_target_entropy(sources):
    stats = m.source_tokens(sources.withColumn("w", m.token_count(sources["text"])), "source", "w")
    weights = [r.weight for r in m.mixture(stats, target_entropy=0.9).collect()]
    assert sum(weights) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(0.9, abs=1e-6)


def test_token_budget(sources):
    got = tokens_by_source(m.mix(sources, max_repeats=3.0, budget_tokens=4000).collect())
    assert 4000 <= sum(got.values()) <= 4000 + 45


def test_same_mix_whatever_the_partitions(sources):
    def key(frame):
        return sorted((r.doc_id, r.pass_no, r.block) for r in m.mix(frame).collect())

    assert key(sources) == key(sources.repartition(13))


def test_odd_documents(odd_docs, clashing_docs, no_docs):
    rows = m.mix(odd_docs).collect()
    assert Counter(str(r.doc_id) for r in rows)["2"] % 2 == 0
    assert {str(r.doc_id) for r in rows} == {str(r.doc_id) for r in odd_docs.collect()}
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {1}
    mixed = m.mix(clashing_docs)
    assert sorted(mixed.columns) == sorted(clashing_docs.columns)
    assert mixed.count() > 0
    assert m.mix(no_docs).count() == 0
