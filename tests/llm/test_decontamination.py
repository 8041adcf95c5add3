import re

import pytest

from plateflow.llm.decontamination import contaminated, drop_contaminated


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_same_as_comparing_all(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = {}
    queries = {row.item_id: shingles(row.text) for row in items.collect()}
    for doc in docs.collect():
        own = shingles(doc.text)
        for item, query in queries.items():
            if query and len(own & query) / len(query) >= 0.8:
                want[doc.doc_id, item] = len(own & query)
    got = {(r.doc_id, r.item_id): r.n_shared for r in contaminated(docs, items).collect()}
    assert got == want and want


@pytest.fixture(scope="module")
def items(spark):
    item = "The river ran past the old mill and turned the wheel all day"
    rows = [(1, item), (1, item), (2, "too short item"), (3, None), (4, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_part_of_an_item(spark, items):
    """Nine shingles: eight in the document are enough, seven are not."""
    docs = [
        (1, "x THE RIVER, ran past -- the old mill and turned the wheel all"),
        (2, "ran past the old mill and turned the wheel all day"),
        (3, "river ran past the old mill and turned the wheel all"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in contaminated(frame, items).collect()} == {1}


def test_odd_documents(odd_docs, clashing_docs, items):
    found = contaminated(odd_docs, items).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "2", "None"]
    clean = drop_contaminated(clashing_docs, items)
    assert clean.columns == clashing_docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted("3 4 None 5 6 7".split())


def test_empty_tables(odd_docs, no_docs, items):
    assert contaminated(no_docs, items).count() == 0
    assert contaminated(odd_docs, items.filter("false")).count() == 0
    assert drop_contaminated(odd_docs, items.filter("false")).count() == odd_docs.count()
