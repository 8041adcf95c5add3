from collections import Counter

import corpus_pipeline
from plateflow.llm import decontamination, quality_rules, simhash_dedup


def test_each_stage_keeps_what_its_operator_says(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in quality_rules.quality_verdicts(docs, "doc_id").filter("kept").collect()}
    left = docs.filter(docs.doc_id.isin(*good))
    groups = simhash_dedup.near_duplicate_groups(left).collect()
    first = {r.component_id for r in groups}
    left = left.filter(left.doc_id.isin(*first))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = {r.doc_id for r in decontamination.contaminated(left, items).collect()}
    rows = corpus_pipeline.run(spark, sf_dir)
    assert set(rows.columns) == {*docs.columns, "shard", "slot"}
    found = Counter(r.doc_id for r in rows.collect())
    assert set(found) == first - leaked and max(found.values()) <= 2


def test_odd_documents_pass_all_stages(spark, sf_dir, clashing_docs):
    docs = clashing_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == clashing_docs.columns
    assert {str(r.doc_id) for r in docs.collect()} <= {"1", "5", "6", "None"}


def test_no_documents(spark, sf_dir, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
