import re

import pytest

from plateflow.llm import license_scan as scan


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", "mit"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
        ("© 2020 CC BY-NC-SA 4.0", "cc-by-nc-sa"),
        ("All rights reserved", "all-rights-reserved"),
        ("The licence is admitted", ""),
        ("ich gehe mit Lizenz", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_labels(text, labels):
    assert scan.scan_text(text)[5] == labels


def test_contained_detections_are_suppressed():
    (only,) = scan.detect("licensed under the apache license version 2 0")
    assert (only.label, only.first_word, only.last_word) == ("apache-2.0", 0, 7)


def test_hundreds_of_rules():
    assert 200 <= len(scan.rules())


def test_base_columns_match_a_plain_count(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = [(900, "mit license mit license"), (901, "mit mit license\xa0"), (902, "Apache—License Apache. LICENSE")]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in scan.scan_licenses(docs).collect():
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places, labels = [], set()
        for phrase, label in scan.BASE_PHRASES.items():
            parts = phrase.split()
            for k in range(len(words)):
                if words[k : k + len(parts)] == parts:
                    places.append(k)
                    labels.add(label)
        assert row.n_words == len(words) and row.n_base == len(places)
        assert row.first_word == min(places, default=None) and row.last_word == max(places, default=None)
        assert row.base_labels == ",".join(sorted(labels))
        assert labels <= set(row.labels.split(",")) | set() and 0 <= row.score <= 1


def test_very_many_detections():
    found = scan.detect(" ".join(["mit license"] * 20_000))
    assert len(found) == 20_000


def test_odd_documents(odd_docs, clashing_docs, no_docs):
    rows = scan.scan_licenses(clashing_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.labels for r in rows if r.doc_id == 6} == {"mit"}
    assert scan.scan_licenses(no_docs).count() == 0
