import re

from hypothesis import given
from hypothesis import strategies as st

from plateflow.llm.substring_dedup import LONG_WORD, remove_repeats, repeated_spans, units_of

PASSAGE = (
    "The council met on the first day of spring. It spoke at length about the bridge over the river!"
    " Nobody agreed on the colour of the rails. In the end they were painted green?"
)


def test_passage_in_the_middle_of_lines(spark):
    docs = [
        (1, "Own beginning one. " + PASSAGE + " Own end one."),
        (2, "Quite another start. " + PASSAGE.upper() + "\nAnd another end."),
        (3, "Clean text. It is short. It is short."),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    (row,) = repeated_spans(frame).collect()
    assert (row.doc_id, row.first_doc_id) == (2, 1)
    assert docs[1][1][row.start : row.end].strip() == PASSAGE.upper()
    cleaned = {r.doc_id: r for r in remove_repeats(frame).collect()}
    assert cleaned[1].text == docs[0][1] and cleaned[3].text == docs[2][1]
    assert cleaned[2].text == docs[1][1][: row.start] + docs[1][1][row.end :]
    assert [(x.start, x.end) for x in cleaned[2].removed_spans] == [(row.start, row.end)]


def test_passage_in_the_middle_of_a_sentence(spark):
    """Found from its first long word on, and up to its last one."""
    own = [f"so they said {n} things about" for n in ("three", "eleven", "twenty")]
    middle = "administration of the countryside was a considerable undertaking for all of them"
    long = " ".join(f"{middle} in year {k}" for k in range(5))
    docs = [(k, f"{text} {long} and then they went home {k} times") for k, text in enumerate(own)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = repeated_spans(frame).collect()
    assert sorted((r.doc_id, r.first_doc_id) for r in rows) == [(1, 0), (2, 0)]
    assert all(docs[r.doc_id][1][r.start : r.end].strip() in long and r.n_words > 50 for r in rows)


@given(st.text(alphabet="ab .!?\n_,é" + "internationally"))
def test_units_follow_the_stated_pattern(text):
    """The same units as one regular expression cuts."""
    pattern = rf"[^.!?\n]*?[^\W_]{{{LONG_WORD},}}[.!?\n]*|[^.!?\n]*[.!?\n]+|[^.!?\n]+"
    want = [
        (m.start(), m.end(), words)
        for m in re.finditer(pattern, text)
        if (words := re.findall(r"[^\W_]+", m[0]))
    ]
    assert list(units_of(text)) == want


def test_short_repeats_stay(spark):
    frame = spark.createDataFrame([(k, "All rights reserved. Page top.") for k in range(5)], "doc_id long, text string")
    assert repeated_spans(frame).count() == 0


def test_odd_documents(spark, odd_docs, clashing_docs, no_docs):
    # Document 1 has its sentence twice; 2 and the one without an id repeat both.
    spans = sorted((str(r.doc_id), r.n_words, r.first_doc_id) for r in repeated_spans(odd_docs).collect())
    assert spans == [("2", 28, 1), ("6", 30_000, 5), ("None", 28, 1)]
    cleaned = remove_repeats(clashing_docs)
    assert cleaned.columns == [*clashing_docs.columns, "_removed_spans"]
    texts = {str(r.doc_id): r.text for r in cleaned.collect()}
    assert cleaned.count() == odd_docs.count()
    assert texts["4"] is None and texts["3"] == "" and texts["2"].strip() == ""
    assert repeated_spans(no_docs).count() == 0 == remove_repeats(no_docs).count()
