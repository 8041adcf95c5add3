"""Repeated passages by hashing text units.

The method: texts are cut into units: at ends of lines and sentences, and after each word of
``LONG_WORD`` letters or more, so that a passage put into the middle of a sentence is cut alike from its
first long word on.  Units are normalised to their words in lower case and hashed to 128 bits; digests
are grouped over the corpus; the occurrence of the
lowest rank, which is the order of document ids and of places in a text, is kept and the others are
removed, with their offsets in the original text.  A chance repeat of a short unit is no passage: of
consecutive repeated units, a run is removed only if it has ``MIN_WORDS`` words or more.

Distribution.  Two passes over the texts give (digest, place) rows, and texts never move.  The first
counts digests, pre-aggregated, so a line in a third of all documents is a few partial counts.  The
second joins places with the digests that occur twice, a join that adaptive execution splits where one
digest is hot; unique units, nearly all, end there.  Runs are windows over the repeated units of one
document.

Defined results: null texts, and units without words, have no unit.  Null ids rank last and are told
apart by their texts.  A document row repeated in all columns is one document.  Offsets count code
points, ends are exclusive.  An empty table gives an empty result.  Other columns are ignored by
``repeated_spans`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import fresh_names, materialise

MIN_WORDS = 25

LONG_WORD = 10

_TOKEN = re.compile(r"[^\W_]+|[.!?\n]+")
_SCHEMA = "doc_id bigint, t bigint, unit int, start int, end int, words int, d1 bigint, d2 bigint"


def units_of(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each unit with words.

    Together with the stretches between that have no word, units tile the text: a unit begins where
    the last one ended, and full stops right after a long word are its unit's.
    """
    start, end, words, closed = 0, 0, [], False
    for token in _TOKEN.finditer(text):
        stop = token[0][0] in ".!?\n"
        if closed and not (stop and token.start() == end):
            yield start, end, words
            start, words, closed = end, [], False
        end = token.end()
        if closed:
            continue
        if stop:
            if words:
                closed = True
            else:
                start = end
        else:
            words.append(token[0])
            closed = len(token[0]) >= LONG_WORD
    if words:
        yield start, end if closed else len(text), words


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_intdigest
    names = [field.split()[0] for field in _SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64()]
    for batch in batches:
        ids, keys, texts = (batch.column(k).to_pylist() for k in range(3))
        rows: list[tuple] = []
        for doc, key, text in zip(ids, keys, texts):
            for number, (start, end, words) in enumerate(units_of(text or "")):
                value = digest(" ".join(words).lower().encode("utf-8", "surrogatepass"))
                high = (value >> 64) - ((value >> 127) << 64)
                low = (value & (1 << 64) - 1) - ((value >> 63 & 1) << 64)
                rows.append((doc, key, number, start, end, len(words), high, low))
            if len(rows) > 20_000:
                yield _batch(rows, names, kinds)
                rows = []
        if rows:
            yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def text_units(docs: DataFrame) -> DataFrame:
    """The units with words of each document: number, span, words and digest."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("t"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(_unit_batches, _SCHEMA)


def _rank(doc_id: str = "doc_id", t: str = "t", start: str = "start") -> Column:
    return F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(t), F.col(start))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed run of units, with the document that keeps its first unit.

    Columns: doc_id, start, end, n_units, n_words, first_doc_id, first_start, and ``t``, a digest of
    the text.
    """
    units = text_units(docs)
    twice = materialise(
        units.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").select("d1", "d2"),
        "unit-digests",
    )
    places = materialise(units.join(twice, ["d1", "d2"]), "unit-places")
    # Written, so that the join below sees two plain inputs and can be split at a hot unit.
    firsts = materialise(
        places.groupBy("d1", "d2").agg(F.min(_rank()).alias("first")), "unit-firsts"
    )
    later = places.join(firsts, ["d1", "d2"]).filter(_rank() > F.col("first"))
    of_doc = Window.partitionBy("doc_id", "t").orderBy("unit")
    # Nothing between a join and its next shuffle may need the join's grouping, or a hot unit can't be
    # split.  So repeated rows of a document stay; they share ranks, and sums are divided by their number.
    runs = later.withColumn("run", F.col("unit") - F.dense_rank().over(of_doc))
    n_units = F.max("unit") - F.min("unit") + 1
    return (
        runs.groupBy("doc_id", "t", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            n_units.cast("int").alias("n_units"),
            (F.sum("words") * n_units / F.count("*")).cast("int").alias("n_words"),
            F.min_by("first", "unit").alias("first"),
        )
        .filter(F.col("n_words") >= min_words)
        .select(
            "doc_id", "start", "end", "n_units", "n_words",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.start").alias("first_start"),
            "t",
        )
    )


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their removed runs, and column ``removed_spans`` with the offsets."""
    doc, t, cuts, removed = fresh_names(docs, "cut_doc", "cut_text", "cuts", "removed_spans")
    spans = (
        repeated_spans(docs, min_words)
        .groupBy(F.col("doc_id").alias(doc), F.col("t").alias(t))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts))
    )
    same = F.xxhash64(docs["text"]) == F.col(t)
    joined = docs.join(spans, same & docs["doc_id"].cast("long").eqNullSafe(F.col(doc)), "left")
    found = F.coalesce(F.col(cuts), F.array().cast("array<struct<start:int,end:int>>"))
    edges = F.concat(
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))),
        found,
        F.array(F.struct(F.length("text").alias("start"), F.length("text").alias("end"))),
    )
    kept = F.transform(
        F.sequence(F.lit(1), F.size(found) + 1),
        lambda k: F.substring(
            F.col("text"),
            F.get(edges, k - 1)["end"] + 1,
            F.get(edges, k)["start"] - F.get(edges, k - 1)["end"],
        ),
    )
    text = F.when(F.size(found) == 0, F.col("text")).otherwise(F.array_join(kept, ""))
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    return joined.select(*columns, found.alias(removed))
