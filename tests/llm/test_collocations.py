import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plateflow.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=5, min_count=100, top=2000):
    """Whole results from counters over ``(text, lang)``."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(words[k : k + size] for k in range(len(words) - size + 1))
    found = set()
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        best = []
        for phrase, a in candidates.items():
            inside = any(
                100 * b >= 100 * a and any(q[k : k + len(phrase)] == phrase for k in range(len(q) - len(phrase) + 1))
                for q, b in candidates.items()
                if len(q) > len(phrase)
            )
            if not inside:
                cuts = ((own[phrase[:k]], own[phrase[k:]], k) for k in range(1, len(phrase)))
                score, _, l, r = min((1000 * a * totals[lang] // (l * r), k, l, r) for l, r, k in cuts)
                best.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return found


def as_results(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def some_rows(seed=1, texts=300):
    rng = random.Random(seed)
    words = ["a", "b", "the", "The", "é", "x\x00y", "x\x1cy", "under score", "mill", "\x01"]
    rows = []
    for k in range(texts):
        own = [rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "; "]) for _ in range(rng.randint(0, 60))]
        rows.append(("".join(own) + rng.choice(["", "in the long run of things", "in the long run. of"]), rng.choice(["en", "en", "de", None, "", "und"])))
    return rows + [(None, "en"), ("", "fr"), ("lonely word " * 40, "fr"), (" . \n", "it")]


@pytest.mark.parametrize("min_count, longest, top", [(5, 5, 2000), (20, 3, 7), (2, 4, None)])
def test_agrees_with_brute_force(spark, min_count, longest, top):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    ours = as_results(c.collocations(docs, longest, min_count, top))
    assert ours == plain(rows, longest, min_count, top)
    assert any(row[0] == "und" for row in ours) and any("\x00" in row[2] for row in ours)


@pytest.mark.parametrize("setting", ["PAGE", "RANGE", "SHARD_BYTES", "SHARD_WORDS", "SAMPLE"])
def test_sizes_don_t_change_the_result(spark, monkeypatch, setting):
    monkeypatch.setattr(c, "PAGE", 7)
    monkeypatch.setattr(c, setting, {"PAGE": 1, "RANGE": 20, "SHARD_BYTES": 500, "SHARD_WORDS": 3, "SAMPLE": 10}[setting])
    rows = some_rows(2, 120)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert as_results(c.collocations(docs, 5, 4)) == plain(rows, 5, 4)


def test_colliding_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(c, "BUCKET_BITS", 4)
    monkeypatch.setattr(c, "BUCKETS", 16)
    monkeypatch.setattr(c, "BLOCK", 8)
    rows = some_rows(3, 120)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert as_results(c.collocations(docs, 5, 4)) == plain(rows, 5, 4)


def test_texts_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = some_rows(4, 120)
    docs = spark.createDataFrame(rows, "text string, lang string").mapInArrow(counted, "text string, lang string")
    assert as_results(c.collocations(docs, 5, 4)) == plain(rows, 5, 4)
    assert read.value == len(rows)


def test_chunks_of_several_languages_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(c, "SPLIT_BYTES", 40)
    rows = [(text, lang or "und") for text, lang in some_rows(5, 60)]
    batch = pa.RecordBatch.from_pylist([{"text": text, "lang": lang} for text, lang in rows])
    found = defaultdict(list)
    for own in c._chunk_batches(iter([batch])):
        (chunk,) = own.to_pylist()
        words = [b".", *(chunk["words"].split(b" ") if chunk["words"] else [])]
        hashes, numbers = c._chunk(chunk["hashes"], chunk["numbers"])
        assert hashes[1:].tolist() == c._word_hashes(chunk["lang"], words[1:]).tolist()
        found[chunk["lang"]] += [words[number] for number in numbers]
    expected = defaultdict(list)
    for text, lang in rows:
        split = re.sub(r"[.,;:!?\x0A-\x0D]", " . ", (text or "").translate(LOWER) + ".")
        expected[lang] += [word.encode() for word in re.findall(r"[^\x20\x09]+", split)]
    assert found == expected


def test_counters_are_sent_by_few_tasks(spark, monkeypatch):
    batch = pa.RecordBatch.from_pylist([{"text": "as we all know", "lang": "en"}])
    (row,) = [row for own in c._chunk_batches(iter([batch])) for row in own.to_pylist()]
    parallel = spark.sparkContext.defaultParallelism
    tasks, counted = spark.sparkContext.accumulator(0), c._bucket_batches

    def noted(batches, **options):
        tasks.add(1)
        return counted(batches, **options)

    monkeypatch.setattr(c, "_bucket_batches", noted)
    rows = [tuple(row[part.split()[0]] for part in c._CHUNKS.split(", "))] * 8 * parallel
    chunks = spark.createDataFrame(rows, c._CHUNKS).repartition(8 * parallel)
    found = c.bucket_bits(chunks, 1, 8 * parallel)
    assert sum(bin(own).count("1") for own in found[0]) == 4
    assert tasks.value <= 2 * parallel


def test_pages_take_few_bytes_an_entry():
    entries = [((b"%06d" % (k // 4), b"%06d" % (k % 1000)), 1 + k % 200) for k in range(2048)]
    made = c.CountTransducer.from_sorted(sorted(entries))
    assert len(made.to_bytes()) < 8 * len(entries)


@pytest.mark.parametrize("share", [0.1, 1e-9])
def test_pages_are_written_once_and_ranges_come_from_a_sample(spark, monkeypatch, share):
    written, write = [], c.materialise

    def noted(df, name, **options):
        written.append((name, "transducer" in df.columns))
        return write(df, name, **options)

    monkeypatch.setattr(c, "materialise", noted)
    for name, value in {"SPLIT_BYTES": 200, "SHARD_BYTES": 500, "PAGE": 7, "RANGE": 20, "SAMPLED_CHUNKS": 0}.items():
        monkeypatch.setattr(c, name, value)
    monkeypatch.setattr(c, "SAMPLED_SHARE", share)
    rows = some_rows(6, 120)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert as_results(c.collocations(docs, 5, 4)) == plain(rows, 5, 4)
    assert [name for name, pages in written if pages] == ["phrase-counts"]


def test_a_phrase_in_most_texts_and_a_very_long_text(spark):
    rows = [("As we all know, this holds.", "en")] * 400 + [("As we all know. " * 20_000, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    assert as_results(c.collocations(docs)) == plain(rows)


def test_other_columns_and_no_documents(spark, clashing_docs, no_docs):
    rows = [(r.text, r.lang) for r in clashing_docs.collect()]
    docs = clashing_docs.selectExpr("*", "1 AS phrase", "2 AS part", "3 AS score", "4 AS size", "5 AS longer")
    assert as_results(c.collocations(docs, 5, 3)) == plain(rows, 5, 3)
    assert c.collocations(no_docs).count() == 0


WORDS = st.lists(st.sampled_from([b"a", b"ab", b"b", b"\x01", b"z"]), min_size=1, max_size=5).map(tuple)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(WORDS, st.integers(1, 2**40)), st.lists(WORDS))
def test_transducers_keep_counts(counts, asked):
    made = c.CountTransducer.from_sorted(sorted(counts.items()))
    again = c.CountTransducer.from_bytes(made.to_bytes())
    assert list(again.entries()) == sorted(counts.items())
    assert len(set(made.states[:-1])) == len(made.states) - 1
    for parts in (asked, sorted(asked)):
        assert list(again.compose(parts)) == [(part, counts.get(part, 0)) for part in parts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(WORDS, st.integers(1, 9)), max_size=5), st.integers(1, 6))
def test_unions_add_up(shards, least):
    total = Counter()
    for shard in shards:
        total.update(shard)
    made = [c.CountTransducer.from_sorted(sorted(shard.items())) for shard in shards]
    assert list(c.union(made, least)) == sorted((w, n) for w, n in total.items() if n >= least)
