"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by an item when it has at least ``THRESHOLD`` of the item's different
five-word shingles.  Items are short and documents long, so the Jaccard similarity says little; the
search is for containment.

The method: items are partitioned by size.  An item keeps the ``k`` shingles with the least values of
a hash, its MinHash sketch; a document is searched with all its shingles.  With threshold ``t`` an item
of ``n`` shingles may miss ``floor((1 - t) n)`` of them, so a sketch with that many and ``hits`` more
must meet ``hits`` shingles of every contaminated document: larger partitions ask for more hits, and
none of them loses a match.  Candidates are verified by exact containment of shingle strings.

Only DataFrame functions run here.  The sketches are broadcast in blocks of ``BLOCK_ROWS`` rows at
most; a larger benchmark takes several scans, each of bounded memory.  A document's different shingles
meet the sketch inside the scan's task, so only hits are shuffled, and texts are fetched again for
candidates only.  Copies of a text share its digest and are searched together; a passage in very many
documents gives one hit row per document and shingle, never pairs of documents.

Words are runs of letters, marks and digits in lower case.

Defined results: null and empty texts, and items of fewer than five words, have no shingles and match
nothing.  Rows of ``benchmark`` with the same id are one item.  A document row repeated in all columns
is reported once.  Null document ids are reported as null, and ``drop_contaminated`` works on texts, so
it treats them like others.  Empty tables give empty results.  Other columns are ignored, and kept by
``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.llm.common import fresh_names, materialise

SHINGLE = 5
THRESHOLD = 0.8
# Items with at least so many shingles must meet so many of their sketch.
HITS_BY_SIZE = ((32, 4), (16, 3), (8, 2), (0, 1))
BLOCK_ROWS = 500_000


def text_words(text: Column) -> Column:
    """Words in lower case: runs of letters, marks and digits."""
    return F.array_remove(
        F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), ""
    )


def _shingles(form: str) -> Column:
    """The different shingles of column ``words``, as ``form`` of their words makes them."""
    words = ", ".join(f"words[i + {k}]" for k in range(SHINGLE))
    return F.expr(
        f"CASE WHEN size(words) >= {SHINGLE} THEN array_distinct("
        f"transform(sequence(0, size(words) - {SHINGLE}), i -> {form.format(words)})) END"
    )


def _hashes() -> Column:
    return _shingles("xxhash64({})")


def _strings() -> Column:
    return _shingles("concat_ws(' ', {})")


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """The different shingles of each item, with the number of them."""
    split = benchmark.select("item_id", text_words(F.col("text")).alias("words"))
    shingles = split.select("item_id", F.explode(_strings()).alias("shingle")).distinct()
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    own, of = shingles.alias("own"), sizes.alias("of")
    return own.join(of, F.col("own.item_id").eqNullSafe(F.col("of.item_id"))).select(
        "own.item_id", "own.shingle", "of.n_shingles"
    )


def item_sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The sketch of each item: hashes of its shingles, and the hits that a match must reach."""
    hits = F.coalesce(*(F.when(F.col("n_shingles") >= n, F.lit(h)) for n, h in HITS_BY_SIZE))
    missing = F.floor((1 - threshold) * F.col("n_shingles") + 1e-9)
    hashed = shingles.withColumn("h", F.xxhash64(*(F.split("shingle", " ")[k] for k in range(SHINGLE))))
    sized = hashed.withColumns(
        {
            "hits": F.least(hits, F.col("n_shingles") - missing).cast("int"),
            "missing": missing.cast("int"),
        }
    )
    order = F.sort_array(F.collect_list(F.struct(F.xxhash64("h", F.lit("minhash")).alias("r"), "h")))
    sketch = sized.groupBy("item_id", "hits", "missing").agg(order.alias("ranked"))
    least = F.slice("ranked", 1, F.col("missing") + F.col("hits"))
    return sketch.select("item_id", "hits", F.explode(least).alias("x")).select(
        "item_id", "hits", F.col("x.h").alias("h")
    )


def _digest() -> list[Column]:
    """128 bits of a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("low"), text).alias("d2")]


def candidates(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Digests of texts that meet enough of an item's sketch."""
    sketches = materialise(sketches, "sketches")
    rows = sketches.count()
    blocks = max(1, -(-rows // BLOCK_ROWS))
    words = docs.select(*_digest(), text_words(F.col("text")).alias("words"))
    hashes = words.select("d1", "d2", F.explode(_hashes()).alias("h"))
    found = None
    for block in range(blocks):
        part = sketches.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        met = (
            hashes.join(F.broadcast(part), "h")
            .groupBy("d1", "d2", "item_id", "hits")
            .agg(F.count_distinct("h").alias("met"))
            .filter("met >= hits")
            .select("d1", "d2")
        )
        found = met if found is None else found.union(met)
    return found.distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared, containment)`` with the digest ``d1, d2`` of the text."""
    items = materialise(item_shingles(benchmark), "item-shingles")
    # Written, so that Spark knows their size and broadcasts them only where they are small.
    texts = materialise(candidates(docs, item_sketches(items, threshold)), "candidates")
    again = docs.select("doc_id", "text", *_digest()).join(texts, ["d1", "d2"], "left_semi")
    words = again.select("doc_id", "d1", "d2", text_words(F.col("text")).alias("words"))
    shared = (
        words.select("doc_id", "d1", "d2", F.explode(_strings()).alias("shingle"))
        .join(items, "shingle")
        .groupBy("doc_id", "d1", "d2", "item_id", "n_shingles")
        .agg(F.count_distinct("shingle").alias("n_shared"))
    )
    return shared.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).filter(
        F.col("containment") >= threshold
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents whose text matches no item, with their columns."""
    pair = fresh_names(docs, "text_digest_1", "text_digest_2")
    found = materialise(
        contaminated(docs, benchmark, threshold)
        .select(*(F.col(d).alias(name) for d, name in zip(("d1", "d2"), pair)))
        .distinct(),
        "contaminated",
    )
    keyed = docs.select("*", *(d.alias(name) for d, name in zip(_digest(), pair)))
    return keyed.join(found, pair, "left_anti").select(*docs.columns)
