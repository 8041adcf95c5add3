"""Quality rules whose thresholds adapt to each language and source.

The method: each document gets four ratios.  Every (language, source) group gets one quantile
sketch per ratio: counts by logarithmic bucket, so a quantile is right within the width of a bucket and
sketches merge by adding counts (Masson, Rim and Lee, "DDSketch", VLDB 2019).  A threshold is an outer
fence, the upper quartile plus ``fence`` times the interquartile range; there is no fixed cutoff.  A
group with fewer than ``min_docs`` documents, or with a spread below ``LEAST_SPREAD`` of its quartile,
says too little: it takes the fence of its language's merged sketch, and failing that of the corpus.
Copies of a text count once, by a hash of it, so that they don't narrow a sketch.

Documents are then joined with the thresholds of their group.  A document is rejected if a numerator
exceeds its threshold by more than ``TOLERANCE``, a few units and a small share of the denominator: one
odd character or one long link in a clean source is no outlier.

Only DataFrame functions run here.  Texts are scanned once and never shuffled: the counts are written
to the shared folder, and the sketches, pre-aggregated before their shuffle, have a bounded number of
buckets per group.  A hot source is thus a few partial sums, and its documents meet its thresholds in
a join that adaptive execution broadcasts or splits.

Defined results: a null text has no words and fails the base rules.  Null and empty languages (or
sources) are one group.  Repeated rows get one verdict each and count once in sketches.  An empty table gives an empty
result.  Other columns are ignored by ``quality_verdicts`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import SPACE_CLASS, fresh_names, materialise, space_words

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

RELATIVE_ERROR = 0.01
FENCE = 3.0
MIN_DOCS = 50
# A sketch needs this spread, as a share of its upper quartile; the corpus is given the second one at least.
LEAST_SPREAD = 0.02
CORPUS_SPREAD = 0.1
# Ratio: (numerator, denominator).
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
}
# What a document may have beyond its threshold: units, and units per unit of the denominator.
TOLERANCE = {"symbols_per_word": (3, 0.01), "word_length": (30, 0.0), "dup_lines": (2, 0.1)}
_GAMMA = (1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR)


def _window_hashes() -> Column:
    """A 64-bit hash of each window of five words, by its start."""
    words = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    return F.expr(
        f"CASE WHEN size(words) >= {WINDOW} THEN"
        f" transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({words}))"
        " ELSE array(CAST(null AS bigint)) END"
    )


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and the counts of each text, one row per document, without a shuffle.

    Windows that recur are found by sorting a document's hashes, so a long text costs n log n; texts
    without a repeated hash, most of them, skip the sort.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        *keep,
        space_words(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS[1:]}")).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    hashed = split.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes().alias("hashes"),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    recurs = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.select(
        *keep,
        *counts,
        F.when(
            recurs, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).alias("ordered"),
    )
    starts = ordered.select(
        *keep,
        *counts,
        F.expr(
            "sort_array(transform(filter(ordered, (x, k) ->"
            " x.h <=> get(ordered, k - 1).h OR x.h <=> get(ordered, k + 1).h), x -> x.i))"
        ).alias("starts"),
    )
    covered = F.expr(
        f"aggregate(transform(starts, (s, k) -> CASE WHEN k = 0 THEN {WINDOW}"
        f" ELSE least({WINDOW}, s - starts[k - 1]) END), 0, (a, x) -> a + x)"
    )
    return starts.select(
        *keep, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def _bucket(value: Column) -> Column:
    """Logarithmic bucket of a ratio; values below a millionth share the lowest one."""
    return F.ceil(F.log(F.greatest(value, F.lit(1e-6))) / math.log(_GAMMA)).cast("int")


def ratio_sketches(counts: DataFrame) -> DataFrame:
    """Bucket counts by language, source and ratio, over different texts, by ``text_hash``, that pass the base rules."""
    ratios = F.array(
        *(
            F.struct(
                F.lit(name).alias("ratio"),
                _bucket(F.col(top) / F.greatest(F.col(below), F.lit(1))).alias("bucket"),
            )
            for name, (top, below) in RATIOS.items()
        )
    )
    return (
        counts.filter(~_base_failed())
        .select("lang", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
        .distinct()
        .select("lang", "source", F.inline(ratios))
        .groupBy("lang", "source", "ratio", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketches: DataFrame, *group: str) -> DataFrame:
    """Document count and both outer quartiles of each sketch, merged up to ``group``."""
    keys = [*group, "ratio"]
    merged = sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bucket")
    ranked = merged.withColumns(
        {
            "upto": F.sum("n").over(upto),
            "docs": F.sum("n").over(Window.partitionBy(*keys)),
        }
    )
    # The upper end of the bucket, so that no document of a uniform group exceeds its quartile.
    value = F.when(F.col("bucket") <= _lowest(), 0.0).otherwise(F.pow(F.lit(_GAMMA), F.col("bucket")))

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("docs"), value))

    return ranked.groupBy(*keys).agg(
        F.first("docs").alias("docs"), quantile(0.25).alias("low"), quantile(0.75).alias("high")
    )


def _lowest() -> int:
    return math.ceil(math.log(1e-6) / math.log(_GAMMA))


def adaptive_thresholds(
    sketches: DataFrame, fence: float = FENCE, min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per language and source: a threshold ``max_<ratio>`` per ratio, and in ``from_<ratio>``
    whether the sketch of the source, the language or the corpus gave it."""
    own = _quartiles(sketches, "lang", "source")
    of_lang = _quartiles(sketches, "lang").select(
        "lang", "ratio", *(F.col(c).alias(f"lang_{c}") for c in ("docs", "low", "high"))
    )
    of_all = _quartiles(sketches).select("ratio", *(F.col(c).alias(f"all_{c}") for c in ("low", "high")))
    levels = own.join(of_lang, ["lang", "ratio"]).join(of_all, "ratio")

    def spread(level: str) -> Column:
        return F.col(f"{level}high") - F.col(f"{level}low")

    def says_enough(level: str) -> Column:
        return (F.col(f"{level}docs") >= min_docs) & (spread(level) >= LEAST_SPREAD * F.col(f"{level}high"))

    wide = F.greatest(spread("all_"), CORPUS_SPREAD * F.col("all_high"))
    limit = (
        F.when(says_enough(""), F.col("high") + fence * spread(""))
        .when(says_enough("lang_"), F.col("lang_high") + fence * spread("lang_"))
        .otherwise(F.col("all_high") + fence * wide)
    )
    origin = F.when(says_enough(""), "source").when(says_enough("lang_"), "lang").otherwise("corpus")
    return levels.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("ratio") == name, F.round(limit, 6))).alias(f"max_{name}") for name in RATIOS),
        *(F.max(F.when(F.col("ratio") == name, origin)).alias(f"from_{name}") for name in RATIOS),
    )


def quality_verdicts(
    docs: DataFrame, *keep: str, fence: float = FENCE, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Counts, thresholds and verdict of each document, with the columns ``keep``.

    ``kept`` is false where the base rules fail, else true unless a ratio is above its threshold by more
    than the tolerance.
    """
    own = [f"kept_{k}" for k in range(len(keep))]
    labels = docs.select(
        *(F.col(name).alias(alias) for name, alias in zip(keep, own)),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    counts = materialise(base_counts(labels, *own, "lang", "source", "text_hash"), "quality-counts")
    # Read back from files, so that Spark knows the size and broadcasts only a small table.
    limits = materialise(
        adaptive_thresholds(ratio_sketches(counts), fence, min_docs), "quality-limits"
    )
    within = F.lit(True)
    for name, (top, below) in RATIOS.items():
        units, share = TOLERANCE[name]
        limit = F.coalesce(F.col(f"max_{name}"), F.lit(float("inf")))
        within &= F.col(top) <= (limit + share) * F.greatest(F.col(below), F.lit(1)) + units
    judged = counts.join(limits, ["lang", "source"], "left")
    return judged.select(
        *(F.col(alias).alias(name) for name, alias in zip(keep, own)),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _base_failed().alias("base_failed"),
        (~_base_failed() & within).alias("kept"),
        *(f"max_{name}" for name in RATIOS),
        *(f"from_{name}" for name in RATIOS),
    )


def keep_good(docs: DataFrame, fence: float = FENCE, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents that pass, with their columns.

    A verdict depends on text, language and source alone, so rejected documents are taken out by a
    digest of the three, which works for null and repeated ids.
    """
    (digest,) = fresh_names(docs, "row_digest")
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text"))
    keyed = docs.withColumn(digest, F.md5(F.concat_ws("\0", *parts)))
    judged = quality_verdicts(keyed, digest, fence=fence, min_docs=min_docs)
    rejected = judged.filter("NOT kept").select(digest).distinct()
    return keyed.join(rejected, digest, "left_anti").select(*docs.columns)
