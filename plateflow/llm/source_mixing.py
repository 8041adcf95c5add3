"""Mixing sources to target weights.

The method: a source with token share ``p`` gets a weight in proportion to ``p ** alpha``.  At
``alpha = 1`` sources keep their shares, at 0 all weigh the same.  ``alpha`` is bisected: to the
largest value whose weights reach a target entropy, or to the smallest that repeats no source more
often than a limit allows.  Normalised weights times the token budget are the tokens of each source.

They are realised as block permutations.  A pass over a source deals its documents into blocks by a
seeded hash, about as many blocks as documents in a block, and orders each block's documents by it.  Whole passes come first,
each with a seed of its own; the last pass stops with the document that reaches the budget.  Only the
block that the budget ends in needs a running sum over its documents.

Only DataFrame functions run here.  Sources are first summed to one row each and written to the shared
folder; every bisection step is one aggregate over these rows and brings one number to the driver.
Running sums go over the block sums of a source and over the documents of a block, never over the
documents of a source, so a source with a third of the corpus is spread over its blocks.

Without ``budget_tokens`` the budget is the least that passes over each source at least once, so no
document is left out.

Defined results: null and empty sources are one source.  A document's tokens are its words, at least
one, so documents without text take part.  Repeated rows are dealt like others.  An empty table gives
an empty result.  Other columns are kept by ``mix``; those called like a
result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import SPACES, fresh_names, materialise, other_columns, row_digest

MAX_REPEATS = 2.0
STEPS = 40
SEED = 7


def token_count(text: Column) -> Column:
    """Words of a text, at least one: runs of other characters between spaces."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.greatest(F.size(F.split(inner, r"[\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def source_tokens(docs: DataFrame, source: str, tokens: str) -> DataFrame:
    """Documents, tokens and token share of each source."""
    sums = materialise(
        docs.groupBy(F.col(source).alias("source")).agg(
            F.count("*").alias("docs"), F.sum(tokens).alias("tokens")
        ),
        "mix-sources",
    )
    total = _value(sums, F.sum("tokens"))
    return sums.withColumn("share", F.col("tokens") / F.lit(total))


def _value(stats: DataFrame, aggregate: Column):
    """One number over all sources; null without sources."""
    return stats.agg(aggregate.alias("value")).first()["value"]


def _bisect(stats: DataFrame, fits: Column) -> float:
    """The largest exponent in [0, 1] at which ``fits``, an aggregate over ``power``, is true.

    ``fits`` must be true at 0 or nowhere; then 0 is the answer.
    """

    def holds(alpha: float) -> bool:
        return bool(_value(stats.withColumn("power", F.pow("share", F.lit(alpha))), fits))

    if holds(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def entropy_exponent(stats: DataFrame, target: float) -> float:
    """The largest exponent whose weights have an entropy of ``target`` nats or more."""
    total = F.sum("power")
    entropy = F.log(total) - F.sum(F.col("power") * F.log("power")) / total
    return _bisect(stats, entropy >= target)


def repetition_exponent(stats: DataFrame, max_repeats: float, budget: int | None) -> float:
    """The smallest exponent at which no source repeats more than ``max_repeats`` times.

    Repeats of a source are ``budget * weight / tokens``; without a budget, those in relation to the
    least repeated source.  They fall as the exponent grows.
    """
    rate = F.col("power") / F.col("tokens")
    if budget is None:
        most = F.max(rate) / F.min(rate)
    else:
        most = F.max(rate) / F.sum("power") * budget
    low = _bisect(stats, most > max_repeats)
    return min(1.0, low + 2.0**-STEPS)


def mixture(
    stats: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget_tokens: int | None = None,
) -> DataFrame:
    """``stats`` with the weight and the token target of each source."""
    if target_entropy is not None:
        alpha = entropy_exponent(stats, target_entropy)
    else:
        alpha = repetition_exponent(stats, max_repeats, budget_tokens)
    powers = stats.withColumn("power", F.pow("share", F.lit(alpha)))
    total = _value(powers, F.sum("power"))
    weights = powers.withColumn("weight", F.col("power") / F.lit(total).cast("double"))
    if budget_tokens is None:
        rate = F.col("weight") / F.col("tokens")
        least = _value(weights, F.min(rate))
        target = F.col("tokens") * (rate / F.lit(least).cast("double"))
    else:
        target = F.col("weight") * budget_tokens
    return weights.select(
        "source", "docs", "tokens", "share", "weight", F.round(target).cast("long").alias("target")
    ).withColumn("alpha", F.lit(alpha))


def mix(
    docs: DataFrame,
    source: str = "source",
    tokens: Column | None = None,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget_tokens: int | None = None,
    seed: int = SEED,
    names: tuple[str, str, str, str] = ("pass_no", "block", "n_tokens", "weight"),
) -> DataFrame:
    """The mixed rows: each document once per pass that takes it, with the columns ``names``.

    Texts don't move: a document's passes follow from its hash, its block's place and, in the block
    where the budget ends, its place there; these are joined to the row by a digest.
    """
    pass_no, block, n_tokens, weight = names
    (digest,) = fresh_names(docs, "mix_digest")
    counted = tokens if tokens is not None else token_count(F.col("text"))
    keyed = docs.withColumn(digest, row_digest(docs))
    small = materialise(
        keyed.select(
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
            F.col(digest).alias("digest"),
            counted.alias("tokens"),
        )
        .groupBy("source", "digest", "tokens")
        .agg(F.count("*").alias("copies")),
        "mix-tokens",
    )
    rows = small.withColumn("tokens_all", F.col("tokens") * F.col("copies"))
    stats = source_tokens(rows, "source", "tokens_all")
    plan = materialise(
        mixture(stats, max_repeats, target_entropy, budget_tokens)
        .withColumn("blocks", F.ceil(F.sqrt("docs")))
        .withColumn("full_passes", F.floor(F.col("target") / F.col("tokens"))),
        "mix-plan",
    )
    at, in_block, counted, share = fresh_names(keyed, "mix_pass", "mix_block", "mix_tokens", "mix_share")
    taken = _taken(rows, plan, seed).toDF(digest, at, in_block, counted, share)
    return keyed.join(taken, digest).select(
        *other_columns(docs, *names),
        F.col(at).alias(pass_no),
        F.col(in_block).alias(block),
        F.col(counted).alias(n_tokens),
        F.col(share).alias(weight),
    )


def _taken(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Digest, pass and block of each document and pass in the mix.

    The last pass of a source is cut: blocks before its end are taken whole, and of the block with the
    end all documents up to the one that reaches the target.
    """
    planned = rows.join(
        plan.select(
            "source", "blocks", "full_passes", F.col("weight").alias("share_of_mix"),
            (F.col("target") - F.col("full_passes") * F.col("tokens")).alias("rest"),
        ),
        "source",
    )
    passes = F.sequence(F.lit(0).cast("long"), F.col("full_passes"))
    dealt = planned.withColumn("at", F.explode(passes)).withColumn(
        "place", F.xxhash64("digest", "at", F.lit(seed))
    ).withColumn("in_block", F.pmod("place", "blocks"))
    whole = dealt.filter(F.col("at") < F.col("full_passes"))
    last = dealt.filter((F.col("at") == F.col("full_passes")) & (F.col("rest") > 0))
    sums = last.groupBy("source", "in_block").agg(F.sum("tokens_all").alias("block_tokens"))
    before = (
        Window.partitionBy("source").orderBy("in_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sums.select(
        "source", "in_block", F.coalesce(F.sum("block_tokens").over(before), F.lit(0)).alias("start")
    )
    earlier = (
        Window.partitionBy("source", "in_block")
        .orderBy("place", "digest", "tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = (
        last.join(starts, ["source", "in_block"])
        .filter(F.col("start") < F.col("rest"))
        .withColumn("upto", F.col("start") + F.coalesce(F.sum("tokens_all").over(earlier), F.lit(0)))
        .filter(F.col("upto") < F.col("rest"))
    )
    columns = ["digest", "at", "in_block", "tokens", "share_of_mix"]
    return whole.select(*columns).unionByName(reached.select(*columns))
