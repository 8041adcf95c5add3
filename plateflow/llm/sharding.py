"""Shards by jump consistent hashing.

The method (Lamping and Veach, 2014): a key and a shard count alone decide the shard, without a ring
table.  A pseudo-random sequence seeded by the key gives the shard counts at which the key moves; the
last one below the current count is its shard.  One more shard takes a 1 / (n + 1) share of the keys,
all into itself, and no other key moves.  The law is thus ``key``: shards are even in expectation.

The hash runs in a vectorised function on keys only.  Slots number the rows of a shard without a gap
and without gathering a shard in one task: rows are ordered within ``shard x part`` cells, parts being
hash ranges of the row, and each cell starts where the counts of the earlier ones end.  The counts
have at most ``shards * parts`` rows, so they are broadcast.

Defined results: a null key is a key like any other.  A null text has no bytes, so its size is 1 and
its checksum that of the empty text.  Rows with the same key share a shard and get slots of their own.
An empty table gives an empty result.  Other columns are kept by ``assign_shards``; those called like a
result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import fresh_names, other_columns

SHARDS = 16
PARTS = 256

_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0 to ``shards - 1``, of each 64-bit key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        shard[active] = jump[active]
        state[active] = state[active] * _MULTIPLIER + np.uint64(1)
        step = ((state[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[active] = ((shard[active] + 1) * (2.0**31 / step)).astype(np.int64)
        active = active[jump[active] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key column of any type."""

    @F.pandas_udf("int")
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return jump(F.xxhash64(key))


def assign_shards(
    docs: DataFrame, key: str, shards: int = SHARDS, parts: int = PARTS, names=("shard", "slot")
) -> DataFrame:
    """The rows with their shard and their slot in it, in columns called ``names``.

    Cells are ordered by key and then by a digest of the row; rows equal in all columns are alike, so
    any order of theirs is the same.
    """
    shard, slot = names
    part, digest, start = fresh_names(docs, "shard_part", "shard_digest", "shard_start")
    kept = other_columns(docs, shard, slot)
    placed = docs.select(
        *kept, shard_of(F.col(key), shards).alias(shard), F.xxhash64(*docs.columns).alias(digest)
    ).withColumn(part, F.pmod(F.xxhash64(key, digest), F.lit(parts)).cast("int"))
    cells = placed.groupBy(shard, part).agg(F.count("*").alias(start))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        shard, part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start)
    )
    within = Window.partitionBy(shard, part).orderBy(key, digest)
    return (
        placed.withColumn(slot, (F.row_number().over(within) - 1).cast("long"))
        .join(F.broadcast(starts), [shard, part])
        .withColumn(slot, F.col(slot) + F.col(start))
        .select(*kept, shard, slot)
    )


def shard_manifest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Size, checksum, shard and slot of each document, without its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return assign_shards(sized, "doc_id", shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
