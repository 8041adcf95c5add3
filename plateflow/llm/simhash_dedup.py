"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints of 64 bits link at ``MAX_BITS`` or fewer differing bits; linked documents form groups.
The method, after the HA-Index (Tang et al., EDBT 2015): fingerprints are sorted by Gray rank, so that
neighbours differ in few bits; leaves hold consecutive ones; a node keeps the bits on which all below
it agree, as a mask and a pattern, and upper nodes keep what their children share.  A search descends
pairs of nodes.  The bits in which two patterns differ under both masks are differences of every pair
below; once they exceed the limit, the whole pair of groups is pruned.

Distribution.  One index over all fingerprints would need each of them sent to nearly every range of
the Gray order.  Instead the 64 bits are cut into ``BLOCKS`` blocks.  Two fingerprints within
``MAX_BITS`` agree on ``BLOCKS - MAX_BITS`` blocks at least, so a bucket per choice of blocks and their
bits, 20 rows a fingerprint, brings every link into some bucket; nothing is missed.  A bucket of
more than ``LEAF`` has its own index; smaller ones, on ordinary data all of them, are compared all
against all.  Only a spanning forest of a bucket's links leaves it.

Groups of copies.  Equal fingerprints are one row from the start, pre-aggregated before the shuffle.
Many different fingerprints in one bucket are many near copies; beyond ``DENSE`` of them the bucket
isn't searched in its task: its fingerprints pass through and are dealt out again by the values near
them (``_dense_links``), work in proportion to their number, over all tasks.

Fingerprints come from a vectorised function over whole texts, one scan; after it only (id, fingerprint)
rows move.  Groups are components of the links; every round of that search is a written table.

Defined results: a null or blank text has fingerprint zero and links like any other.  With fewer words
than a shingle the whole sequence is one.  Null ids never name a group that has other ids.  Repeated
rows share a group.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import fresh_names, materialise, row_digest
from plateflow.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
BLOCKS = 6
LEAF = 32
FANOUT = 8
DENSE = 4096
CHUNK = 65536

_BITS = 64


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = list(accumulate((len(word) + 1 for word in words), initial=0))
    spans = zip(ends, (end - 1 for end in ends[width:]))
    total, counts = 0, np.zeros(_BITS, np.int64)
    while part := [digest(joined[a:b], 42) for a, b in islice(spans, CHUNK)]:
        octets = np.array(part, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [simhash(text.as_py()) for text in batch.column(batch.num_columns - 1)]
        columns = [*batch.columns[:-1], pa.array(prints, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, *keep: Column) -> DataFrame:
    """The columns ``keep`` and the fingerprint ``fp`` of each text."""
    narrow = docs.select(*keep, F.col("text").cast("string").alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]]
    return narrow.mapInArrow(_fingerprint_batches, ", ".join([*fields, "fp bigint"]))


def _block_masks(blocks: int = BLOCKS, agree: int = BLOCKS - MAX_BITS) -> list[int]:
    """Signed masks of all choices of blocks that must agree."""
    bounds = [round(k * _BITS / blocks) for k in range(blocks + 1)]
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(bounds, bounds[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, agree)]
    return [mask - (1 << _BITS) if mask >> (_BITS - 1) else mask for mask in masks]


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each unsigned value in the order of the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over the fingerprints of one bucket."""

    def __init__(self, values: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        """``values``: unsigned fingerprints in Gray order."""
        self.values = values
        self.leaf = leaf
        self.fanout = fanout
        full = np.full(len(values), ~np.uint64(0))
        self.levels = [self._group(full, values, leaf)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._group(*self.levels[-1], fanout))

    @staticmethod
    def _group(masks, patterns, size):
        """Nodes over runs of ``size`` children: the bits known to all of them and alike."""
        starts = np.arange(0, len(masks), size)
        known = np.bitwise_and.reduceat(masks, starts)
        ones = np.bitwise_and.reduceat(patterns, starts)
        some = np.bitwise_or.reduceat(patterns, starts)
        mask = known & ~(ones ^ some)
        return mask, ones & mask

    def links(self, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pairs of fingerprints within ``max_bits``."""
        left = right = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            masks, patterns = self.levels[level]
            differ = (patterns[left] ^ patterns[right]) & masks[left] & masks[right]
            near = np.bitwise_count(differ) <= max_bits
            left, right = left[near], right[near]
            size = self.fanout if level else self.leaf
            count = len(self.levels[level - 1][0]) if level else len(self.values)
            left, right = self._children(left, right, size, count)
        near = np.bitwise_count(self.values[left] ^ self.values[right]) <= max_bits
        return left[near], right[near]

    @staticmethod
    def _children(left, right, size, count):
        """All pairs of children of the paired nodes, each once."""
        steps = np.arange(size)
        a = (left[:, None, None] * size + steps[:, None] + 0 * steps[None, :]).ravel()
        b = (right[:, None, None] * size + 0 * steps[:, None] + steps[None, :]).ravel()
        valid = (a <= b) & (b < count) & (a < count)
        return a[valid], b[valid]


def _forest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked value with the least value of its component within the bucket."""
    label = np.arange(len(values))
    while True:
        least = label.copy()
        np.minimum.at(least, left, label[right])
        np.minimum.at(least, right, label[left])
        least = least[least]
        if np.array_equal(least, label):
            break
        label = least
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _bucket_links(table, values: np.ndarray):
    """Rows ``(choice, a, b)`` of one sorted bucket; ``b`` is null where it is too dense."""
    if len(values) > DENSE:
        return [(table, values, None)]
    order = np.argsort(gray_rank(values), kind="stable")
    ordered = values[order]
    a, b = _forest(ordered, *GrayIndex(ordered).links())
    return [(table, a, b)] if len(a) else []


def _search_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link the fingerprints of each bucket; rows come sorted by bucket, a bucket may span batches."""
    held: list[np.ndarray] = []

    def out(rows) -> Iterator[pa.RecordBatch]:
        for table, a, b in rows:
            size = len(a)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, table, np.int32)),
                    pa.array(a.view(np.int64)),
                    pa.nulls(size, pa.int64()) if b is None else pa.array(b.view(np.int64)),
                ],
                ["choice", "a", "b"],
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack(
            [
                batch.column("choice").to_numpy().astype(np.int64),
                batch.column("bits").to_numpy(),
                batch.column("fp").to_numpy(),
            ]
        )
        held.append(rows)
        if (rows[-1, :2] == held[0][0, :2]).all():
            continue
        joined = np.concatenate(held)
        cuts = np.flatnonzero((joined[1:, :2] != joined[:-1, :2]).any(axis=1)) + 1
        yield from out(_closed(joined[: cuts[-1]], cuts[:-1]))
        held = [joined[cuts[-1] :]]
    if held:
        joined = np.concatenate(held)
        cuts = np.flatnonzero((joined[1:, :2] != joined[:-1, :2]).any(axis=1)) + 1
        yield from out(_closed(joined, cuts))


def _closed(rows: np.ndarray, cuts: np.ndarray) -> list:
    """Links of whole buckets, which begin at 0 and at the cuts."""
    if not len(rows):
        return []
    starts = np.concatenate(([0], cuts))
    sizes = np.diff(np.concatenate((starts, [len(rows)])))
    values = rows[:, 2].astype(np.int64).view(np.uint64)
    found = []
    # Buckets of at most a leaf need no upper nodes: all of them are compared at once, by distance.
    small = sizes <= LEAF
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, min(LEAF, int(sizes.max()))):
        same = (bucket[step:] == bucket[:-step]) & small[bucket[step:]]
        near = same & (np.bitwise_count(values[step:] ^ values[:-step]) <= MAX_BITS)
        at = np.flatnonzero(near)
        if len(at):
            found.append((0, values[at], values[at + step]))
    for k in np.flatnonzero(~small):
        start = starts[k]
        found.extend(_bucket_links(rows[start, 0], values[start : start + sizes[k]]))
    return found


def _dense_links(dense: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links within dense buckets, with work in proportion to their fingerprints.

    Two fingerprints differ in three bits at most where some value is one flip from the one and two
    flips from the other, or nearer.  So each fingerprint is dealt to all values within one flip of it,
    where the least stays, and to all within two flips, where it links with the one that stayed.  Every
    such link is a real one, and all that stay at a value are linked with each other.
    """
    low, high = max_bits // 2, max_bits - max_bits // 2
    flips = {
        radius: [0, *(sum(bits) for k in range(1, radius + 1) for bits in combinations(_ONES, k))]
        for radius in (low, high)
    }

    def balls(radius: int) -> DataFrame:
        near = F.array(*(F.lit(_signed(flip)) for flip in flips[radius]))
        return dense.select("a", F.explode(near).alias("flip")).select(
            "a", F.col("a").bitwiseXOR(F.col("flip")).alias("value")
        )

    stays = balls(low).groupBy("value").agg(F.min("a").alias("b"))
    return balls(high).join(stays, "value").filter("a != b").select("a", "b").distinct()


_ONES = [1 << k for k in range(_BITS)]


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all different fingerprints of ``prints (fp)`` within the limit."""
    masks = F.array(
        *(
            F.struct(F.lit(k).alias("choice"), F.lit(mask).alias("mask"))
            for k, mask in enumerate(_block_masks())
        )
    )
    buckets = prints.select("fp", F.inline(masks)).select(
        "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp"
    )
    searched = materialise(
        buckets.repartition("choice", "bits")
        .sortWithinPartitions("choice", "bits")
        .mapInArrow(_search_buckets, "choice int, a bigint, b bigint"),
        "simhash-links",
    )
    sparse = searched.filter("b IS NOT NULL").select("a", "b")
    dense = searched.filter("b IS NULL").select("a").distinct()
    return sparse.union(_dense_links(dense))


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """``(fp, root)``: the least linked fingerprint of each one that has links."""
    return connected_components(fingerprint_links(prints)).toDF("fp", "root")


def near_duplicate_groups(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Id, fingerprint in hexadecimal and group of each document; a group is named by its least id."""
    prints = materialise(fingerprints(docs, F.col(id_column).alias("id")), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    named = _named_groups(distinct, "least")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("name").alias("component_id"),
    )


def _named_groups(distinct: DataFrame, least: str) -> DataFrame:
    """``(fp, name)``: the least value of column ``least`` over the group of each fingerprint."""
    distinct = materialise(distinct, "simhash-distinct")
    roots = fingerprint_groups(distinct.select("fp"))
    rooted = distinct.join(roots, "fp", "left").withColumn(
        "root", F.coalesce(F.col("root"), F.col("fp"))
    )
    names = rooted.groupBy("root").agg(F.min(least).alias("name"))
    return rooted.join(names, "root").select("fp", "name")


def keep_one(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One document of each group, the one with the least id, then the least digest of its row.

    Null ids come last.  Rows that are alike in all columns stay once.
    """
    digest, number = fresh_names(docs, "row_digest", "row_number")
    keyed = docs.withColumn(digest, row_digest(docs))
    rank = F.struct(F.col(id_column).isNull(), F.col(id_column), F.col(digest).alias("digest"))
    prints = materialise(fingerprints(keyed, rank.alias("rank")), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("rank").alias("least"))
    kept = _named_groups(distinct, "least").select(F.col("name.digest").alias(digest)).distinct()
    alike = Window.partitionBy(digest).orderBy(F.lit(1))
    return (
        keyed.join(kept, digest, "left_semi")
        .withColumn(number, F.row_number().over(alike))
        .filter(F.col(number) == 1)
        .select(*docs.columns)
    )
