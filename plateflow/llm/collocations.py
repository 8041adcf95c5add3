r"""Phrases whose words stand together more often than their frequencies explain, per language.

Texts are split into pieces and these into words; f counts a phrase's contiguous occurrences in pieces.
A candidate has 2 to ``longest`` words and f of ``min_count`` or more.  Each cut of it in two parts has
the score ``1000 a n / (l r)``, rounded down, of its own count a, its parts' l and r and the language's
words n; the least counts.  Candidates that stand inside a longer one of the same count are dropped.

The method: weighted acyclic automata.  A shard, some MB of a language, sorts its n-grams and builds a
count transducer from them in one pass: states of the path that the next n-gram leaves are closed and
looked up in a register, so equal ones are shared; arcs carry words and counts.  Transducers are sent as
compressed pages, cut at the boundaries of prefix ranges, and united range by range, a merge that sums
the weights and builds anew.  The counts of parts come from composing sorted parts with their range's
transducers, which walks shared beginnings once.

Texts are split once: a first scan writes them as numbers of words, in chunks of about a MB of a language
with their words and the words' hashes.  All later scans read these.

Which n-grams enter.  A phrase is frequent only if all its parts are.  So before the transducers one
scan for each length adds up n-grams by hash in ``BUCKETS`` counters; an n-gram enters the next scan only
if its bucket and those of both n-grams one word shorter reached ``min_count``.  A bucket holds its
n-grams' sum, so no frequent one is lost; what enters beyond these is dropped at the union, whose counts
are of the words themselves.  The number of buckets changes the cost and never the result.

Distribution.  Counters and bits have fixed size, whatever the corpus (2 MB of bits a length, the only
thing broadcast beside range boundaries).  A phrase in a third of all texts is one entry a shard.  Range
boundaries come from where pages of a sample of chunks start (at most ``SAMPLE`` of these), so a frequent
first word is cut at its second; they balance the ranges and don't change what is counted.  The sample's
pages are built for that alone; all pages go straight into the shuffle, so that they are on disk once.  Scores are
decimals of 38 digits, exact below 10^38.

Defined results: a null text has no words, a null language is ``und``.  Repeated rows count each time.
Ties in score go to the higher count, then to the phrase in byte order; of equal cuts the first counts.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from heapq import merge
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import materialise

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
NO_LANGUAGE = "und"

BUCKET_BITS = 24
BUCKETS = 1 << BUCKET_BITS
#: Buckets that travel together, so that their sums spread over many tasks.
BLOCK = 1 << 12
#: Text and different words of a shard, text that is split at a time.
SHARD_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
SPLIT_BYTES = 1 << 20
#: Text that shares one set of counters, which a scan sends once for each of its tasks.
COUNTED_BYTES = 1 << 30
#: Readers hold a row group of chunks, which have up to some MB each.
ROW_GROUPS = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "4",
}
PAGE = 1 << 11
RANGE = 1 << 17
MAX_RANGES = 10_000
SAMPLE = 50_000
#: Chunks whose pages tell the ranges: at least so many, and at least this share of all.
SAMPLED_CHUNKS = 64
SAMPLED_SHARE = 1 / 64
BOUNDARY_BYTES = 256
TOP_SALTS = 64

_MIX, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

# A to Z become small, all separators of pieces a full stop.
_TEXT_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?" or 10 <= c <= 13 else c for c in range(256)
)

Words = tuple[bytes, ...]


class CountTransducer:
    """An acyclic automaton that maps word sequences to counts.

    A state is a tuple of arcs ``(word, count, target)`` in the order of words; a count of zero is that
    of a sequence that only leads to others.  ``states`` lists each different state after its targets.
    """

    def __init__(self, states: list[tuple]) -> None:
        self.states = states

    @classmethod
    def from_sorted(cls, entries: Iterable[tuple[Words, int]]) -> CountTransducer:
        """Built from sequences in ascending order, none of them twice."""
        states: list[tuple] = []
        register: dict[tuple, int] = {}
        path: list[bytes] = []
        open_arcs: list[list] = [[]]
        counts: list[int] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                arcs = tuple(open_arcs.pop())
                target = register.setdefault(arcs, len(states))
                if target == len(states):
                    states.append(arcs)
                open_arcs[-1].append((path.pop(), counts.pop(), target))

        for words, count in entries:
            shared = 0
            while shared < len(path) and shared < len(words) and path[shared] == words[shared]:
                shared += 1
            close(shared)
            for word in words[shared:]:
                path.append(word)
                counts.append(0)
                open_arcs.append([])
            counts[-1] += count
        close(0)
        states.append(tuple(open_arcs[0]))
        return cls(states)

    def entries(self) -> Iterator[tuple[Words, int]]:
        """Sequences and counts in ascending order."""
        stack = [(iter(self.states[-1]), ())]
        while stack:
            arcs, before = stack[-1]
            arc = next(arcs, None)
            if arc is None:
                stack.pop()
                continue
            word, count, target = arc
            words = (*before, word)
            if count:
                yield words, count
            if self.states[target]:
                stack.append((iter(self.states[target]), words))

    def compose(self, parts: Iterable[Words]) -> Iterator[tuple[Words, int]]:
        """Each part with its count, 0 where there is none; a beginning shared with the part before is
        walked once."""
        done: Words = ()
        path = [(0, len(self.states) - 1)]
        for part in parts:
            shared = 0
            while shared < min(len(done), len(part), len(path) - 1) and done[shared] == part[shared]:
                shared += 1
            del path[shared + 1 :]
            for word in part[shared:]:
                arcs = self.states[path[-1][1]]
                at = bisect_left(arcs, word, key=lambda arc: arc[0])
                if at == len(arcs) or arcs[at][0] != word:
                    break
                path.append(arcs[at][1:])
            done = part
            yield part, path[-1][0] if len(path) == len(part) + 1 else 0

    def to_bytes(self) -> bytes:
        words = sorted({word for arcs in self.states for word, _, _ in arcs})
        number = {word: k for k, word in enumerate(words)}
        arcs = [arc for own in self.states for arc in own]
        columns = (
            [len(own) for own in self.states],
            [number[word] for word, _, _ in arcs],
            [at - target for at, own in enumerate(self.states) for _, _, target in own],
            [count for _, count, _ in arcs],
        )
        parts = [_narrow(values) for values in columns]
        body = b"".join(part.tobytes() for part in parts) + b" ".join(words)
        head = np.array([len(self.states), len(arcs), len(body)], "<u4").tobytes()
        return head + bytes(part.itemsize for part in parts) + _packed(body)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountTransducer:
        n_states, n_arcs, size = np.frombuffer(data, "<u4", 3).tolist()
        body = _unpacked(data[16:], size)
        columns, at = [], 0
        for width, length in zip(data[12:16], (n_states, n_arcs, n_arcs, n_arcs)):
            columns.append(np.frombuffer(body, f"<u{width}", length, at).tolist())
            at += width * length
        sizes, labels, back, counts = columns
        words = body[at:].split(b" ")
        states, first = [], 0
        for number, size in enumerate(sizes):
            last = first + size
            own = zip(labels[first:last], counts[first:last], back[first:last])
            states.append(tuple((words[label], count, number - steps) for label, count, steps in own))
            first = last
        return cls(states)


def _narrow(values: list[int]) -> np.ndarray:
    """Numbers from 0 in as few bytes each as the largest needs."""
    return np.array(values, "<u8").astype(_number_kind(max(values, default=0)))


def _packed(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True)


def union(transducers: list[CountTransducer], min_count: int = 1) -> Iterator[tuple[Words, int]]:
    """Sequences of all transducers with summed counts, in ascending order."""
    for words, same in groupby(merge(*(t.entries() for t in transducers)), key=lambda entry: entry[0]):
        total = sum(count for _, count in same)
        if total >= min_count:
            yield words, total


class _Numbers(dict):
    """Numbers of words in the order in which they come; 0 is what stands between pieces."""

    def __init__(self) -> None:
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Different words of some texts, and the texts as their numbers from 1; 0 ends each text."""
    numbers = _Numbers()
    split = b".".join([*texts, b""]).translate(_TEXT_BYTES).replace(b".", b" . ").split()
    found = np.fromiter(map(numbers.__getitem__, split), np.int32, len(split))
    del numbers[b"."]
    return list(numbers), found


_CHUNKS = "lang string, bytes bigint, n_words bigint, words binary, hashes binary, numbers binary"


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a language as numbers, some at a time, with their words and the words' hashes."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()

    def out(language: str) -> pa.RecordBatch:
        words, numbers = _numbered(waiting.pop(language))
        hashes = _word_hashes(language, words).astype("<u8").tobytes()
        count = int(np.count_nonzero(numbers))
        numbers = numbers.astype(_number_kind(len(words))).tobytes()
        row = (language, sizes.pop(language), count, b" ".join(words), hashes, numbers)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = [part.split()[0] for part in _CHUNKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            language, raw = lang.as_py(), text.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            waiting.setdefault(language, []).append(raw)
            sizes[language] += len(raw) + 1
            if sizes[language] >= SPLIT_BYTES:
                yield out(language)
            elif sizes.total() >= SHARD_BYTES:
                yield from map(out, list(waiting))
    yield from map(out, list(waiting))


def _number_kind(words: int) -> np.dtype:
    return np.min_scalar_type(words).newbyteorder("<")


def _chunk(hashes: bytes, numbers: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes by number, with one for 0, and the numbers of a chunk."""
    own = np.frombuffer(hashes, "<u8")
    return np.append(np.uint64(0), own), np.frombuffer(numbers, _number_kind(len(own)))


def _word_hashes(language: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(language.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(word, seed) for word in words), np.uint64, len(words))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _SPREAD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _surviving(
    hashes: np.ndarray, numbers: np.ndarray, bits: list[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length up to one more than there are bits: the places that start an n-gram which may be
    frequent as far as its parts tell, and their buckets."""
    places = np.flatnonzero(numbers)
    own = hashes[numbers[places]]
    for length in range(1, len(bits) + 2):
        if length > 1:
            # Both n-grams one word shorter are alive.
            both = np.flatnonzero(np.diff(places) == 1)
            places = places[both]
            own = own[both] * _MIX + hashes[numbers[places + length - 1]]
        buckets = _buckets(own)
        yield places, buckets
        if length <= len(bits):
            reached = np.flatnonzero(_reached(bits[length - 1], buckets))
            places, own = places[reached], own[reached]


def _reached(bits: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (bits[buckets >> 3] >> (buckets & 7).astype(np.uint8)) & 1


def _bucket_batches(
    batches: Iterator[pa.RecordBatch], bits: Broadcast, min_count: int
) -> Iterator[pa.RecordBatch]:
    """Counts by bucket, not above ``min_count``, in blocks."""
    known = [np.frombuffer(own, np.uint8) for own in bits.value]
    totals = np.zeros(BUCKETS, np.min_scalar_type(min_count))
    for batch in batches:
        for chunk in zip(batch.column("hashes").to_pylist(), batch.column("numbers").to_pylist()):
            *_, (_, buckets) = _surviving(*_chunk(*chunk), known)
            found, counts = np.unique(buckets, return_counts=True)
            totals[found] = np.minimum(totals[found] + counts, min_count)
    blocks = totals.reshape(-1, BLOCK)
    used = np.flatnonzero(blocks.any(axis=1))
    for start in range(0, len(used), 256):
        chosen = used[start : start + 256]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chosen, pa.int32()),
                pa.array([_packed(blocks[k].tobytes()) for k in chosen], pa.binary()),
            ],
            ["block", "counts"],
        )


def _reached_batches(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Bits of the buckets of each block whose sum is enough; the rows of a block follow each other."""
    kind = np.min_scalar_type(min_count)
    at, total = None, None

    def out() -> pa.RecordBatch:
        reached = np.packbits(total >= min_count, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([reached], pa.binary())], ["block", "bits"]
        )

    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            if block != at:
                if at is not None:
                    yield out()
                at, total = block, np.zeros(BLOCK, np.int64)
            own = np.frombuffer(_unpacked(counts, BLOCK * kind.itemsize), kind)
            total = np.minimum(total + own, min_count)
    if at is not None:
        yield out()


def bucket_bits(chunks: DataFrame, longest: int, min_count: int) -> list[bytes]:
    """For each length the buckets that reached ``min_count``, one bit each.

    A bit array has ``BUCKETS`` bits on the driver, whatever the corpus.  Each task of a scan sends all
    its counters, so there are no more tasks than keep the cores busy or ``COUNTED_BYTES`` of text asks for.
    """
    context = chunks.sparkSession.sparkContext
    text = chunks.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(2 * context.defaultParallelism, -(-text // COUNTED_BYTES))
    scanned = chunks.select("hashes", "numbers").coalesce(tasks)
    found: list[bytes] = []
    for _ in range(longest):
        sent = context.broadcast(list(found))
        counted = scanned.mapInArrow(
            partial(_bucket_batches, bits=sent, min_count=min_count), "block int, counts binary"
        )
        reached = (
            counted.repartition("block")
            .sortWithinPartitions("block")
            .mapInArrow(partial(_reached_batches, min_count=min_count), "block int, bits binary")
        )
        bits = bytearray(BUCKETS // 8)
        for row in reached.collect():
            bits[row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = row["bits"]
        found.append(bytes(bits))
    return found


def _shard_entries(
    words: list[bytes], ranks: np.ndarray, alive: list[np.ndarray]
) -> Iterator[tuple[Words, int]]:
    """N-grams and counts of a shard in ascending order; a prefix comes before what it begins.

    ``alive`` has the places where those of each length start."""
    size = max(len(words), 1)
    layers = []
    keys, before = ranks, np.zeros(0, np.int64)
    for length, places in enumerate(alive, 1):
        pairs = ranks[places] if length == 1 else keys[places] * size + ranks[places + length - 1]
        found, inverse, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        parents, labels = (np.zeros_like(found), found) if length == 1 else np.divmod(found, size)
        starts = np.searchsorted(parents, np.arange(len(before) + 1) if length > 1 else np.arange(2))
        layers.append((labels.tolist(), counts.tolist(), starts.tolist()))
        keys = np.full(len(ranks), -1, np.int64)
        keys[places] = inverse
        before = found
    stack = [(0, 0, layers[0][2][1], ())] if layers else []
    while stack:
        depth, at, end, prefix = stack.pop()
        if at == end:
            continue
        labels, counts, _ = layers[depth]
        stack.append((depth, at + 1, end, prefix))
        entry = (*prefix, words[labels[at]])
        yield entry, counts[at]
        if depth + 1 < len(layers):
            starts = layers[depth + 1][2]
            stack.append((depth + 1, starts[at], starts[at + 1], entry))


def _pages(entries: Iterator[tuple[Words, int]]) -> Iterator[tuple[bytes, bytes, int, bytes]]:
    """First and last sequence, number and transducer of each page of sorted entries."""
    page: list[tuple[Words, int]] = []

    def out() -> tuple[bytes, bytes, int, bytes]:
        data = CountTransducer.from_sorted(page).to_bytes()
        return b" ".join(page[0][0]), b" ".join(page[-1][0]), len(page), data

    for entry in entries:
        page.append(entry)
        if len(page) == PAGE:
            yield out()
            page = []
    if page:
        yield out()


_PAGES = "range int, lang string, first binary, last binary, entries bigint, transducer binary"
_PAGE_NAMES = [part.split()[0] for part in _PAGES.split(", ")]
_PAGE_KINDS = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]


def _page_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _PAGE_NAMES]
    arrays = [pa.array(values, kind) for values, kind in zip(columns, _PAGE_KINDS)]
    return pa.RecordBatch.from_arrays(arrays, _PAGE_NAMES)


class _Shard:
    """Chunks of one language with their surviving n-grams."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.alive: list[list[np.ndarray]] = []
        self.bytes = self.places = 0

    def add(self, size: int, words: bytes, hashes: bytes, numbers: bytes, bits: list[np.ndarray]) -> None:
        by_number, own = _chunk(hashes, numbers)
        found = [
            places[np.flatnonzero(_reached(bits[length], buckets))] + self.places
            for length, (places, buckets) in enumerate(_surviving(by_number, own, bits[:-1]))
        ]
        names = words.split(b" ") if words else []
        self.parts.append(np.array([0, *map(self.numbers.__getitem__, names)], np.int32)[own])
        self.alive.append(found)
        self.places += len(own)
        self.bytes += size

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or len(self.numbers) > SHARD_WORDS

    def sorted_words(self) -> tuple[list[bytes], np.ndarray]:
        """Different words in byte order, and the texts as their ranks; -1 stands between pieces."""
        del self.numbers[b"."]
        words = sorted(self.numbers)
        ranks = np.full(len(words) + 1, -1, np.int64)
        for rank, word in enumerate(words):
            ranks[self.numbers[word]] = rank
        return words, ranks[np.concatenate(self.parts)]


def _shard_batches(batches: Iterator[pa.RecordBatch], bits: Broadcast) -> Iterator[pa.RecordBatch]:
    """The pages of each shard."""
    known = [np.frombuffer(own, np.uint8) for own in bits.value]
    shards: dict[str, _Shard] = {}
    held = 0

    def out(language: str) -> Iterator[pa.RecordBatch]:
        shard = shards.pop(language)
        words, ranks = shard.sorted_words()
        for page in _pages(_shard_entries(words, ranks, [np.concatenate(own) for own in zip(*shard.alive)])):
            yield _page_rows([(None, language, *page)])

    for batch in batches:
        names = ("lang", "bytes", "words", "hashes", "numbers")
        for language, size, *chunk in zip(*(batch.column(n).to_pylist() for n in names)):
            shard = shards.setdefault(language, _Shard())
            shard.add(size, *chunk, known)
            held += size
            if shard.full() or held >= 2 * SHARD_BYTES:
                for name in list(shards) if held >= 2 * SHARD_BYTES else [language]:
                    held -= shards[name].bytes
                    yield from out(name)
    for language in list(shards):
        yield from out(language)


Boundary = tuple[str, Words]


def _start_batches(batches: Iterator[pa.RecordBatch], bits: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in _shard_batches(batches, bits):
        yield batch.select(["lang", "first", "entries"])


def _boundaries(chunks: DataFrame, bits: Broadcast) -> list[Boundary]:
    """Where prefix ranges of about ``RANGE`` entries begin, by language and words.

    The pages of some chunks tell; they are built for this alone, and only where they start is kept.
    """
    known = chunks.count()
    share = min(1.0, max(SAMPLED_CHUNKS / max(known, 1), SAMPLED_SHARE))
    some = chunks.sample(share, seed=1) if share < 1 else chunks
    pages = materialise(
        some.coalesce(2 * chunks.sparkSession.sparkContext.defaultParallelism)
        .mapInArrow(partial(_start_batches, bits=bits), "lang string, first binary, entries bigint")
        .withColumn("first", F.substring("first", 1, BOUNDARY_BYTES)),
        "phrase-starts",
    )
    size = pages.agg(F.count("*").alias("pages"), F.sum("entries").alias("entries")).first()
    if not size["pages"]:
        return []
    starts = pages.select("lang", "first")
    if size["pages"] > SAMPLE:
        starts = starts.sample(SAMPLE / size["pages"], seed=1)
    found = sorted((row["lang"], tuple(bytes(row["first"]).split(b" "))) for row in starts.collect())
    ranges = min(MAX_RANGES, ceil(size["entries"] / share / RANGE), len(found))
    return sorted({found[k * len(found) // ranges] for k in range(1, ranges)})


def _cut_batches(batches: Iterator[pa.RecordBatch], boundaries: Broadcast) -> Iterator[pa.RecordBatch]:
    """Pages that lie in one prefix range each."""
    known = boundaries.value

    def place(language: str, words: Words) -> int:
        return bisect_right(known, (language, words))

    for batch in batches:
        names = ("lang", "first", "last", "entries", "transducer")
        for language, first, last, entries, data in zip(*(batch.column(n).to_pylist() for n in names)):
            least, most = (place(language, tuple(key.split(b" "))) for key in (first, last))
            if least == most:
                yield _page_rows([(least, language, first, last, entries, data)])
                continue
            own = CountTransducer.from_bytes(data).entries()
            for number, part in groupby(own, key=lambda entry: place(language, entry[0])):
                yield _page_rows([(number, language, *page) for page in _pages(part)])


def _cut_shard_batches(
    batches: Iterator[pa.RecordBatch], bits: Broadcast, boundaries: Broadcast
) -> Iterator[pa.RecordBatch]:
    return _cut_batches(_shard_batches(batches, bits), boundaries)


def _united_batches(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """The union of each range and language, whose pages follow each other."""
    at, own = None, []

    def out() -> Iterator[pa.RecordBatch]:
        for page in _pages(union(own, min_count)):
            yield _page_rows([(*at, *page)])

    for batch in batches:
        for number, language, data in zip(*(batch.column(n).to_pylist() for n in ("range", "lang", "transducer"))):
            if at != (number, language):
                yield from out() if own else ()
                at, own = (number, language), []
            own.append(CountTransducer.from_bytes(data))
    yield from out() if own else ()


def _entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, data in zip(batch.column("lang").to_pylist(), batch.column("transducer").to_pylist()):
            phrases, sizes, counts = [], [], []
            for words, count in CountTransducer.from_bytes(data).entries():
                phrases.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                sizes.append(len(words))
                counts.append(count)
            arrays = [
                pa.array([language] * len(phrases), pa.string()),
                pa.array(phrases, pa.string()),
                pa.array(sizes, pa.int32()),
                pa.array(counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "size", "a"])


def _placed_batches(batches: Iterator[pa.RecordBatch], boundaries: Broadcast) -> Iterator[pa.RecordBatch]:
    known = boundaries.value
    for batch in batches:
        keys = zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist())
        ranges = [bisect_right(known, (lang, tuple(part.encode().split(b" ")))) for lang, part in keys]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranges, pa.int32()), batch.column("lang"), batch.column("part")],
            ["range", "lang", "part"],
        )


def _composed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of parts; each range's pages come before its parts."""
    at, pages, asked, found = None, [], [], []

    def answer() -> None:
        pages.sort(key=lambda page: page[0])
        firsts = [first for first, _ in pages]
        for page, parts in groupby(asked, key=lambda part: bisect_right(firsts, part[2]) - 1):
            own = list(parts)
            if page >= 0:
                counts = pages[page][1].compose(words for _, _, words in own)
                found.extend((lang, text, count) for (lang, text, _), (_, count) in zip(own, counts))
        asked.clear()

    for batch in batches:
        names = ("range", "lang", "first", "transducer", "part")
        for number, language, first, data, part in zip(*(batch.column(n).to_pylist() for n in names)):
            if at != (number, language):
                answer()
                at = (number, language)
                pages.clear()
            if data is not None:
                pages.append((tuple(first.split(b" ")), CountTransducer.from_bytes(data)))
            else:
                asked.append((language, part, tuple(part.encode().split(b" "))))
        answer()
        columns = zip(*found) if found else [[], [], []]
        kinds = [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)], ["lang", "part", "f"]
        )
        found.clear()


class PhraseCounts:
    """The transducers of all frequent phrases, range by range, and each language's words."""

    def __init__(self, pages: DataFrame, words: DataFrame, boundaries: list[Boundary]) -> None:
        self.pages, self.words, self._boundaries = pages, words, boundaries

    def phrases(self) -> DataFrame:
        """``lang, phrase, size, a`` of each frequent phrase of one word or more."""
        return self.pages.select("lang", "transducer").mapInArrow(
            _entry_batches, "lang string, phrase string, size int, a bigint"
        )

    def look_up(self, parts: DataFrame) -> DataFrame:
        """``lang, part, f`` for each different row of ``parts (lang, part)`` that is frequent."""
        sent = parts.sparkSession.sparkContext.broadcast(self._boundaries)
        placed = parts.distinct().mapInArrow(
            partial(_placed_batches, boundaries=sent), "range int, lang string, part string"
        )
        pages = self.pages.select("range", "lang", "first", "transducer")
        rows = pages.unionByName(placed, allowMissingColumns=True)
        return (
            rows.repartition("range")
            .sortWithinPartitions("range", "lang", F.col("transducer").isNull(), "first", "part")
            .select("range", "lang", "first", "transducer", "part")
            .mapInArrow(_composed_batches, "lang string, part string, f bigint")
        )


def count_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> PhraseCounts:
    """Count all phrases of ``docs (lang, text)`` that occur ``min_count`` times in their language."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    chunks = materialise(texts.mapInArrow(_chunk_batches, _CHUNKS), "phrase-texts", **ROW_GROUPS)
    bits = context.broadcast(bucket_bits(chunks, longest, min_count))
    words = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    boundaries = _boundaries(chunks, bits)
    sent = context.broadcast(boundaries)
    united = (
        chunks.mapInArrow(partial(_cut_shard_batches, bits=bits, boundaries=sent), _PAGES)
        .repartition("range")
        .sortWithinPartitions("range", "lang")
        .mapInArrow(partial(_united_batches, min_count=min_count), _PAGES)
    )
    return PhraseCounts(materialise(united, "phrase-counts"), words, boundaries)


def _slice(first: Column | int, length: Column | int) -> Column:
    words = F.split("phrase", " ", -1)
    return F.array_join(F.slice(words, first, length), " ")


def _absorbed(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the highest count of a longer candidate that each phrase stands in."""
    inner = candidates.filter("size > 2").select(
        "lang",
        "phrase",
        "a",
        "size",
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"),
    )
    placed = inner.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start")
    )
    parts = placed.select("lang", _slice(F.col("start"), F.col("length")).alias("phrase"), "a")
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int | None = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases, or of all."""
    counts = count_phrases(docs, longest, min_count)
    candidates = materialise(counts.phrases().filter("size > 1"), "phrase-candidates")
    cuts = candidates.select(
        "lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        _slice(F.lit(1), F.col("k")).alias("left"),
        _slice(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    asked = cuts.select("lang", F.col("left").alias("part")).union(cuts.select("lang", "right"))
    known = materialise(counts.look_up(asked), "phrase-parts")
    score = F.expr("1000BD * a_ * n_ div (l_ * r_)").alias("score")
    scored = (
        cuts.join(known.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(counts.words, "lang")
        .select("*", *(_exact(name).alias(f"{name}_") for name in "anlr"))
        .select("lang", "phrase", "k", "a", "l", "r", "n", score)
    )
    least = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    best = scored.groupBy("lang", "phrase").agg(least).select("lang", "phrase", "cut.*").drop("k")
    whole = (
        best.join(_absorbed(candidates), ["lang", "phrase"], "left")
        .filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
        .drop("longer")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # The first of each language are among the first of its parts.
        salted = whole.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
        within = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
        whole = salted.withColumn("place", within).filter(F.col("place") <= top)
    ranked = whole.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
