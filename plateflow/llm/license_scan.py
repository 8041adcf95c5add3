"""License scans by ordered signature rules.

The method: each rule is a regular expression over the words of a text, with a label, a weight and a
keyword without which it can't match.  One pass of an automaton over the text finds the keywords, and
only the rules they open are tried.  Detections are taken in order of priority, longer ones first; one
that lies within a detection already taken is suppressed.  Texts are lower-cased (A to Z) and cut into
words, so rules see single spaces and no punctuation; spans are in words, from 0.

Rules are the product of license descriptions and of the forms in which texts name a license, from a
machine-readable tag down to a bare title; the form decides priority and weight.

Three base phrases are counted at all their places whatever the rules suppress, and give base labels.

Every text is scanned whole in the task that reads it; nothing is shuffled, and no text needs more
memory than a few times its own length.

Defined results: a null text is empty.  Without detections ``labels`` is empty and ``score`` is 0.
Repeated rows are scanned like others.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
BASE_WEIGHT = 0.5

_LIC = r"licen[cs]e"
_GNU = r"(?:gnu )?"
# Label, title as an expression over words, a literal in every title, tag words.
LICENSES = (
    ("apache-1.1", rf"apache (?:software )?{_LIC}(?: version)? 1 1", "apache", "apache 1 1"),
    ("apache-2.0", rf"apache (?:software )?{_LIC}(?: version| v)? (?:2 0|2|v2)", "apache", "apache 2 0"),
    ("mit", rf"mit (?:x11 )?{_LIC}", "mit", "mit"),
    ("mit-0", rf"mit no attribution(?: {_LIC})?", "mit no attribution", "mit 0"),
    ("x11", rf"x11 {_LIC}", "x11", "x11"),
    ("isc", rf"isc {_LIC}", "isc", "isc"),
    ("0bsd", rf"(?:zero clause bsd|bsd zero clause|0bsd)(?: {_LIC})?", "bsd", "0bsd"),
    ("bsd-2-clause", rf"(?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd)(?: {_LIC})?", "bsd", "bsd 2 clause"),
    ("bsd-3-clause", rf"(?:(?:3|three) clause bsd|bsd (?:3|three) clause|new bsd|modified bsd)(?: {_LIC})?", "bsd", "bsd 3 clause"),
    ("bsd-4-clause", rf"(?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)(?: {_LIC})?", "bsd", "bsd 4 clause"),
    ("bsd", rf"bsd(?: style)? {_LIC}", "bsd", "bsd"),
    ("gpl-1.0", rf"{_GNU}(?:general public {_LIC}|gpl)(?: version| v)? (?:1 0|1|v1)", "g", "gpl 1 0"),
    ("gpl-2.0", rf"{_GNU}(?:general public {_LIC}|gpl)(?: version| v)? (?:2 0|2|v2)", "g", "gpl 2 0"),
    ("gpl-3.0", rf"{_GNU}(?:general public {_LIC}|gpl)(?: version| v)? (?:3 0|3|v3)", "g", "gpl 3 0"),
    ("gpl", rf"{_GNU}(?:general public {_LIC}|gpl {_LIC})", "g", "gpl"),
    ("lgpl-2.0", rf"{_GNU}(?:library general public {_LIC}|lgpl)(?: version| v)? (?:2 0|2|v2)", "l", "lgpl 2 0"),
    ("lgpl-2.1", rf"{_GNU}(?:lesser general public {_LIC}|lgpl)(?: version| v)? (?:2 1|v2 1)", "l", "lgpl 2 1"),
    ("lgpl-3.0", rf"{_GNU}(?:lesser general public {_LIC}|lgpl)(?: version| v)? (?:3 0|3|v3)", "l", "lgpl 3 0"),
    ("lgpl", rf"{_GNU}(?:(?:lesser|library) general public {_LIC}|lgpl)", "l", "lgpl"),
    ("agpl-3.0", rf"{_GNU}(?:affero general public {_LIC}|agpl)(?: version| v)? (?:3 0|3|v3)", "a", "agpl 3 0"),
    ("agpl", rf"{_GNU}(?:affero general public {_LIC}|agpl)", "a", "agpl"),
    ("fdl", rf"{_GNU}free documentation {_LIC}(?:(?: version| v)? \d(?: \d)?)?", "free documentation", "gfdl"),
    ("mpl-1.1", rf"mozilla public {_LIC}(?: version| v)? (?:1 1|v1 1)", "mozilla public", "mpl 1 1"),
    ("mpl-2.0", rf"mozilla public {_LIC}(?: version| v)? (?:2 0|2|v2)", "mozilla public", "mpl 2 0"),
    ("mpl", rf"mozilla public {_LIC}", "mozilla public", "mpl"),
    ("epl-1.0", rf"eclipse public {_LIC}(?: version| v)? (?:1 0|1|v1)", "eclipse public", "epl 1 0"),
    ("epl-2.0", rf"eclipse public {_LIC}(?: version| v)? (?:2 0|2|v2)", "eclipse public", "epl 2 0"),
    ("edl", rf"eclipse distribution {_LIC}", "eclipse distribution", "edl"),
    ("cddl", rf"common development and distribution {_LIC}(?:(?: version| v)? 1 [01])?", "common development and distribution", "cddl 1 0"),
    ("cpl", rf"common public {_LIC}(?:(?: version| v)? \d \d)?", "common public", "cpl 1 0"),
    ("eupl", rf"european union public {_LIC}(?:(?: version| v)? 1 \d)?", "european union public", "eupl 1 2"),
    ("artistic", rf"(?:perl )?artistic {_LIC}(?:(?: version| v)? [12] \d)?", "artistic", "artistic 2 0"),
    ("zlib", rf"zlib(?: libpng)? {_LIC}", "zlib", "zlib"),
    ("boost", rf"boost software {_LIC}(?:(?: version| v)? 1 0)?", "boost software", "bsl 1 0"),
    ("psf", rf"python software foundation {_LIC}", "python software foundation", "psf 2 0"),
    ("php", rf"php {_LIC}(?:(?: version| v)? 3 01?)?", "php", "php 3 01"),
    ("ruby", rf"ruby {_LIC}", "ruby", "ruby"),
    ("unlicense", r"(?:the )?unlicense", "unlicense", "unlicense"),
    ("wtfpl", rf"(?:wtfpl|do what the fuck you want to public {_LIC})", "w", "wtfpl"),
    ("postgresql", rf"postgresql {_LIC}", "postgresql", "postgresql"),
    ("openssl", rf"openssl {_LIC}", "openssl", "openssl"),
    ("ofl", rf"(?:sil )?open font {_LIC}(?:(?: version| v)? 1 1)?", "open font", "ofl 1 1"),
    ("ms-pl", rf"microsoft public {_LIC}", "microsoft public", "ms pl"),
    ("ms-rl", rf"microsoft reciprocal {_LIC}", "microsoft reciprocal", "ms rl"),
    ("upl", rf"universal permissive {_LIC}", "universal permissive", "upl 1 0"),
    ("osl", rf"open software {_LIC}(?:(?: version| v)? [123] \d)?", "open software", "osl 3 0"),
    ("afl", rf"academic free {_LIC}(?:(?: version| v)? [123] \d)?", "academic free", "afl 3 0"),
    ("odbl", rf"open (?:data commons open )?database {_LIC}", "database", "odbl 1 0"),
    ("cc0", r"(?:creative commons zero|cc0)(?: 1 0)?(?: universal)?", "c", "cc0 1 0"),
    ("cc-by-nc-sa", rf"(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: {_LIC})?(?: \d \d)?", "c", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", rf"(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s?|cc by nc nd)(?: {_LIC})?(?: \d \d)?", "c", "cc by nc nd 4 0"),
    ("cc-by-nc", rf"(?:creative commons attribution non ?commercial|cc by nc)(?: {_LIC})?(?: \d \d)?", "c", "cc by nc 4 0"),
    ("cc-by-nd", rf"(?:creative commons attribution no ?deriv(?:ative)?s?|cc by nd)(?: {_LIC})?(?: \d \d)?", "c", "cc by nd 4 0"),
    ("cc-by-sa", rf"(?:creative commons attribution share ?alike|cc by sa)(?: {_LIC})?(?: \d \d)?", "c", "cc by sa 4 0"),
    ("cc-by", rf"(?:creative commons attribution|cc by)(?: {_LIC})?(?: \d \d)?", "c", "cc by 4 0"),
    ("creative-commons", rf"creative commons(?: {_LIC})?", "creative commons", "cc"),
    ("public-domain", r"(?:in|into|to) the public domain", "public domain", "public domain"),
)
# Literals for titles whose alternatives share none: any of them opens the rule.
_KEYWORDS = {
    "g": ("general public licen", "gpl"),
    "l": ("lesser general public licen", "library general public licen", "lgpl"),
    "a": ("affero general public licen", "agpl"),
    "w": ("wtfpl", "do what the fuck"),
    "c": ("creative commons", "cc0", "cc by"),
    "mit": ("mit license", "mit licence", "mit x11"),
    "apache": ("apache license", "apache licence", "apache software licen"),
}
# Form, expression around a title or tag, keyword of its own, weight; in order of priority.
FORMS = (
    ("tag", r"spdx license identifier {tag}", "spdx license identifier", 1.0),
    ("grant", r"(?:licensed|licenced|released|distributed|published|available|provided)(?: [^ ]+)??(?: [^ ]+)?? (?:under|with)(?: (?:the|a|an))?(?: terms of(?: the)?)? {title}", None, 0.95),
    ("terms", r"(?:subject to|in compliance with|governed by|terms (?:and conditions )?of)(?: the)? {title}", None, 0.9),
    ("notice", r"(?:see|copy of|text of|read)(?: the)? {title}", None, 0.8),
    ("title", r"{title}", None, 0.7),
)
# Rules without a license title: label, expression, keyword, weight.
STATEMENTS = (
    ("all-rights-reserved", r"all rights reserved", "all rights reserved", 0.6),
    ("all-rights-reserved", r"tous droits réservés", "tous droits", 0.6),
    ("all-rights-reserved", r"todos los derechos reservados", "todos los derechos", 0.6),
    ("all-rights-reserved", r"alle rechte vorbehalten", "alle rechte", 0.6),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted", 1.0),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", "permission to use copy", 1.0),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use", 1.0),
    ("apache-2.0", r"apache org licenses license 2 0", "apache org licenses", 0.9),
    ("mpl-2.0", r"mozilla org mpl 2 0", "mozilla org mpl", 0.9),
    ("gpl", r"gnu org licenses gpl", "gnu org licenses", 0.9),
    ("cc-by", r"creativecommons org licenses by \d \d", "creativecommons org", 0.9),
    ("cc-by-sa", r"creativecommons org licenses by sa \d \d", "creativecommons org", 0.9),
    ("cc-by-nc", r"creativecommons org licenses by nc \d \d", "creativecommons org", 0.9),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa \d \d", "creativecommons org", 0.9),
    ("cc0", r"creativecommons org publicdomain zero", "creativecommons org", 0.9),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "confidential", 0.7),
)


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    weight: float


# What is made once in each process.  A plain dictionary travels by value with the functions that use it,
# unlike their memos, which executors would look for in an installed package.
_made: dict[str, object] = {}


def rules() -> tuple[Rule, ...]:
    """All rules, by priority: tags, then statements, then the other forms from grant to title."""
    if "rules" not in _made:
        _made["rules"] = _make_rules()
    return _made["rules"]


def _make_rules() -> tuple[Rule, ...]:
    made = []
    for number, (form, shape, keyword, weight) in enumerate(FORMS):
        for label, title, literal, tag in LICENSES:
            words = shape.format(title=f"(?:{title})", tag=tag)
            keys = (keyword,) if keyword else _KEYWORDS.get(literal, (literal,))
            made.append((number, label, words, keys, weight))
    made += [(0, label, words, (keyword,), weight) for label, words, keyword, weight in STATEMENTS]
    return tuple(
        Rule(priority, label, re.compile(rf"(?<![^ ]){words}(?![^ ])"), keys, weight)
        for priority, label, words, keys, weight in made
    )


def _gate() -> ahocorasick.Automaton:
    """Keywords with the numbers of the rules they open."""
    if "gate" not in _made:
        _made["gate"] = _make_gate()
    return _made["gate"]


def _make_gate() -> ahocorasick.Automaton:
    opened: dict[str, list[int]] = {}
    for number, rule in enumerate(rules()):
        for keyword in rule.keywords:
            opened.setdefault(keyword, []).append(number)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in opened.items():
        automaton.add_word(keyword, tuple(numbers))
    automaton.make_automaton()
    return automaton


# Bytes of words stay, A to Z become small, all others separate words.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Detection:
    label: str
    first_word: int
    last_word: int
    weight: float


def detect(words: str) -> list[Detection]:
    """Detections in a text of single-spaced words that no other one suppresses, in order of place."""
    opened = {number for _, numbers in _gate().iter(words) for number in numbers}
    known = rules()
    found = []
    for number in opened:
        rule = known[number]
        found.extend((rule.priority, -len(m[0]), *m.span(), number) for m in rule.pattern.finditer(words))
    starts = sorted({start for _, _, start, _, _ in found})
    reach = _Reach(len(starts))
    taken = []
    for _, _, start, end, number in sorted(found):
        rank = bisect_right(starts, start)
        if reach.furthest(rank) < end:
            reach.extend(rank, end)
            taken.append((start, end, number))
    detections, first, upto = [], 0, 0
    for start, end, number in sorted(taken):
        first += words.count(" ", upto, start)
        upto = start
        rule = known[number]
        detections.append(Detection(rule.label, first, first + words.count(" ", start, end), rule.weight))
    return detections


class _Reach:
    """The furthest end of the spans taken that start at a rank or before it, in logarithmic time."""

    def __init__(self, size: int) -> None:
        self.ends = [0] * (size + 1)

    def extend(self, rank: int, end: int) -> None:
        while rank < len(self.ends):
            self.ends[rank] = max(self.ends[rank], end)
            rank += rank & -rank

    def furthest(self, rank: int) -> int:
        end = 0
        while rank:
            end = max(end, self.ends[rank])
            rank &= rank - 1
        return end


def base_places(words: str) -> dict[str, list[int]]:
    """Places in words of each base phrase, by label."""
    padded = f" {words} "
    places: dict[str, list[int]] = {}
    for phrase, label in BASE_PHRASES.items():
        at = padded.find(f" {phrase} ")
        count, upto = 0, 0
        while at >= 0:
            count += padded.count(" ", upto, at)
            upto = at
            places.setdefault(label, []).append(count)
            at = padded.find(f" {phrase} ", at + 1)
    return places


_SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double,"
    " detections array<struct<label:string,first_word:bigint,last_word:bigint,weight:double>>"
)
_DETECTIONS = pa.list_(
    pa.struct(
        [
            ("label", pa.string()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("weight", pa.float64()),
        ]
    )
)


def scan_text(text: str | None) -> tuple:
    """The result columns of one text, without the id."""
    split = words_of(text)
    words = b" ".join(split).decode("utf-8", "surrogatepass")
    base = base_places(words)
    detections = detect(words)
    places = sorted(place for own in base.values() for place in own)
    labels = {*base, *(d.label for d in detections)}
    weights = [d.weight for d in detections] + [BASE_WEIGHT] * bool(base)
    return (
        len(split),
        len(places),
        places[0] if places else None,
        places[-1] if places else None,
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        max(weights, default=0.0),
        [vars(d) for d in detections],
    )


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), _DETECTIONS]
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = zip(*(scan_text(text.as_py()) for text in batch.column("text")))
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Words, base places, labels, score and detections of each document."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(_scan_batches, _SCHEMA)
