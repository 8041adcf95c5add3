r"""Cheapest edits that repair the turns of a conversation.

A conversation is whole if the initials of its roles match ``(s?(ua)+)?``: perhaps a system turn, then
user and assistant in turn.  Edits are Keep, Rerole (to user or assistant), Delete and Insert (an empty
user or assistant turn); the audit is their initials in order.  A blank turn and one whose role and text
came before must go; a truncated one that stays costs more.  Of the cheapest audits the least in ASCII
order counts.

The method, a persistent audit DP: it reads the turns in order and keeps, for each of four states
(nothing yet, system, user, assistant), the best cost and audit.  Audits share their prefixes: each is a
linked node with its last letter, its depth, a rolling hash of all letters and its ancestors 1, 2, 4, …
steps back.  Audits of equal cost are compared by a search for their longest common prefix over these
ancestors' hashes; that the prefixes are equal in fact, not in hash only, is verified before the next
letters decide.  (Of two audits with equal cost none is a prefix of the other, since what follows would
be insertions, which cost.)  States that can't win any more are dropped, and what the others share is
settled from time to time and leaves memory.

Distribution.  Digests and faults are columns; the DP sees no text.  Equal rows are counted before the
first shuffle; the first of equal turns is found per conversation, role and digest.  The turns of a
conversation are brought together by a shuffle and a spilling sort and read as a stream: a task holds the
open ends of four audits and the letters settled, whatever the conversation's share of all rows.  A
second stream, with each audit before its turns, writes the repaired turns and never holds a text twice.

Defined results: null roles and texts are one space.  Turns with the same number are in order of role and
SHA-256 of the text, null numbers first; repeated rows are repeated turns.  Null ids are one conversation.
A role without a first letter of its own can't be kept.  Ids in ``ids`` without turns get zeros and an
empty audit.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.common import SPACES

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
SENTENCE_ENDS = (".", "!", "?")
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Turns after which what all states share is settled.
SETTLE_TURNS = 1 << 12
ROWS_OUT = 1 << 10

# States, and where a turn of an initial leads from each.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: The state after an inserted or reroled turn, and its role.
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


class Audit:
    """A node: the audit of its parent and one more letter."""

    __slots__ = ("letter", "depth", "hash", "ups")

    def __init__(self, parent: Audit | None = None, letter: str = "") -> None:
        self.letter = letter
        self.depth = parent.depth + 1 if parent else 0
        self.hash = (parent.hash * _BASE + ord(letter)) % _MODULUS if parent else 0
        ups, node = [], parent
        while node is not None:
            ups.append(node)
            step = len(ups) - 1
            node = node.ups[step] if step < len(node.ups) else None
        self.ups = tuple(ups)

    def at_depth(self, depth: int) -> Audit:
        node = self
        while node.depth > depth:
            node = node.ups[(node.depth - depth).bit_length() - 1]
        return node

    def letters(self) -> str:
        found, node = [], self
        while node.ups:
            found.append(node.letter)
            node = node.ups[0]
        return "".join(reversed(found))


def _same(one: Audit, other: Audit) -> bool:
    """Whether two audits of equal depth and hash are equal; shared nodes end the walk."""
    while one is not other and one.ups:
        if one.letter != other.letter:
            return False
        one, other = one.ups[0], other.ups[0]
    return True


def comes_before(one: Audit, other: Audit) -> bool:
    """Whether an audit is less than another, by their longest common prefix."""
    depth = min(one.depth, other.depth)
    a, b = one.at_depth(depth), other.at_depth(depth)
    if a.hash == b.hash:
        if _same(a, b):
            return one.depth < other.depth
        return one.letters() < other.letters()
    # The deepest pair of ancestors with equal hashes is the parents of a and b in the end.
    step = len(a.ups) - 1
    while step >= 0:
        if step < len(a.ups) and a.ups[step].hash != b.ups[step].hash:
            a, b = a.ups[step], b.ups[step]
        else:
            step -= 1
    if not _same(a.ups[0], b.ups[0]):
        return one.letters() < other.letters()
    return a.letter < b.letter


def _common(one: Audit, other: Audit) -> Audit:
    """The deepest node that two audits share."""
    depth = min(one.depth, other.depth)
    a, b = one.at_depth(depth), other.at_depth(depth)
    if a is b:
        return a
    step = len(a.ups) - 1
    while step >= 0:
        if step < len(a.ups) and a.ups[step] is not b.ups[step]:
            a, b = a.ups[step], b.ups[step]
        else:
            step -= 1
    return a.ups[0]


class RepairPlan:
    """The best audits of the turns read so far."""

    def __init__(self) -> None:
        self._best: dict[int, tuple[int, Audit]] = {NOTHING: (0, Audit())}
        self._settled: list[str] = []
        self._open = 0
        self._insert()

    @staticmethod
    def _offer(best: dict, state: int, cost: int, parent: Audit, letter: str) -> bool:
        """Take an audit for a state if none there is as good."""
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        audit = Audit(parent, letter)
        if held is not None and held[0] == cost and not comes_before(audit, held[1]):
            return False
        best[state] = (cost, audit)
        return True

    def _insert(self) -> None:
        """Insertions between two turns, until none is better."""
        better = True
        while better:
            better = False
            for state, (cost, audit) in list(self._best.items()):
                better |= self._offer(self._best, NEXT[state], cost + COSTS[INSERT], audit, INSERT)

    def read(self, initial: str, fault: int) -> None:
        """The next turn, by the first letter of its role and its fault."""
        best: dict[int, tuple[int, Audit]] = {}
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, audit) in self._best.items():
            self._offer(best, state, cost + COSTS[DELETE], audit, DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            kept = MOVES.get(initial, {}).get(state)
            if kept is not None:
                self._offer(best, kept, cost + extra + COSTS[KEEP], audit, KEEP)
            self._offer(best, NEXT[state], cost + extra + COSTS[REROLE], audit, REROLE)
        self._best = best
        self._insert()
        self._drop_beaten()
        self._open += 1
        if self._open >= SETTLE_TURNS:
            self._settle()

    def _drop_beaten(self) -> None:
        """Drop audits that can't be among the cheapest any more.

        What may follow a system turn may follow an assistant's; what may follow nothing may too, but
        for a system turn, which can be deleted instead.
        """
        if ASSISTANT not in self._best:
            return
        limit = self._best[ASSISTANT][0]
        for state, margin in ((NOTHING, COSTS[DELETE]), (SYSTEM, 0)):
            if state in self._best and self._best[state][0] > limit + margin:
                del self._best[state]

    def _settle(self) -> None:
        """Put the prefix that all audits share aside and start them anew after it."""
        self._open = 0
        shared = None
        for _, audit in self._best.values():
            shared = audit if shared is None else _common(shared, audit)
        if not shared.depth:
            return
        self._settled.append(shared.letters())
        moved = {shared: Audit()}
        for state, (cost, audit) in self._best.items():
            path = []
            while audit not in moved:
                path.append(audit)
                audit = audit.ups[0]
            new = moved[audit]
            for node in reversed(path):
                new = moved[node] = Audit(new, node.letter)
            self._best[state] = (cost, new)

    def result(self) -> tuple[int, str]:
        """The least cost of whole conversations, and the least audit with it."""
        ends = [self._best[state] for state in (NOTHING, ASSISTANT) if state in self._best]
        cost, audit = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or other_cost == cost and comes_before(other, audit):
                cost, audit = other_cost, other
        return cost, "".join(self._settled) + audit.letters()


class _Reading:
    """Counts and plan of one conversation, read turn by turn."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.plan = RepairPlan()
        self.faults = [0, 0, 0, 0]
        self.least = self.most = self.before = None
        self.numbers = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int, copies: int) -> None:
        if copies and turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.numbers += 1
        for copy in range(copies):
            if copy and fault != BLANK:
                fault = DUPLICATE
            self.faults[fault] += 1
            if self.before is not None and self.before + initial not in LEGAL:
                self.illegal += 1
            self.before = initial
            self.plan.read(initial, fault)

    def row(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.numbers
        return self.conv_id, gaps, *self.faults[1:], self.illegal, *self.plan.result()


_AUDITS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " cost bigint, audit string"
)
_AUDIT_NAMES = [part.split()[0] for part in _AUDITS.split(", ")]
_AUDIT_KINDS = [*[pa.int64()] * 7, pa.string()]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(columns, kinds)], names)


def _audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reading, done = None, []
    for batch in batches:
        for conv_id, turn, initial, fault, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if reading is None or reading.conv_id != conv_id:
                if reading is not None:
                    done.append(reading.row())
                reading = _Reading(conv_id)
            reading.add(turn, initial, fault, copies)
            if len(done) >= ROWS_OUT:
                yield _table(done, _AUDIT_NAMES, _AUDIT_KINDS)
                done = []
    if reading is not None:
        yield _table([*done, reading.row()], _AUDIT_NAMES, _AUDIT_KINDS)


def _whole(turns: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text("role"),
        text("text"),
    )
    return own.withColumn("digest", F.unhex(F.sha2("text", 256)))


def audit_turns(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, least cost and audit of each conversation of ``turns (conv_id, turn, role, text)``.

    ``ids (conv_id)`` adds conversations that may have no turns.
    """
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(shown == "", BLANK).when(~F.right(shown, F.lit(1)).isin(*SENTENCE_ENDS), TRUNCATED)
    counted = (
        _whole(turns)
        .select("conv_id", "turn", "role", "digest", fault.alias("own_fault"))
        .groupBy("conv_id", "turn", "role", "digest", "own_fault")
        .agg(F.count("*").alias("copies"))
    )
    equal = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    later = (F.row_number().over(equal) > 1) & ~F.col("own_fault").eqNullSafe(F.lit(BLANK))
    rows = counted.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        F.when(later, DUPLICATE).otherwise(F.coalesce("own_fault", F.lit(NO_FAULT))).alias("fault"),
        "copies",
    )
    if ids is not None:
        none = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        rows = rows.unionByName(
            none.select("conv_id", F.lit(NO_FAULT).alias("fault"), F.lit(0).cast("long").alias("copies")),
            allowMissingColumns=True,
        )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    initial = F.coalesce(F.left("role", F.lit(1)), F.lit(""))
    return ordered.select("conv_id", "turn", initial.alias("initial"), "fault", "copies").mapInArrow(
        _audit_batches, _AUDITS
    )


_REPAIRED = "conv_id bigint, position bigint, edit string, turn bigint, role string, text string"
_REPAIRED_NAMES = [part.split()[0] for part in _REPAIRED.split(", ")]
_REPAIRED_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]


class _Editing:
    """Applies an audit to the turns of its conversation."""

    def __init__(self, conv_id: int | None, audit: str) -> None:
        self.conv_id, self.audit = conv_id, audit
        self.at = self.position = 0
        self.state = NOTHING

    def _out(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        self.position += 1
        return self.conv_id, self.position, edit, turn, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self.state = NEXT[self.state]
            yield self._out(INSERT, None, ROLES[self.state], "")

    def edited(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = MOVES[role[0]][self.state]
            yield self._out(edit, turn, role, text)
        elif edit == REROLE:
            self.state = NEXT[self.state]
            yield self._out(edit, turn, ROLES[self.state], text)


def _repaired_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of each conversation after a row with its audit."""
    editing = None
    for batch in batches:
        done: list[tuple] = []
        for conv_id, audit, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if editing is not None:
                    done.extend(editing.inserted())
                editing = _Editing(conv_id, audit)
            else:
                done.extend(editing.edited(turn, role, text))
        yield _table(done, _REPAIRED_NAMES, _REPAIRED_KINDS)
    if editing is not None:
        yield _table(list(editing.inserted()), _REPAIRED_NAMES, _REPAIRED_KINDS)


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns after the edits of ``audit_turns``, with position and edit.

    Rows of a conversation are in one partition and in order.  An inserted turn has no number.
    """
    heads = audits.select("conv_id", "audit")
    rows = _whole(turns).unionByName(heads, allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), "turn", "role", "digest"
    )
    return ordered.select("conv_id", "audit", "turn", "role", "text").mapInArrow(
        _repaired_batches, _REPAIRED
    )


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()]
    at, digest, done = None, None, []
    for batch in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None or at != conv_id:
                if digest is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield _table(done, names, kinds)
        done = []
    if digest is not None:
        yield _table([(at, digest.hexdigest())], names, kinds)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` of each conversation's repaired turns, joined by line feeds."""
    return repaired.select("conv_id", "role", "text").mapInArrow(
        _digest_batches, "conv_id bigint, repaired_sha256 string"
    )


def damage(turns: DataFrame) -> DataFrame:
    """Turns with faults, by CRC-32 of conversation and number modulo 20.

    0 drops a turn, 1 empties it, 2 takes its sentence ends away, 3 repeats it, 4 makes it a user's.
    """
    whole = _whole(turns).drop("digest")
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", "".join(SENTENCE_ENDS), ""))
    return (
        whole.withColumn("kind", F.crc32(key) % 20)
        .filter(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            text.otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
