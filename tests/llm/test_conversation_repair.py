import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from plateflow.llm import conversation_repair as r
from plateflow.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHOLE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\f\r"


def plain_faults(rows):
    """The first fault of each ``(role, text)``."""
    faults = []
    for k, (role, text) in enumerate(rows):
        shown = text.strip(SPACE)
        if not shown:
            faults.append(r.BLANK)
        elif (role, text) in rows[:k]:
            faults.append(r.DUPLICATE)
        else:
            faults.append(r.NO_FAULT if shown[-1] in ".!?" else r.TRUNCATED)
    return faults


def every_audit(rows):
    """Each way to edit the rows with two insertions in a gap at most: cost, audit, repaired rows."""
    faults = plain_faults(rows)
    empty = [("I", "user", ""), ("I", "assistant", "")]
    gaps = [list(c) for n in range(3) for c in itertools.product(empty, repeat=n)]
    ways = []
    for (role, text), fault in zip(rows, faults):
        extra = 5 if fault == r.TRUNCATED else 0
        own = [("D", 2, None)]
        if fault not in (r.BLANK, r.DUPLICATE):
            own += [("K", extra, (role, text)), *(("R", 1 + extra, (new, text)) for new in ("user", "assistant"))]
        ways.append(own)
    for edits in itertools.product(*ways):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            out, audit, cost = [], "", 0
            for k, gap in enumerate(inserts):
                audit += "I" * len(gap)
                cost += 5 * len(gap)
                out += [(role, text) for _, role, text in gap]
                if k < len(rows):
                    audit += edits[k][0]
                    cost += edits[k][1]
                    out += [edits[k][2]] if edits[k][2] else []
            if WHOLE.fullmatch("".join(role[:1] or "?" for role, _ in out)):
                yield cost, audit, out


def plain_best(rows):
    """Cheapest and least audit by a plain DP over whole strings."""
    best = {"": (0, "", [])}

    def state_of(out):
        return out[-1][0][0] if out else ""

    def insert(best):
        for _ in range(4):
            for cost, audit, out in list(best.values()):
                for role in ("user", "assistant"):
                    offer(best, cost + 5, audit + "I", [*out, (role, "")])

    def offer(best, cost, audit, out):
        initials = "".join(role[:1] or "?" for role, _ in out)
        if not re.fullmatch(r"(s?(ua)*u?)", initials):
            return
        key = state_of(out)
        if key not in best or (cost, audit) < best[key][:2]:
            best[key] = (cost, audit, out)

    insert(best)
    for (role, text), fault in zip(rows, plain_faults(rows)):
        extra = 5 if fault == r.TRUNCATED else 0
        after = {}
        for cost, audit, out in best.values():
            offer(after, cost + 2, audit + "D", out)
            if fault not in (r.BLANK, r.DUPLICATE):
                offer(after, cost + extra, audit + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    offer(after, cost + extra + 1, audit + "R", [*out, (new, text)])
        best = after
        insert(best)
    return min((best[key] for key in ("", "a") if key in best), key=lambda b: b[:2])


def planned(rows):
    plan = r.RepairPlan()
    for (role, _), fault in zip(rows, plain_faults(rows)):
        plan.read(role[:1], fault)
    return plan.result()


def random_rows(rng, length):
    roles = ["user", "assistant", "system", "tool", "", "a", "s"]
    texts = ["Fine.", "cut", "", " \n", "Yes!", "So"]
    return [
        (rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts) + ("" if rng.random() < 0.3 else f"{k}."))
        for k in range(length)
    ]


@pytest.mark.parametrize("seed", range(60))
def test_cheapest_of_all_edits(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randint(0, 3))
    cost, audit, _ = min(every_audit(rows), key=lambda way: way[:2])
    assert planned(rows) == (cost, audit)


@pytest.mark.parametrize("seed", range(200))
def test_longer_conversations(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randint(0, 60))
    assert planned(rows) == plain_best(rows)[:2]


def test_settling_and_equal_hashes_change_nothing(monkeypatch):
    rng = random.Random(5)
    conversations = [random_rows(rng, 80) for _ in range(20)]
    wanted = [planned(rows) for rows in conversations]
    monkeypatch.setattr(r, "SETTLE_TURNS", 3)
    assert [planned(rows) for rows in conversations] == wanted
    monkeypatch.setattr(r, "_MODULUS", 3)
    assert [planned(rows) for rows in conversations] == wanted
    monkeypatch.setattr(r, "_MODULUS", 1)
    assert [planned(rows) for rows in conversations] == wanted


def test_order_of_audits():
    def audit(letters):
        node = r.Audit()
        for letter in letters:
            node = r.Audit(node, letter)
        return node

    rng = random.Random(1)
    for _ in range(500):
        one, other = ("".join(rng.choices("DK", k=rng.randint(0, 12))) for _ in range(2))
        assert r.comes_before(audit(one), audit(other)) == (one < other)
        assert audit(one).letters() == one


def test_memory_of_a_long_conversation():
    plan = r.RepairPlan()
    for k in range(3 * r.SETTLE_TURNS):
        plan.read("ua"[k % 2], r.NO_FAULT)
    assert max(audit.depth for _, audit in plan._best.values()) <= r.SETTLE_TURNS + 4
    assert plan.result() == (0, "K" * 3 * r.SETTLE_TURNS)


def plain_result(rows):
    """All columns for one conversation's ``(turn, role, text)`` after damage, in any order."""
    rows = [(t, " " if role is None else role, " " if text is None else text) for t, role, text in rows]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
    pairs = [(role, text) for _, role, text in rows]
    faults = plain_faults(pairs)
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    initials = [role[:1] for role, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, out = plain_best(pairs)
    repaired = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
    counts = [faults.count(kind) for kind in (r.BLANK, r.DUPLICATE, r.TRUNCATED)]
    return gaps, *counts, illegal, cost, audit, repaired


def plain_damage(rows):
    for conv, turn, role, text in rows:
        own = [" " if value is None else value for value in (conv, turn, role, text)]
        kind = zlib.crc32(f"{own[0]}:{own[1]}".encode()) % 20
        role = "user" if kind == 4 else own[2]
        text = {1: "", 2: re.sub("[.!?]", "", own[3])}.get(kind, own[3])
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv, turn, role, text


def plain_query(rows):
    groups = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in plain_damage(rows):
        groups[conv].append((turn, role, text))
    return {conv: plain_result(own) for conv, own in groups.items()}


def as_results(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = frame.collect()
    found = {row.conv_id: tuple(row[name] for name in names) for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_agrees_with_brute_force_on_the_whole_table(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_results(op13_conversation_repair(spark, sf_dir)) == plain_query(rows)


def odd_turns():
    rng = random.Random(3)
    rows = []
    for conv in (None, 1, 2, 3):
        for turn in (None, None, 0, 1, 1, 2, 4, 2**40):
            rows.append((conv, turn, rng.choice([None, "user", "assistant", "system", "", "émile"]), rng.choice([None, "", "ok", "Ja.", "x" * 50_000, "  "])))
    return rows + rows[3:9] + [(9, 5, "user", "Drop.")] * 3


def test_odd_turns(spark, tmp_path):
    rows = odd_turns()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS audit", "2 AS digest", "3 AS fault", "4 AS copies")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    found = as_results(op13_conversation_repair(spark, str(tmp_path)))
    assert found == plain_query(rows) and None in found


def test_conversations_without_turns_and_no_conversations(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (None,)], "conv_id long")
    found = {a.conv_id: (a.cost, a.audit, a.gaps) for a in r.audit_turns(turns, ids).collect()}
    assert found == {1: (2, "D", 0), 2: (0, "", 0), None: (0, "", 0)}
    none = turns.filter("false")
    assert r.audit_turns(none).count() == 0
    assert r.repaired_turns(none, r.audit_turns(none)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 3, "user", "What now?"), (1, 4, "tool", "This.")]
    turns = spark.createDataFrame(rows, SCHEMA)
    repaired = r.repaired_turns(turns, r.audit_turns(turns)).orderBy("position").collect()
    by_edit = defaultdict(list)
    for row in repaired:
        by_edit[row.edit].append((row.turn, row.role, row.text))
    assert [row.role for row in repaired] == ["user", "assistant", "user", "assistant"]
    assert by_edit["K"] == [(1, "assistant", "Hello."), (3, "user", "What now?")]
    assert by_edit["R"] == [(0, "user", "Be kind."), (4, "assistant", "This.")]
