"""Operator 11 against exhaustive search and a row-by-row version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quarry.llm import conversations as c
from quarry.llm.common import table
from quarry.llm.derivation import ACCEPTING, STATES, chained, repairs

SF = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?\Z")
BLANK = re.compile(r"[\x20\x09-\x0d]*\Z")


def exhaustive(initials, faults):
    """The least (cost, audit) over all sequences of edits with up to two insertions in a row."""
    insertions = [("", "", 0), ("I", "u", 5), ("I", "a", 5), ("II", "ua", 10), ("II", "au", 10)]
    places = [insertions]
    for initial, fault in zip(initials, faults):
        own = [("D", "", 2)]
        if fault not in "bd":
            extra = 5 if fault == "t" else 0
            own += [("K", initial, extra), ("R", "u", 1 + extra), ("R", "a", 1 + extra)]
        places += [own, insertions]
    return min((sum(e[2] for e in edits), "".join(e[0] for e in edits)) for edits in itertools.product(*places)
               if LEGAL.match("".join(e[1] for e in edits)))


def by_dynamic_programming(initials, faults):
    """(cost, audit) by plain recursion over rest and state: an independent form for longer rows."""
    into = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    rest = {}
    for at in range(len(initials), -1, -1):
        now = {}
        for state in into:
            options = [(0, "")] if at == len(initials) and state in (0, 3) else []
            if at < len(initials):
                cost, audit = rest.get(state, (10**9, ""))
                options.append((cost + 2, "D" + audit))
                if faults[at] not in "bd":
                    extra = 5 if faults[at] == "t" else 0
                    for role, after in into[state].items():
                        cost, audit = rest.get(after, (10**9, ""))
                        if role == initials[at]:
                            options.append((cost + extra, "K" + audit))
                        elif role != "s":
                            options.append((cost + 1 + extra, "R" + audit))
            now[state] = options
        for _ in range(3):  # insertions, until nothing changes
            best = {s: min(o) for s, o in now.items() if o}
            for state in into:
                now[state] += [(best[t][0] + 5, "I" + best[t][1]) for role, t in into[state].items() if role != "s" and t in best]
        rest = {s: min(o) for s, o in now.items() if o}
    return rest[0]


def test_agenda_against_exhaustive_search():
    draw = random.Random(1)
    for _ in range(120):
        n = draw.randint(0, 4)
        initials, faults = ("".join(draw.choice(x) for _ in range(n)) for x in ("suax", "...tbd"))
        want = exhaustive(initials, faults)
        assert repairs(initials, faults, [0], ACCEPTING)[0] == want == by_dynamic_programming(initials, faults)


def test_blocks_chain_to_the_repair_of_the_whole():
    draw = random.Random(2)
    for _ in range(200):
        n, size = draw.randint(1, 60), draw.randint(1, 9)
        initials, faults = ("".join(draw.choice(x) for _ in range(n)) for x in ("suaxua", "....tbd"))
        blocks = []
        for a in range(0, n, size):
            part, last = slice(a, a + size), a + size >= n
            blocks.append({(s, e): v for e in ([-1] if last else STATES) for s, v in repairs(
                initials[part], faults[part], STATES if a else [0], ACCEPTING if last else [e]).items()})
        cost, states = chained(blocks)
        audit = "".join(b[s, e][1] for b, s, e in zip(blocks, states, [*states[1:], -1]))
        assert (cost, audit) == repairs(initials, faults, [0], ACCEPTING)[0] == by_dynamic_programming(initials, faults)


def broken(rows):
    """The damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def report(rows, original):
    """The whole query in Python."""
    out = []
    for conv in {r[0] for r in original}:
        def place(r):
            digest = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
            return (r[1] is not None, r[1] or 0, digest)
        own = sorted((r for r in rows if r[0] == conv), key=place)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), ""
        for _, _, role, text in own:
            stripped = text.rstrip(" \t\n\r\x0b\x0c")
            faults += "b" if BLANK.match(text) else "d" if (role, text) in seen else "." if stripped[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = "".join(r[2][:1] if r[2][:1] in ("s", "u", "a") else "x" for r in own)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = by_dynamic_programming(initials, faults)
        lines, state, left = [], 0, iter(own)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[2:]
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query_against_the_row_by_row_version(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations", "conv_id", "turn", "role", "text").collect()]
    assert key(c.op11_conversations(spark, SF).collect()) == key(report(broken(rows), rows))


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (1, 3, "assistant", "Ho."), (1, 3, "assistant", "Ho."),
    (2, None, "user", "first?"), (2, 5, None, None), (2, 5, "system", "late."), (2, 6, "", "no role."),
    (None, 1, "user", "no id"), (None, None, "assistant", "no id!"), (3, 0, None, None), (4, 0, "Üser", "ünï…"),
    (5, 0, "system", "Be nice."), (5, 1, "user", "long " * 60_000 + "."), (5, 2, "assistant", "x" * 200_000),
    (6, None, "user", "a."), (6, None, "user", "a."), (7, -3, "assistant", ". \t\n"), (7, 4, "user", " \t"), (8, 0, "usher", "Kept?"),
]


@pytest.fixture(scope="module")
def odd_turns(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    return df.withColumns({x: F.lit(1) for x in ("pos", "block", "digest", "audit", "kind", "copy", "conv", "side", "cost")}).repartition(3)


def test_odd_rows(spark, odd_turns):
    rows = [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in ODD]
    assert key(c.repair_report(odd_turns).collect()) == key(report(rows, rows))
    assert key(c.repair_report(c.damage(odd_turns), odd_turns).collect()) == key(report(broken(ODD), ODD))
    assert c.repair_report(odd_turns.limit(0)).collect() == []
    gone = c.repair_report(odd_turns.limit(0), odd_turns).collect()
    assert len(gone) == 9 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", c.EMPTY)}


def test_one_conversation_over_many_blocks_and_tasks(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(1, t // 2 * 3, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["yes.", "no", "", f"turn {t}.", f"turn {t}"]))
            for t in range(900)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    monkeypatch.setattr(c, "BLOCK_BITS", 4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert key(c.repair_report(df).collect()) == key(report(rows, rows))


def test_repaired_turns_are_a_legal_conversation(spark):
    rows = c.damage(table(spark, SF, "conversations", "conv_id", "turn", "role", "text"))
    want = {str(r.conv_id): r.repaired_sha256 for r in c.repair_report(rows).collect()}
    got: dict = {}
    for r in c.repaired_turns(rows).orderBy("conv_id", "block", "nth").collect():
        got.setdefault(r.conv_id, []).append(r)
    for conv, turns in got.items():
        assert LEGAL.match("".join(t.role[0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == want[conv]
    assert {v for k, v in want.items() if k not in got} <= {c.EMPTY}
