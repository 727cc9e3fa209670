"""Knuth's agenda for lightest derivations, and the deductions that repair a
sequence of roles to ``(s?(ua)+)?``.

A deduction system is a weighted hypergraph: a deduction takes an edit item (a
row kept, given another role or deleted, a turn inserted, or a whole block
repaired) and an item for the rest of the sequence to an item for a longer
rest. A value is (cost, audit): edits cost something and put their letters in front
of the audit, so a smaller rest never gives a larger whole (monotone). Items leave
the agenda by cost, then by rows consumed, then by audit; every deduction raises the
cost or the rows consumed (superior), so an item's first departure is its
lightest derivation, and the agenda ends when the goals have left.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterable

# Costs of edits by their letters, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5

# States of the grammar: nothing yet, after s, after u, after a.
START, STATES, ACCEPTING = 0, (0, 1, 2, 3), (0, 3)
AFTER = {"s": 1, "u": 2, "a": 3}
INTO = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}


class Chain:
    """A long audit: a string in front of a shared rest."""

    __slots__ = ("head", "rest")

    def __init__(self, head: str, rest: Chain | None):
        self.head, self.rest = head, rest

    def __radd__(self, head: str) -> Chain:
        return Chain(head, self)

    def __lt__(self, other: Chain) -> bool:
        a, b, x, y = self, other, "", ""
        while True:
            if not x and not y and a is b:
                return False  # one and the same rest
            while not x and a is not None:
                x, a = a.head, a.rest
            while not y and b is not None:
                y, b = b.head, b.rest
            if not x or not y:
                return not x and bool(y)
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            x, y = x[n:], y[n:]


def lightest(axioms: Iterable[tuple], deductions: Callable, goals: set) -> dict:
    """(cost, audit, item) for each item that left the agenda before the last of
    the goals: its lightest derivation and the rest that it was derived from.
    ``axioms`` are (item, audit) of cost 0; ``deductions(item)`` yields
    (conclusion, rows consumed, cost, edit)."""
    count = itertools.count()  # what is pushed first leaves first, should all else be equal
    agenda = [(0, 0, audit, next(count), item, None) for item, audit in axioms]
    heapq.heapify(agenda)
    final: dict = {}
    left = set(goals)
    while agenda and left:
        cost, _, audit, _, item, rest = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit, rest)
        left.discard(item)
        for conclusion, consumed, more, edit in deductions(item):
            if conclusion not in final:
                heapq.heappush(agenda, (cost + more, consumed, edit + audit, next(count), conclusion, item))
    return final


def repairs(initials: str, faults: str, starts: Iterable[int], ends: Iterable[int]) -> dict[int, tuple[int, str]]:
    """Lightest repairs of rows from each state in ``starts`` to any in ``ends``.

    ``initials`` are the rows' roles (s, u, a or another character); rows whose fault
    is ``b`` or ``d`` must be deleted, ``t`` costs extra if it stays."""
    n = len(initials)

    def deductions(item):
        at, state = item  # the rows from ``at`` on are repaired, beginning in ``state``
        for before, role in INTO[state]:
            if at and faults[at - 1] not in "bd":
                extra = TRUNCATED if faults[at - 1] == "t" else 0
                if initials[at - 1] == role:
                    yield (at - 1, before), n - at + 1, COST[KEEP] + extra, KEEP
                elif role != "s":
                    yield (at - 1, before), n - at + 1, COST[REROLE] + extra, REROLE
            if role != "s":
                yield (at, before), n - at, COST[INSERT], INSERT
        if at:
            yield (at - 1, state), n - at + 1, COST[DELETE], DELETE

    goals = {(0, s) for s in starts}
    final = lightest([((n, e), "") for e in ends], deductions, goals)
    return {s: final[0, s][:2] for _, s in goals if (0, s) in final}


def chained(blocks: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[int]]:
    """The lightest repair of a row of blocks, each with its repairs by (state
    before, state after; -1 at the end): the cost and the state before each block."""
    n = len(blocks)

    def deductions(item):
        at, state = item
        if at:
            for (before, after), (cost, audit) in blocks[at - 1].items():
                if after == state:
                    yield (at - 1, before), n - at + 1, cost, audit

    item, states = (0, START), []
    final = lightest([((n, -1), Chain("", None))], deductions, {item})
    cost = final[item][0]
    while item[0] < n:
        states.append(item[1])
        item = final[item][2]
    return cost, states


def replay(audit: str, state: int, rows: Iterable[tuple[str, str]]):
    """Apply a repair: (edit, role, text) of each turn that results, where the
    ``rows`` are (role, text). A deleted row yields nothing."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = "assistant" if state == AFTER["u"] else "user"
        state = AFTER[role[:1]]
        yield edit, role, text
