"""Cheapest edits of a list of turns, by Hirschberg's divide and conquer over four states.

A repaired conversation gives the role initials ``(s?(ua)+)?``. Its states: nothing yet, after
``s``, after ``u``, after ``a``; it may end in the first and the last. An item is a turn, or a
block of turns, with the cost of going from each state to each other while it is used up, and
for each start the order of the audits of these ways. An audit ends with the letter that used
up the last turn (inserted turns stand before a kept one, not after it), so of two audits over
the same items none begins with the other. Therefore the order of two audits never depends on
what follows them, and the order of the states by audit can be carried along with their costs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

STATES = range(4)
NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: Where each role initial leads from each state; -1 where it may not stand.
_LEADS = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: Where an inserted turn, or one with a new role, leads.
_NEXT = (2, 2, 3, 2)
#: Cost of the turns inserted at the end, and their audit.
TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))

Item = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]


@lru_cache(maxsize=None)  # 4 initials, 3 conditions
def turn_ways(initial: str, condition: str) -> tuple[Item, tuple[tuple[str, ...], ...]]:
    """The item of one turn, and the audit from each state to each other.

    ``initial`` is that of its role, of any role but s, u and a the empty text;
    ``condition`` is ``bad`` (must go), ``truncated`` or ``sound``.
    """
    costs, orders, audits = [], [], []
    for start in STATES:
        best: list[tuple[int, str]] = [(NEVER, "")] * 4
        at = start
        for n in range(3):
            options = [(at, DELETE, "D")]
            if condition != "bad":
                extra = TRUNCATED if condition == "truncated" else 0
                options.append((_NEXT[at], REROLE + extra, "R"))
                options.append((_LEADS.get(initial, (-1,) * 4)[at], KEEP + extra, "K"))
            for end, cost, letter in options:
                if end >= 0:
                    best[end] = min(best[end], (n * INSERT + cost, "I" * n + letter))
            at = _NEXT[at]
        costs.append(tuple(c for c, _ in best))
        audits.append(tuple(a for _, a in best))
        by = sorted(STATES, key=lambda e: best[e][1])
        orders.append(tuple(by.index(e) for e in STATES))
    return (tuple(costs), tuple(orders)), tuple(audits)


def more_deleted(item: Item, n: int) -> Item:
    """``item`` followed by ``n`` turns that must go: none of them changes a state or an order."""
    costs, orders = item
    return tuple(tuple(min(NEVER, c + n * DELETE) for c in row) for row in costs), orders


def _forward(items: Sequence[Item], low: int, high: int, start: int) -> tuple[list[int], list[int]]:
    """Least cost to each state after ``items[low:high]``, and the place of its least audit."""
    cost, place = [NEVER] * 4, [4] * 4
    cost[start], place[start] = 0, 0
    for i in range(low, high):
        step, order = items[i]
        new, keys = [NEVER] * 4, [(9, 9)] * 4
        for s in STATES:
            if cost[s] >= NEVER:
                continue
            for e in STATES:
                c = cost[s] + step[s][e]
                if c < new[e] or (c == new[e] < NEVER and (place[s], order[s][e]) < keys[e]):
                    new[e], keys[e] = c, (place[s], order[s][e])
        by = sorted(STATES, key=keys.__getitem__)
        cost, place = new, [by.index(e) for e in STATES]
    return cost, place


def _backward(items: Sequence[Item], low: int, high: int, end: int) -> list[int]:
    """Least cost from each state before ``items[low:high]`` to ``end``."""
    cost = [NEVER] * 4
    cost[end] = 0
    for i in range(high - 1, low - 1, -1):
        step = items[i][0]
        cost = [min(NEVER, *(step[s][e] + cost[e] for e in STATES)) for s in STATES]
    return cost


def folded(items: Sequence[Item]) -> Item:
    """One item in the place of many."""
    rows = [_forward(items, 0, len(items), s) for s in STATES]
    return tuple(tuple(c) for c, _ in rows), tuple(tuple(p) for _, p in rows)


def last_state(items: Sequence[Item], start: int = 0) -> int:
    """The state after all items of the cheapest whole repair, of several the one of least audit."""
    cost, place = _forward(items, 0, len(items), start)
    return min(STATES, key=lambda e: (cost[e] + TAIL[e][0], place[e]))


def crossings(items: Sequence[Item], start: int, end: int) -> list[int]:
    """The state after each item on the cheapest way, of several the one of least audit.

    Forward and backward costs meet after the middle item, where the states whose sum is
    least are crossings of a cheapest way; the one of least audit up to there is taken and
    both halves are settled alike. Beside the result, memory holds four numbers a depth.
    """
    out = [end] * len(items)

    def settle(low: int, high: int, start: int, end: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        cost, place = _forward(items, low, middle, start)
        rest = _backward(items, middle, high, end)
        meet = min(STATES, key=lambda s: (cost[s] + rest[s], place[s]))
        out[middle - 1] = meet
        settle(low, middle, start, meet)
        settle(middle, high, meet, end)

    settle(0, len(items), start, end)
    return out
