"""Conversation repair against a search over all edits, and over blocks of a few turns."""

import hashlib
import heapq
import random
import zlib

import pytest

from tillflow.llm import conversations, crossings

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, block int, fault string"


def hurt(rows):
    out = []
    for c, t, r, x in rows:
        space = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        r, x = space(r), space(x)
        if fate == 0:
            continue
        if fate == 1:
            x = ""
        if fate == 2:
            x = "".join(ch for ch in x if ch not in ".!?")
        if fate == 4:
            r = "user"
        out += [(c, t, r, x)] * (2 if fate == 3 else 1)
    return out


def cheapest(turns):
    """Search by cost and then audit, with no state merged; for short conversations."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, kept
        for role in ("user", "assistant"):
            if (state, role[0]) in after:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*kept, role + ":")))
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, kept))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            if (state, role[:1]) in after:
                heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*kept, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if (state, new[0]) in after:
                    heapq.heappush(heap, (more + 2, audit + "R", i + 1, new[0], (*kept, f"{new}:{text}")))


def figures(original, rows):
    out = []
    for c in {r[0] for r in original}:
        turns = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known, faults, told = set(), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, []
        for _, role, text in turns:
            last = text.rstrip(SPACE)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in known else "" if last in ".!?" else "truncated"
            known.add((role, text))
            faults[fault] += 1
            told.append((role, text, fault))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        cost, audit, kept = cheapest(told)
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=str)


def conversation(r, c):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s"]
    texts = ["Yes.", "No!", "what", "", "  \n", None, "é?", "Yes. ", "long " * 3000 + "."]
    turns = [r.choice([None, 0, 1, 1, 2, 3, 5, 9, -2]) for _ in range(r.randint(1, 5))]
    return [(c, t, r.choice(roles), r.choice(texts)) for t in turns]


@pytest.mark.parametrize("bits", [9, 1])
def test_repair(spark, monkeypatch, bits):
    """Null ids, turns, roles and texts, equal rows, ties of a turn, other columns of the names used inside."""
    monkeypatch.setattr(conversations, "BITS", bits)
    r = random.Random(bits)
    rows = [x for c in [*range(40), None] for x in conversation(r, c)]
    rows += rows[:5]
    df = spark.createDataFrame([(*x, 1, "f") for x in rows], SCHEMA).repartition(3)
    got = conversations.digest(df, conversations.damaged(df)).collect()
    assert sorted(map(tuple, got), key=str) == figures(rows, hurt(rows))
    assert {c for c, *_ in got} == {x[0] for x in rows}


def test_edits(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Cut")]
    df = spark.createDataFrame([(*x, 0, "") for x in rows], SCHEMA)
    got = conversations.repaired(df).orderBy("place").select("edit", "new_role", "fault").collect()
    assert [tuple(x) for x in got] == [("K", "user", None), ("D", None, "duplicate"), ("K", "assistant", "truncated")]


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repaired(none).count() == 0
    assert conversations.digest(none, none).count() == 0
    gone = spark.createDataFrame([(4, 1, "user", "x", 0, "")], SCHEMA)
    row = conversations.digest(gone, gone.filter("false")).first()
    assert tuple(row) == (4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_equal_rows_are_counted_before_they_meet(spark):
    df = spark.range(20000).selectExpr("1L conv_id", "0L turn", "'user' role", "'Hi.' text", "0 block", "'' fault")
    row = conversations.digest(df, df).first()
    assert (row.duplicate, row.illegal, row.cost) == (19999, 19999, 19999 * 3 + 2)
    assert row.audit == "K" + "D" * 19999 + "I"
    assert conversations.repaired(df).count() == 3


def test_long_conversation_is_settled_in_blocks(spark, monkeypatch):
    """Blocks of blocks give what one block gives."""
    r = random.Random(5)
    rows = [(7, t, r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", "c?", "", f"{t}!"]), 0, "") for t in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(conversations, "BITS", 12)
    whole = conversations.digest(df, df).collect()
    monkeypatch.setattr(conversations, "BITS", 3)
    assert conversations.digest(df, df).collect() == whole


def test_folded_items_keep_costs_and_order():
    r = random.Random(3)
    for _ in range(200):
        items = [crossings.turn_ways(r.choice(["s", "u", "a", ""]), r.choice(["bad", "truncated", "sound"]))[0] for _ in range(r.randint(1, 9))]
        cut = r.randint(0, len(items))
        parts = [crossings.folded(p) for p in (items[:cut], items[cut:]) if p]
        end = crossings.last_state(items)
        assert crossings.last_state(parts) == end
        states = crossings.crossings(items, 0, end)
        assert crossings.crossings(parts, 0, end)[0] == states[cut - 1 if 0 < cut else -1]
