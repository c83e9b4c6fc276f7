"""Repair of the turn structure of conversations.

Turns are cut into blocks by their number, so that a long conversation spreads over many
tasks. Within a block, and above the blocks over their summaries, the cheapest edits come from
Hirschberg's divide and conquer (`crossings`). Rows of a conversation are taken by turn (null
first), rows of one turn by role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import LEAST, stored
from tillflow.llm.crossings import (
    INSERT,
    REROLE,
    TAIL,
    Item,
    crossings,
    folded,
    last_state,
    more_deleted,
    turn_ways,
)

#: Turn numbers of a block, and blocks settled together, as a power of two.
BITS = 9
_SPACE = "\t\n\x0b\x0c\r "
_COST = {"K": 0, "R": REROLE, "D": 3, "I": INSERT}

_EDITS = (
    "conv_id long, block long, place long, edit string, times long, turn long, role string, "
    "new_role string, text string, fault string"
)
_ITEM = "conv_id long, block long, cost array<long>, place array<int>"
_SETTLED = "conv_id long, block long, first int, final int, ends boolean"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as ``conv_id, turn, role, text`` with faults that follow from a checksum of id and turn.

    Null ids, turns, roles and texts count as one space there; null ids and turns stay null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(fate == 4, "user").otherwise(space("role"))
    copies = F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))
    return (
        conversations.filter(fate != 0)
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
        .drop("copy")
    )


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that are equal in ``names``, from sorted batches; values as Python objects."""
    now, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        keys = zip(*(columns[batch.schema.get_field_index(n)] for n in names), strict=True)
        for key, row in zip(keys, zip(*columns, strict=True), strict=True):
            if key != now or not rows:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, rows


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` characters of text."""
    kept, held = [], 0
    for row in rows:
        kept.append(row)
        held += 64 + sum(len(v) for v in row if isinstance(v, str))
        if held >= size:
            yield _table(kept, schema)
            kept, held = [], 0
    if kept:
        yield _table(kept, schema)


_LONG, _TEXT = pa.int64(), pa.string()
_EDITS_ARROW = pa.schema([
    ("conv_id", _LONG), ("block", _LONG), ("place", _LONG), ("edit", _TEXT), ("times", _LONG), ("turn", _LONG),
    ("role", _TEXT), ("new_role", _TEXT), ("text", _TEXT), ("fault", _TEXT),
])
_ITEM_ARROW = pa.schema([("conv_id", _LONG), ("block", _LONG), ("cost", pa.list_(_LONG)), ("place", pa.list_(pa.int32()))])
_SETTLED_ARROW = pa.schema([("conv_id", _LONG), ("block", _LONG), ("first", pa.int32()), ("final", pa.int32()), ("ends", pa.bool_())])


# --- turns of one block -----------------------------------------------------------


def _last(text: str) -> str:
    return text.rstrip(_SPACE)[-1:]


def _faults(rows: list[tuple]) -> list[str]:
    """The first fault of each row ``turn, role, text, n, seen``; empty for none."""
    known: set[tuple[str, str]] = set()
    out = []
    for _, role, text, _, seen in rows:
        last = _last(text)
        again = seen or (role, text) in known
        known.add((role, text))
        out.append("blank" if not last else "duplicate" if again else "" if last in ".!?" else "truncated")
    return out


def _kinds(rows: list[tuple], faults: list[str]) -> tuple[tuple[str, str, int], ...]:
    """What the repair depends on: the initial, the condition and the copies of each row."""
    condition = {"blank": "bad", "duplicate": "bad", "truncated": "truncated", "": "sound"}
    return tuple(
        (role[:1] if role[:1] in ("s", "u", "a") else "", condition[fault], row_n)
        for (_, role, _, row_n, _), fault in zip(rows, faults, strict=True)
    )


def _items(kinds: tuple[tuple[str, str, int], ...]) -> list[Item]:
    return [
        more_deleted(turn_ways(initial, condition)[0], n - 1) if n > 1 else turn_ways(initial, condition)[0]
        for initial, condition, n in kinds
    ]


def _audits(kinds: tuple[tuple[str, str, int], ...], first: int, final: int | None) -> list[str]:
    """The audit of each row, inserted turns before it included; ``final`` None lets the block end a repair."""
    items = _items(kinds)
    if final is None:
        final = last_state(items, first)
    states = crossings(items, first, final)
    before = [first, *states[:-1]]
    return [turn_ways(i, c)[1][s][e] for (i, c, _), s, e in zip(kinds, before, states, strict=True)]


@lru_cache(maxsize=1 << 14)
def _short_audits(kinds: tuple[tuple[str, str, int], ...], first: int, final: int | None) -> list[str]:
    return _audits(kinds, first, final)  # most conversations are short and alike


def _edits(conv_id, block, rows: list[tuple], first: int, final: int | None, ends: bool) -> Iterator[tuple]:
    faults = _faults(rows)
    kinds = _kinds(rows, faults)
    audits = (_short_audits if len(kinds) <= 12 else _audits)(kinds, first, final)
    state, place = first, 0
    follows = ("user", "user", "assistant", "user")  # the role that an inserted turn has
    leads = (2, 2, 3, 2)

    def inserted(n: int) -> Iterator[tuple]:
        nonlocal state, place
        for _ in range(n):
            yield (conv_id, block, place, "I", 1, None, None, follows[state], "", None)
            state, place = leads[state], place + 1

    for (turn, role, text, n, _), fault, audit, (initial, _, _) in zip(rows, faults, audits, kinds, strict=True):
        yield from inserted(len(audit) - 1)
        letter = audit[-1]
        new = {"K": role, "R": follows[state], "D": None}[letter]
        yield (conv_id, block, place, letter, 1, turn, role, new, text, fault or None)
        place += 1
        if n > 1:  # the other copies
            copy = "blank" if fault == "blank" else "duplicate"
            yield (conv_id, block, place, "D", n - 1, turn, role, None, text, copy)
            place += 1
        if letter == "R":
            state = leads[state]
        elif letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[initial]
    if ends:
        yield from inserted(len(TAIL[state][1]))


# --- blocks of a conversation -------------------------------------------------------


def _dealt(rows: DataFrame, keys: list[str], order: list[str], fn: Callable, schema: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fn, schema)


def _most_blocks(blocks: DataFrame) -> int:
    return blocks.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _unpacked(cost: list[int], place: list[int]) -> Item:
    return tuple(tuple(cost[4 * s : 4 * s + 4]) for s in range(4)), tuple(tuple(place[4 * s : 4 * s + 4]) for s in range(4))


def _packed(conv_id, block, item: Item) -> tuple:
    return conv_id, block, [c for row in item[0] for c in row], [p for row in item[1] for p in row]


def _settled(items: DataFrame) -> DataFrame:
    """The first and last state of each block; blocks of blocks are settled before."""
    if _most_blocks(items) <= 1 << BITS:

        def settle_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for (conv_id,), group in _groups(batches, ["conv_id"]):
                    parts = [_unpacked(g[2], g[3]) for g in group]
                    states = crossings(parts, 0, last_state(parts))
                    for g, s, e in zip(group, [0, *states], states, strict=False):
                        yield conv_id, g[1], s, e, g is group[-1]

            yield from _batched(rows(), _SETTLED_ARROW)

        return _dealt(items, ["conv_id"], ["block"], settle_all, _SETTLED)

    above = items.withColumn("above", F.shiftright("block", BITS))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (conv_id, block), group in _groups(batches, ["conv_id", "above"]):
                yield _packed(conv_id, block, folded([_unpacked(g[2], g[3]) for g in group]))

        yield from _batched(rows(), _ITEM_ARROW)

    whole = _settled(stored(_dealt(above, ["conv_id", "above"], ["block"], fold, _ITEM), "blocks_of_blocks"))
    whole = whole.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_above"), "first", "final", "ends")
    placed = above.join(whole, above["conv_id"].eqNullSafe(whole["_conv"]) & (above["above"] == whole["_above"])).drop("_conv", "_above")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (conv_id, _), group in _groups(batches, ["conv_id", "above"]):
                first, final, ends = group[0][5:8]
                states = crossings([_unpacked(g[2], g[3]) for g in group], first, final)
                for g, s, e in zip(group, [first, *states], states, strict=False):
                    yield conv_id, g[1], s, e, ends and g is group[-1]

        yield from _batched(rows(), _SETTLED_ARROW)

    return _dealt(placed, ["conv_id", "above"], ["block"], settle, _SETTLED)


def repaired(conversations: DataFrame) -> DataFrame:
    """The cheapest edits that give each conversation the role initials ``(s?(ua)+)?``.

    Takes ``conv_id, turn, role, text`` and ignores other columns. Null roles and texts count
    as one space; null ids are one conversation; null turns come first. A row is ``blank``
    (white space only), ``duplicate`` (role and text stand earlier in its conversation; the
    second of two equal rows too) or ``truncated`` (its last character but white space is none
    of ``.!?``), whatever comes first. Keeping costs 0, another role 2, deleting 3, inserting
    an empty turn 2; blank and duplicate rows must go, a truncated one that stays costs 1
    more. Of equal costs the edits whose letters (K, R, D, I) are least are taken.

    Returns a row for each edit: ``conv_id, block, place`` (blocks and places in order),
    ``edit, times`` (more than 1 where equal rows are deleted together), ``turn, role, text``
    and ``fault`` of the row (turn, role and fault null where inserted), ``new_role`` (null
    where deleted). An empty table gives no rows.

    Equal rows are counted before they are shuffled. A task holds one block of a conversation:
    its rows of up to 512 turn numbers.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    turn = F.col("turn").cast("long")
    counted = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
        F.coalesce(F.shiftright(turn, BITS), F.lit(LEAST)).alias("block"),
    ).groupBy("conv_id", "block", "turn", "role", "text").agg(F.count("*").alias("n"))
    rows = stored(counted, "turns")
    most = _most_blocks(rows.select("conv_id", "block").distinct())
    rows = rows.withColumn("seen", F.lit(False)) if most < 2 else _with_earlier_blocks(rows)
    rows = rows.select("conv_id", "block", "turn", "role", "text", "n", "seen")
    keys, order = ["conv_id", "block"], ["turn", "role", "text"]
    if most < 2:

        def repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def edits() -> Iterator[tuple]:
                for (conv_id, block), group in _groups(batches, keys):
                    yield from _edits(conv_id, block, [g[2:7] for g in group], 0, None, True)

            yield from _batched(edits(), _EDITS_ARROW)

        return _dealt(rows, keys, order, repair_whole, _EDITS)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple]:
            for (conv_id, block), group in _groups(batches, keys):
                turns = [g[2:7] for g in group]
                yield _packed(conv_id, block, folded(_items(_kinds(turns, _faults(turns)))))

        yield from _batched(items(), _ITEM_ARROW)

    settled = stored(_settled(stored(_dealt(rows, keys, order, summarise, _ITEM), "blocks")), "settled")
    settled = settled.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "first", "final", "ends")
    placed = rows.join(settled, rows["conv_id"].eqNullSafe(settled["_conv"]) & (rows["block"] == settled["_block"]))

    def repair_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            for (conv_id, block), group in _groups(batches, keys):
                first, final, ends = group[0][7:10]
                yield from _edits(conv_id, block, [g[2:7] for g in group], first, final, ends)

        yield from _batched(edits(), _EDITS_ARROW)

    return _dealt(placed.drop("_conv", "_block"), keys, order, repair_blocks, _EDITS)


def _with_earlier_blocks(rows: DataFrame) -> DataFrame:
    """``seen``: whether role and text stand in an earlier block of the conversation.

    They are told by their SHA-256. Only what stands in several blocks is joined.
    """
    said = F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text"), 256)
    marked = rows.withColumn("said", said)
    first = (
        marked.groupBy("conv_id", "said").agg(F.min("block").alias("_first"), F.max("block").alias("_last"))
        .filter("_first < _last").select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "_first")
    )
    joined = marked.join(first, marked["conv_id"].eqNullSafe(first["_conv"]) & (marked["said"] == first["_said"]), "left")
    return stored(joined.withColumn("seen", F.coalesce(F.col("_first") < F.col("block"), F.lit(False))).drop("_conv", "_said", "_first", "said"), "seen")


# --- figures of each conversation ------------------------------------------------------

_DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_DIGEST_ARROW = pa.schema([
    ("conv_id", _LONG), *((n, _LONG) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", _TEXT), ("repaired_sha256", _TEXT),
])
_LEGAL = {"su", "ua", "au"}


class _Figures:
    """Added up row by row, in the order of a conversation's edits."""

    def __init__(self) -> None:
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.initial: str | None = None
        self.audit: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def add(self, edit, times, turn, role, new_role, text, fault) -> None:
        self.audit.append(edit * times)
        self.cost += _COST[edit] * times + (fault == "truncated" and edit != "D")
        if new_role is not None:
            self.hash.update((("\n" if self.any else "") + new_role + ":" + text).encode())
            self.any = True
        if edit == "I":
            return
        if fault:
            self.faults[fault] += times
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.illegal += times - 1  # a copy after its like
        self.initial = initial
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.turn:
                self.turns += 1
            self.high = self.turn = turn

    def row(self, conv_id) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def digest(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Figures of every id of ``conversations`` from the repair of ``rows``.

    One pass over the sorted edits that holds a conversation's audit and a running hash, not
    its texts. An id without rows gets zeros, an empty audit and the hash of nothing.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(LEAST).alias("block")).distinct()
    edits = repaired(rows).unionByName(ids.withColumn("place", F.lit(-1).cast("long")), allowMissingColumns=True)
    names = [f.name for f in _EDITS_ARROW]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def figures() -> Iterator[tuple]:
            now, sums = None, None
            for batch in batches:
                columns = [batch.column(n).to_pylist() for n in names]
                for conv_id, _, _, edit, times, turn, role, new_role, text, fault in zip(*columns, strict=True):
                    if sums is None or conv_id != now:
                        if sums is not None:
                            yield sums.row(now)
                        now, sums = conv_id, _Figures()
                    if edit is not None:
                        sums.add(edit, times, turn, role, new_role, text, fault)
            if sums is not None:
                yield sums.row(now)

        yield from _batched(figures(), _DIGEST_ARROW)

    return _dealt(edits.select(*names), ["conv_id"], ["block", "place"], add_up, _DIGEST)


SQL = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(b))
), fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
      regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS fate
  FROM conversations, crc
), hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fate WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM fated WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS cut FROM hurt
), told AS (
  SELECT *, left(role, 1) AS r,
    CASE WHEN cut = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM placed
), way AS (
  -- from each state (w0 nothing yet, w1 after s, w2 after u, w3 after a) the cheapest rest: its cost, audit and texts
  SELECT conv_id, max(n) + 1 AS i,
    {'c': 0, 'l': '', 't': []::VARCHAR[]} AS w0, {'c': 4, 'l': 'II', 't': ['user:', 'assistant:']} AS w1,
    {'c': 2, 'l': 'I', 't': ['assistant:']} AS w2, {'c': 0, 'l': '', 't': []::VARCHAR[]} AS w3
  FROM told GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i,
    list_min([c0, {'c': c2.c + 2, 'l': 'I' || c2.l, 't': list_concat(['user:'], c2.t)},
      {'c': c3.c + 4, 'l': 'II' || c3.l, 't': list_concat(['user:', 'assistant:'], c3.t)}]),
    list_min([c1, {'c': c2.c + 2, 'l': 'I' || c2.l, 't': list_concat(['user:'], c2.t)},
      {'c': c3.c + 4, 'l': 'II' || c3.l, 't': list_concat(['user:', 'assistant:'], c3.t)}]),
    list_min([c2, {'c': c3.c + 2, 'l': 'I' || c3.l, 't': list_concat(['assistant:'], c3.t)}]),
    list_min([c3, {'c': c2.c + 2, 'l': 'I' || c2.l, 't': list_concat(['user:'], c2.t)}])
  FROM (
    SELECT w.conv_id, w.i - 1 AS i, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END AS bad,
      CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS cutoff,
      list_min([{'c': w0.c + 3, 'l': 'D' || w0.l, 't': w0.t},
        {'c': w2.c + bad + cutoff + 2, 'l': 'R' || w2.l, 't': list_concat(['user:' || text], w2.t)},
        {'c': w1.c + bad + cutoff + CASE r WHEN 's' THEN 0 ELSE 1000000000 END, 'l': 'K' || w1.l, 't': list_concat([role || ':' || text], w1.t)},
        {'c': w2.c + bad + cutoff + CASE r WHEN 'u' THEN 0 ELSE 1000000000 END, 'l': 'K' || w2.l, 't': list_concat([role || ':' || text], w2.t)}]) AS c0,
      list_min([{'c': w1.c + 3, 'l': 'D' || w1.l, 't': w1.t},
        {'c': w2.c + bad + cutoff + 2, 'l': 'R' || w2.l, 't': list_concat(['user:' || text], w2.t)},
        {'c': w2.c + bad + cutoff + CASE r WHEN 'u' THEN 0 ELSE 1000000000 END, 'l': 'K' || w2.l, 't': list_concat([role || ':' || text], w2.t)}]) AS c1,
      list_min([{'c': w2.c + 3, 'l': 'D' || w2.l, 't': w2.t},
        {'c': w3.c + bad + cutoff + 2, 'l': 'R' || w3.l, 't': list_concat(['assistant:' || text], w3.t)},
        {'c': w3.c + bad + cutoff + CASE r WHEN 'a' THEN 0 ELSE 1000000000 END, 'l': 'K' || w3.l, 't': list_concat([role || ':' || text], w3.t)}]) AS c2,
      list_min([{'c': w3.c + 3, 'l': 'D' || w3.l, 't': w3.t},
        {'c': w2.c + bad + cutoff + 2, 'l': 'R' || w2.l, 't': list_concat(['user:' || text], w2.t)},
        {'c': w2.c + bad + cutoff + CASE r WHEN 'u' THEN 0 ELSE 1000000000 END, 'l': 'K' || w2.l, 't': list_concat([role || ':' || text], w2.t)}]) AS c3
    FROM way w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i - 1
  )
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM told GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w0.c, 0)::BIGINT AS cost,
  coalesce(w0.l, '') AS audit, sha256(coalesce(array_to_string(w0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM way WHERE i = 1) w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""
