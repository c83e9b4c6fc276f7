"""Deobfuscation of written text by a noisy channel over a character language model.

A writer may put digits and signs for letters, part letters by blanks or points, or repeat
them. Text that may hide such writing becomes a lattice: each character stands for itself, for
letters that look like it, for a gap, or for nothing. Viterbi search takes the path that the
language model and the costs of the channel make likeliest. Everything else has one path and
stays as it is.

The model has three letters of context over small letters, the bytes of characters beyond
ASCII, and the gap between words; its counts come from every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import portions, utf8, whole_text
from tillflow.llm.words import lowered

#: The gap, 26 small letters, 128 bytes beyond ASCII.
SYMBOLS = 1 + 26 + 128
# The letters that a digit or sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c",
}
# A star hides a vowel.
HIDES = {"*": "aeiou"}
# What may part letters, beside blanks.
PARTS = "-._*~'`^,:/"
#: Costs of the channel, in nats: a look-alike; a hidden vowel; a look-alike that is none; letters
#: joined over a sign or over a blank; a blank between single letters that is one; a letter
#: left out of a pair or of a longer run.
LOOKS, HIDDEN, SIGN, JOINED, UNSPACED, SPACED, OF_PAIR, OF_RUN = 1.0, 2.5, 7.0, 2.0, 0.5, 1.5, 5.0, 0.2
#: Bytes of a stretch decoded at once; longer ones are decoded piece after piece.
PIECE = 256
#: Bytes of decoded stretches that a task keeps.
KEPT = 1 << 22

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, SYMBOLS)
_BYTE = bytes([32, *range(97, 123), *range(128, 256)])
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = _CODE > 0
_STRONG, _WEAK, _PART = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
for _c in LOOKS_LIKE:  # digits, @ and $ may begin and end a word, the others stand within one
    (_STRONG if _c.isdigit() or _c in "@$" else _WEAK)[ord(_c)] = True
for _c in PARTS:
    _PART[ord(_c)] = True


def parted(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased rows with a line end behind each, and where each begins."""
    n = len(offs) - 1
    out = np.full(len(data) + n, 10, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offs))] = lowered(data)
    return out, offs + np.arange(n + 1)


# --- the language model -----------------------------------------------------------


def trigrams(data: np.ndarray) -> np.ndarray:
    """Codes of the letters and the first gap behind them, each with the two symbols before it in its word."""
    x = _CODE[data]
    b = np.append(0, x[:-1])
    a = np.where(b > 0, np.append([0, 0], x[:-2])[: len(x)], 0)
    return ((a * SYMBOLS + b) * SYMBOLS + x)[(x > 0) | (b > 0)]


def counted(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the trigrams of all documents: at most 155**3 codes, whatever the input."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, part, offs in portions(data, offsets):
                code, n = np.unique(trigrams(parted(part, offs)[0]).astype(np.int32), return_counts=True)
                total[code] += n
        code = np.flatnonzero(total)
        yield pa.record_batch([pa.array(code.astype(np.int32)), pa.array(total[code])], names=["code", "n"])

    found = docs.select(whole_text().alias("text")).mapInArrow(emit, "code int, n long")
    table = found.groupBy("code").agg(F.sum("n").alias("n")).toArrow().sort_by("code")
    return table["code"].to_numpy(), table["n"].to_numpy()


class Channel:
    """Restores stretches of text by the counts of a corpus."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        self._cost: np.ndarray | None = None
        self._known: dict[bytes, bytes] = {}
        self._kept = 0

    def __getstate__(self):
        return self.codes, self.counts

    def __setstate__(self, state):
        self.__init__(*state)

    @property
    def cost(self) -> np.ndarray:
        """-log P(symbol | two before it), lower orders mixed in; built once in a task."""
        if self._cost is None:
            n = np.zeros(SYMBOLS**3)
            n[self.codes] = self.counts
            n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
            pairs = n.sum(0)
            single = pairs.sum(0) + 1
            p1 = single / single.sum()
            p2 = (pairs + 20 * p1) / (pairs.sum(1, keepdims=True) + 20)
            n += 5 * p2
            n /= n.sum(2, keepdims=True)
            self._cost = -np.log(n, out=n).astype(np.float32)
        return self._cost

    # --- where to look ----------------------------------------------------------

    def stretches(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of what may hide something in parted rows (that begin at ``starts``).

        These are words with letters and look-alikes, with letters three times in a row, with
        a pair that one letter less makes likelier by the model, or with a sign between
        letters; and three or more single characters with one blank between.
        """
        n = len(data)
        space, letter, code = _SPACE[data], _LETTER[data], _CODE[data]
        same = np.append(data[1:] == data[:-1], False)
        triple = same & np.append(same[1:], False)
        run = triple | np.append(False, triple[:-1]) | np.append([False, False], triple[:-2])[:n]
        strong = _STRONG[data] & ~(run & ~((data >= 48) & (data < 58)))  # three signs alike are ornament
        core = letter | strong
        before, after = np.append(False, core[:-1]), np.append(core[1:], False)
        inside = before & after
        odd = strong | (_WEAK[data] & inside)
        sign = _PART[data] & inside
        # a pair: is one letter likelier?
        at = np.flatnonzero(same & letter & (data < 128) & ~run)
        at = at[at + 2 < n]
        p = np.where(at > 0, code[at - 1], 0)
        b, nxt = code[at], code[at + 2]
        cost = self.cost
        pair = at[cost[p, b, b] + cost[b, b, nxt] - cost[p, b, nxt] > OF_PAIR]
        marks = np.zeros(n + 1, np.int64)
        # one count for each reason that needs letters beside it, one for those that don't
        marks[1:] = np.cumsum(odd | sign)
        plain = np.zeros(n, bool)
        plain[pair] = True
        plain |= triple & letter
        alone = np.append(0, np.cumsum(plain))
        letters = np.append(0, np.cumsum(letter))
        edge = np.diff(np.append(True, space).astype(np.int8))
        first = np.flatnonzero(edge == -1)
        last = np.flatnonzero(edge == 1)  # every row ends in a line end
        places = np.flatnonzero(core)
        low, high = np.searchsorted(places, first), np.searchsorted(places, last)
        full = high > low
        begin, end = places[low[full]], places[high[full] - 1] + 1
        hides = ((marks[end] > marks[begin]) & (letters[end] > letters[begin])) | (alone[end] > alone[begin])
        spans = [np.stack([begin[hides], end[hides]], 1)]
        # single characters with one blank between
        lone = (last - first == 1) & core[first] & (data[first] < 128)
        row = np.searchsorted(starts, first, "right")
        joins = lone[1:] & lone[:-1] & (first[1:] - last[:-1] == 1) & (row[1:] == row[:-1])
        step = np.diff(np.concatenate([[False], joins, [False]]).astype(np.int8))
        a, z = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        long = z - a >= 2
        a, z = first[a[long]], last[z[long]]
        some = letters[z] > letters[a] if len(a) else np.zeros(0, bool)
        spans.append(np.stack([a[some], z[some]], 1))
        both = np.concatenate(spans)
        both = both[np.argsort(both[:, 0], kind="stable")]
        return both[:, 0], both[:, 1]

    # --- the lattice ----------------------------------------------------------------

    def _options(self, s: bytes, i: int) -> list[tuple[int, float]]:
        """What a byte may stand for, with costs: a symbol, the gap (0), nothing (-1)."""
        c = s[i]
        char = chr(c)
        if c in (9, 10, 11, 12, 13, 32):
            return [(0, SPACED), (-1, UNSPACED)]
        out: list[tuple[int, float]] = []
        if _CODE[c]:
            out.append((int(_CODE[c]), 0.0))
        for letter in LOOKS_LIKE.get(char, ""):
            out.append((ord(letter) - 96, LOOKS))
        if not _CODE[c]:
            gap = [(0, SIGN)] if out else [(0, 0.0), (-1, JOINED)]
            out += gap + [(ord(letter) - 96, HIDDEN) for letter in HIDES.get(char, "")]
        if i and s[i - 1] == c and c < 128 and len(out) and out[0][0] > 0:
            long = (i > 1 and s[i - 2] == c) or (i + 1 < len(s) and s[i + 1] == c)
            out.append((-1, OF_RUN if long else OF_PAIR))
        return out

    def _search(self, s: bytes) -> bytes:
        cost = self.cost
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(s)):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            options = self._options(s, i)
            for (a, b), (spent, path) in states.items():
                for symbol, extra in options:
                    if symbol < 0 or (symbol == 0 and b == 0):
                        key, total, way = (a, b), spent + extra, path
                    else:
                        key = (b, symbol) if symbol else (0, 0)
                        total, way = spent + extra + float(cost[a, b, symbol]), (path, symbol)
                    if key not in new or total < new[key][0]:
                        new[key] = (total, way)
            states = new
        ends = ((spent + (float(cost[a, b, 0]) if b else 0.0), i) for i, ((a, b), (spent, _)) in enumerate(states.items()))
        path = list(states.values())[min(ends)[1]][1]
        out = bytearray()
        while path is not None:
            path, symbol = path
            out.append(_BYTE[symbol])
        return bytes(reversed(out))

    def decoded(self, s: bytes) -> bytes:
        """The likeliest reading of a lower-cased stretch: words with single blanks between."""
        found = self._known.get(s)
        if found is None:
            pieces = [self._search(s[i : i + PIECE]) for i in range(0, len(s), PIECE)]
            found = b" ".join(b" ".join(pieces).split())
            self._kept += len(s) + len(found)
            if self._kept > KEPT:
                self._known.clear()
                self._kept = len(s) + len(found)
            self._known[s] = found
        return found

    def restored(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cased rows with every hiding stretch replaced by its reading, each row with a line end behind."""
        text, starts = parted(data, offs)
        begin, end = self.stretches(text, starts[:-1])
        if not len(begin):
            return text, starts
        raw, out, at, grown = text.tobytes(), [], 0, []
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            new = self.decoded(raw[a:b])
            out += [raw[at:a], new]
            grown.append(len(new) - (b - a))
            at = b
        out.append(raw[at:])
        total = np.append(0, np.cumsum(grown))
        return np.frombuffer(b"".join(out), np.uint8), starts + total[np.searchsorted(begin, starts)]
