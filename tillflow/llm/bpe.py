"""Byte-level BPE encoding and decoding with forced boundaries.

A merge builds a token of the vocabulary, so two bytes that stand side by side inside no
token are never joined: between them lies a certain cut. Texts are first split as the
vocabulary's pattern says, then at all certain cuts; each distinct fragment is encoded once,
on its own, and the results are put together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import portions, ragged, utf8, whole_text

#: Distinct fragments a Python worker keeps; then the older half goes.
KEPT_FRAGMENTS = 160_000

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0


@lru_cache(1)
def char_classes() -> np.ndarray:
    """For every code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            a, b = ord(every[run.start()]), ord(every[run.end() - 1])
            if a < 0xD800 <= b:
                out[a:0xD800] = out[0xE000 : b + 1] = kind
            else:
                out[a : b + 1] = kind
    return out


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: itself if it prints, else from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file, and the byte pairs inside tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.bytes_of = {i: to_bytes(t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        ids = model["vocab"]
        self.first = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.first[b] = ids[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        pair = left << 32 | right
        by = np.argsort(pair, kind="stable")
        pair, self.rank = pair[by], by
        once = np.append(True, pair[1:] != pair[:-1])
        self.pair, self.rank = pair[once], self.rank[once]
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        inside = np.zeros(1 << 16, bool)
        for token in map(to_bytes, model["vocab"]):
            t = np.frombuffer(token, np.uint8).astype(np.int64)
            inside[t[:-1] << 8 | t[1:]] = True
        self.inside = inside
        self.tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None


def encode_fragments(vocabulary: Vocabulary, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all fragments of ``data`` side by side: ids end to end, and their offsets.

    Every round joins in each fragment its pair of lowest rank, at all places where it stands.
    A new pair has a higher rank than the merge that made it, so this is the usual order.
    """
    ids = vocabulary.first[data]
    size = np.diff(offs)
    piece = np.repeat(np.arange(len(size)), size)
    done_ids, done_piece = [], []
    none = len(vocabulary.made)
    while len(ids):
        pair = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(vocabulary.pair, pair), len(vocabulary.pair) - 1)
        rank = np.where((vocabulary.pair[at] == pair) & (piece[:-1] == piece[1:]), vocabulary.rank[at], none)
        rank = np.append(rank, none)
        head = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        n = np.diff(np.append(head, len(ids)))
        best = np.minimum.reduceat(rank, head)
        stay = best < none
        over = np.repeat(~stay, n)
        done_ids.append(ids[over])
        done_piece.append(piece[over])
        chosen = (rank == np.repeat(best, n)) & ~over
        # of overlapping places, as in a run of one letter, every other one joins
        spot = np.flatnonzero(chosen)
        run = np.flatnonzero(np.append(True, np.diff(spot) != 1)) if len(spot) else spot
        length = np.diff(np.append(run, len(spot)))
        spot = spot[(np.arange(len(spot)) - np.repeat(run, length)) % 2 == 0]
        ids[spot] = vocabulary.made[rank[spot]]
        keep = ~over
        keep[spot + 1] = False
        ids, piece = ids[keep], piece[keep]
    all_ids, all_piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_ids, done_piece))
    by = np.argsort(all_piece, kind="stable")
    return all_ids[by], np.append(0, np.cumsum(np.bincount(all_piece, minlength=len(size))))


_ENDINGS = {"s", "t", "m", "d", "re", "ve", "ll"}


def pattern_starts(points: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Marks the code points where the usual pattern begins a new piece.

    Pieces: ``'s 't 're 've 'm 'll 'd``; letters, numbers or other signs with one space
    before; white space, of which a last space goes with what follows. The rows lie end to
    end; all are nonempty.
    """
    n = len(points)
    kind = char_classes()[points]
    row_start = np.zeros(n + 1, bool)
    row_start[offs] = True
    begins = row_start[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    last = np.append(space[:-1] & ~space[1:], False) & ~row_start[1:]  # of a run, with text after it
    begins |= last
    glued = np.flatnonzero(last & (points == 32)) + 1
    begins[glued] = False
    # an apostrophe alone, with neither space nor sign before it, may begin a short ending
    edge = np.append(begins[1:], True)
    quote = np.flatnonzero((points == 39) & begins & edge & ~row_start[1:])
    quote = quote[kind[quote + 1] == _LETTER]
    for q in quote.tolist():
        one = chr(points[q + 1])
        two = one + chr(points[q + 2]) if q + 2 < n and not row_start[q + 2] else ""
        size = 1 if one in _ENDINGS else 2 if two in _ENDINGS else 0
        if size:
            begins[q + 1] = False
            if q + 1 + size < n:
                begins[q + 1 + size] = True
    return begins


class Encoder:
    """Encodes texts with a vocabulary, keeping the ids of fragments seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def fragments(self, fragments: list[bytes]) -> list[bytes]:
        """The ids of each fragment, as 32-bit words."""
        if len(self.young) > KEPT_FRAGMENTS // 2:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, fragments))
        missing = {f for f, x in zip(fragments, found, strict=True) if x is None}
        if missing:
            known = {f: self.old[f] for f in missing if f in self.old}
            new = [f for f in missing if f not in known]
            if new:
                data = np.frombuffer(b"".join(new), np.uint8)
                offs = np.append(0, np.cumsum(np.fromiter(map(len, new), np.int64, len(new))))
                ids, at = encode_fragments(self.vocabulary, data, offs)
                raw, at = ids.astype("<i4").tobytes(), (at * 4).tolist()
                known |= {f: raw[a:b] for f, a, b in zip(new, at, at[1:], strict=False)}
            self.young |= known
            found = [known[f] if x is None else x for f, x in zip(fragments, found, strict=True)]
        return found

    def encode(self, data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of UTF-8 ``data``."""
        raw = data.tobytes()
        plain, special = self._special(raw, offs)
        size = np.diff(plain)
        full = np.flatnonzero(size > 0)
        ids_of: list[bytes] = [b""] * len(size)
        if len(full):
            starts = _byte_starts(data, plain, size)
            pair = data[:-1].astype(np.int64) << 8 | data[1:]
            starts[1:] |= ~self.vocabulary.inside[pair]
            # special tokens are no text: they are left out below
            cut = np.flatnonzero(starts)
            for s, e, _ in special:
                cut = cut[(cut <= s) | (cut >= e)]
            ends = np.append(cut[1:], len(data))
            pieces = [raw[a:b] for a, b in zip(cut.tolist(), ends.tolist(), strict=True)]
            encoded = self._with_special(pieces, cut, special)
            first = np.searchsorted(cut, plain[:-1])
            last = np.searchsorted(cut, plain[1:])
            for i in full.tolist():
                ids_of[i] = b"".join(encoded[first[i] : last[i]])
        at = np.searchsorted(plain, offs)
        return [np.frombuffer(b"".join(ids_of[a:b]), "<i4") for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]

    def _special(self, raw: bytes, offs: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Offsets cut around special tokens as well, and the places and ids of these."""
        found = []
        for token in self.vocabulary.special:
            if token.encode() in raw:
                for a, b in zip(offs.tolist(), offs[1:].tolist(), strict=False):
                    if token.encode() in raw[a:b]:
                        text = raw[a:b].decode()
                        for m in self.vocabulary.split_special.finditer(text):
                            s = a + len(text[: m.start()].encode())
                            found.append((s, s + len(m[0].encode()), self.vocabulary.special[m[0]]))
        found = sorted(set(found))
        # rows keep their offsets, empty ones too; a cut at a row's edge is there already
        more = np.array([x for s, e, _ in found for x in (s, e)], np.int64)
        return np.sort(np.concatenate([offs, np.setdiff1d(more, offs)])), found

    def _with_special(self, pieces: list[bytes], cut: np.ndarray, special: list[tuple[int, int, int]]) -> list[bytes]:
        encoded = self.fragments(pieces)
        for s, _, token in special:
            encoded[int(np.searchsorted(cut, s))] = token.to_bytes(4, "little")
        return encoded


def _byte_starts(data: np.ndarray, offs: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Marks the bytes where a piece of the pattern begins."""
    lead = (data & 0xC0) != 0x80
    where = np.flatnonzero(lead)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
    edges = np.searchsorted(where, offs[:-1][size > 0])
    starts = np.zeros(len(data), bool)
    starts[where[pattern_starts(points, np.append(edges, len(points)))]] = True
    return starts


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of ``ids``; bytes that form no character become U+FFFD, unknown ids nothing."""
    tokens, n = vocabulary.tokens, len(vocabulary.tokens)
    return b"".join([tokens[i] for i in ids.tolist() if i < n]).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    return Encoder(Vocabulary(path))


def _encoded(batches: Iterator[pa.RecordBatch], names: list[str], path: str) -> Iterator[pa.RecordBatch]:
    use = encoder(path)
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for i, j, part, offs in portions(data, offsets, 1 << 18):
            ids = use.encode(part, offs)
            at = np.append(0, np.cumsum([len(x) for x in ids]))
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
            yield pa.record_batch([*(batch.column(n).slice(i, j - i) for n in names), lists], names=[*names, "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], names: list[str], path: str) -> Iterator[pa.RecordBatch]:
    vocabulary = encoder(path).vocabulary
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.append(0, np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        for i in range(0, len(batch), 200):  # a few texts at a time bound the worker's memory
            part, ends = batch.slice(i, 200), at[i : i + 201].tolist()
            texts = [decode(vocabulary, flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])


def _kinds(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole ``text``. Null texts are empty. ``path``: on every executor."""
    names = docs.columns
    return docs.withColumn("_text", whole_text()).mapInArrow(lambda b: _encoded(b, names, path), f"{_kinds(docs)}, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of their ``ids``; null ids are none."""
    names = rows.columns
    return rows.mapInArrow(lambda b: _decoded(b, names, path), f"{_kinds(rows)}, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` in place of ``text``: `encode`, then `decoded`, in one Python worker a task.

    As two steps they take two workers a task, each with a vocabulary, and pass all ids through the JVM.
    """
    rest = docs.drop("text")
    names = rest.columns
    texts = docs.select(*names, whole_text().alias("_text"))
    both = lambda b: _decoded(_encoded(b, names, path), [*names, "ids"], path)
    return texts.mapInArrow(both, ", ".join(x for x in (_kinds(rest), "ids array<int>", "decoded string") if x))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Round trip of every document: the number and hash of its ids, and the hash of what they decode to."""
    both = round_trip(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
