"""Near duplicates by the Jaccard similarity of their word shingles.

Candidates meet under bands of min-hashes; a pair at the threshold of 0.8 misses all bands
with a chance of 1.3e-7, a closer one with less. Within a band's file the sets of shingles
themselves are compared, so every link is exact. Equal sets are one row from the start, and
files of the same members are compared once. As in ``simhash``, only links that join
something new are kept, and larger files are dealt out in cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import simhash
from tillflow.llm.common import LEAST, ordered_id, ragged, stored, utf8, whole_text
from tillflow.llm.components import smallest_reachable

#: Bands of min-hashes and hashes of each: pairs of similarity s share none with a chance of (1 - s**ROWS)**BANDS.
BANDS, ROWS = 40, 5
#: Sets, and shingles of sets, that a part of a file holds, about.
CELL, CELL_SHINGLES = 1024, 1 << 19
#: Rows that go to Python or come back together.
_TOGETHER = 256

_MIX = np.random.default_rng(20).integers(0, 2**63, (2, BANDS * ROWS), np.uint64)
_ADD, _TIMES = _MIX[0], _MIX[1] * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, size: int, seed: int = 42) -> np.ndarray:
    """The distinct XXH64 of all ``size`` words in a row, in order; fewer words are one shingle, no words give 0."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return np.zeros(1, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1]).tolist()
    size = min(size, len(words))
    ends = (ends[size - 1 :] - 1).tolist()
    return np.unique(np.fromiter((h(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends)))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The key of each band, as signed longs."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        part = hashes[None, at : at + (1 << 10)] ^ _ADD[:, None]
        part *= _TIMES[:, None]
        np.minimum(least, part.min(1), out=least)
    rows = least.reshape(BANDS, ROWS).astype("<u8")
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), n) for n, row in enumerate(rows)], np.uint64).view(np.int64)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    data, offs = utf8(batch.column("text"))
    return (shingles(data[a:b].tobytes(), size) for a, b in zip(offs[:-1], offs[1:], strict=True))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), _TOGETHER):
            yield batch.slice(at, _TOGETHER)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, ord, tid, sid, n, keys`` of each document: ``sid`` names its set of ``n`` shingles."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sids, sizes, keys = [], [], []
            for s in _sets(batch, size):
                sids.append(xxhash.xxh64_intdigest(s.astype("<u8").tobytes()))
                sizes.append(len(s))
                keys.append(bands(s))
            cols = [*(batch.column(c) for c in ("doc_id", "ord", "tid")), pa.array(np.array(sids, np.uint64).view(np.int64)), pa.array(sizes, pa.int64())]
            keys = pa.ListArray.from_arrays(np.arange(len(sids) + 1, dtype=np.int32) * BANDS, np.concatenate(keys))
            yield pa.record_batch([*cols, keys], names=["doc_id", "ord", "tid", "sid", "n", "keys"])

    return _texts(docs).mapInArrow(emit, "doc_id long, ord long, tid long, sid long, n long, keys array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), ordered_id().alias("ord"), F.xxhash64(text).alias("tid"), text.alias("text"))


def _whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """``sid, shingles`` of each row, the shingles as 64-bit words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            found = pa.array([s.astype("<u8").tobytes() for s in _sets(batch, size)], pa.binary())
            yield pa.record_batch([batch.column("sid"), found], names=["sid", "shingles"])

    return texts.select("sid", "text").mapInArrow(emit, "sid long, shingles binary")


def forest(data: np.ndarray, offsets: np.ndarray, split: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of sets of similarity ``percent`` or more connect: at most one a set.

    Set k is ``data[offsets[k]:offsets[k + 1]]``, without repeats. ``split``: 0, or how many
    sets belong to the first of two groups; then only pairs across the groups count.
    """
    names, data = np.unique(data, return_inverse=True)
    sizes = np.diff(offsets)
    side = np.arange(len(sizes)) < split
    marked = np.zeros(len(names), bool)
    a, b = [], []
    unseen = np.arange(len(sizes))
    while len(unseen):
        queue, unseen = [unseen[0]], unseen[1:]
        while queue and len(unseen):
            at = queue.pop()
            # sizes alone rule most others out
            close = np.minimum(sizes[unseen], sizes[at]) * 100 >= np.maximum(sizes[unseen], sizes[at]) * percent
            if split:
                close &= side[unseen] != side[at]
            some = unseen[close]
            if not len(some):
                continue
            own = data[offsets[at] : offsets[at + 1]]
            marked[own] = True
            hits = marked[data[ragged(offsets[some], sizes[some])]]
            marked[own] = False
            both = np.add.reduceat(hits, np.cumsum(sizes[some]) - sizes[some], dtype=np.int64)
            new = some[both * 100 >= (sizes[some] + sizes[at] - both) * percent]
            if len(new):
                a.append(np.full(len(new), at))
                b.append(new)
                queue.extend(new.tolist())
                unseen = np.setdiff1d(unseen, new, assume_unique=True)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links(dealt: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of the cells of ``dealt``, whose rows come cell by cell, the first group first."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in _pieces(batches):
            out: list[tuple[int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("key", "i", "j", "second", "sid", "shingles"))
            for key, i, j, second, sid, found in zip(*columns, strict=True):
                if (key, i, j) != cell:
                    out += _joined(cell, rows, percent)
                    cell, rows = (key, i, j), []
                rows.append((second, sid, found))
            yield _pairs(out)
        yield _pairs(_joined(cell, rows, percent))

    return dealt.mapInArrow(emit, "a long, b long")


def _joined(cell: tuple | None, rows: list[tuple[bool, int, bytes]], percent: int) -> list[tuple[int, int]]:
    if len(rows) < 2:
        return []
    data = np.frombuffer(b"".join(r[2] for r in rows), "<u8")
    offsets = np.append(0, np.cumsum([len(r[2]) // 8 for r in rows]))
    split = sum(not r[0] for r in rows) if cell[1] != cell[2] else 0
    if cell[1] != cell[2] and split in (0, len(rows)):
        return []
    x, y = forest(data, offsets, split, percent)
    return [(rows[p][1], rows[q][1]) for p, q in zip(x.tolist(), y.tolist(), strict=True)]


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def similar_links(docs: DataFrame, sketched: DataFrame, size: int, percent: int, cell: int, cell_shingles: int) -> DataFrame:
    """Links ``a, b`` between distinct sets (``sid``) that connect all similar pairs of a band."""
    nodes = sketched.groupBy("sid").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    filed = stored(nodes.select("sid", "n", F.explode("keys").alias("key")), "bands")
    files = filed.groupBy("key").agg(
        F.count("*").alias("m"),
        F.sum("n").alias("weight"),
        F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("members"),
        F.sum(F.xxhash64("sid", F.lit(1)).cast("decimal(20,0)")).alias("members2"),
    )
    parts = F.ceil(F.greatest(F.col("m") / cell, F.col("weight") / cell_shingles)).cast("int")
    compared = files.filter("m > 1").groupBy("m", "weight", "members", "members2").agg(F.min("key").alias("key")).select("key", parts.alias("parts"))
    shared = stored(filed.join(compared, "key").select("sid", "key", "parts"), "shared_bands")
    # one document of each set that is compared
    wanted = sketched.join(shared.select("sid").distinct(), "sid").groupBy("sid").agg(F.min(F.struct("ord", "tid")).alias("at")).select("sid", "at.*")
    texts = _texts(docs).join(wanted, ["ord", "tid"]).dropDuplicates(["sid"])
    sets = stored(_whole_sets(texts, size), "sets")
    # a file of several parts becomes a cell for each pair of parts: no task holds a whole file
    mine: Column = F.pmod(F.xxhash64("sid", F.lit(2)), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j")))
    cells = (
        shared.withColumn("mine", mine)
        .select("sid", "key", "mine", F.explode(others).alias("c"))
        .select("key", "c.i", "c.j", (F.col("mine") == F.col("c.j")).alias("second"), "sid")
    )
    dealt = cells.join(sets, "sid").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "second", "sid")
    return _links(dealt.select("key", "i", "j", "second", "sid", "shingles"), percent)


def print_links(docs: DataFrame, sketched: DataFrame, distance: int = 3) -> DataFrame:
    """Links ``a, b`` between sets (``sid``) of documents whose SimHash fingerprints differ in ``distance`` bits or less.

    The fingerprints are those of `simhash`. Texts of one fingerprint are linked to the least of their sets,
    and the least sets of close fingerprints to each other.
    """
    texts = _texts(docs).select(F.col("tid").alias("doc_id"), "text")
    prints = simhash.fingerprints(texts).select(F.col("doc_id").alias("tid"), "fp").distinct()
    held = stored(sketched.select("tid", "sid").distinct().join(prints, "tid").select("fp", "sid").distinct(), "prints")
    least = held.groupBy("fp").agg(F.min("sid").alias("a"))
    close = simhash.near_links(least.select("fp"), distance).select(F.col("a").alias("fp"), F.col("b").alias("other"))
    ends = least.select(F.col("fp").alias("other"), F.col("a").alias("b"))
    across = close.join(least, "fp").join(ends, "other").select("a", "b")
    return held.join(least, "fp").select("a", F.col("sid").alias("b")).unionByName(across).filter("a <> b")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, cell: int = CELL, cell_shingles: int = CELL_SHINGLES, distance: int | None = None
) -> DataFrame:
    """Group documents whose sets of shingles have a Jaccard similarity of ``percent`` or more, directly or through others.

    With ``distance`` documents whose SimHash fingerprints differ in so many bits or less are linked too.

    Shingles are ``size`` words in a row, words split at ASCII white space after lowering
    A-Z; fewer words are one shingle. Documents without words are one group. Null texts are empty.

    Returns ``doc_id`` and ``component_id``, the smallest ``doc_id`` of the group, a row for
    each input row. A null id sorts before all and makes the group's id null. ``percent``
    below 80 would need more bands.
    """
    if percent < 80:
        raise ValueError("the bands are made for a similarity of 80 percent or more")
    sketched = stored(sketches(docs, size), "sketches")
    links = similar_links(docs, sketched, size, percent, cell, cell_shingles)
    if distance is not None:
        links = links.unionByName(print_links(docs, sketched, distance))
    roots = smallest_reachable(links)
    groups = sketched.groupBy("sid").agg(F.min("ord").alias("first"))
    placed = groups.join(roots, groups["sid"] == roots["node"], "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = placed.join(least, "root").select("sid", F.when(F.col("least") != LEAST, F.col("least")).alias("component_id"))
    return sketched.join(named, "sid").select("doc_id", "component_id")
