"""SimHash near-duplicates: fingerprints of word shingles, linked through shared blocks.

A fingerprint of 64 bits is cut into ``blocks`` blocks. Two that differ in ``distance`` bits
agree in at least ``blocks - distance`` blocks, so each fingerprint is filed under every
choice of that many blocks, and close pairs share a file. Equal fingerprints are one row
from the start. Within a file every pair is verified, but only links that join something
new are kept: at most one for each fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import LEAST, ordered_id, stored, utf8, whole_text
from tillflow.llm.components import smallest_reachable

#: Fingerprints of a file that one row of work compares; larger files are dealt out in cells.
CELL = 1024


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Majority of each bit over the XXH64 of all shingles; even votes give 0."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1]).tolist()
    size = min(size, len(words))
    ends = (ends[size - 1 :] - 1).tolist()
    hashes = np.fromiter((h(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = votes * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, ord, fp`` for each document; ``fp`` is the fingerprint as a signed long.

    Shingles are ``size`` words in a row, repeats included, words split at ASCII white space
    after lowering A-Z; fewer words are one shingle, no words give 0. Null texts are empty.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            got = np.fromiter(
                (fingerprint(data[a:b].tobytes(), size, seed) for a, b in zip(offs[:-1], offs[1:], strict=True)),
                np.uint64,
                len(batch),
            )
            yield pa.record_batch([batch.column("doc_id"), batch.column("ord"), pa.array(got.view(np.int64))], names=["doc_id", "ord", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ordered_id().alias("ord"), whole_text().alias("text"))
    return rows.mapInArrow(emit, "doc_id long, ord long, fp long")


def block_keys(fp: str, blocks: int, distance: int) -> Column:
    """The keys of all choices of ``blocks - distance`` blocks; each tells its choice apart."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = 0
        for b in chosen:
            mask |= ((1 << (edges[b + 1] - edges[b])) - 1) << edges[b]
        signed = mask - 2**64 if mask >= 2**63 else mask
        keys.append(F.struct(F.lit(n).alias("choice"), F.col(fp).bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def forest(values: np.ndarray, split: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within ``distance`` bits connect: at most one a value.

    ``split``: 0, or how many values belong to the first of two groups; then only pairs
    across the groups count.
    """
    a, b = [], []
    side = np.arange(len(values)) < split
    unseen = np.arange(len(values))
    while len(unseen):
        queue, unseen = [unseen[0]], unseen[1:]
        while queue and len(unseen):
            at = queue.pop()
            near = np.bitwise_count(values[unseen] ^ values[at]) <= distance
            if split:
                near &= side[unseen] != side[at]
            if near.any():
                new = unseen[near]
                a.append(np.full(len(new), at))
                b.append(new)
                queue.extend(new.tolist())
                unseen = unseen[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def near_links(prints: DataFrame, distance: int = 3, blocks: int = 5, cell: int = CELL) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect all close pairs."""
    if not distance < blocks:
        raise ValueError("blocks must be more than distance")
    filed = stored(prints.select("fp", F.explode(block_keys("fp", blocks, distance)).alias("k")).select("fp", "k.*"), "blocks")
    sizes = filed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / cell).cast("int")
    shared = filed.join(sizes, ["choice", "bits"]).withColumn("parts", parts)
    # a file of several parts becomes a cell for each pair of parts: no task holds a whole file
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j")))
    cells = (
        shared.withColumn("mine", mine)
        .select("fp", "choice", "bits", "mine", F.explode(others).alias("c"))
        .select("choice", "bits", "c.i", "c.j", (F.col("mine") == F.col("c.j")).alias("second"), "fp")
    )
    dealt = cells.repartition("choice", "bits", "i", "j").sortWithinPartitions("choice", "bits", "i", "j", "second", "fp")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            heads = _heads(table)
            done, rest = table.slice(0, heads[-1]), table.slice(heads[-1])
            if len(done):
                yield _links(done, heads, distance)
        if rest is not None and len(rest):
            yield _links(rest, np.zeros(1, np.int64), distance)

    return dealt.mapInArrow(emit, "a long, b long")


def _heads(table: pa.Table) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[:1] = True
    for c in ("choice", "bits", "i", "j"):
        v = table[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _links(table: pa.Table, heads: np.ndarray, distance: int) -> pa.RecordBatch:
    fp = table["fp"].to_numpy().view(np.uint64)
    cross = table["i"].to_numpy() != table["j"].to_numpy()
    second = table["second"].to_numpy()
    ends = np.append(heads[heads < len(table)][1:], len(table))
    found = []
    for s, e in zip(heads, ends, strict=False):
        if e - s == 2 and not cross[s]:
            if (int(fp[s]) ^ int(fp[s + 1])).bit_count() <= distance:
                found.append((fp[s : s + 1], fp[s + 1 : e]))
            continue
        x, y = forest(fp[s:e], int((~second[s:e]).sum()) if cross[s] else 0, distance)
        found.append((fp[s:e][x], fp[s:e][y]))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
    return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 3, blocks: int = 5, seed: int = 42, cell: int = CELL) -> DataFrame:
    """Group documents whose fingerprints differ in at most ``distance`` bits, directly or through others.

    Returns ``doc_id``, ``fp`` (signed long) and ``component_id``, the smallest ``doc_id`` of
    the group, a row for each input row. A null id sorts before all and makes the group's id
    null. Rows of one id and different texts may fall into different groups. Documents
    without words have fingerprint 0 and are linked like any other.
    """
    prints = stored(fingerprints(docs, size, seed), "fingerprints")
    groups = prints.groupBy("fp").agg(F.min("ord").alias("first"))
    links = near_links(groups.select("fp"), distance, blocks, cell)
    roots = smallest_reachable(links)
    placed = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = placed.join(least, "root").select("fp", F.when(F.col("least") != LEAST, F.col("least")).alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
