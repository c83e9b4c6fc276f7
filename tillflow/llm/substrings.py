"""Exact substring dedup: bytes covered by a string of ``span`` bytes that also starts earlier.

Every window of ``span`` bytes is filed under the least hash of its short grams, so equal
windows meet under one key wherever they stand; neighbouring windows that share that gram
form a run, and about eight runs form a stretch. Of stretches with equal bytes only the
earliest goes on: the windows of the others all start earlier there. Of what is left, runs
whose key is unique are done. Of runs of one key with equal bytes all but the earliest go.
The earliest ones of a key are suffix-sorted by two-stage sorting, and adjacent common
prefixes show the windows they share.

Keys of more than ``together`` runs never meet in one task: their earliest runs are found by
aggregation and a join. Those with more than ``together`` distinct runs are cut into short
segments, of which equal ones keep the earliest, and then into single windows, which need no
sorting.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import (
    bit_filter,
    ordered_id,
    passes,
    portions,
    ragged,
    stored,
    utf8,
    whole_text,
)
from tillflow.llm.suffixes import repeated_starts

#: Bits of the filters that are broadcast: 8 MB each, whatever the input.
FILTER_BITS = 26
#: Runs of a key that one task may hold.
TOGETHER = 2048
#: Bytes of text that are hashed together, and of rows that are judged together unless one key
#: has more: a byte takes about 100 bytes of memory meanwhile.
PORTION = 1 << 19
#: Bytes of runs, with their keys and places, that are suffix-sorted together unless one key has more.
SORTED = 1 << 16
#: Places that are hashed at a time: their numbers stay in the cache of a core.
BLOCK = 1 << 15
#: Keys of runs that are counted together before a shuffle, and the first bits of a key by which it goes.
KEYS = 1 << 20
KEY_BITS = 12
#: Rows with their whole texts that are packed or cut together.
FEW = 256

_MIX = np.random.default_rng(100).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)
_SEGMENT = 1 << 23

_RUN = pa.schema([(c, pa.int64()) for c in ("key", "bytes_hash", "ord", "tid", "lo", "hi")])
_RUN_DDL = "key long, bytes_hash long, ord long, tid long, lo long, hi long"
_SPAN_DDL = "ord long, tid long, a long, b long"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place; ``gram`` is a power of two."""
    out = np.empty(max(len(data) - gram + 1, 0), np.uint64)
    one, two = (np.empty(min(len(data), BLOCK + gram), np.uint64) for _ in range(2))
    for base in range(0, len(out), BLOCK):
        part = data[base : base + BLOCK + gram - 1]
        if gram < 8:
            x, step = np.take(_MIX, part, out=one[: len(part)]), 1
        else:  # eight bytes are mixed as one number
            x, step = one[: len(part) - 7], 8
            x[:] = np.ndarray(len(x), "<u8", np.ascontiguousarray(part), strides=(1,))
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= np.right_shift(x, np.uint64(29), out=two[: len(x)])
        factor, spare = 0x9E3779B97F4A7C15, two
        while step < gram:
            y = np.multiply(x[:-step], np.uint64(factor), out=spare[: len(x) - step])
            y += x[step:]
            x, spare = y, one if spare is two else two
            factor = factor * factor % 2**64
            step *= 2
        x ^= np.right_shift(x, np.uint64(29), out=spare[: len(x)])
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.bitwise_xor(x, np.right_shift(x, np.uint64(32), out=spare[: len(x)]), out=out[base : base + BLOCK])
    return out


def least_places(x: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` neighbours in ``x``, the first one of equals."""
    out = np.empty(len(x) - width + 1, np.int32)
    one, two, places = (np.arange(min(len(x), BLOCK + width), dtype=np.uint64) for _ in range(3))
    for base in range(0, len(out), BLOCK):
        part = x[base : base + BLOCK + width - 1]
        least, spare = np.bitwise_and(part, ~_PLACE, out=one[: len(part)]), two
        least |= places[: len(part)]
        done = 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:], out=spare[: len(least) - step])
            spare = one if spare is two else two
            done += step
        least &= _PLACE
        np.add(least, np.uint64(base), out=out[base : base + BLOCK], casting="unsafe")
    return out


def window_runs(
    data: np.ndarray, offsets: np.ndarray, span: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share their least gram: key, first start, last start, row."""
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none.astype(np.uint64), none, none, none
    found = []
    for base in range(0, len(data) - span + 1, _SEGMENT):
        part = data[base : base + _SEGMENT + span - 1]
        x = gram_hashes(part, gram)
        at = least_places(x, span - gram + 1)
        begins = np.ones(len(at), bool)
        begins[1:] = at[1:] != at[:-1]
        long = np.flatnonzero(np.diff(offsets) >= span)
        for edge in (offsets[long] - base, offsets[long + 1] - span + 1 - base):
            begins[edge[(edge >= 0) & (edge < len(begins))]] = True
        lo = np.flatnonzero(begins)
        hi = np.append(lo[1:], len(at)) - 1
        row = np.searchsorted(offsets, lo + base, "right") - 1
        inside = lo + base + span <= offsets[row + 1]
        lo, hi, row = lo[inside], hi[inside], row[inside]
        found.append((x[at[lo]], lo + base, hi + base, row))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def stretches(raw: bytes, runs: tuple, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads of the stretches among ``runs`` and a hash of 128 bits of each one's bytes, as two words.

    A stretch ends where the key of the next run says so, or with its row.
    """
    key, lo, hi, row = runs
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    begins = key & np.uint64(7) == 0
    begins[0] = True
    begins[1:] |= row[1:] != row[:-1]
    head = np.flatnonzero(begins)
    last = np.append(head[1:], len(key)) - 1
    h = xxhash.xxh3_128_digest
    both = b"".join(h(raw[a:b]) for a, b in zip(lo[head].tolist(), (hi[last] + span).tolist(), strict=True))
    words = np.frombuffer(both, ">u8").astype(np.uint64)
    return head, words[::2], words[1::2]


def segments(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut runs where the bytes say so, about every eighth window: run, first and last start."""
    none = np.zeros(0, np.int64)
    if not len(lo):
        return none, none, none
    n = hi - lo + 1
    starts = ragged(lo, n)
    hashes = gram_hashes(data[ragged(lo, n + 7)], 8)  # of the runs only, end to end
    begins = hashes[ragged(np.cumsum(n + 7) - n - 7, n)] & np.uint64(7) == 0
    begins[np.cumsum(n) - n] = True
    head = np.flatnonzero(begins)
    return np.repeat(np.arange(len(lo)), n)[head], starts[head], starts[np.append(head[1:], len(starts)) - 1]


def _place_hash(key: np.ndarray, ord_: np.ndarray, lo: np.ndarray) -> np.ndarray:
    x = key + ord_.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + lo.astype(np.uint64) * np.uint64(0x9E3779B185EBCA87)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = [batch.column(c).to_numpy() for c in ("ord", "tid")]
        for i, j, part, offs in portions(data, offsets, PORTION):
            yield part, offs, ids[0][i:j], ids[1][i:j]


def _hash_runs(part: np.ndarray, lo: np.ndarray, hi: np.ndarray, span: int) -> np.ndarray:
    raw, h = part.tobytes(), xxhash.xxh3_64_intdigest
    return np.fromiter((h(raw[a:b]) for a, b in zip(lo.tolist(), (hi + span).tolist(), strict=True)), np.uint64, len(lo))


def _touching(ord_: np.ndarray, tid: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the spans that touch their neighbour, in the order in which they come."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    apart = (ord_[1:] != ord_[:-1]) | (tid[1:] != tid[:-1]) | (a[1:] > b[:-1]) | (a[1:] < a[:-1]) | (b[1:] < b[:-1])
    head = np.flatnonzero(np.append(True, apart))
    return head, np.append(head[1:], len(a)) - 1


def _u64(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(np.uint64)


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c.view(np.int64)) for c in columns], schema=_RUN)


def removed_spans(docs: DataFrame, span: int, gram: int, together: int) -> DataFrame:
    """Rows ``ord, tid, a, b``: bytes ``a`` to ``b`` of the row go; rows may overlap."""
    send = docs.sparkSession.sparkContext.broadcast
    rank = F.col("ord").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + F.col("lo")
    rank = rank.cast("decimal(38,0)")

    def firsts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key", "bytes_hash").agg(F.min(rank).alias("first"), F.count("*").alias("n"))

    def filtered(rows: DataFrame, wanted) -> DataFrame:
        def emit(batches):
            for batch in batches:
                yield batch.filter(pa.array(passes(wanted.value, _u64(batch, "key"))))

        return rows.mapInArrow(emit, rows.schema)

    def places(rows: DataFrame) -> DataFrame:
        def emit(batches):
            for batch in batches:
                at = _place_hash(_u64(batch, "key"), batch.column("ord").to_numpy(), batch.column("lo").to_numpy())
                yield pa.record_batch([pa.array(at.view(np.int64))], names=["key"])

        return rows.select("key", "ord", "lo").mapInArrow(emit, "key long")

    def but_first(rows: DataFrame, first: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
        """Spans of all ``rows`` but the earliest of equal ones, and those earliest ones.

        ``first`` is ``firsts(rows)``. A row whose place is that of no earliest one repeats
        something: such rows need no join, and touching ones of a text leave as one span.
        The others, the earliest and what the filter lets through by chance, are joined.
        """
        at = first.withColumn("lo", F.expr("cast(pmod(first, 4294967296BD) as bigint)"))
        leading = send(bit_filter(places(at.withColumn("ord", F.expr("(first - lo) div 4294967296BD"))), FILTER_BITS))

        def emit(batches):
            for batch in batches:
                ord_, tid, lo, hi = (batch.column(c).to_numpy() for c in ("ord", "tid", "lo", "hi"))
                may_lead = passes(leading.value, _place_hash(_u64(batch, "key"), ord_, lo))
                open_ = batch.filter(pa.array(may_lead))
                head, last = _touching(ord_[~may_lead], tid[~may_lead], lo[~may_lead], hi[~may_lead] + span)
                lo, hi, ord_, tid = lo[~may_lead][head], hi[~may_lead][last], ord_[~may_lead][head], tid[~may_lead][head]
                gone = _rows(np.zeros_like(lo), np.zeros_like(lo), ord_, tid, lo, hi)
                for part, flag in ((open_, True), (gone, False)):
                    flags = pa.array(np.full(len(part), flag))
                    yield pa.record_batch([*part.columns, flags], names=[*_RUN.names, "open"])

        judged = stored(rows.mapInArrow(emit, f"{_RUN_DDL}, open boolean"), label)
        open_ = judged.filter("open").drop("open").join(first.drop("n"), ["key", "bytes_hash"])
        later = judged.filter("not open").drop("open", "key", "bytes_hash").unionByName(
            open_.filter(rank > F.col("first")).select("ord", "tid", "lo", "hi")
        )
        spans = later.select("ord", "tid", F.col("lo").alias("a"), (F.col("hi") + span).alias("b"))
        return spans, open_.filter(rank == F.col("first")).drop("first")

    # stretches: all but the first of equal ones go
    def cut(batches):
        for part, offs, ord_, tid in _batches(batches):
            runs = window_runs(part, offs, span, gram)
            head, key, more = stretches(part.tobytes(), runs, span)
            row = runs[3][head]
            lo, hi = runs[1][head], runs[2][np.append(head[1:], len(runs[0])) - 1] if len(head) else head
            yield _rows(key, more, ord_[row], tid[row], lo - offs[row], hi - offs[row])

    long = stored(docs.mapInArrow(cut, _RUN_DDL), "stretches")
    shared = stored(firsts(long).filter("n > 1"), "shared_stretches")
    copied = send(bit_filter(shared.select("key").distinct(), FILTER_BITS))
    # a stretch that only the filter takes for a copy has no first one, and leads
    later = F.coalesce(rank > F.col("first"), F.lit(False)).alias("later")
    judged = stored(
        filtered(long, copied).join(shared, ["key", "bytes_hash"], "left").select("key", "ord", "tid", "lo", "hi", later),
        "judged_stretches",
    )
    leading = send(bit_filter(places(judged.filter("not later")), FILTER_BITS))

    def live(part, offs, ord_):
        """The runs of all stretches but later copies."""
        runs = window_runs(part, offs, span, gram)
        head, key, _ = stretches(part.tobytes(), runs, span)
        row = runs[3][head]
        first = passes(leading.value, _place_hash(key, ord_[row], runs[1][head] - offs[row]))
        keep = np.repeat(~passes(copied.value, key) | first, np.diff(np.append(head, len(runs[0]))))
        return tuple(c[keep] for c in runs)

    # runs: those of a unique key go no further
    def count_keys(batches):
        held, size = [], 0
        for part, offs, ord_, _ in _batches(batches):
            held.append(live(part, offs, ord_)[0])
            size += len(held[-1])
            if size >= KEYS:
                yield _counted(held)
                held, size = [], 0
        yield _counted(held)

    counts = docs.mapInArrow(count_keys, "key long, keys binary, counts binary")
    counts = counts.repartition("key").sortWithinPartitions("key").mapInArrow(_repeated_keys, "key long, n long")
    counts = stored(counts, "repeated_keys")
    repeated = send(bit_filter(counts, FILTER_BITS))
    busy = bit_filter(counts.filter(F.col("n") > together), FILTER_BITS)
    any_busy, busy = bool(busy.any()), send(busy)

    def runs_of(wanted, besides=None) -> DataFrame:
        def emit(batches):
            for part, offs, ord_, tid in _batches(batches):
                key, lo, hi, row = live(part, offs, ord_)
                ok = passes(wanted.value, key)
                if besides is not None:
                    ok &= ~passes(besides.value, key)
                key, lo, hi, row = key[ok], lo[ok], hi[ok], row[ok]
                yield _rows(key, _hash_runs(part, lo, hi, span), ord_[row], tid[row], lo - offs[row], hi - offs[row])

        return docs.mapInArrow(emit, _RUN_DDL)

    together_by_key = runs_of(repeated, busy).repartition("key").sortWithinPartitions("key", "bytes_hash", "ord", "lo")
    kinds = "key long, ord long, tid long, lo long, hi long, later boolean"
    apart = stored(together_by_key.mapInArrow(_judge_keys, kinds), "judged_runs")
    ends = (F.col("hi") + span).alias("b")
    out = [rows.filter("later").select("ord", "tid", F.col("lo").alias("a"), ends) for rows in (judged, apart)]
    sorting = places(apart.filter("not later"))
    if any_busy:
        many = stored(runs_of(busy), "busy_runs")
        first = stored(firsts(many), "busy_firsts")
        distinct = first.groupBy("key").agg(F.count("*").alias("distinct"))
        crowded = bit_filter(distinct.filter(F.col("distinct") > together), FILTER_BITS)
        any_crowded, crowded = bool(crowded.any()), send(crowded)
        spans, leaders = but_first(many, first, "judged_busy_runs")
        out.append(spans)
        few = distinct.filter(F.col("distinct").between(2, together)).select("key")
        sorting = sorting.unionByName(places(leaders.join(few, "key", "left_semi")))
        if any_crowded:
            def cut_short(batches):
                for part, offs, ord_, tid in _batches(batches):
                    key, lo, hi, row = live(part, offs, ord_)
                    ok = passes(crowded.value, key)
                    of, lo, hi = segments(part, lo[ok], hi[ok])
                    key, row, raw = key[ok][of], row[ok][of], part.tobytes()
                    pieces = [raw[a:b] for a, b in zip(lo.tolist(), (hi + span).tolist(), strict=True)]
                    rows = _rows(key, _hash_runs(part, lo, hi, span), ord_[row], tid[row], lo - offs[row], hi - offs[row])
                    yield pa.record_batch([*rows.columns, pa.array(pieces, pa.binary())], names=[*_RUN.names, "bytes"])

            short = stored(docs.mapInArrow(cut_short, f"{_RUN_DDL}, bytes binary"), "segments")
            copies = short.join(firsts(short).filter("n > 1"), ["key", "bytes_hash"], "left")
            short = stored(copies.select("key", "ord", "tid", "lo", "hi", "bytes", later), "judged_segments")
            out.append(short.filter("later").select("ord", "tid", F.col("lo").alias("a"), ends))

            def single(batches):
                for batch in batches:
                    data, offs = utf8(batch.column("bytes"))
                    n = np.diff(offs) - span + 1
                    at = ragged(offs[:-1], n)
                    lo = np.repeat(batch.column("lo").to_numpy() - offs[:-1], n) + at
                    key, ord_, tid = (np.repeat(batch.column(c).to_numpy(), n) for c in ("key", "ord", "tid"))
                    yield _rows(key, _hash_runs(data, at, at, span), ord_, tid, lo, lo)

            # stored: two Python steps in one stage would keep four workers in an executor of two cores
            windows = stored(short.filter("not later").mapInArrow(single, _RUN_DDL), "windows")
            out.append(but_first(windows, stored(firsts(windows), "window_firsts"), "judged_windows")[0])
    sorting = send(bit_filter(sorting, FILTER_BITS))

    # the earliest of different runs of a key, with their bytes
    def run_bytes(batches):
        for part, offs, ord_, tid in _batches(batches):
            key, lo, hi, row = live(part, offs, ord_)
            ok = passes(repeated.value, key) & passes(sorting.value, _place_hash(key, ord_[row], lo - offs[row]))
            key, lo, hi, row = key[ok], lo[ok], hi[ok], row[ok]
            raw = part.tobytes()
            pieces = [raw[a:b] for a, b in zip(lo.tolist(), (hi + span).tolist(), strict=True)]
            cols = [key.view(np.int64), ord_[row], tid[row], lo - offs[row]]
            yield pa.record_batch([*map(pa.array, cols), pa.array(pieces, pa.binary())], names=["key", "ord", "tid", "lo", "bytes"])

    def sort(batches):
        for held in _whole_keys(batches, SORTED):
            yield _sorted(held, span)

    pieces = docs.mapInArrow(run_bytes, "key long, ord long, tid long, lo long, bytes binary")
    out.append(pieces.repartition("key").sortWithinPartitions("key").mapInArrow(sort, _SPAN_DDL))
    return reduce(DataFrame.unionByName, out)


def _whole_keys(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Regroup rows that come sorted by ``key``: tables of whole keys, of about ``size`` bytes."""
    held: list[pa.Table] = []
    due = size
    for piece in _pieces(batches, size):
        held.append(pa.Table.from_batches([piece]))
        if sum(t.nbytes for t in held) < due:
            continue
        table = pa.concat_tables(held)
        keys = table["key"].to_numpy()
        last = int(np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[-1])
        if last:
            yield table.slice(0, last)
            table = table.slice(last)
        held = [table.combine_chunks()]
        due = max(size, 2 * table.nbytes)  # a key of many pieces is not copied for each
    if held:
        yield pa.concat_tables(held)


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut into pieces of about ``size`` bytes, as many rows in each."""
    for batch in batches:
        rows = -(-len(batch) // max(1, batch.nbytes // size)) if len(batch) else 1
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    """Different keys of ``held`` and how often each comes, in a row for each value of their first bits."""
    keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
    first = (keys >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    head = np.flatnonzero(np.append(True, first[1:] != first[:-1])[: len(first)])
    edges, columns = np.append(head, len(keys)), []
    for numbers in (keys, n.astype(np.uint32)):
        offsets = pa.py_buffer((edges * numbers.itemsize).astype(np.int32))
        columns.append(pa.Array.from_buffers(pa.binary(), len(head), [None, offsets, pa.py_buffer(numbers)]))
    return pa.record_batch([pa.array(first[head]), *columns], names=["key", "keys", "counts"])


def _repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that come more than once in rows of ``_counted``, sorted by ``key``, and how often."""
    for table in _whole_keys(batches, PORTION):
        keys, n = (utf8(table[c])[0].view(kind) for c, kind in (("keys", np.uint64), ("counts", np.uint32)))
        by = np.argsort(keys)
        keys = keys[by]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        n = np.add.reduceat(n[by], head, dtype=np.int64) if len(head) else n.astype(np.int64)
        more = n > 1
        yield pa.record_batch([pa.array(keys[head][more].view(np.int64)), pa.array(n[more])], names=["key", "n"])


def _judge_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Later ones of equal runs, and the earliest of each run whose key has different runs."""
    for table in _whole_keys(batches, PORTION):
        key, same, ord_, lo = (table[c].to_numpy() for c in ("key", "bytes_hash", "ord", "lo"))
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, same[1:] != same[:-1])
        head = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        later = (ord_ != ord_[head][of]) | (lo != lo[head][of])
        kinds = np.bincount(np.cumsum(new_key) - 1, weights=new)
        keep = later | (kinds[np.cumsum(new_key) - 1] > 1)
        part = table.select(["key", "ord", "tid", "lo", "hi"]).append_column("later", pa.array(later)).filter(pa.array(keep))
        yield from part.to_batches()


def _sorted(table: pa.Table, span: int) -> pa.RecordBatch:
    """Spans of the runs in ``table`` that an earlier one, or an earlier start of the same, repeats."""
    table = table.combine_chunks()
    ord_, tid, lo = (table[c].to_numpy() for c in ("ord", "tid", "lo"))
    data, offs = utf8(table["bytes"])
    windows = np.diff(offs) - span + 1
    starts = ragged(offs[:-1], windows)
    run = np.repeat(np.arange(len(windows)), windows)
    begin = lo[run] + starts - offs[run]
    # equal places rank equal; a start has 31 bits
    place = (np.unique(ord_, return_inverse=True)[1].astype(np.int64)[run] << 32) + begin
    gone = repeated_starts(data, starts, span, place)
    at, of = begin[gone], run[gone]
    # touching windows of a run join to one span
    head = np.flatnonzero(np.append(True, (np.diff(at) > span) | (np.diff(of) != 0))) if len(at) else at
    last = np.append(head[1:], len(at)) - 1 if len(at) else at
    cols = [ord_[of[head]], tid[of[head]], at[head], at[last] + span]
    return pa.record_batch([*map(pa.array, cols)], names=["ord", "tid", "a", "b"])


def drop_repeats(docs: DataFrame, span: int = 100, gram: int = 32, together: int = TOGETHER) -> DataFrame:
    """Remove bytes that a string of ``span`` bytes covers which also starts earlier.

    Earlier: in a row of smaller ``doc_id`` (null before all), or at a lower start under the
    same ``doc_id``. Strings are judged on the input and never cross rows; overlaps count.
    Null texts are empty; texts shorter than ``span`` stay whole. Rows of equal id and text
    are no earlier than each other and get equal results. Other columns are ignored.

    Returns ``doc_id``, ``n_bytes``, ``kept`` (binary) and ``spans`` (removed runs
    ``[start, end)``, maximal, ascending), one row for each input row.
    """
    if gram & (gram - 1) or gram > span:
        raise ValueError("gram: a power of two, at most span")
    text = whole_text()
    rows = docs.select("doc_id", ordered_id().alias("ord"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("text"))
    gone = removed_spans(rows.drop("doc_id"), span, gram, together)
    # equal rows have equal runs: each is kept once, so what is joined back grows with the rows
    by_doc = gone.groupBy("ord", "tid").agg(F.collect_set(F.struct("a", "b")).alias("gone"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long")).select("doc_id", "ord", "tid", "text")
    joined = rows.mapInArrow(_packed, "doc_id long, ord long, tid long, text binary").join(by_doc, ["ord", "tid"], "left")
    cut = joined.select("doc_id", "text", "gone")
    return cut.mapInArrow(_cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts, compressed for the shuffle."""
    pack = zstandard.ZstdCompressor(3).compress
    for batch in (whole.slice(at, FEW) for whole in batches for at in range(0, len(whole), FEW)):
        texts = pa.array([pack(t) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.record_batch([*batch.columns[:3], texts], names=["doc_id", "ord", "tid", "text"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in (whole.slice(at, FEW) for whole in batches for at in range(0, len(whole), FEW)):
        lists = batch.column("gone")
        kept, spans, n_spans = [], [], []
        inner = lists.flatten()
        a_all, b_all = (inner.field(i).to_numpy() for i in (0, 1))
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        at = np.append(0, np.cumsum(sizes))
        lengths = []
        for i, packed in enumerate(batch.column("text")):
            text = np.frombuffer(unpack(packed.as_py()), np.uint8)
            lengths.append(len(text))
            if sizes[i]:
                a, b = a_all[at[i] : at[i + 1]], b_all[at[i] : at[i + 1]]
                by = np.argsort(a, kind="stable")
                a, b = a[by], np.maximum.accumulate(b[by])
                head = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
                a, b = a[head], b[np.append(head[1:], len(b)) - 1]
                keep = np.ones(len(text), bool)
                for s, e in zip(a, b, strict=True):
                    keep[s:e] = False
                text = text[keep]
                spans.append((a, b))
                n_spans.append(len(a))
            else:
                n_spans.append(0)
            kept.append(text.tobytes())
        empty = np.zeros(0, np.int64)
        a = np.concatenate([s[0] for s in spans]) if spans else empty
        b = np.concatenate([s[1] for s in spans]) if spans else empty
        pairs = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_spans)), pa.int32()), pairs)
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(kept, pa.binary()), lists],
            names=["doc_id", "n_bytes", "kept", "spans"],
        )


def digest(out: DataFrame) -> DataFrame:
    """The result by document: counts and the hash of what is kept."""
    removed: Column = F.col("n_bytes") - F.length("kept")
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
