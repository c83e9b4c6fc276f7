"""Exact substring dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tillflow.llm import substrings, suffixes
from tillflow.llm.substrings import drop_repeats


def brute(rows, span):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        o = -(2**63) if i is None else i
        for p in range(len(b) - span + 1):
            first[b[p : p + span]] = min(first.get(b[p : p + span], (o, p)), (o, p))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        o = -(2**63) if i is None else i
        gone = [False] * len(b)
        for p in range(len(b) - span + 1):
            if first[b[p : p + span]] < (o, p):
                gone[p : p + span] = [True] * span
        runs = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, span, **args):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ord string, key int")
    got = substrings.digest(drop_repeats(docs.repartition(3), span, **args)).collect()
    return sorted(map(tuple, got), key=str)


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 4))) for _ in range(60)]
    text = lambda n: " ".join(r.choices(words, k=n))
    passages = [text(20) for _ in range(4)]
    rows = []
    for i in range(60):
        t = text(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(t))
            t = t[:at] + r.choice(passages) + t[at:]
        rows.append((i, t))
    rows += [(100 + i, rows[i % 7][1]) for i in range(15)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (5, rows[9][1]), (200, None), (201, ""), (202, "a" * 700), (203, "ab" * 300)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("span", "gram", "together", "bits"), [(40, 16, 1000, 26), (40, 8, 2, 15), (100, 32, 1000, 26)])
def test_against_all_windows(spark, monkeypatch, span, gram, together, bits):
    monkeypatch.setattr(substrings, "FILTER_BITS", bits)  # the smallest filter lets much pass by chance
    rows = corpus(span + together)
    assert run(spark, rows, span, gram=gram, together=together) == brute(rows, span)


def test_empty_table(spark):
    assert run(spark, [], 100) == []


def test_no_repeats(spark):
    rows = [(1, "short"), (2, "".join(map(str, range(200))))]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_equal_rows_share_their_runs(spark):
    """A text in n equal rows, after an earlier one: the runs that are joined back don't grow with n."""
    text = "".join(chr(97 + (i * i + i // 7) % 23) for i in range(400))
    sizes = []
    for n in (20, 40):
        rows = [(1, text[:250]), *[(None, text)] * 1, *[(5, "head " + text)] * n]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = substrings.drop_repeats(docs).filter("doc_id = 5").collect()
        assert len(got) == n and len({(bytes(r.kept), tuple(map(tuple, r.spans))) for r in got}) == 1
        assert [tuple(s) for s in got[0].spans] == [(5, 405)]
        listed = docs.select("doc_id", substrings.ordered_id().alias("ord"), substrings.F.xxhash64(substrings.whole_text()).alias("tid"),
                             substrings.F.col("text").cast("binary").alias("text")).drop("doc_id")
        gone = substrings.removed_spans(listed, 100, 32, substrings.TOGETHER)
        sizes.append(gone.distinct().count())
    assert sizes[0] == sizes[1]


def test_large_batches_are_worked_on_in_pieces():
    keys = np.repeat(np.arange(5000), 2)
    batch = pa.record_batch([pa.array(keys), pa.array([b"x" * 200] * len(keys), pa.binary())], names=["key", "bytes"])
    tables = list(substrings._whole_keys(iter([batch, batch.slice(0, 0), batch.slice(9999)]), 1 << 16))
    assert max(t.nbytes for t in tables) < 4 << 16
    assert pa.concat_tables(tables)["key"].to_pylist() == [*keys.tolist(), 4999]
    seen = [k for t in tables for k in set(t["key"].to_pylist())]
    assert len(seen) == len(set(seen))
    texts = pa.record_batch([pa.array(range(3000))] * 3 + [pa.array([b"some text"] * 3000)], names=["doc_id", "ord", "tid", "text"])
    packed = list(substrings._packed(iter([texts])))
    assert max(map(len, packed)) < 1000 and sum(map(len, packed)) == 3000


def test_no_stage_runs_two_python_steps(spark, monkeypatch):
    """Each would keep a worker of its own beside the others."""
    plans, write = [], substrings.stored

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(substrings, "stored", noted)
    rows = corpus(42)
    assert run(spark, rows, 40, gram=8, together=2) == brute(rows, 40)
    assert "judged_windows" in dict(plans)
    stages = [(label, stage) for label, plan in plans for stage in plan.split("Exchange")]
    assert [label for label, stage in stages if stage.count("MapInArrow") > 1] == []


def test_keys_are_counted_in_packed_rows():
    """Keys leave a task in a row for each value of their first bits, not in a row each."""
    r = np.random.default_rng(1)
    parts = [r.integers(0, 2**64, 30_000, dtype=np.uint64) for _ in range(3)]
    parts += [np.repeat(parts[0][:70], 5), parts[1][:9], np.full(5000, 2**64 - 1, np.uint64), np.zeros(1, np.uint64)]
    batches = [substrings._counted(parts[:4]), substrings._counted([]), substrings._counted(parts[4:])]
    assert max(map(len, batches)) <= 2**substrings.KEY_BITS
    rows = pa.Table.from_batches(batches).sort_by("key").to_batches(max_chunksize=1000)
    got = [row for b in substrings._repeated_keys(iter(rows)) for row in zip(b["key"].to_pylist(), b["n"].to_pylist(), strict=True)]
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    want = zip(keys[n > 1].view(np.int64).tolist(), n[n > 1].tolist(), strict=True)
    assert sorted(got) == sorted(want)


def test_segments_hash_their_runs_only(monkeypatch):
    hashed, write = [], substrings.gram_hashes
    data = np.random.default_rng(2).integers(97, 110, 50_000).astype(np.uint8)
    lo, hi = np.array([100, 40_000]), np.array([180, 40_900])
    begins = np.flatnonzero(write(data, 8) & np.uint64(7) == 0)
    monkeypatch.setattr(substrings, "gram_hashes", lambda part, gram: hashed.append(len(part)) or write(part, gram))
    of, a, b = substrings.segments(data, lo, hi)
    assert sum(hashed) < 2000
    want = [[x, *(p for p in begins.tolist() if x < p <= y)] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
    assert [a[of == i].tolist() for i in range(2)] == want
    assert [b[of == i].tolist() for i in range(2)] == [[*(p - 1 for p in w[1:]), y] for w, y in zip(want, hi.tolist(), strict=True)]


def test_a_key_of_many_pieces_is_copied_few_times(monkeypatch):
    copied, merge = [], pa.concat_tables
    monkeypatch.setattr(substrings.pa, "concat_tables", lambda tables: copied.append(sum(t.nbytes for t in tables)) or merge(tables))
    batch = pa.record_batch([pa.array([7] * 20_000), pa.array([b"x" * 200] * 20_000, pa.binary())], names=["key", "bytes"])
    tables = list(substrings._whole_keys(iter([batch]), 1 << 14))
    assert [len(t) for t in tables] == [20_000]
    assert sum(copied) < 4 * batch.nbytes


@pytest.mark.parametrize("block", [70, substrings.BLOCK])
def test_least_grams_in_blocks(monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    data = np.random.default_rng(3).integers(0, 3, 400).astype(np.uint8)
    for gram in (1, 2, 4, 8, 16, 32):
        x, seen = substrings.gram_hashes(data, gram), {}
        assert all(seen.setdefault(data[i : i + gram].tobytes(), h) == h for i, h in enumerate(x.tolist()))
        assert len(x) == 401 - gram and len(set(seen.values())) == len(seen)
        rank = [h >> 24 for h in x.tolist()]
        for width in (1, 2, 7, 69):
            want = [min(range(i, i + width), key=lambda j: (rank[j], j)) for i in range(len(x) - width + 1)]
            assert substrings.least_places(x, width).tolist() == want


def test_repeated_starts_against_all_strings():
    for seed in range(400):
        r = np.random.default_rng(seed)
        text = r.integers(0, r.integers(1, 4), r.integers(0, 150)).astype(np.uint8) * np.uint8(r.integers(1, 85))
        span = int(r.integers(1, 60))
        starts = np.flatnonzero(r.random(max(len(text) - span + 1, 0)) < 0.7)
        place = r.integers(0, max(len(starts), 1), len(starts))
        first, strings = {}, [text[s : s + span].tobytes() for s in starts]
        for s, p in zip(strings, place, strict=True):
            first[s] = min(first.get(s, p), p)
        want = [p > first[s] for s, p in zip(strings, place, strict=True)]
        assert suffixes.repeated_starts(text, starts, span, place).tolist() == want
