"""Hard negatives against brute force, and products over residues against whole numbers."""

import math
import random

import numpy as np
import pytest

from tillflow.llm import negatives, residues

SCHEMA = "vec_id long, label int, embedding array<double>, vec string, kind int, place int"


def brute(rows, every, low=80, high=100, k=5):
    good = [
        (i, label, [math.floor(256 * x) for x in e])
        for i, label, e in rows
        if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i in sorted({r[0] for r in good if r[0] % every == 0}):
        label, e = min((r[1], r[2]) for r in good if r[0] == i)
        near = sorted((-dot(e, v), j) for j, own, v in good if own == label and j != i)[:k]
        far = sorted((-dot(e, v), j) for j, own, v in good if own != label)
        for p, j in near:
            window = [(s, n) for s, n in far if low * -p <= 100 * -s <= high * -p][:k]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(window, 1)]
    return sorted(out)


def vectors(r, n, wide=1.0):
    centre = [[r.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(n):
        c = r.choice(centre)
        rows.append((i, r.randint(0, 2), [wide * (x + r.gauss(0, 0.2)) for x in c[: r.choice([4, 6, 6, 6])]]))
    rows += [(10 * k + 500, 1, rows[3][2]) for k in range(12)]  # one vector many times: ties
    return rows + [(None, 1, [1.0]), (600, None, [1.0]), (700, 1, None), (710, 1, [1.0, None]), (720, 1, [float("nan")]), (730, 2, [float("inf")]), (740, 1, [])]


@pytest.mark.parametrize("wide", [1.0, 1e6])
def test_hard_negatives(spark, monkeypatch, wide):
    """Nulls, ties, clashing columns, vectors of different lengths, and several groups, blocks and buckets."""
    for name, value in (("GROUP_BYTES", 200), ("BLOCK", 3), ("CHUNK", 16), ("BUCKET", 40)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(random.Random(4), 150, wide)
    df = spark.createDataFrame([(*x, "w", 1, 2) for x in rows], SCHEMA).repartition(5)
    got = negatives.hard_negatives(df, every=10)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_repeated_rows(spark):
    rows = vectors(random.Random(9), 60)[:60]
    rows += [rows[0], rows[20], (20, 0, rows[5][2])]
    df = spark.createDataFrame([(*x, "w", 1, 2) for x in rows], SCHEMA)
    got = sorted(map(tuple, negatives.hard_negatives(df, every=20).collect()))
    assert sorted(set(got)) == sorted(set(brute(rows, 20)))


def test_nothing_and_too_long(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(none).count() == 0
    long = spark.createDataFrame([(100, 1, [1e9], "", 0, 0), (1, 1, [1e9], "", 0, 0)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(long)


def test_relabelled(spark):
    df = spark.createDataFrame([(7, 9, [1.0], "", 0, 0), (8, 9, None, "", 0, 0), (None, 9, None, "", 0, 0)], SCHEMA)
    assert [r.label for r in negatives.relabelled(df).collect()] == [0, 9, 9]


@pytest.mark.parametrize("largest,width", [(3, 5), (300, 2500), (2**20, 40), (2**28, 3)])
def test_products(largest, width):
    r = np.random.default_rng(largest)
    a, b = (r.integers(-largest, largest + 1, (4, width)) for _ in range(2))
    want = a.astype(object) @ b.astype(object).T
    primes = residues.moduli(largest * largest * width)
    got = residues.products(residues.residues(a.astype(float), primes), residues.residues(b.astype(float), primes), primes)
    assert (got == want).all()


def test_moduli():
    for bound in (0, 1, 10**5, 10**18):
        assert math.prod(residues.moduli(bound)) > 2 * bound + 1
    assert math.prod(residues.moduli(10**5)[:-1]) <= 2 * 10**5 + 1
    with pytest.raises(ValueError):
        residues.moduli(10**150)
