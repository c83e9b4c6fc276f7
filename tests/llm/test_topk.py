"""Top products against a comparison of every query with every row."""

import math

import numpy as np
import pytest

from tillflow.llm import topk


def brute(rows, every, k, scale):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({i: a for i, a in ok if i % every == 0}.items()):
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def corpus(kind):
    r = np.random.default_rng(4)
    n = 300
    v = r.normal(size=(n, 12))
    if kind == "lengths":
        v *= np.exp(r.normal(size=n) * 2)[:, None]
    if kind == "alike":
        v = v[:6][r.integers(0, 6, n)] + r.normal(size=(n, 12)) * 0.01 * (r.random(n) < 0.5)[:, None]
    if kind == "negative":
        v = -np.abs(v)
        v[::20] *= -1
    if kind == "huge":
        v *= 1e5  # products above 2**53, within a long
    rows = [(int(i), [float(x) for x in e]) for i, e in enumerate(v)]
    return rows + [(1000, None), (1001, [1.0, None]), (1020, [float("nan")] * 12), (1040, [float("inf")] * 12), (1060, [0.0] * 12), (1080, []), (1100, [2.0]), (None, [1.0] * 12)]


@pytest.mark.parametrize("kind", ["plain", "lengths", "alike", "negative", "huge"])
def test_against_every_pair(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BUCKET", 40)
    rows = corpus(kind)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, norm int, rank int").repartition(3)
    got = topk.top_products(df, every=20, k=5, bands=4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20, 5, 1024)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert list(map(tuple, topk.top_products(df).collect())) == [(0, 1, 1, 1024 * 2048)]


def test_empty_table(spark):
    assert topk.top_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
