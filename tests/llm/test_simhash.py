"""SimHash groups against a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tillflow.llm import simhash


def fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    order = lambda d: (d is not None, d)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if r not in least else min(least[r], d, key=order)
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeÉÀ", k=r.randint(1, 5))) for _ in range(400)]
    rows = []
    for i in range(40):
        base = r.choices(words, k=r.randint(0, 120))
        rows.append((i * 3 + 7, " ".join(base)))
        for k in range(r.randint(0, 8)):
            copy = list(base)
            if copy:
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((1000 + i * 10 + k, "\n".join(copy).upper() if k == 3 else " ".join(copy)))
    rows += [(5, None), (4, ""), (3, " \t\n"), (2, "one"), (2, "one"), (None, "two words"), (9, "two words")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "cell"), [(1, 1024), (2, 2)])
def test_against_all_pairs(spark, seed, cell):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, root int").repartition(3)
    got = simhash.digest(simhash.near_duplicates(docs, cell=cell)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_forest_joins_what_pairs_join():
    r = np.random.default_rng(3)
    values = np.unique(np.concatenate([r.integers(0, 2**63, 30), *[np.int64(77) ^ (np.int64(1) << r.integers(0, 63, 40))]])).astype(np.uint64)
    a, b = simhash.forest(values, 0, 2)
    assert len(a) < len(values)
    near = {(int(x) ^ 77).bit_count() <= 1 for x in values}
    assert near and len(a) == sum((int(x) ^ 77).bit_count() <= 1 for x in values) - 1


def test_close_pairs_share_a_block(spark):
    r = random.Random(5)
    pairs = []
    for _ in range(200):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), 3):
            y ^= 1 << b
        pairs.append(tuple(v - 2**64 if v >= 2**63 else v for v in (x, y)))
    df = spark.createDataFrame(pairs, "x long, y long").select(
        simhash.block_keys("x", 5, 3).alias("a"), simhash.block_keys("y", 5, 3).alias("b")
    )
    assert df.selectExpr("arrays_overlap(a, b) as o").filter("not o").count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.digest(simhash.near_duplicates(docs)).collect() == []
