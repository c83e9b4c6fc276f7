"""Groups by Jaccard similarity against a comparison of all pairs."""

import random

import pytest

import corpus_pipeline
from tillflow.llm import jaccard, simhash


def shingles(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    order = lambda d: (d is not None, d)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if r not in least else min(least[r], d, key=order)
    return sorted(((d, least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeÉÀ", k=r.randint(1, 5))) for _ in range(400)]
    rows = []
    for i in range(40):
        base = r.choices(words, k=r.randint(0, 300))
        rows.append((i * 3 + 7, " ".join(base)))
        for k in range(r.randint(0, 8)):
            copy = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 40)):
                if copy:
                    copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((1000 + i * 10 + k, "\n".join(copy).upper() if k == 3 else " ".join(copy)))
    rows += [(5, None), (4, ""), (3, " \t\n"), (2, "one"), (2, "one"), (None, "two words"), (9, "two words")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "cell"), [(1, 1024), (2, 2)])
def test_against_all_pairs(spark, seed, cell):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, sid int").repartition(3)
    got = jaccard.near_duplicates(docs, cell=cell).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert len({c for _, c in want}) < len(rows) / 2


def test_no_documents(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pipeline_keeps_one_of_copies_at_four_fifths(spark):
    r = random.Random(4)
    rows = []
    for i in range(30):
        base = [f"w{r.randrange(5000)}" for _ in range(200)]
        copy = list(base)
        for at in (30, 90, 150):  # 15 of 196 shingles change: similarity 181 / 211
            copy[at] = "changed"
        rows += [(i, " ".join(base)), (100 + i, " ".join(copy))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x.doc_id for x in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()) == list(range(30))


def test_pipeline_groups_by_simhash_and_by_similarity(spark):
    r = random.Random(6)
    rows = corpus(3)
    for i in range(8):  # one phrase over and over: equal fingerprints or nearly, few shingles in common
        phrase = " ".join(r.choices("abcdefgh", k=5)) + " "
        for k in range(4):
            rows.append((5000 + 10 * i + k, phrase * 400 + " ".join(f"t{r.randrange(10**6)}" for _ in range(12))))
    prints = [simhash.fingerprint((t or "").encode(), 3, 42) for _, t in rows]
    by_similarity = brute(rows)
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    order = lambda d: (d is not None, d)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d, key=order)
    want = sorted(((d, least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)
    docs = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = jaccard.near_duplicates(docs.repartition(3), distance=3).collect()
    assert sorted(map(tuple, got), key=str) == want != by_similarity
    kept = {d for d, c in want if d == c}
    assert {x.doc_id for x in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()} == kept
