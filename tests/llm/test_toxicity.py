"""The noisy channel against an enumeration of its lattice, and the classifier on texts of known words."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tillflow.llm import channel, toxicity

DOCS = "doc_id long, text string, toxicity string, hash int, code long"
LABELS = "doc_id long, toxic int, text string"
SYLLABLES = ["ba", "ke", "lin", "to", "mur", "é", "san", "vor", "ti", "ple"]
BAD = ["idiot", "moron", "stupid", "scum"]


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def corpus(seed, n=300):
    """Texts of invented words; a sixth hold one bad word, plain or as a stem with an ending."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [word(r) for _ in range(r.randint(3, 60))]
        bad = r.random() < 1 / 6
        if bad:
            words[r.randrange(len(words))] = r.choice([*BAD, "loweg" + word(r)])
        rows.append((i, " ".join(words) + ".", int(bad)))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, 4) for i, t, *_ in rows], DOCS).repartition(4)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(1, 600)
    labels = spark.createDataFrame([(i, y, "") for i, _, y in rows], LABELS)
    return rows, toxicity.train(table(spark, rows), labels)


def plain_trigrams(texts):
    n = Counter()
    for t in texts:
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
        for w in "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in low).split(" "):
            code = [ord(c) - 96 if ord(c) < 128 else ord(c) - 101 for c in w]
            whole = [0, 0, *code, 0]
            for a, b, c in zip(whole, whole[1:], whole[2:], strict=False) if code else []:
                n[(a * 155 + b) * 155 + c] += 1
    return n


def test_every_document_is_counted(spark):
    texts = ["A bé, c1d! ee", None, "", "--", "x" * 1_500_000, "Zé"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    codes, n = channel.counted(df)
    assert dict(zip(codes.tolist(), n.tolist(), strict=True)) == plain_trigrams(texts)
    assert len(channel.counted(df.filter("false"))[0]) == 0


def cheapest(ch, s):
    best = None
    for way in itertools.product(*(ch._options(s, i) for i in range(len(s)))):
        total, a, b, out = 0.0, 0, 0, []
        for symbol, extra in way:
            total += extra
            if symbol > 0 or (symbol == 0 and b):
                total += float(ch.cost[a, b, symbol])
                out.append(symbol)
                a, b = (b, symbol) if symbol else (0, 0)
        total += float(ch.cost[a, b, 0]) if b else 0.0
        if best is None or total < best[0] - 1e-9:
            best = (total, b"".join(bytes([channel._BYTE[x]]) for x in out))
    return b" ".join(best[1].split())


def test_search_takes_the_cheapest_way(fitted):
    ch = fitted[1][0]
    r = random.Random(2)
    for _ in range(60):
        s = "".join(r.choice("abdiost10$.*- !") for _ in range(r.randint(1, 4))).encode()
        assert ch._search(s).split() == cheapest(ch, s).split()


@pytest.mark.parametrize("hidden", [
    "1d10t", "i d i o t", "id10t", "m0r0n", "i.d.i.o.t", "idiooot", "iiddiioott", "$cum", "S-T-U-P-I-D", "st*pid", "stup1d", "sssstupid", "m o r o n",
])
def test_restored(spark, fitted, hidden):
    """Hidden words come back, other words stay as they are."""
    _, (ch, model) = fitted
    df = spark.createDataFrame([(1, f"Ba linto {hidden} kesan, toto.", "x", 3, 4)], DOCS)
    row = toxicity.scored(df, ch, model, restored="plain").first()
    assert any(f" {w} " in row.plain for w in BAD), row.plain
    assert row.plain.startswith("ba linto ") and row.plain.endswith(" kesan, toto.")
    assert row.toxicity >= 0.7 and (row.hash, row.code, row.text) == (3, 4, f"Ba linto {hidden} kesan, toto.")


def test_held_out_texts(spark, fitted):
    rows, (ch, model) = fitted
    fresh = corpus(7, 400)
    got = {r.doc_id: r for r in toxicity.digest(table(spark, fresh), ch, model).collect()}
    wrong = [i for i, _, y in fresh if got[i].predicted != y]
    assert len(got) == 400 and len(wrong) <= 4
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in fresh)


def test_held_out_labels_teach_nothing(spark):
    rows = corpus(3, 200)
    labels = [(i, y, "") for i, _, y in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, t) for i, y, t in labels]
    df = table(spark, rows)
    scores = []
    for some in (labels, turned + [(None, 1, ""), (5, None, ""), (6, 7, ""), (9999, 1, "")]):
        ch, model = toxicity.train(df, spark.createDataFrame(some, LABELS))
        scores.append(sorted(map(tuple, toxicity.digest(df, ch, model).collect())))
    assert scores[0] == scores[1]


def test_scores_depend_on_the_text_alone(spark, fitted):
    """Neither other rows, nor ids, nor the other columns matter; long, empty and null texts are scored whole."""
    _, (ch, model) = fitted
    long = ("ba linto kesan " * 100_000) + "1d10t"
    rows = [(1, "Ba moron."), (2, "Ba moron."), (None, "Ba moron."), (2, "Ba moron."), (3, None), (4, ""), (5, long), (6, long[:-5]), (7, "x1" * 3000)]
    wide = toxicity.scored(table(spark, rows), ch, model).coalesce(1).collect()
    alone = {t: toxicity.scored(table(spark, [(9, t)]), ch, model).first().toxicity for _, t in rows}
    assert [r.toxicity for r in wide] == [alone[r.text] for r in wide] and len(wide) == 9
    assert alone["Ba moron."] >= 0.7 and alone[long] >= 0.7
    assert alone[None] == alone[""] == alone[long[:-5]] < 0.3


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOCS)
    no_labels = spark.createDataFrame([], LABELS)
    ch, model = toxicity.train(none, no_labels)
    assert toxicity.digest(none, ch, model).count() == 0
    one = table(spark, [(1, "idiot 1d10t"), (2, None)])
    ch, model = toxicity.train(one, no_labels)
    assert [r.score for r in toxicity.digest(one, ch, model).collect()] == [0.5, 0.5]


def test_repeated_rows_are_bounded(spark):
    """One labelled id in many rows gives one row of the sample."""
    rows = [(2, f"ba {i}") for i in range(500)] + [(3, "idiot")]
    labels = spark.createDataFrame([(2, 0, ""), (2, 0, ""), (3, 1, "")], LABELS)
    assert toxicity.labelled(table(spark, rows), labels, 10).count() <= 2


def test_company_is_not_chosen():
    """Of words that always come with a telling one only the telling one is taken."""
    r = np.random.default_rng(1)
    y = (r.random(400) < 0.2).astype(float)
    telling = np.flatnonzero(y)
    with_it = telling[: len(telling) // 2]
    row = np.concatenate([telling, with_it, r.integers(0, 400, 300)])
    place = np.concatenate([np.zeros(len(telling), int), np.ones(len(with_it), int), np.full(300, 2)])
    pairs = np.unique(row * 3 + place)
    assert toxicity.choose(pairs // 3, pairs % 3, y, 3) == [0]
