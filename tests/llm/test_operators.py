"""Decontamination, sharding, line dedup, URL filters and the classifier on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillflow.llm import decontaminate, hosts, lines, quality, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination ----------------------------------------------------------


def contained(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall(lowered(t))
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = WORD.findall(lowered(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 15)
    r = random.Random(1)
    words = ["a", "bé", "c1", "日本", "dd", "E", "f"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", "-", "\n", ", "]) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 3, 9, 10, 14]))) for i in range(12)] + [(1, text(11)), (None, text(4)), (50, None), (51, "--")]
    docs = [(i, text(r.randint(0, 60)) + (r.choice(items)[1] or "")) for i in range(40)]
    docs += [(3, docs[3][1]), (3, "other"), (None, items[4][1]), (90, None), (91, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, key int").repartition(3)
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, window string")
    got = decontaminate.digest(decontaminate.contained_items(df, bench)).collect()
    assert sorted(map(tuple, got), key=str) == contained(docs, items)


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.contained_items(docs, none)).first()["contaminated"] is False
    assert decontaminate.contained_items(docs.limit(0), none).count() == 0


# --- sharding -----------------------------------------------------------------


def shards(spark, rows, tree, grown=None):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, shard int, n int")
    return sharding.assign_shards(df, tree, grown).collect()


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 16)
    rows = [(i, "é" * (i % 5)) for i in range(2000)] + [(None, None), (None, ""), (7, "x"), (7, "x"), (7, "x")]
    got = shards(spark, rows, sharding.plain_tree(40), sharding.plain_tree(41))
    assert len(got) == len(rows) and Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    for s in range(40):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.size for r in got if r.doc_id == 4} == {16 + 8}
    assert {r.text_crc32 for r in got if r.doc_id == 4} == {zlib.crc32(("é" * 4).encode())}
    assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {40}
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert max(Counter(r.shard for r in got).values()) < 120


def test_weights_and_movement(spark):
    tree = [(0, 0, 0, 1.0), (0, 1, 1, 1.0), (1, 0, 2, 2.0)]
    heavier = [(0, 0, 0, 1.0), (0, 1, 1, 1.0), (1, 0, 2, 6.0)]
    got = shards(spark, [(i, "") for i in range(4000)], tree, heavier)
    n = Counter(r.shard for r in got)
    assert abs(n[2] - 2000) < 200 and abs(n[0] - 1000) < 150
    assert {(r.shard, r.grown_shard) for r in got if r.shard != r.grown_shard} == {(0, 2), (1, 2)}
    with pytest.raises(ValueError, match="above zero"):
        sharding.shard_of(None, [(0, 0, 0, 0.0)])


def test_no_documents(spark):
    assert shards(spark, [], sharding.plain_tree(4)) == []


# --- line dedup ---------------------------------------------------------------


def deduped(rows):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    filled = lambda ls: sum(bool((x or "").strip(" ")) for x in ls)
    seen, out = {}, {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for d, t in sorted(rows, key=key):
        ls = (t or "").split("\n")
        gone, a = set(), 0
        for i in range(len(ls)):
            if i < len(ls) - 1 and md5(md5(ls[i]) + md5(ls[i + 1]))[0] >= "e":
                continue
            part, a, start = ls[a : i + 1], i + 1, a
            around = (ls[start - 1] if start else None, ls[i + 1] if i + 1 < len(ls) else None)
            place = (d is not None, d or 0, start)
            if not filled(part):
                continue
            first, theirs = seen.setdefault("\n".join(part), (place, around))
            same = [filled([x]) and x == y for x, y in zip(around, theirs, strict=True)]
            if first < place and filled(part) + sum(same) >= 2:
                gone |= set(range(start - same[0], i + 1 + same[1]))
        out[(d, t)] = "\n".join(x for i, x in enumerate(ls) if i not in gone)
    return sorted(((d, out[(d, t)]) for d, t in rows), key=str)


def test_line_dedup(spark):
    r = random.Random(3)
    pool = [f"line {i} é" for i in range(12)] + ["", " ", "x"]
    passage = "\n".join(f"common {i}" for i in range(12))
    rows = [(i, "\n".join(r.choices(pool, k=r.randint(1, 15))) + ("\n" + passage if i % 3 == 0 else "")) for i in range(60)]
    rows += [(None, passage), (4, rows[4][1]), (200, None), (201, ""), (202, "\n\n\n"), (203, "y " * 9000)]
    r.shuffle(rows)
    df = spark.createDataFrame([(i, t, 5, 3) for i, t in rows], "doc_id long, text string, _h int, `a.idx` int").repartition(3)
    out = lines.drop_repeated_lines(df)
    assert out.columns[:4] == ["doc_id", "text", "_h", "a.idx"]
    got = out.collect()
    assert all((x[2], x[3]) == (5, 3) for x in got)
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == deduped(rows)
    assert sum(x._n_removed for x in got) > 50
    assert all(x._n_lines - x._n_removed == (x.text.count("\n") + 1 if x.text or x._n_removed < x._n_lines else 0) for x in got)


def test_line_dedup_of_nothing(spark):
    assert lines.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError, match="_n_lines"):
        lines.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string, _n_lines int"))


def test_line_dedup_takes_short_passages(spark):
    """Passages of two lines among lines of each text's own: nearly all later ones go, lone repeats stay."""
    own = lambda i, k: " ".join(f"own{i}x{k}y{j}" for j in range(6))
    shared = lambda i: [f"first line of passage {i}", f"second line of passage {i}"]
    rows = []
    for i in range(200):
        rows += [(i, "\n".join([own(i, 0), *shared(i), own(i, 1)])), (1000 + i, "\n".join([own(1000 + i, 0), *shared(i), own(1000 + i, 1), "a common line"]))]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.text) for x in got) == sorted(deduped(rows))
    taken = [x._n_removed for x in got if x.doc_id >= 1000]
    assert set(taken) <= {0, 2} and sum(taken) >= 2 * 0.8 * len(taken)
    assert all(x._n_removed == 0 for x in got if x.doc_id < 1000)
    assert all("a common line" in x.text for x in got if x.doc_id >= 1000)


def test_line_dedup_of_a_long_text(spark):
    rows = [(1, "\n".join(f"line {i % 700}" for i in range(20_000))), (2, "z" * 200_000 + "\nend")]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.text) for x in got) == deduped(rows)


# --- URL filters --------------------------------------------------------------


def test_urls(spark):
    link = '<a href="http://{}/x">'.format
    rows = [
        (1, "http://A.Example.com/en/1?q#f", link("good.org")),
        (2, "https://www.example.com/en/", ""),
        (3, "http://x.net/es/1", link("Bad.org") + link("x.net")),
        (4, "http://x.net/fr/", None),
        (5, "http://good.org/", "<a href='/rel'>"),
        (6, "http://bad.org/a", link("x.net") * 3),
        (7, None, None),
        (8, "no scheme", ""),
        (9, "http://example.com", ""),
        (10, "x://notexample.com?u=://y", ""),
        (10, "x://notexample.com?u=://y", ""),
        (None, "http://EXAMPLE.com/en/#", ""),
    ]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, size int")
    got = {r.page_id: r for r in hosts.judge_urls(df, hosts.RULES).collect()}
    assert hosts.judge_urls(df, hosts.RULES).count() == len(rows)
    want = {
        1: ("a.example.com", "/en/1", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("x.net", "/es/1", "net/es/", "block"), 4: ("x.net", "/fr/", "net/fr/", "block"), 5: ("good.org", "/", None, "allow"),
        6: ("bad.org", "/a", None, "block"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("example.com", "", None, "block"),
        10: ("notexample.com", "", None, "allow"), None: ("example.com", "/en/", "example.com/en/", "block"),
    }
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == want
    assert got[6].distrust > hosts.UNIT // 20 and got[5].distrust == 0


def test_no_pages(spark):
    assert hosts.judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), hosts.RULES).collect() == []


# --- quality ------------------------------------------------------------------


def test_quality(spark):
    r = random.Random(5)
    good = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(80))
    bad = lambda: " ".join(["BUY!!"] * 60)
    docs = [(i, good() if i % 5 else bad(), i % 2) for i in range(400)]
    docs += [(1000, None, 0), (1001, "", 1), (None, "no id", 0), (3, docs[3][1], 1), (1002, good() * 200, 0)]
    labels = [(i, int(i % 5 > 0), 0) for i in range(300)] + [(7, 0, 1), (7, 1, 0), (8, None, 0), (None, 1, 0), (5000, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, quality int").repartition(3)
    got = quality.digest(d, quality.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    assert len(got) == len(docs) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got)
    held = [x for x in got if x.held_out and x.doc_id < 400]
    assert np.mean([x.predicted == (x.doc_id % 5 > 0) for x in held]) > 0.95


def test_no_labels(spark):
    d = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.digest(d, quality.train(d, none)).first()["predicted"] == 1
    assert quality.digest(d.limit(0), quality.train(d.limit(0), none)).collect() == []


def test_risk_is_held_at_zero():
    r = np.random.default_rng(0)
    p, u = r.normal(2, 1, (200, 5)), np.concatenate([r.normal(2, 1, (300, 5)), r.normal(-2, 1, (300, 5))])
    s = quality.fit(p.astype(np.float32), u.astype(np.float32), 0.5).score(u)
    assert (s[:300] >= 0.5).mean() > 0.98 and (s[300:] < 0.5).mean() > 0.98
