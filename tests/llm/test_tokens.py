"""Token ids against the tokenizers library, their files and their way back."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillflow.llm import bpe, records

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
PARTS = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "é", "ñ", "日本", "🙂", "1", "23", "!", "<|endoftext|>", " ", "\r\n", "½", "É", "aaaa", "é", "\x00", "\x1c"]


def corpus(seed):
    r = random.Random(seed)
    rows = [(i * 2, "".join(r.choices(PARTS, k=r.randint(0, 40)))) for i in range(80)]
    rows += [(1, None), (3, ""), (5, "x" * 20000), (7, "word " * 5000), (None, "no id"), (4, "twice"), (4, "twice"), (4, "other")]
    r.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, "e", 3) for i, t in rows], "doc_id long, text string, ids string, start int").repartition(3)


def test_round_trip(spark):
    rows, t = corpus(1), Tokenizer.from_file(BYTES)
    want = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = bpe.digest(table(spark, rows), BYTES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_cuts_never_lie_inside_a_token():
    v = bpe.Vocabulary(BYTES)
    assert 0 < v.inside.sum() < 1 << 16
    for token in list(v.bytes_of.values())[:5000]:
        if token != b"<|endoftext|>":
            t = np.frombuffer(token, np.uint8).astype(int)
            assert v.inside[t[:-1] << 8 | t[1:]].all()


@pytest.mark.parametrize("size", [1000, 32 << 20])
def test_records(spark, monkeypatch, size):
    monkeypatch.setattr(records, "FILE_BYTES", size)
    rows, t = corpus(2), Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, records.digest(table(spark, rows), WORDS).collect()), key=lambda r: r[1])
    ids = [t.encode(x or "", add_special_tokens=False).ids + [2] for _, x in rows]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    want = sorted(((i, len(x), crc(x)) for (i, _), x in zip(rows, ids, strict=True)), key=str)
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == want
    assert [s for _, s, _, _ in got] == np.append(0, np.cumsum([n for _, _, n, _ in got]))[:-1].tolist()
    keys = [(d is not None, d) for d, *_ in got]
    assert keys == sorted(keys)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert records.digest(empty, WORDS).collect() == [] and bpe.digest(empty, BYTES).collect() == []


def test_damage_is_noticed():
    data = bytearray(records.framed(7, np.arange(9), 2))
    assert records.unframed(memoryview(data), 0)[0] == 7
    data[25] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        records.unframed(memoryview(data), 0)


def test_letters_that_nfc_takes_apart_before_marks():
    t = Tokenizer.from_file(WORDS)
    letters = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and not 0x3400 <= ord(c) < 0xD800]
    words = ["হয়,", "क़.", "שׁ!", *(f"a{c}{m}" for c in letters[:20000] for m in (",", ".")), "plain,", "plain"]
    found = records.WordEncoder(WORDS).encode([w.encode() for w in words])
    wrong = [w for w, ids in zip(words, found, strict=True) if ids.tolist() != t.encode(w, add_special_tokens=False).ids]
    assert wrong == []


def test_ids_that_do_not_fit_are_refused():
    assert records.unframed(memoryview(records.framed(1, np.array([65535], "<u4"), 2)), 0)[1].tolist() == [65535]
    with pytest.raises(ValueError, match="65536 does not fit"):
        records.framed(1, np.array([3, 65536], "<u4"), 2)


def test_a_known_stem_is_not_encoded_again(monkeypatch):
    monkeypatch.setattr(records, "KEPT_WORDS", 4)
    encoder = records.WordEncoder(WORDS)
    encoder.encode([b"alpha beta gamma delta"])
    sent, ids = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: sent.extend(texts) or ids(texts))
    found = encoder.encode([b"alpha, beta."])[0].tolist()
    assert sorted(sent) == [",", "."]
    assert found == Tokenizer.from_file(WORDS).encode("alpha, beta.", add_special_tokens=False).ids


@pytest.mark.parametrize(("words", "size"), [(30, 1 << 20), (1 << 20, 200), (1 << 20, 1 << 20)])
def test_words_that_are_forgotten(monkeypatch, words, size):
    monkeypatch.setattr(records, "KEPT_WORDS", words)
    monkeypatch.setattr(records, "KEPT_BYTES", size)
    r, t = random.Random(words + size), Tokenizer.from_file(WORDS)
    stems = ["".join(r.choices("abcdeEéĦß", k=r.randint(1, 5))) for _ in range(60)]
    ends = ["", "", ",", ".", "...", "!?", "'s", "***", "12", ",x"]
    encoder = records.WordEncoder(WORDS)
    for _ in range(40):
        texts = [" ".join(r.choice(stems) + r.choice(ends) for _ in range(r.randint(0, 12))) + r.choice(["", " ", "\n"]) for _ in range(5)]
        found = encoder.encode([x.encode() for x in texts])
        assert [x.tolist() for x in found] == [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(encoder.known) <= words + 200
