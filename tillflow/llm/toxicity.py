"""A toxicity classifier over deobfuscated text.

Texts are restored by the noisy channel (`channel`), whose language model is counted over all
documents. The classifier looks at which words and beginnings of words a restored text holds.
Words are chosen one at a time, each for what the chosen ones leave unexplained, so words that
merely keep company with a telling one (copies of a text have many) are left out; a logistic
model over the chosen ones gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.channel import Channel, counted
from tillflow.llm.common import portions, stored, utf8, whole_text
from tillflow.llm.words import mixed, word_hashes

#: Labelled documents that a model is fitted on, at most; the first by a hash of their id.
SAMPLE = 20_000
#: Words looked at when choosing: those that tell most by themselves, at most so many.
WORDS = 4096
#: Beginnings of words that count beside the words, in bytes; and how many words of one
#: beginning a text must hold, as endings of a telling stem vary and single words may be chance.
BEGINNINGS, TIMES = (4, 5, 6, 7, 8), (1, 2, 3)
#: Chosen words at most, and the least gain (half a squared standard score) to choose one more.
CHOSEN, LEAST_GAIN = 256, 5.0
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[128:] = True


def held_out(doc_id: str = "doc_id"):
    """The third whose crc32 of the id's text leaves 1 by 3. A null id is held out never."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def word_features(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of row and hash, for rows that end in a line end.

    A hash stands for a word, or for a beginning that so many different longer words share.
    """
    inside = _LETTERS[text]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(starts, a, "right") - 1
    row, code, at = _distinct(row, word_hashes(text, a, b))
    a, b = a[at], b[at]
    rows, codes = [row], [code]
    for k in BEGINNINGS:
        long = b - a > k
        of, stem, _ = _sorted(row[long], mixed(word_hashes(text, a[long], a[long] + k) + np.uint64(k)))
        head = np.flatnonzero(_heads(of, stem))
        n = np.diff(np.append(head, len(of)))
        for times in TIMES:
            some = head[n >= times]
            rows.append(of[some])
            codes.append(stem[some] + np.uint64(times))
    return np.concatenate(rows), np.concatenate(codes)


def _sorted(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by = np.lexsort((code, row))
    return row[by], code[by], by


def _heads(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])) if len(row) else np.zeros(0, bool)


def _distinct(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, code, by = _sorted(row, code)
    new = _heads(row, code)
    return row[new], code[new], by[new]


def _present(channel: Channel, data: np.ndarray, offs: np.ndarray, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and hash; with ``only`` (sorted), of row and place in it, by row."""
    row, code = word_features(*channel.restored(data, offs))
    if only is None:
        return row, code
    if not len(only):
        return row[:0], row[:0]
    at = np.minimum(np.searchsorted(only, code), len(only) - 1)
    known = only[at] == code
    by = np.lexsort((at[known], row[known]))
    return row[known][by], at[known][by]


class Model:
    """Weights of word hashes, and where the score starts."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        by = np.argsort(hashes)
        self.hashes, self.weights, self.bias = hashes[by], weights[by], bias

    def score(self, channel: Channel, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        row, place = _present(channel, data, offs, self.hashes)
        z = self.bias + np.bincount(row, self.weights[place], len(offs) - 1) if len(row) else np.full(len(offs) - 1, self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def choose(row: np.ndarray, place: np.ndarray, y: np.ndarray, n_words: int) -> list[int]:
    """Words whose presence raises the odds most, given those chosen before.

    ``row, place``: which words each document holds. Each step takes the word with the largest
    score statistic against the present odds, and sets its weight by Newton's method.
    """
    by = np.argsort(place, kind="stable")
    row, place = row[by], place[by]
    at = np.searchsorted(place, np.arange(n_words + 1))
    z = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)) if len(y) else 0.0)
    chosen: list[int] = []
    while len(chosen) < CHOSEN:
        p = 1 / (1 + np.exp(-z))
        slope = np.bincount(place, (y - p)[row], n_words)
        bend = np.bincount(place, (p * (1 - p))[row], n_words) + 1e-2
        gain = np.where(slope > 0, slope * slope / bend / 2, 0)
        gain[chosen] = 0
        best = int(np.argmax(gain)) if n_words else 0
        # one document says little: the odds must rise in two or more
        if not n_words or gain[best] < LEAST_GAIN or slope[best] < 1.2:
            break
        chosen.append(best)
        docs = row[at[best] : at[best + 1]]
        step = 0.0
        for _ in range(30):
            q = 1 / (1 + np.exp(-(z[docs] + step)))
            step += float(np.clip(((y[docs] - q).sum() - 0.02 * step) / ((q * (1 - q)).sum() + 0.02), -2, 2))
        z[docs] += step
    return chosen


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 60) -> tuple[np.ndarray, float]:
    """Logistic weights of a few columns, by Newton's method with a ridge."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = ridge / 10
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (p - y) + penalty * w
        bend = (full * (p * (1 - p))[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``sample`` documents outside the held-out third.

    Labels that are null or neither 0 nor 1, and null ids, are left out; of several labels of
    one id the least holds, of several texts the first by a hash.
    """
    chosen = (
        labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
        .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # at most ``sample`` rows of two numbers: small enough to send to every executor
    found = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")
    return found.groupBy("doc_id").agg(first, F.first("toxic").alias("toxic")).select("doc_id", "t.text", "toxic")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Channel, Model]:
    """The channel from all documents, and the model from labelled ones.

    Without labels of both kinds every text scores one half or the share of toxic ones.
    """
    channel = Channel(*counted(docs))
    known = stored(labelled(docs, labels, sample), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for i, j, part, offs in portions(data, offsets):
                row, code = _present(channel, part, offs)
                codes, at = np.unique(code, return_inverse=True)
                bad = np.bincount(at, toxic[i:j][row], len(codes)).astype(np.int64)
                n = np.bincount(at, minlength=len(codes))
                yield pa.record_batch([pa.array(codes.astype(np.int64)), pa.array(bad), pa.array(n)], names=["code", "bad", "n"])

    facts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    share = (facts["bad"] + 1) / (facts["n"] + 2)
    words = known.mapInArrow(count, "code long, bad long, n long").groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    # the likelihood ratio of "as often as elsewhere", for words more often toxic than others
    odds = F.col("bad") * F.log(F.col("bad") / F.col("n") / share)
    rest = F.when(F.col("n") > F.col("bad"), (F.col("n") - F.col("bad")) * F.log((1 - F.col("bad") / F.col("n")) / (1 - share))).otherwise(0.0)
    telling = (
        words.filter((F.col("bad") >= 2) & (F.col("bad") / F.col("n") > share))
        .select("code", (odds + rest).alias("tells")).orderBy(F.desc("tells"), "code").limit(WORDS)
    )
    codes = np.sort(telling.toArrow()["code"].to_numpy().astype(np.uint64))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j, part, offs in portions(data, offsets):
                row, place = _present(channel, part, offs, codes)
                at = np.searchsorted(row, np.arange(j - i + 1))
                has = [place[a:b].astype(np.int32) for a, b in zip(at, at[1:], strict=False)]
                cols = [batch.column("doc_id").slice(i, j - i), batch.column("toxic").slice(i, j - i), pa.array(has, pa.list_(pa.int32()))]
                yield pa.record_batch(cols, names=["doc_id", "toxic", "has"])

    # at most ``sample`` rows of a few small numbers
    seen = known.mapInArrow(look, "doc_id long, toxic int, has array<int>").toArrow().sort_by("doc_id")
    y = seen["toxic"].to_numpy().astype(float)
    has = seen["has"].to_pylist()
    row = np.repeat(np.arange(len(has)), [len(h) for h in has]).astype(np.int64)
    place = np.array([p for h in has for p in h], np.int64)
    chosen = choose(row, place, y, len(codes))
    x = np.zeros((len(y), len(chosen)))
    for k, c in enumerate(chosen):
        x[row[place == c], k] = 1
    weights, bias = fit(x, y) if len(y) else (np.zeros(0), 0.0)
    return channel, Model(codes[chosen], weights, bias)


def scored(docs: DataFrame, channel: Channel, model: Model, text: str = "text", score: str = "toxicity", restored: str | None = None) -> DataFrame:
    """``docs`` with ``score``, the chance that the whole text is toxic; a null text is empty.

    ``restored`` names a column for the deobfuscated, lower-cased text. The new columns
    replace columns of these names, in any case; others are kept.
    """
    new = {score.lower(), *([restored.lower()] if restored else [])}
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(len(kept)))
            for i, j, part, offs in portions(data, offsets):
                cols = [batch.column(k).slice(i, j - i) for k in range(len(kept))]
                cols.append(pa.array(model.score(channel, part, offs)))
                if restored:
                    whole, at = channel.restored(part, offs)
                    raw = whole.tobytes()
                    cols.append(pa.array([raw[a : b - 1].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)], pa.string()))
                yield pa.record_batch(cols, names=names)

    names = [*(f.name for f in kept), score, *([restored] if restored else [])]
    kinds = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept] + [f"`{score}` double"] + ([f"`{restored}` string"] if restored else [])
    columns = [F.col(f"`{f.name.replace('`', '``')}`") for f in kept]
    return docs.select(*columns, whole_text(text).alias("__toxicity_text")).mapInArrow(emit, ", ".join(kinds))


def digest(docs: DataFrame, channel: Channel, model: Model) -> DataFrame:
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), channel, model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"))
