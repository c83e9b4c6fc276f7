"""A quality classifier from positive and unlabelled texts.

Trusted positives are texts labelled good; the unlabelled texts keep no label, and the share
of good ones among them, the class prior, is estimated from the labelled part. The model
minimises the non-negative unbiased risk: the positives' risk as good, plus the unlabelled
texts' risk as bad less the part that the prior lays to positives, held at zero or above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import portions, utf8, whole_text
from tillflow.llm.words import lowered, word_hashes

#: Labelled rows that a model is fitted on, at most; the first by a hash of their id.
SAMPLE = 20_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` that do not cross rows."""
    full = np.diff(offs) > 0
    before = np.append(False, inside[:-1])[: len(inside)]
    before[offs[:-1][full]] = False
    after = np.append(inside[1:], False)[: len(inside)]
    after[offs[1:][full] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _variety(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By row: the share of distinct hashes, and the share of the most frequent one."""
    total = np.maximum(np.bincount(row, minlength=n), 1)
    key = np.sort(row.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(key)))
    of = (key[head] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, of, size)
    return np.bincount(of, minlength=n) / total, most / total


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """What the model sees of each text: frequencies of bytes, and shares over words and lines."""
    n, sizes = len(offs) - 1, np.diff(offs)
    row = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
    length = np.maximum(sizes, 1)[:, None]
    space = _SPACE[data]
    starts, ends = _runs(~space, offs)
    words = word_hashes(lowered(data), starts, ends)
    of = row[starts] if len(starts) else starts
    n_words = np.bincount(of, minlength=n)
    distinct, most = _variety(of, words, n)
    again = np.zeros(n)
    if len(of) > 1:
        again = np.bincount(of[1:][(words[1:] == words[:-1]) & (of[1:] == of[:-1])], minlength=n)
    a, b = _runs(data != 10, offs)
    line_of = row[a] if len(a) else a
    lines, top_line = _variety(line_of, word_hashes(data, a, b), n)
    upper = counts[:, 65:91].sum(1)
    letters = np.maximum(upper + counts[:, 97:123].sum(1), 1)
    total = np.maximum(n_words, 1)
    marks = counts[:, 33:48].sum(1) + counts[:, 58:65].sum(1) + counts[:, 91:97].sum(1) + counts[:, 123:127].sum(1)
    share = counts / length
    entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(1)
    more = [
        distinct, most, again / total, lines, top_line, upper / letters, marks / total, entropy,
        np.log1p(sizes), np.log1p(n_words), sizes / total / 10, np.bincount(line_of, minlength=n) / total,
    ]
    return np.concatenate([np.sqrt(share), np.stack(more, 1)], 1).astype(np.float32)


class Model:
    """One hidden layer over scaled features."""

    def __init__(self, mean, scale, w1, b1, w2, b2):
        self.parts = (mean, scale, w1, b1, w2, b2)

    def score(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2 = self.parts
        z = np.maximum(np.clip((x - mean) * scale, -8, 8) @ w1 + b1, 0) @ w2 + b2
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 32, epochs: int = 80, seed: int = 1) -> Model:
    """Minimise the non-negative risk with logistic loss; with no positives or no rows, score one half."""
    width = unlabelled.shape[1] if unlabelled.ndim == 2 else positive.shape[1]
    if not len(positive) or not len(unlabelled):
        zero = np.zeros((width, 1))
        return Model(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), 0.0)
    r = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(0), 1 / np.maximum(unlabelled.std(0), 1e-3)
    p, u = (np.clip((x - mean) * scale, -8, 8).astype(np.float32) for x in (positive, unlabelled))
    w = [r.normal(0, (2 / width) ** 0.5, (width, hidden)), np.zeros(hidden), r.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    w = [x.astype(np.float32) for x in w]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    batch = 512
    for _ in range(epochs):
        by_u = r.permutation(len(u))
        for at in range(0, len(u), batch):
            xu = u[by_u[at : at + batch]]
            xp = p[r.integers(0, len(p), batch)]
            x = np.concatenate([xp, xu])
            h = np.maximum(x @ w[0] + w[1], 0)
            s = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            sp, su = s[: len(xp)], s[len(xp) :]
            bad = -np.log(np.maximum(1 - su, 1e-6)).mean() - prior * -np.log(np.maximum(1 - sp, 1e-6)).mean()
            if bad >= 0:
                g = np.concatenate([(prior * (sp - 1) - prior * sp) / len(xp), su / len(xu)])
            else:  # a risk below zero is fitted noise: step back from it
                g = np.concatenate([prior * sp / len(xp), -su / len(xu)])
            g = g.astype(np.float32)
            gh = np.outer(g, w[2]) * (h > 0)
            grads = [x.T @ gh + 1e-4 * w[0], gh.sum(0), h.T @ g + 1e-4 * w[2], g.sum(keepdims=True)]
            t += 1
            for k, d in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = w[k] - 2e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    model = Model(mean, scale, w[0], w[1], w[2], w[3])
    w[3] = w[3] - _cut(np.log(1 / np.maximum(1 - model.score(unlabelled), 1e-13) - 1 + 1e-13), prior)
    return Model(mean, scale, w[0], w[1], w[2], w[3])


def _cut(logits: np.ndarray, prior: float) -> float:
    """Where as many unlabelled texts lie above as the prior says: the widest gap within its error."""
    z, n = np.sort(logits), len(logits)
    error = 2 * (n * prior * (1 - prior)) ** 0.5
    low, high = (int(np.clip(n * (1 - prior) + d, 0, n - 1)) for d in (-error, error))
    if high <= low:
        return 0.0 if low in (0, n - 1) else float(z[low])
    at = low + int(np.argmax(np.diff(z[low : high + 1])))
    return float((z[at] + z[at + 1]) / 2)


def in_fold(doc_id: str = "doc_id"):
    """The held-out third: crc32 of the id's text leaves 1 by 3. A null id is held out never."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and a fair coin of at most ``sample`` labelled rows outside the held-out third.

    Labels that are null or neither 0 nor 1, and null ids, are left out; of several labels of one id the least holds.
    """
    chosen = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .filter(~in_fold())
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # at most ``sample`` rows of two numbers: small enough to send to every executor
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j, part, offs in portions(data, offsets):
                x = features(part, offs)
                cols = [batch.column(c).slice(i, j - i) for c in ("doc_id", "quality")]
                yield pa.record_batch([*cols, pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])

    got = rows.mapInArrow(emit, "doc_id long, quality int, x binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    raw = got["x"].to_pylist()
    x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1) if raw else np.zeros((0, 268), np.float32)
    coin = np.random.default_rng(2).random(len(raw)) < 0.5
    return x, got["quality"].to_numpy(), coin


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on good texts of one half of the labelled sample, and on the other half without labels."""
    x, y, coin = labelled_features(docs, labels, sample)
    trusted = coin & (y == 1)
    prior = float(y[coin].mean()) if coin.any() else 0.5
    return fit(x[trusted], x[~coin], prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``, the chance of good quality by the whole text. Null texts are empty."""
    names = docs.columns

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            for i, j, part, offs in portions(data, offsets):
                score = pa.array(model.score(features(part, offs)))
                yield pa.record_batch([*(batch.column(n).slice(i, j - i) for n in names), score], names=[*names, "_score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.withColumn("_text", whole_text()).mapInArrow(emit, f"{kinds}, _score double")


def digest(docs: DataFrame, model: Model) -> DataFrame:
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", in_fold().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
