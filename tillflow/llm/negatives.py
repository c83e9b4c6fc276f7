"""Hard negatives of a stated set of anchors, by products over residues and windows of scores.

Anchors stay in a task and the other rows pass by in chunks: a tile is a group of anchors and
a bucket of rows, so rows travel once for every group of anchors. Products are taken modulo
small primes (`residues`). A first round finds each anchor's positives, a second the best rows
of other labels within the window that each positive's score opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillflow.llm.common import stored
from tillflow.llm.residues import moduli, products, residues

#: Bytes of the anchors that a task holds, and anchors and rows multiplied together.
GROUP_BYTES, BLOCK, CHUNK = 1 << 25, 256, 4096
#: Rows of a bucket while there are few of them, and buckets at most.
BUCKET, MOST_BUCKETS = 8192, 1024
_NONE = np.iinfo(np.int64).min


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, vec, width, norm``: floor(scale * x) as whole doubles, and an upper bound of the length.

    Rows without id, label or vector, or with a component that is null or not finite, are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter("vec_id is not null and label is not null and embedding is not null").filter(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            with np.errstate(over="ignore"):
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale))
                at = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
                norms = [float((flat[a:b] ** 2).sum()) ** 0.5 * (1 + 1e-9) for a, b in zip(at, at[1:], strict=False)]
            raw = flat.astype("<f8").tobytes()
            vec = pa.array([raw[8 * a : 8 * b] for a, b in zip(at, at[1:], strict=False)], pa.binary())
            width = pa.array(np.diff(at).astype(np.int32))
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), vec, width, pa.array(norms, pa.float64())], names=["vec_id", "label", "vec", "width", "norm"])

    return rows.mapInArrow(emit, "vec_id long, label long, vec binary, width int, norm double")


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        part = np.frombuffer(v, "<f8")
        row[: len(part)] = part
    return out


class Best:
    """The ``k`` best of each slot so far: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.scores, self.ids = np.full((slots, k), _NONE), np.full((slots, k), np.iinfo(np.int64).max)
        self.k = k

    def beaten(self, slots: slice | np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which scores (slots by rows) come before the last one kept."""
        last, last_id = self.scores[slots, -1][:, None], self.ids[slots, -1][:, None]
        return (scores > last) | ((scores == last) & (ids[None, :] < last_id))

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, place = np.unique(slots, return_inverse=True)
        old = self.scores[touched]
        kept = old != _NONE
        slot = np.concatenate([np.nonzero(kept)[0], place])
        score = np.concatenate([old[kept], scores.astype(np.int64)])
        vec = np.concatenate([self.ids[touched][kept], ids])
        by = np.lexsort((vec, -score, slot))
        slot, score, vec = slot[by], score[by], vec[by]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        top = rank < self.k
        self.scores[touched[slot[top]], rank[top]] = score[top]
        self.ids[touched[slot[top]], rank[top]] = vec[top]


class Anchors:
    """A group of anchors that rows pass by."""

    def __init__(self, rows: pa.Table, primes: list[int], width: int, k: int):
        self.primes, self.width = primes, width
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.residues = residues(_matrix(rows["vec"].to_pylist(), width), primes)
        given = [p or [] for p in rows["positives"].to_pylist()] if "positives" in rows.column_names else None
        if given is None:
            self.best = Best(len(self.ids), k)
        else:
            # a column for each rank of the positives; where there are fewer, none
            self.most = max(map(len, given), default=0)
            self.has = np.array([[i < len(g) for i in range(self.most)] for g in given], bool).reshape(len(given), self.most)
            self.limits = np.array([[g[i] if i < len(g) else 0 for i in range(self.most)] for g in given], np.int64).reshape(len(given), self.most)
            self.best = Best(len(self.ids) * self.most, k)
        self.windows = given is not None

    def see(self, ids: np.ndarray, labels: np.ndarray, vectors: list[bytes], low: int, high: int) -> None:
        rows = residues(_matrix(vectors, self.width), self.primes)
        for a in range(0, len(self.ids), BLOCK):
            part = slice(a, min(a + BLOCK, len(self.ids)))
            scores = products([r[part] for r in self.residues], rows, self.primes)
            same = self.labels[part, None] == labels[None, :]
            if not self.windows:
                self._offer(np.arange(part.start, part.stop), scores, ids, same & (self.ids[part, None] != ids[None, :]))
                continue
            for i in range(self.most):
                limit = self.limits[part, i, None].astype(scores.dtype)
                inside = (low * limit <= 100 * scores) & (scores * 100 <= high * limit)
                slots = np.arange(part.start, part.stop) * self.most + i
                self._offer(slots, scores, ids, ~same & inside & self.has[part, i, None])

    def _offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        at, row = np.nonzero(allowed & self.best.beaten(slots, scores, ids).astype(bool))
        if len(at):
            self.best.offer(slots[at], scores[at, row], ids[row])

    def found(self) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.best.scores != _NONE)
        anchor, place = (slot // self.most, slot % self.most) if self.windows else (slot, np.zeros(len(slot), np.int64))
        columns = [self.ids[anchor], place.astype(np.int32), self.best.ids[slot, rank], self.best.scores[slot, rank]]
        return pa.record_batch([pa.array(c) for c in columns], names=["anchor_id", "place", "vec_id", "score"])


_FOUND = "anchor_id long, place int, vec_id long, score long"


def _search(batches: Iterator[pa.RecordBatch], primes: list[int], width: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Rows come by tile, its anchors before the others."""
    now, waiting, anchors = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        tile, kind = table["tile"].to_numpy(), table["kind"].to_numpy()
        edges = np.flatnonzero(np.append(True, (np.diff(tile) != 0) | (np.diff(kind) != 0))) if len(tile) else []
        for a, b in zip(edges, np.append(edges[1:], len(tile)), strict=True):
            if now != tile[a]:
                if anchors is not None:
                    yield anchors.found()
                now, waiting, anchors = tile[a], [], None
            part = table.slice(a, b - a)
            if kind[a] == 0:
                waiting.append(part)
                continue
            if anchors is None:
                if not waiting:
                    continue
                anchors = Anchors(pa.concat_tables(waiting), primes, width, k)
            for s in range(0, len(part), CHUNK):
                rows = part.slice(s, CHUNK)
                anchors.see(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), rows["vec"].to_pylist(), low, high)
    if anchors is not None:
        yield anchors.found()


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, scale: int = 256, low: int = 80, high: int = 100
) -> DataFrame:
    """The best rows of other labels whose score is ``low`` to ``high`` hundredths of a positive's.

    Takes ``vec_id, label, embedding`` and ignores other columns; see `whole_numbers` for rows
    that take no part. Anchors are the rows whose ``vec_id`` is divisible by ``every``; an id
    given twice is asked once, with its least label and vector, and rows of the anchor's own id
    are no positives. Of vectors of different lengths the missing components are zero. Scores
    are exact at any size; a table whose longest vectors' product passes 64 bits is refused.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; an
    empty table, or anchors without positives, give no rows.
    """
    rows = stored(whole_numbers(vectors, scale), "vectors")
    facts = rows.agg(
        F.count("*").alias("n"), F.max("norm").alias("norm"), F.max("width").alias("width"),
        F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("anchors"),
    ).first()
    width, longest = facts["width"] or 1, facts["norm"] or 0.0
    if longest >= 2.0**31.5:
        raise ValueError("products of the longest vectors pass 64 bits")
    primes = moduli(int(longest * longest * (1 + 1e-6)) + 1)
    groups = max(1, -(-facts["anchors"] * width * 8 // GROUP_BYTES))
    buckets = min(max(1, -(-facts["n"] // BUCKET)), MOST_BUCKETS)

    anchors = (
        rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("a"))
        .select("vec_id", "a.label", "a.vec", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("group"))
    )
    bucket = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(buckets))

    def tile(group: Column, bucket: Column) -> Column:
        return (group * buckets + bucket).alias("tile")

    others = rows.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), bucket.alias("bucket"), "vec_id", "label", "vec",
    ).select(tile(F.col("group"), F.col("bucket")), F.lit(1).alias("kind"), "vec_id", "label", "vec")

    def search(asked: DataFrame, k: int) -> DataFrame:
        each = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
        each = each.withColumns({"tile": tile(F.col("group"), F.col("bucket")), "kind": F.lit(0)}).drop("group", "bucket")
        dealt = each.unionByName(others, allowMissingColumns=True).repartition("tile").sortWithinPartitions("tile", "kind")
        return dealt.mapInArrow(lambda b: _search(b, primes, width, k, low, high), _FOUND)

    def ranked(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = stored(ranked(search(anchors, positives), positives), "positives")
    pairs = first.select("anchor_id", (F.col("rank") - 1).cast("int").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # at most ``positives`` scores an anchor, in order
    scores = F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
    known = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(scores.alias("positives"))
    second = ranked(search(anchors.join(known, "vec_id"), negatives), negatives)
    return second.join(pairs, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """Each seventh row under the next of ten labels, so that near rows of another label exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", moved.alias("label"), "embedding")


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
