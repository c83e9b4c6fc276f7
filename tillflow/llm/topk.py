"""Exact top-k by inner product with buckets of like length.

Vectors are grouped into bands of length. A first look at the longest band gives each query
a score that its k-th best reaches at least. A band is passed over where that score is out
of reach for its longest vector. Elsewhere the score, over the lengths of query and bucket,
is a local cosine threshold: where it is low the bucket is cut at the length that can still
reach the score, where it is high vectors are left out whose share in a few leading
coordinates rules the cosine out. What stays is verified by whole-number products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillflow.llm.common import stored

BANDS = 16
#: Vectors of a bucket; a band has as many buckets as it needs.
BUCKET = 4096
#: Queries verified together.
BLOCK = 256
#: Local cosine from which coordinates prune better than lengths.
COORDINATES_FROM = 0.35
#: Leading coordinates of a query that are looked at.
FOCUS = 3

_FOUND = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, vec, norm``: floor(scale * x) as 64-bit words, and an upper bound of the length.

    Vectors that are null or hold a null or a component that is not finite are left out, as
    are rows without id. Components beyond 2**62 are cut to it.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            flat = np.floor(np.clip(lists.flatten().to_numpy(zero_copy_only=False) * float(scale), -(2.0**62), 2.0**62))
            at = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
            squares = [float((flat[a:b] ** 2).sum()) for a, b in zip(at, at[1:], strict=False)]
            raw, at = flat.astype("<i8").tobytes(), (at * 8).tolist()
            norm = np.sqrt(np.array(squares, np.float64)) * (1 + 1e-9)
            vec = pa.array([raw[a:b] for a, b in zip(at, at[1:], strict=False)], pa.binary())
            yield pa.record_batch([batch.column("vec_id"), vec, pa.array(norm)], names=["vec_id", "vec", "norm"])

    return rows.mapInArrow(emit, "vec_id long, vec binary, norm double")


def _matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of 64-bit words, shorter ones filled up with zeros."""
    parts = [np.frombuffer(v, "<i8") for v in column.to_pylist()]
    out = np.zeros((len(parts), max([width, *map(len, parts)])), np.int64)
    for row, p in zip(out, parts, strict=True):
        row[: len(p)] = p
    return out


class Bucket:
    """Vectors of one bucket, longest first."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        self.ids, self.norms = rows["vec_id"].to_numpy(), rows["norm"].to_numpy()
        self.vectors = _matrix(rows["vec"])
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64)
        self.units = self.floats / np.maximum(self.norms, 1e-300)[:, None]

    def candidates(self, q: np.ndarray, norm: float, least: float) -> np.ndarray | slice:
        """The rows that may score ``least`` or more with ``q``."""
        if not least > 0:
            return slice(None)  # a score of zero or less rules no length out
        reach = least * (1 - 1e-6)
        if norm * self.norms[0] < reach:
            return slice(0, 0)
        cosine = reach / (norm * self.norms[0])
        n = int(np.searchsorted(-self.norms, -reach / norm, "right"))
        if cosine < COORDINATES_FROM:
            return slice(0, n)
        unit = q / norm
        stay = np.arange(n)
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            # the other coordinates add at most what their lengths allow
            part = self.units[stay, f]
            bound = unit[f] * part + np.sqrt(max(0.0, 1 - unit[f] ** 2) * np.maximum(0, 1 - part**2))
            stay = stay[bound >= cosine - 1e-6]
        return stay

    def scores(self, q: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        if int(np.abs(q).max(initial=0)) * self.largest * max(1, len(q)) < 2**53:
            return (self.floats[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ q  # of 64 bits, which may wrap

    def best(self, query_id: int, q: np.ndarray, norm: float, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best that reach ``least``; ties go to the smaller id."""
        width = self.vectors.shape[1]
        q = q[:width] if len(q) >= width else np.append(q, np.zeros(width - len(q), np.int64))
        rows = self.candidates(q, norm, least)
        ids, scores = self.ids[rows], self.scores(q, rows)
        ok = (scores >= least) & (ids != query_id)
        ids, scores = ids[ok], scores[ok]
        if len(ids) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            ok = scores >= edge
            ids, scores = ids[ok], scores[ok]
        by = np.lexsort((ids, -scores))[:k]
        return ids[by], scores[by]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, its vectors before its queries."""
    now, vectors, bucket = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        place = table["bucket"].to_numpy()
        kind = table["kind"].to_numpy()
        edges = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (np.diff(kind) != 0))) if len(place) else []
        for a, b in zip(edges, np.append(edges[1:], len(place)), strict=True):
            part = table.slice(a, b - a)
            if now != place[a]:
                now, vectors, bucket = place[a], [], None
            if kind[a] == 0:
                vectors.append(part)
                continue
            if bucket is None:
                if not vectors:
                    continue
                bucket = Bucket(pa.concat_tables(vectors))
            for s in range(0, len(part), BLOCK):
                block = part.slice(s, BLOCK)
                found = []
                q = [np.frombuffer(v, "<i8") for v in block["vec"].to_pylist()]
                least = block["least"].to_numpy()
                for i, (qid, norm) in enumerate(zip(block["vec_id"].to_pylist(), block["norm"].to_pylist(), strict=True)):
                    ids, scores = bucket.best(qid, q[i], norm, float("-inf") if np.isnan(least[i]) else least[i], k)
                    found.append((np.full(len(ids), qid, np.int64), ids, scores))
                cols = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.record_batch(cols, names=["query_id", "vec_id", "score"])


def top_products(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, bands: int = BANDS) -> DataFrame:
    """The ``k`` best other rows of each query, by the product of vectors of whole numbers.

    Queries are the rows whose ``vec_id`` is divisible by ``every``. Ties go to the smaller
    ``vec_id``. See ``whole_numbers`` for vectors that take no part. Of vectors of different
    lengths the missing components are zero. Rows of the query's own id are no candidates;
    an id given twice is asked once, with its shorter vector. Other columns are ignored.

    Returns ``query_id, rank, vec_id, score``.
    """
    rows = stored(whole_numbers(vectors, scale), "vectors")
    shares = [i / bands for i in range(1, bands)]
    edges = sorted(set(rows.agg(F.percentile_approx("norm", shares, 10_000)).first()[0] or []))
    band = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col("norm"))) if edges else F.lit(0)
    rows = rows.withColumn("band", band.cast("long"))
    known = rows.groupBy("band").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).orderBy("band").collect()  # one row a band
    buckets = {r["band"]: -(-r["n"] // BUCKET) for r in known}
    # a bucket's number: that of its band, and then its own
    spread = F.element_at(F.create_map(*(F.lit(x) for p in buckets.items() for x in p)), F.col("band")) if buckets else F.lit(1)
    bucket = F.col("band") * 2**40 + F.pmod(F.xxhash64("vec_id"), spread)
    filed = rows.select(bucket.alias("bucket"), F.lit(0).alias("kind"), "vec_id", "vec", "norm", F.lit(None).cast("double").alias("least"))
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .groupBy("vec_id").agg(F.min(F.struct("norm", "vec")).alias("q"))
        .select("vec_id", "q.vec", "q.norm")
    )

    def visits(queries: DataFrame, some: list) -> DataFrame:
        """A row for each query and bucket of the bands that may hold its ``least``."""
        ways = F.array(
            *(
                F.struct(F.lit(r["band"]).alias("band"), F.lit(r["longest"]).alias("longest"), F.lit(buckets[r["band"]]).alias("n"))
                for r in some
            )
        )
        near = F.filter(ways, lambda w: F.coalesce((F.col("least") <= 0) | (w["longest"] * F.col("norm") >= F.col("least") * (1 - 1e-6)), F.lit(True)))
        each = F.flatten(F.transform(near, lambda w: F.transform(F.sequence(F.lit(0), w["n"] - 1), lambda i: w["band"] * 2**40 + i)))
        return queries.select(F.explode(each).alias("bucket"), F.lit(1).alias("kind"), "vec_id", "vec", "norm", "least")

    def search(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        dealt = candidates.unionByName(queries).repartition("bucket").sortWithinPartitions("bucket", "kind")
        return dealt.mapInArrow(lambda b: _search(b, k), _FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    if not known:
        return ranked(rows.selectExpr("vec_id as query_id", "vec_id", "vec_id as score")).select("query_id", "rank", "vec_id", "score")
    top = known[-1]["band"]
    open_ended = visits(asked.withColumn("least", F.lit(None).cast("double")), known[-1:])
    first = stored(ranked(search(filed.filter(F.col("bucket") >= top * 2**40), open_ended)), "first_look")
    least = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    second = asked.join(least, "vec_id", "left")
    rest = known[:-1]
    found = first.select("query_id", "vec_id", "score")
    if rest:
        found = found.unionByName(search(filed.filter(F.col("bucket") < top * 2**40), visits(second, rest)))
    return ranked(found).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
