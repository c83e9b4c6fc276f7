"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item asks for its windows: each ``window`` words in a row, or all words of a
shorter item. A window is contained only where all its shingles are, so by the rule of
prefix filtering one shingle, the rarest in the documents, is the necessary prefix. Only
that token is joined. Its place in the window and the length bound where the window may lie;
there the words themselves are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import bit_filter, ordered_id, passes, portions, stored, utf8, whole_text
from tillflow.llm.words import lowered, shingle_hashes, word_hashes, word_places

#: Bits of each broadcast filter: 4 MB, whatever the size of the benchmark.
FILTER_BITS = 25


def _tokens(part: np.ndarray, offs: np.ndarray, sizes: list[int]):
    """Lower-cased bytes, word places, and by shingle size the token of each word (0 for none)."""
    low = lowered(part)
    starts, ends, first = word_places(low, offs)
    hashes = word_hashes(low, starts, ends)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(starts))  # words to the row's end
    found = []
    for size in sizes:
        token = shingle_hashes(hashes, size)
        at = np.flatnonzero(left[: len(token)] >= size)
        found.append((at, token[at]))
    return low, starts, ends, first, found


def _item_windows(batches, window: int, shingle: int):
    """A row for each shingle of each window of each item."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("item_id").to_pylist()
        rows = []
        for i in range(len(ids)):
            part, offs = data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]])
            low, starts, ends, first, _ = _tokens(part, offs, [])
            raw = low.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts, ends, strict=True)]
            if not words:
                continue
            n = min(window, len(words))
            size = min(shingle, n)
            token = shingle_hashes(word_hashes(low, starts, ends), size).view(np.int64)
            for s in range(len(words) - n + 1):
                text = " ".join(words[s : s + n])
                rows += [(ids[i], text, n, size, k, int(token[s + k])) for k in range(n - size + 1)]
        names = ["item_id", "window", "n", "size", "at", "key"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def contained_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Which words of each document lie in a window of a benchmark item, and of which items.

    Words are runs of digits, letters a-z (A-Z are lowered first) and characters beyond ASCII,
    of whole texts; null texts have none. Items without words ask for nothing; items of one id
    count once; a null id counts as ''. Rows of equal id and text get equal results. Other
    columns are ignored.

    Returns ``doc_id``, ``n_words``, ``spans`` (word ranges ``[start, end)`` of the windows
    found, ascending, may overlap) and ``items`` (ids as strings, sorted), a row for each input row.
    """
    context = docs.sparkSession.sparkContext
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), whole_text().alias("text"))
    shingles = stored(
        items.mapInArrow(
            lambda b: _item_windows(b, window, shingle), "item_id string, window string, n int, size int, at int, key long"
        ),
        "windows",
    )
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()]  # at most ``shingle`` numbers
    text = whole_text()
    rows = docs.select("doc_id", ordered_id().alias("ord"), F.xxhash64(text).alias("tid"), text.alias("text"))

    asked = context.broadcast(bit_filter(shingles.select("key").distinct(), FILTER_BITS))

    def count_tokens(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for _, _, part, offs in portions(data, offsets):
                found = _tokens(part, offs, sizes)[-1]
                token = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.uint64)
                token, n = np.unique(token[passes(asked.value, token)], return_counts=True)
                yield pa.record_batch([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    counts = rows.select("text").mapInArrow(count_tokens, "key long, n long").groupBy("key").agg(F.sum("n").alias("rarity"))
    distinct = shingles.select("window", "n", "at", "key").distinct()
    rarest = F.min(F.struct(F.col("rarity"), F.col("at"), F.col("key"))).alias("p")
    # a shingle the documents lack rules its window out
    prefix = stored(
        distinct.join(counts, "key", "left")
        .groupBy("window", "n")
        .agg(F.count("rarity").alias("present"), F.count("*").alias("asked"), rarest)
        .filter("present = asked")
        .select("window", "n", "p.at", "p.key"),
        "prefixes",
    )
    joined = context.broadcast(bit_filter(prefix.select("key").distinct(), FILTER_BITS))

    def candidates(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            cols = {c: batch.column(c) for c in ("doc_id", "ord", "tid")}
            for i, j, part, offs in portions(data, offsets):
                low, starts, ends, first, found = _tokens(part, offs, sizes)
                at = np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.int64)
                token = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.uint64)
                ok = passes(joined.value, token)
                at, token = at[ok], token[ok]
                by = np.argsort(at, kind="stable")
                at, token = at[by], token[by].view(np.int64)
                row = np.searchsorted(first, at, "right") - 1
                begin = np.maximum(at - window + 1, first[row])
                end = np.minimum(at + window, first[row + 1])
                raw = low.tobytes()
                around = [
                    " ".join(raw[s:e].decode() for s, e in zip(starts[b:f].tolist(), ends[b:f].tolist(), strict=True))
                    for b, f in zip(begin, end, strict=True)
                ]
                pairs = pa.StructArray.from_arrays(
                    [pa.array(token), pa.array((at - first[row]).astype(np.int32)), pa.array((at - begin).astype(np.int32)), pa.array(around, pa.string())],
                    names=["key", "pos", "before", "around"],
                )
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32()), pairs)
                yield pa.record_batch(
                    [cols["doc_id"].slice(i, j - i), cols["ord"].slice(i, j - i), cols["tid"].slice(i, j - i), pa.array(np.diff(first)), lists],
                    names=["doc_id", "ord", "tid", "n_words", "found"],
                )

    kind = "doc_id long, ord long, tid long, n_words long, found array<struct<key:long,pos:int,before:int,around:string>>"
    by_doc = stored(rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(candidates, kind), "candidates")
    begin = F.col("before") - F.col("at")
    hits = (
        by_doc.select("ord", "tid", "n_words", F.explode("found").alias("f"))
        .select("ord", "tid", "n_words", "f.*")
        .join(prefix, "key")
        .withColumn("start", F.col("pos") - F.col("at"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
        .filter(F.array_join(F.slice(F.split("around", " "), F.greatest(begin, F.lit(0)) + 1, F.col("n")), " ") == F.col("window"))
        .select("ord", "tid", "window", F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n")).cast("long").alias("end")).alias("span"))
    )
    hits = stored(hits, "hits")
    spans = hits.groupBy("ord", "tid").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    owners = shingles.select("item_id", "window").distinct()
    of = (
        hits.select("ord", "tid", "window").distinct().join(owners, "window").select("ord", "tid", "item_id").distinct()
        .groupBy("ord", "tid").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    found = spans.join(of, ["ord", "tid"])
    return by_doc.drop("found").join(found, ["ord", "tid"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def digest(out: DataFrame) -> DataFrame:
    """The result by document: counts and the hash of the items found."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(s["end"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
        ),
    )["n"]
    return out.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_CAPS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = rf"regexp_extract_all(translate(coalesce(text, ''), '{_CAPS}', '{_SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH words AS (
  SELECT doc_id, {_SPLIT} AS w FROM documents
), items AS (
  SELECT item_id, {_SPLIT} AS w FROM benchmark
), asked AS (
  SELECT DISTINCT item_id, 10 AS n, array_to_string(w[p:p + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS p FROM items WHERE len(w) >= 10)
  UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM items WHERE len(w) BETWEEN 1 AND 9
), lengths AS (
  SELECT DISTINCT n FROM asked
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words
), ten AS (
  SELECT doc_id, p, array_agg(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w
  FROM placed
), hits AS (
  SELECT doc_id, p, t.n, item_id
  FROM (SELECT doc_id, p, n, array_to_string(w[1:n], ' ') AS win FROM ten, lengths WHERE len(w) >= n) t
  JOIN asked a ON a.n = t.n AND a.win = t.win
), covered AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
