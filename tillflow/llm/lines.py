"""Line dedup by content-defined chunks of lines.

A hash rolls over the hashes of each line and the next; where it is small a chunk ends. An
end inside a passage follows from the passage alone, so shared passages fall into equal
chunks whatever stands around them. Chunks are short, often a line, so that passages of two
lines hold whole ones too. A repeated chunk is compared byte by byte with the first of its
kind; the lines before and after, where they are equal too, count to it, and what is several
lines goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import ordered_id, stored, whole_text

#: A chunk ends where the first hex digit of the rolling hash is below this: 14 of 16 lines.
ENDS_BELOW = "e"
#: Lines with other than white space that must be equal in a row to be removed.
LEAST_LINES = 2
#: Words of the filter that is broadcast: at most so many rows of two longs, 64 bits each.
FILTER_WORDS = 1 << 17


def _filled(line: Column) -> Column:
    return F.coalesce(F.trim(line) != "", F.lit(False))


def _chunked(docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with the chunks of ``text`` as ``_chunks``: ``idx`` of the first line, ``n`` lines,
    ``filled`` ones among them, ``text``, and the MD5 of the lines ``before`` and ``after``, null where there is none but blank."""
    names = docs.columns
    lines = docs.withColumn("_lines", F.split(text, "\n"))
    hashed = lines.withColumn("_h", F.transform("_lines", F.md5))
    pairs = F.arrays_zip(F.col("_h").alias("h"), F.slice("_h", 2, F.size("_h")).alias("next"))
    rolled = F.transform(pairs, lambda x: F.substring(F.md5(F.concat(x["h"], x["next"])), 1, 1))  # null at the last line
    marks = F.transform(rolled, lambda r, i: F.when(r.isNull() | (r < ENDS_BELOW), i))
    ended = hashed.withColumn("_ends", F.filter(marks, lambda i: i.isNotNull()))
    bounds = F.arrays_zip(
        F.concat(F.array(F.lit(-1)), F.slice("_ends", 1, F.size("_ends") - 1)).alias("last"), F.col("_ends").alias("end")
    )

    def around(i: Column) -> Column:
        return F.when(_filled(F.get("_lines", i)), F.unhex(F.get("_h", i)))

    def chunk(b: Column) -> Column:
        part = F.slice("_lines", b["last"] + 2, b["end"] - b["last"])
        return F.struct(
            (b["last"] + 1).alias("idx"),
            (b["end"] - b["last"]).alias("n"),
            F.size(F.filter(part, _filled)).alias("filled"),
            F.array_join(part, "\n").alias("text"),
            around(b["last"]).alias("before"),
            around(b["end"] + 1).alias("after"),
        )

    return ended.select(*names, F.transform(bounds, chunk).alias("_chunks"))


def _word(h: str) -> Column:
    return F.pmod(F.shiftright(h, 6), F.lit(FILTER_WORDS))


def _bit(h: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({h} & 63 as int))")


def drop_repeated_lines(docs: DataFrame, least_lines: int = LEAST_LINES) -> DataFrame:
    """Remove passages of ``least_lines`` lines or more, blank ones not counted, that occur earlier in the table.

    Earlier: under a smaller ``doc_id`` (null before all) or higher up in the same text. A
    passage is a chunk of lines whose bytes equal those of an earlier one, with the line before
    and the line after it, as far as they are not blank and equal those of the first such chunk
    (by 128 bits of MD5). A line goes if one such passage holds
    it; so the first of equal lines always stays, as does a repeated line whose neighbours
    differ. Rows of equal id and text get equal results; among texts of one id the one of
    least hash counts as the first. Null texts become empty; texts of one line stay as they are.

    Returns the columns of ``docs`` with the new ``text``, and the numbers of lines and of removed
    ones as ``_n_lines`` and ``_n_removed``; a table that has columns of these names is refused.
    """
    names = docs.columns
    if {"_n_lines", "_n_removed"} & {n.lower() for n in names}:
        raise ValueError("_n_lines and _n_removed are columns of the result")
    text = whole_text()
    rank = (F.col("_ord").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + F.col("idx")).cast("decimal(38,0)")
    chunks = (
        _chunked(docs.select(ordered_id().alias("_ord"), F.xxhash64(text).alias("_tid"), "text"), text)
        # Spark tests a plain explode for empty arrays below the scan's projections, and so
        # builds all chunks a second time, nested in one another
        .select("_ord", "_tid", F.explode_outer("_chunks").alias("c"))
        .filter("c.filled > 0")
        .select("_ord", "_tid", "c.*")
        .withColumn("h", F.xxhash64("text"))
    )
    repeated = stored(chunks.groupBy("h").agg(F.count("*").alias("m"), F.min(rank).alias("first")).filter("m > 1").drop("m"), "repeated_chunks")
    words = repeated.groupBy(_word("h").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits"))
    # the filter lets every repeated chunk pass and spares the rest a shuffle
    likely = chunks.withColumn("w", _word("h")).join(F.broadcast(words), "w").filter(_bit("h").bitwiseAND(F.col("bits")) != 0)
    held = stored(likely.drop("w", "bits").join(repeated, "h"), "held_chunks")
    parts = ("text", "before", "after")
    original = (
        held.filter(rank == F.col("first"))
        .groupBy("h").agg(F.min(F.struct("_tid", *parts)).alias("o"))
        .select("h", *(F.col(f"o.{c}").alias(f"first_{c}") for c in parts))
    )
    same = held.filter(rank > F.col("first")).join(original, "h").filter("text = first_text")
    for side in ("before", "after"):
        equal = F.coalesce(F.col(side) == F.col(f"first_{side}"), F.lit(False))
        same = same.withColumn(f"more_{side}", equal.cast("int"))
    gone = same.filter(F.col("filled") + F.col("more_before") + F.col("more_after") >= least_lines)
    passage = F.struct((F.col("idx") - F.col("more_before")).alias("a"), (F.col("idx") + F.col("n") - 1 + F.col("more_after")).alias("b"))
    by_doc = gone.groupBy("_ord", "_tid").agg(F.collect_set(passage).alias("_gone"))

    whole = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("_row"), ordered_id().alias("_ord"), F.xxhash64(text).alias("_tid"), text.alias("_text"))
    touched = F.col("_gone").isNotNull()
    lost = F.flatten(F.transform("_gone", lambda g: F.sequence(g["a"], g["b"])))
    cut = whole.join(by_doc, ["_ord", "_tid"], "left").withColumn("_lines", F.split("_text", "\n"))
    cut = cut.withColumn("_kept", F.when(touched, F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), lost)))
    kept = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    return cut.select(
        *(F.when(touched, kept).otherwise(F.col("_text")).alias("text") if n == "text" else F.col(f"_row.`{n}`").alias(n) for n in names),
        F.size("_lines").alias("_n_lines"),
        F.when(touched, F.size("_lines") - F.size("_kept")).otherwise(0).alias("_n_removed"),
    )


def digest(out: DataFrame) -> DataFrame:
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.col("_n_removed").cast("long").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


SQL = f"""
WITH hashed AS (
  SELECT doc_id, ls, list_transform(ls, lambda x: md5(x)) AS h
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), ended AS (
  SELECT doc_id, ls, list_filter(range(1, len(ls) + 1),
    lambda i: i = len(ls) OR md5(h[i] || h[i + 1])[1:1] < '{ENDS_BELOW}') AS ends
  FROM hashed
), chunks AS (
  SELECT doc_id, a + 1 AS head, b AS tail, array_to_string(ls[a + 1:b], chr(10)) AS part,
         len(list_filter(ls[a + 1:b], lambda x: trim(x) <> '')) AS filled, CASE WHEN a > 0 AND trim(ls[a]) <> '' THEN ls[a] END AS before,
         CASE WHEN trim(ls[b + 1]) <> '' THEN ls[b + 1] END AS after
  FROM (
    SELECT doc_id, ls, CASE WHEN k > 1 THEN ends[k - 1] ELSE 0 END AS a, ends[k] AS b
    FROM (SELECT *, unnest(range(1, len(ends) + 1)) AS k FROM ended))
), compared AS (
  SELECT *, row_number() OVER w > 1 AS later,
         coalesce(before = first_value(before) OVER w, false) AS same_before, coalesce(after = first_value(after) OVER w, false) AS same_after
  FROM chunks WHERE filled > 0
  WINDOW w AS (PARTITION BY part ORDER BY doc_id NULLS FIRST, head)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(head - CAST(same_before AS INT), tail + 1 + CAST(same_after AS INT))) AS i
  FROM compared
  WHERE later AND filled + CAST(same_before AS INT) + CAST(same_after AS INT) >= {LEAST_LINES}
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM hashed
)
SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.i = g.i
GROUP BY l.doc_id
"""
