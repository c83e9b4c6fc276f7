"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of regions and racks. A key draws a child at each level: every child
has a hash of key and child, stretched by its weight, and the least draw wins, so children
are chosen in proportion to weight. A child whose weight grows wins keys and loses none to
its siblings; movement stays inside subtrees whose weights change.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored, whole_text

#: Bytes a record takes besides its text.
RECORD_BYTES = 16
#: About so many rows are numbered together, over all shards.
BLOCK_ROWS = 1 << 20

Tree = list[tuple[int, int, int, float]]


def plain_tree(shards: int, racks: int = 4, per_rack: int = 5) -> Tree:
    """``region, rack, shard, weight`` of equal shards; full regions first, so a new one opens a region."""
    per_region = racks * per_rack
    return [(s // per_region, s % per_region // per_rack, s, 1.0) for s in range(shards)]


def _children(tree: Tree) -> list[dict[str, dict[str, float]]]:
    """For each level: the children of each node and their weights; nodes are named by their path."""
    levels: list[dict[str, dict[str, float]]] = [defaultdict(lambda: defaultdict(float)) for _ in range(3)]
    for region, rack, shard, weight in tree:
        path = [f"{region}", f"{region}.{rack}", f"{region}.{rack}.{shard}"]
        for level, (parent, child) in enumerate(zip(["", *path], path, strict=False)):
            levels[level][parent][child] += weight
    return levels


def drawn(key: Column, child: Column, weight: Column) -> Column:
    """An exponential draw of rate ``weight``, fixed by key and child."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), child)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1) / F.lit(float(2**52))) / weight


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) that the text column ``key`` descends to. Weights are above zero."""
    if any(w <= 0 for *_, w in tree):
        raise ValueError("weights must be above zero")
    at: Column = F.lit("")
    for level in _children(tree):
        pairs = []
        for parent, children in level.items():
            named = [F.struct(F.lit(c).alias("child"), F.lit(float(w)).alias("weight")) for c, w in children.items()]
            pairs += [F.lit(parent), F.array(*named)]
        choices = F.element_at(F.create_map(*pairs), at)
        draws = F.transform(choices, lambda c: F.struct(drawn(key, c["child"], c["weight"]).alias("draw"), c["child"].alias("child")))
        at = F.array_min(draws)["child"]
    return F.element_at(F.split(at, r"\."), -1).cast("int")


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Put each row of ``docs`` into a shard by its ``doc_id`` alone, and number the rows of each shard.

    Slots run from 0 without gaps, in the order of a hash of id, size and checksum. They
    are counted block by block of that hash, so no task holds a shard; rows equal in all
    three count as one until the end. A null id is the key ''; a null text has no bytes.

    Returns ``doc_id, size, text_crc32, shard, slot, grown_shard`` (by ``grown``; null without).
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    named = F.concat_ws("|", key, F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    equal = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    bits = max(4, math.ceil(math.log2(max(1, docs.count() / BLOCK_ROWS))))
    order = F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")
    drawn_rows = stored(
        equal.select(
            "*",
            shard_of(key, tree).alias("shard"),
            (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
            order.alias("place"),
        ).withColumn("block", F.shiftright("place", 60 - bits)),
        "sharded",
    )
    counts = drawn_rows.groupBy("shard", "block").agg(F.sum("n").alias("m"))
    starts = counts.selectExpr("shard", "block", "sum(m) over (partition by shard order by block) - m as start")
    within = drawn_rows.join(starts, ["shard", "block"]).selectExpr(
        "*", "sum(n) over (partition by shard, block order by place, doc_id, size, text_crc32) - n + start as base"
    )
    slots = F.explode(F.sequence("base", F.col("base") + F.col("n") - 1))
    return within.select("doc_id", "size", "text_crc32", "shard", slots.alias("slot"), "grown_shard")


def digest(out: DataFrame) -> DataFrame:
    return out.withColumn("law", F.lit("key"))


def _sql_level(key: str, parent: str, level: dict[str, dict[str, float]]) -> str:
    cases = []
    for name, children in level.items():
        draws = ", ".join(
            f"(-ln((CAST('0x' || md5({key} || '/{c}')[1:13] AS BIGINT) + 1) / 4503599627370496.0::DOUBLE) / {w}::DOUBLE, '{c}')"
            for c, w in children.items()
        )
        cases.append(f"WHEN '{name}' THEN list_min([{draws}])[2]")
    return f"CASE {parent} {' '.join(cases)} END"


def sql(tree: Tree, grown: Tree) -> str:
    key = "coalesce(CAST(doc_id AS VARCHAR), '')"
    text = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(b))
), bytes AS (
  SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents
), sized AS (
  SELECT doc_id, len(h) + 16 AS size,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(h, lambda x: CAST('0x' || x AS BIGINT))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
  FROM bytes, crc
)"""
    source = "sized"
    for side, levels in (("a", _children(tree)), ("b", _children(grown))):
        at = "''"
        for n, level in enumerate(levels):
            text += f""", {side}{n} AS (SELECT *, {_sql_level(key, at, level)} AS {side}{n}_at FROM {source})"""
            source, at = f"{side}{n}", f"{side}{n}_at"
    return text + f"""
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(split_part(a2_at, '.', 3) AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a2_at ORDER BY CAST('0x' || md5({key} || '|' || size || '|' || text_crc32)[1:15] AS BIGINT),
                          doc_id, size, text_crc32) - 1 AS slot,
       CAST(split_part(b2_at, '.', 3) AS INTEGER) AS grown_shard
FROM {source}
"""
