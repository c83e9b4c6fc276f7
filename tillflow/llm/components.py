"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored


def smallest_reachable(links: DataFrame, rounds: int = 50) -> DataFrame:
    """For each end of ``links`` (``a``, ``b``, longs): the smallest node it reaches, as ``node, root``.

    Alternates two star steps until nothing changes: every node's larger neighbours are
    linked to its least one, then its smaller neighbours are. The number of rounds grows
    with the logarithm of the number of nodes. Each round is written to the shared folder.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links"
    )
    last = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small, "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = mark
    raise RuntimeError(f"components did not settle in {rounds} rounds")
