"""A training corpus from raw documents: rows, stage after stage, each stage on what the last one kept.

The quality classifier drops documents that it rejects; line dedup takes repeated chunks of
lines out of the texts; of each group of near duplicates (SimHash fingerprints within 3 bits,
or five-word shingles of Jaccard similarity 0.8 or more) the document of smallest id stays;
documents that hold a passage of the benchmark go; the rest is encoded, decoded and counted.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import bpe, decontaminate, jaccard, lines, quality
from tillflow.llm.common import small_batches, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more. A null text is empty and scored like any other."""
    small_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs.select(*COLUMNS), model).filter("_score >= 0.5").drop("_score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that stand earlier; ``n_chars`` follows the text."""
    out = lines.drop_repeated_lines(docs.select(*COLUMNS)).select(*COLUMNS)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates; null is the smallest.

    Documents of one id stay or go together. SimHash links what differs in few of 64 bits, and
    min-hashes what is similar at 0.8 and more but further apart than that.
    """
    small_batches(spark)
    groups = jaccard.near_duplicates(docs.select("doc_id", "text"), distance=3)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(first, docs["doc_id"].cast("long").eqNullSafe(first["_kept"]), "left_semi").select(*COLUMNS)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. Documents of one id go together."""
    small_batches(spark)
    found = decontaminate.contained_items(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    dirty = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, docs["doc_id"].cast("long").eqNullSafe(dirty["_dirty"]), "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, their number and hash, and the hash of the text they decode to."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.round_trip(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), path)
    return both.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", keep_clean),
    ("bpe_encoding", encode),
]

#: The classifier is learnt, so no SQL gives its rows; tests hold the other stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
