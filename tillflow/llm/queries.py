"""Queries that apply the operators to the whole driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import (
    bpe,
    conversations,
    decontaminate,
    hosts,
    lines,
    negatives,
    quality,
    records,
    sharding,
    simhash,
    substrings,
    topk,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.drop_repeats(table(spark, sf_dir, "documents")))


@query(decontaminate.SQL)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contained_items(docs, items))


@query()
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


@query(hosts.sql())
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge_urls(table(spark, sf_dir, "pages"), hosts.RULES)


_TREE, _GROWN = sharding.plain_tree(40), sharding.plain_tree(41)


@query(sharding.sql(_TREE, _GROWN))
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.assign_shards(table(spark, sf_dir, "documents"), _TREE, _GROWN))


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.digest(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query(topk.SQL)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


@query(lines.SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.drop_repeated_lines(table(spark, sf_dir, "documents")))


@query()
def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(conversations.SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.digest(rows, conversations.damaged(rows))


@query(negatives.SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.digest(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))
