"""The numbered queries: each applies its operator to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import (bpe, codes, language, lsh_forest, mixing, phrases, pivot_search, quality, sharding, simhash, suffixes, toxicity,
                          urls)
from viewtide.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLE[name] = sql
        return plan

    return add


@query("op1_simhash_trie")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents"))


@query("op5_quality_qda")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_bpe_speculative")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"))


@query("op9_mix_temperature")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


@query("op10_toxicity_grammar")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_shard_kdtree")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


@query("op2_ann_lsh_forest")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.nearest(table(spark, folder, "embeddings"))


@query("op3_topk_pivot")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_search.top_products(table(spark, folder, "embeddings"))


@query("op4_url_link_graph", urls.ORACLE_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op7_language_centroids")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


@query("op13_vector_codes", codes.ORACLE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return codes.vector_codes(table(spark, folder, "embeddings"))


@query("op11_phrase_fingerprints", phrases.ORACLE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query("op12_suffix_family", suffixes.ORACLE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeat_digests(table(spark, folder, "documents"))
