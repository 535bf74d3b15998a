"""The corpus pipeline: documents in; cleaned, deduplicated, mixed and tokenized documents out.

Each stage takes all rows that its predecessor kept, with the columns of documents; the last adds what tokenizing yields.
A stage reads nothing from the folder but ``labels``, which the two classifiers learn from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import bpe, mixing, quality, simhash, toxicity
from viewtide.llm.common import fresh, store
from viewtide.session import ship_package


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject."""
    ship_package(spark)
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return simhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to half again as often as the largest."""
    return mixing.mixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number of tokens and the hashes of the ids and of the decoded text."""
    ship_package(spark)
    out = fresh(docs, "digest")
    rows = docs.withColumn(out, bpe.digests(F.col("text"), bpe.default_path()))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns],
                       *[F.col(out)[c].alias(fresh(docs, c)) for c in bpe.DIGEST.names])


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", civil),
    ("SimHash near-dedup", one_of_each),
    ("mixing sources to target weights", mixed_sources),
    ("BPE encoding and decoding", tokenized),
]
#: SQL can express neither the classifiers nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stage's rows written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
