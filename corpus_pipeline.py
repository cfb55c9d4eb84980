"""The corpus pipeline: documents pass five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costseries.llm import bpe, decontamination, linededup, quality, queries, simhash
from costseries.llm.common import table
from costseries.session import workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, repeated rows stay or go together, an empty table gives an empty one."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier one; ``n_chars`` counts the new text.

    Null and empty texts stay; rows equal in id and text lose the same lines; of equal lines the first by id, text hash and place stays.
    """
    return linededup.dedup(docs).select("row.*").withColumn("n_chars", queries.n_chars("text"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id.

    Texts without a word (null, empty, blank) are one group with any other fingerprint near zero; of repeated rows one stays.
    """
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts stay, repeated rows stay or go together, an empty benchmark keeps all."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digests; a null text counts as empty, repeated rows give repeated results."""
    return bpe.encode(docs, queries.vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]

ORACLE_SQL = None  # byte-pair merges are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after all stages. Every stage is landed in the shared folder, so a lost executor repeats one stage at most."""
    folder, docs = workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {**queries.QUERIES, "pipeline": run}
SQL = dict(queries.SQL)
