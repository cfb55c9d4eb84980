"""Queries of the operators; each reads its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costseries.llm import bpe, decontamination, fim, html, langid, linededup, negatives, ngramjoin, pii, quality, sharding, simhash, toxicity
from costseries.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def n_chars(text: str) -> Column:
    """Code points of a text, as the documents table counts them; null for a null text."""
    return F.length(text).cast("long")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "row.text", "n_lines", "n_removed")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate(table(spark, folder, "documents"))


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents")).drop("found")


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), vocabulary_path(), ids=False)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Today's layout is one of 20 shards by source; the new one has 24 shards of near-equal bytes."""
    docs = table(spark, folder, "documents")
    olds = 20
    placed = sharding.reshard(docs, F.pmod(F.xxhash64(docs.source), F.lit(olds)), olds)
    return placed.select(
        F.col("row.doc_id").alias("doc_id"), "size", F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old",
    )


def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngramjoin.join(table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fim.restore(fim.transform(table(spark, folder, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_quality_rules, op3_html, op4_decontamination, op5_language_id, op6_toxicity, op7_pii, op8_bpe, op9_simhash,
        op10_sharding, op11_ngram_join, op12_hard_negatives, op13_fill_in_middle,
    )
}
SQL: dict[str, str] = {
    "op1_line_dedup": linededup.sql(), "op2_quality_rules": quality.sql(), "op11_ngram_join": ngramjoin.sql(), "op12_hard_negatives": negatives.sql(), "op13_fill_in_middle": fim.sql(),
}
