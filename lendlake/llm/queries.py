"""Registered queries of the numbered operators: each on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.llm import (
    hamming_search,
    hard_negatives,
    jaccard_join,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    packing,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
)
from lendlake.llm.oracle import ORACLE
from lendlake.llm.shipping import ship

SHARDS = 40


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(documents(spark, sf_dir).select("doc_id", "text"), size=13)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(documents(spark, sf_dir).select("doc_id", "text"), words=3, percent=90)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = language_id.split_remainder(3) == 1
    model = language_id.learn(docs.where(~held_out))
    predicted = language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return predicted.select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir).select("doc_id", "text"), SHARDS)
    law = [F.lit("rows").alias("law"), F.col("shard"), F.col("slot"), F.lit(None).cast("int").alias("grown_shard")]
    return placed.select("doc_id", "size", "text_crc32", *law)


def op7_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return hamming_search.search(vectors, F.col("id") % 50 == 0, k=10)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "blocks", "spans")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = language_id.split_remainder(7) == 2
    scored = lm_scoring.score(docs, *lm_scoring.learn(docs.where(~held_out)))
    return scored.withColumn("held_out", held_out)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components as whole 256ths; the label of every seventh id is moved on by one."""
    ship(spark)
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    number = F.transform("embedding", lambda x: x.cast("double") * 256)
    whole = F.forall(number, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("embedding", F.when(whole, number))
    rows = table.select(F.col("vec_id").alias("id"), moved.alias("label"), F.transform("embedding", lambda x: F.floor(x)).alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir).select("doc_id", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir).select("doc_id", "text"), misspell_every=31)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_sharding": op6_sharding,
    "op7_hamming_search": op7_hamming_search,
    "op8_mixing": op8_mixing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
__all__ = ["ORACLE", "QUERIES"]
