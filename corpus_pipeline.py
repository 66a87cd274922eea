"""From raw documents to packed sequences: one stage after another, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``docs`` needs doc_id, text,
lang and source. Null columns, empty texts, repeated rows and empty tables are handled as the operators state; documents
without a recognised language, which includes empty ones, leave in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendlake.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from lendlake.llm.queries import documents, vocabulary
from lendlake.llm.shipping import ship
from lendlake.sources.scratch import scratch_root

#: No SQL: the first stage is a trained model and the last needs a tokenizer.
ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises."""
    ship(spark)
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles."""
    ship(spark)
    return jaccard_join.representatives(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document has."""
    ship(spark)
    return substring_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts the mix takes; a document read twice is there twice."""
    return mixing.mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    root = scratch_root(spark)
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
