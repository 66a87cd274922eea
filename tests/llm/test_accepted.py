"""The language stage of the pipeline keeps the columns of its input as they are, also those named like its own results."""

from lendlake.llm import language_id
from pyspark.sql import functions as F


def test_columns_of_the_input_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    named = docs.withColumn("score", F.lit("mine")).withColumn("lang_pred", F.col("doc_id")).withColumn("__row", F.lit(None).cast("int"))
    kept = language_id.accepted(named)
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in named.schema]
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in language_id.accepted(docs).collect()}
    assert len(rows) > 0.8 * docs.count()
    assert all(r.score == "mine" and r.lang_pred == r.doc_id for r in rows)
