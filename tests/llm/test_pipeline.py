"""The corpus pipeline on the smallest tables and on empty ones."""

import corpus_pipeline
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, tmp_path, empty):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0 if empty else 10**6)
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        assert name == "packing" or docs.columns == columns
    assert all(counts) != empty
    if not empty:
        assert counts[0] >= counts[1] >= counts[2]
        assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
