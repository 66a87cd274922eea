"""Nearest binary codes against brute force."""

import numpy as np
import pytest
from lendlake.llm import hamming_search
from lendlake.llm.hamming_search import search
from lendlake.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def brute(table, asked, k):
    codes = [(i, tuple(x is not None and x > 0 for x in v)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in table if v and i is not None)]
    out = []
    for i, x in codes:
        if asked(i):
            near = sorted((sum(a != b for a, b in zip(x, y, strict=True)), j) for j, y in codes if j != i and len(x) == len(y))
            out += [(i, r, j, d) for r, (d, j) in enumerate(near[:k], 1)]
    return sorted(out)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = sorted(tuple(r) for r in QUERIES["op7_hamming_search"](spark, SF_DIR).collect())
    assert found == brute([tuple(r) for r in rows], lambda i: i % 50 == 0, 10)


@pytest.mark.parametrize("n", [0, 1, 3, 60])
def test_edges(spark, n):
    rng = np.random.default_rng(n)
    table = [(i, [float(x) for x in rng.normal(size=20)] if i % 3 else [1.0] * 20) for i in range(n)]
    table += table[:2] + ([(None, [1.0] * 20), (99, None), (98, [])] if n else [])
    df = spark.createDataFrame(table, "id bigint, vector array<double>").repartition(3)
    assert sorted(tuple(r) for r in search(df, F.col("id") % 5 == 0, 4).collect()) == brute(table, lambda i: i % 5 == 0, 4)


def vectors(spark, n, width, constant=0, seed=3):
    rng = np.random.default_rng(seed)
    made = [(i, [1.0] * constant + [float(x) for x in rng.normal(size=width - constant)]) for i in range(n)]
    return made, spark.createDataFrame(made, "id bigint, vector array<double>").repartition(4)


def test_bits_equal_everywhere_make_no_segment(spark):
    made, df = vectors(spark, 800, 40, constant=16)
    layout = hamming_search.layouts(hamming_search.smallest_ids(
        df.select("id", F.size("vector").alias("length"), hamming_search.sign_words(F.col("vector")).alias("words"), F.lit(0).alias("salt")), 5
    )).first()
    assert sorted(sum(layout["segments"], [])) == list(range(16, 40))
    found = sorted(tuple(r) for r in search(df, F.col("id") % 20 == 0, 3).collect())
    assert found == brute(made, lambda i: i % 20 == 0, 3)


def test_equal_codes_and_lengths_side_by_side(spark):
    made = [(i, [1.0] * 12) for i in range(30)] + [(30 + i, [1.0, -1.0, 1.0 - 2 * (i % 2)]) for i in range(9)]
    df = spark.createDataFrame(made, "id bigint, vector array<double>")
    assert sorted(tuple(r) for r in search(df, F.col("id") % 5 == 0, 4).collect()) == brute(made, lambda i: i % 5 == 0, 4)


def test_candidates_of_a_query_do_not_grow_with_the_table(spark):
    met = {}
    for n in (1000, 8000):
        _, df = vectors(spark, n, 64)
        rows = df.select("id", F.size("vector").alias("length"), hamming_search.sign_words(F.col("vector")).alias("words"))
        layout = hamming_search.layouts(rows)
        index = hamming_search.coded(rows, layout).withColumn("entry", F.col("id")).cache()
        values = index.select("entry", "length", F.posexplode("code").alias("segment", "value"))
        asked = index.where("id % 100 = 0").withColumn("query", F.col("id"))
        met[n] = hamming_search.candidates(asked, values, 1).count() / (n / 100)
        index.unpersist()
    assert met[8000] < 2 * met[1000]


def test_clashing_columns_are_not_used(spark):
    made, df = vectors(spark, 120, 24)
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("code", "query", "entry", "length", "distance", "rank", "salt")])
    assert sorted(tuple(r) for r in search(clashing, F.col("id") % 10 == 0, 4).collect()) == brute(made, lambda i: i % 10 == 0, 4)
