"""op6 where one id, or none, has a great part of the rows; op1 where one window fills documents."""

import hashlib
import zlib

from lendlake.llm import sharding, substring_dedup


def test_rows_of_a_hot_or_missing_id_are_spread(spark):
    rows = [(None, f"a{i}") for i in range(3000)] + [(7, f"b{i}") for i in range(3000)] + [(i, f"c{i}") for i in range(3000)] + [(None, "a0")] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    counted = df.selectExpr("doc_id", "crc32(cast(text as binary)) as text_crc32")
    bounds = sorted({7, *range(0, 3000, 20)})
    sizes = sharding.apart(sharding.bucketed(counted, "doc_id", bounds), bounds).groupBy("bucket").count()
    assert sizes.agg({"count": "max"}).first()[0] < 40
    each, total = sharding.numbered(df)
    found = sorted(each.collect(), key=lambda r: r.row_number)
    assert [r.row_number for r in found] == list(range(len(rows))) and total == len(rows)
    order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]) for r in found]
    assert order == sorted(order)
    assert sorted(r.text_crc32 for r in found) == sorted(zlib.crc32(t.encode()) for _, t in rows)


def test_one_word_repeated_many_times(spark):
    rows = [(1, "x " * 20_000), (2, "x " * 30_000 + "y"), (3, "z " + "x " * 12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in substring_dedup.digest(df, size=13).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [(found[i].n_words, found[i].n_removed) for i in (1, 2, 3)] == [(20_000, 0), (30_001, 30_000), (13, 0)]
    assert found[2].kept_sha256 == sha("y") and found[3].kept_sha256 == sha(" ".join(rows[2][1].split()))


def test_few_windows_have_a_row_per_document(spark):
    keyed = substring_dedup.with_key(spark.createDataFrame([(1, "x " * 20_000), (2, "x " * 30_000)], "doc_id bigint, text string"))
    shared = spark.sparkContext.broadcast(substring_dedup.sketched(keyed, 13))
    find = substring_dedup.lists_of_starts(substring_dedup.repeats_finder(shared, 13, hot=False))
    listed = keyed.mapInArrow(find, substring_dedup.LISTED).collect()
    assert {(r.doc_id, len(r.starts)) for r in listed} == {(1, 19_988), (2, 29_988)} and len(listed) == 2
