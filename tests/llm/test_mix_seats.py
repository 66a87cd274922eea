"""op8: the seats won by highest quotients decide which blocks of words are taken, and for which shard."""

import collections

import pytest
from lendlake.llm import mixing
from lendlake.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def house(targets, block):
    """Sources in the order of their seats: always the highest quotient, down to half a block."""
    seats, order = collections.Counter(), []
    while True:
        best = min(targets, key=lambda s: (-targets[s][1] / (2 * seats[s] + 1), targets[s][0]))
        if targets[best][1] / (2 * seats[best] + 1) < block / 2:
            return order
        seats[best] += 1
        order.append(best)


def table(spark, blocks):
    rows = [("big", i, 900 + i) for i in range(60)] + [(f"s{i}", 1000 + i, 40 + 13 * i) for i in range(25)] + [(None, 2000, 5), ("none", 2001, 0)]
    df = spark.createDataFrame(rows, "source string, doc_id bigint, size bigint").repartition(3)
    return mixing.mix(df, ["doc_id"], blocks).collect()


def check(found, blocks):
    size, target = {}, {}
    for r in found:
        size[r.source], target[r.source] = r.source_size, r.target
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    block = max(1, int(1.5 * sum(size.values())) // blocks)
    expected = house({s: (order.index(s), target[s]) for s in order if size[s]}, block)
    won = collections.Counter(expected)
    assert all(r.blocks == won[r.source] for r in found)
    per_shard = -(-len(expected) // mixing.SHARDS)
    quota = collections.Counter((s, i // per_shard) for i, s in enumerate(expected))
    taken, seats = collections.Counter(), {}
    for r in found:
        for span in r.spans:
            taken[r.source, span.block] += span.words
            seats[r.source, span.block] = (span.seat, span.shard)
    filled = {key: seat for key, seat in seats.items() if seat[0] is not None}
    assert collections.Counter((s, shard) for (s, _), (_, shard) in filled.items()) == quota
    for s in order:
        own = {b: seats[s, b][0] for t, b in seats if t == s}
        assert sum(x is None for x in own.values()) <= 1
        assert sorted(x for x in own.values() if x is not None) == list(range(1, won[s] + 1))
        full = [taken[s, b] for b, seat in own.items() if seat is not None and seat < won[s]]
        assert all(words == block for words in full)
        assert sum(taken[s, b] for b in own) == pytest.approx(target[s], abs=0.51)


@pytest.mark.parametrize("blocks", [30, 500, 65536])
def test_seats_decide_the_blocks(spark, blocks):
    check(table(spark, blocks), blocks)


def test_seats_of_the_query(spark):
    check(QUERIES["op8_mixing"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source"), "doc_id").collect(), mixing.BLOCKS)


def test_without_seats_hardly_anything_is_taken(spark, monkeypatch):
    full = sum(r.taken for r in table(spark, 500))
    quotas = mixing.quotas
    monkeypatch.setattr(mixing, "quotas", lambda *args: quotas(*args).where(F.lit(False)))
    assert sum(r.taken for r in table(spark, 500)) < 0.1 * full


def test_rows_without_an_id_are_dealt_out(spark):
    """They do not stand together in the order of their source, so no bucket holds them all."""
    rows = [("a", None, i) for i in range(1, 300)]
    found = mixing.mix(spark.createDataFrame(rows, "source string, doc_id bigint, size bigint"), ["doc_id"], 100).collect()
    assert len(found) == 299 and sum(r.taken for r in found) == pytest.approx(found[0].target, abs=0.51)
    starts = [r.start for r in sorted(found, key=lambda r: r["size"])]
    assert starts != sorted(starts)


def test_rows_that_differ_in_other_columns_keep_them(spark):
    rows = [(1, "same text here", "s", "de"), (1, "same text here", "s", "en"), (None, "more of it", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    texts = mixing.mixed_texts(docs.withColumn("spans", F.lit(1)).withColumn("blocks", F.lit("b")))
    assert {(r.doc_id, r.lang, r.blocks) for r in texts.collect()} <= {(1, "de", "b"), (1, "en", "b"), (None, None, "b")}
    assert {r.lang for r in texts.where("doc_id = 1").collect()} == {"de", "en"}
