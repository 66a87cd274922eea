"""Mixing of sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Targets: sources in code point order, a null last, weigh 3, 1, 2, repeating, and share a multiple of all words; a target stops at
twice its source's words, and the excess is shared again by weight among the others (a running sum over sources ordered by where
they stop gives the same as repeating that).

Blocks: the mix is dealt in about BLOCKS blocks of equally many words, whatever the size of the input. Seats go one after another to the source
with the highest quotient target / (2 * seats - 1), ties to the earlier source, as long as the quotient is half a block or more; so the
house has as many seats as all targets rounded to blocks, and no source is off its target by more than half a block. A shard is a run of
consecutive seats, which gives each shard an integer quota of blocks per source.

Selection: a source's documents stand in seeded order and are read twice; each block is a run of words of these two readings. A source fills
the seats it has won, and only these, with blocks of the first reading in seeded order, then of the second, so no word is taken more than
twice. What rounding to blocks leaves is evened out by one block at most: the last seat's block is cut to the words wanted, or one block without a
seat, in a shard by hash, gives the words that are wanted beyond the seats. So a source without a seat, one smaller than a block, still gets its target.

Null texts and texts without words have size 0 and nothing is taken of them. Equal rows (source, id, key columns) are counted before
positions are summed, and each gets its own position. A table without words has targets 0. Other columns are
not used, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.prefix import running_total
from lendlake.llm.words import PATTERN
from lendlake.sources.scratch import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCKS = 65_536
SHARDS = 64
BUCKET_ROWS = 1 << 14
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``rank``, source_size and target of each source; ``sizes`` has a row per source: source, source_size."""
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    weighed = weighed.withColumn("most", F.col("source_size") * MOST).withColumn("total", F.sum("source_size").over(everything) * F.lit(SHARE))
    by_stop = [F.col("most") / F.col("weight"), F.col("rank")]
    later = Window.orderBy(*by_stop).rowsBetween(0, Window.unboundedFollowing)
    earlier = Window.orderBy(*by_stop).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("most").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    levels = weighed.withColumn("level", level)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    # The first level that its source does not exceed holds for all sources.
    shared = levels.withColumn("level", F.coalesce(F.first(reached, True).over(Window.orderBy(*by_stop).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0)))
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    return shared.select("source", "rank", "source_size", target.alias("target"), F.col("total"))


def quotas(targets: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """Seats: rank, seat (1, 2, ...) and shard; at most ``blocks`` rows and one per source are sorted at once."""
    sized = targets.where("source_size > 0").withColumn("block_words", block_size(blocks))
    upper = F.ceil(F.col("target") / F.col("block_words"))
    tries = sized.where(upper > 0).withColumn("seat", F.explode(F.sequence(F.lit(1).cast("long"), upper)))
    won = tries.withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1)).where(F.col("quotient") >= F.col("block_words") / 2)
    order = Window.orderBy(F.desc("quotient"), "rank", "seat")
    numbered = won.withColumn("house", F.row_number().over(order)).withColumn("seats", F.count(F.lit(1)).over(Window.partitionBy()))
    per_shard = F.ceil(F.col("seats") / shards)
    return numbered.select("rank", "seat", F.floor((F.col("house") - 1) / per_shard).cast("int").alias("shard"))


def block_size(blocks: int) -> Column:
    return F.greatest(F.lit(1), F.floor(F.col("total") / blocks)).cast("long")


def selected_blocks(seats: DataFrame, targets: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """rank, block, its seat, shard and words taken; block b begins at word b * block_words of two readings. ``seats`` is used twice: a written table."""
    sized = targets.where("source_size > 0").withColumn("block_words", block_size(blocks)).withColumn("wanted", F.round("target").cast("long"))
    begin, most = F.col("block") * F.col("block_words"), F.col("source_size") * MOST
    all_blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(most / F.col("block_words")) - 1)))
    # A block that the end of the second reading cuts comes last, where no more than its words can be left.
    partial = (begin + F.col("block_words") > most).cast("int")
    reading = (begin >= F.col("source_size")).cast("int")
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.col("rank"), F.col("block")).cast("binary"))
    order = Window.partitionBy("rank").orderBy(partial, reading, drawn, "block")
    numbered = all_blocks.withColumn("seat", F.row_number().over(order).cast("long"))
    won = seats.groupBy(F.col("rank").alias("__rank")).agg(F.count(F.lit(1)).alias("blocks"))
    numbered = numbered.join(F.broadcast(won), F.col("rank") == F.col("__rank"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)))
    left = F.col("wanted") - (F.col("seat") - 1) * F.col("block_words")
    numbered = numbered.where(F.col("seat") <= F.col("blocks") + 1).withColumn("words", F.least("block_words", left)).where("words > 0")
    dealt = numbered.join(seats.select("rank", "seat", "shard"), ["rank", "seat"], "left")
    spare = F.pmod(F.xxhash64(F.lit(seed), "rank", "seat"), F.lit(shards)).cast("int")
    seat = F.when(F.col("shard").isNotNull(), F.col("seat")).alias("seat")
    return dealt.select("rank", "block", seat, F.coalesce("shard", spare).alias("shard"), F.col("words").alias("block_taken"))


def mix(rows: DataFrame, keys: list[str], blocks: int = BLOCKS, seed: str = SEED) -> DataFrame:
    """What the mix takes of each row of ``rows``, which has source, size and ``keys`` (doc_id among them).

    Returns a row for each row: source, keys, size, copy (0 on for equal rows), source_size, target, taken, and spans:
    reading, first word, words, block, seat (null beyond the seats) and shard of each piece that is taken. ``blocks`` is the number of seats that the
    row's source has won.
    """
    columns = ["source", *[k for k in keys if k != "source"], "size"]
    counted = written(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")), "sized")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    targets = written(source_targets(sizes), "targets")
    seats = written(quotas(targets, blocks), "seats")
    chosen = selected_blocks(seats, targets, blocks, seed=seed)
    won = seats.groupBy("rank").agg(F.count(F.lit(1)).alias("blocks"))
    targets = targets.join(won, "rank", "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)))

    rows_of_bucket = counted.agg(F.count(F.lit(1))).first()[0] / BUCKET_ROWS
    digits = max(1, math.ceil(math.log(max(rows_of_bucket, 1), 16)))
    ranked = counted.join(targets.select(F.col("source").alias("__source"), "rank", "source_size", "target", "total", "blocks"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # Rows without an id, or with the same, are dealt out by the rest of their key.
    drawn = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in [*keys, "size"]]).cast("binary"))
    placed = ranked.withColumn("drawn", drawn).withColumn("bucket", F.substring("drawn", 1, digits)).withColumn("words", F.col("size") * F.col("copies"))
    order = ["drawn", *[F.asc_nulls_first(k) for k in keys], "size"]
    placed = running_total(placed, ["rank"], "bucket", order, "words", "start").drop("words", "bucket", "drawn")
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    each = each.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))

    readings = each.withColumn("block_words", block_size(blocks)).drop("total").withColumn("reading", F.explode(F.array(F.lit(0), F.lit(1))))
    readings = readings.withColumn("begin", F.col("start") + F.col("reading") * F.col("source_size")).withColumn("end", F.col("begin") + F.col("size"))
    spanned = F.sequence(F.floor(F.col("begin") / F.col("block_words")), F.floor((F.col("end") - 1) / F.col("block_words")))
    parts = readings.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, spanned)))
    found = parts.join(chosen, ["rank", "block"], "left")
    first = F.greatest(F.col("begin"), F.col("block") * F.col("block_words"))
    last = F.least(F.col("end"), F.col("block") * F.col("block_words") + F.col("block_taken"))
    span = F.struct("reading", (first - F.col("begin")).alias("first"), (last - first).alias("words"), "block", "seat", "shard")
    found = found.withColumn("span", F.when(F.col("shard").isNotNull() & (last > first), span))
    taken = F.coalesce(F.sum("span.words"), F.lit(0)).alias("taken")
    return found.groupBy(*columns, "copy", "start", "source_size", "target", "blocks").agg(taken, F.sort_array(F.collect_list("span")).alias("spans"))


def mix_documents(docs: DataFrame, blocks: int = BLOCKS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, blocks and spans of each document."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(rows, ["doc_id"], blocks, seed)


def mixed_texts(docs: DataFrame, blocks: int = BLOCKS, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each reading of a document of which words are taken.

    A reading taken whole keeps its text as it is; of another, the taken words are joined by one space and n_chars, where
    there is such a column, is counted anew. A document read twice has two rows of the same id.
    """
    keyed = docs.withColumn("__size", word_count(F.col("text"))).withColumn("__key", F.xxhash64(*docs.columns))
    rows = keyed.select("doc_id", "source", F.col("__size").alias("size"), F.col("__key").alias("key"))
    spans = mix(rows, ["doc_id", "key"], blocks, seed).where("taken > 0")
    pieces = spans.select("doc_id", "source", "key", F.explode("spans").alias("span"), "copy")
    readings = pieces.groupBy("doc_id", "source", "key", "copy", "span.reading").agg(F.sort_array(F.collect_list(F.struct("span.first", "span.words"))).alias("spans"))
    readings = readings.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("key").alias("__key"), "spans")
    # Equal rows share their readings: one of them stands for all.
    one = keyed.groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "__key").agg(F.max(F.struct("__size", *docs.columns)).alias("__row"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("__id", "__source", "__key")]
    joined = one.alias("a").join(readings.alias("b"), same[0] & same[1] & same[2])
    words = F.filter(F.split("__row.text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.concat_ws(" ", F.flatten(F.transform("spans", lambda s: F.slice(words, (s["first"] + 1).cast("int"), s["words"].cast("int")))))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    text = F.when(total == F.col("__row.__size"), F.col("__row.text")).otherwise(cut)
    result = joined.select(*[F.col(f"__row.{c}").alias(c) for c in docs.columns if c != "text"], text.alias("text"))
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns)
