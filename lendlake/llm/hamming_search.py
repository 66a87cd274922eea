"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A vector's code has a bit for each positive component. Bits that are equal in all codes are left out; the others are dealt to segments in the
order of their entropy, so that each segment gets its share of telling and of idle bits. A segment is about as wide as the binary logarithm of the number
of distinct codes, so a value of it has a few entries at any size of the table. Codes of each length have a layout of their own.

The index has an entry for each segment's value. Round r looks up all values that differ from the query's segment in exactly r bits. After it,
every code within m * (r + 1) - 1 bits (m segments) has been met, because one of its segments is within r bits. A query is done when its k-th
verified distance is no larger than that, or no code is left; only the others go into the next round. Where the probes up to a round would outnumber the
codes, growing further costs more than reading all codes: the queries still open are compared with every code, in blocks. Both
ways are exact. Native functions only.

Equal codes are one index entry with their k + 1 smallest ids, found in salted parts, so a vector that fills a third of the table is
met once. Ties in distance go to the smaller id. A vector is not its own neighbour; rows of the same id are one vector if their codes are
equal. Null or empty vectors have no code: they neither ask nor answer. A null id does not either. Vectors of different lengths are not
compared. An empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.sources.scratch import written

WORD = 16
SALTS = 64
BLOCK = 4096


def sign_words(vector: Column) -> Column:
    """The sign bits, WORD of them in an integer."""
    last = F.ceil(F.size(vector) / WORD).cast("int") - 1
    bits = F.sequence(F.lit(0), F.lit(WORD - 1))

    def word(s: Column) -> Column:
        on = lambda i: F.coalesce(F.get(vector, s * WORD + i) > 0, F.lit(False))
        return F.aggregate(bits, F.lit(0), lambda a, i: a + F.when(on(i), F.pow(F.lit(2), i).cast("int")).otherwise(0))

    return F.transform(F.sequence(F.lit(0), last), word)


def bit(words: Column | str, position: Column) -> Column:
    return F.getbit(F.get(words, F.floor(position / WORD).cast("int")), F.pmod(position, F.lit(WORD)))


def layouts(codes: DataFrame) -> DataFrame:
    """length, how many ``codes`` (length, words) there are, their number of varying bits and the bit positions of each segment."""
    positions = codes.select("length", "words", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("position"))
    ones = positions.groupBy("length", "position").agg(F.count(F.lit(1)).alias("codes"), F.sum(bit("words", F.col("position"))).alias("ones"))
    even = F.least("ones", F.col("codes") - F.col("ones"))
    by_entropy = Window.partitionBy("length").orderBy(F.desc("even"), "position")
    varying = ones.withColumn("even", even).where(F.col("even") > 0).withColumn("rank", F.row_number().over(by_entropy) - 1)
    varying = varying.withColumn("bits", F.count(F.lit(1)).over(Window.partitionBy("length")))
    segments = F.greatest(F.lit(1), F.round(F.col("bits") / F.ceil(F.log2("codes"))).cast("int"))
    dealt = varying.groupBy("length", "codes", "bits", F.pmod("rank", segments).alias("segment")).agg(F.sort_array(F.collect_list("position")).alias("positions"))
    return dealt.groupBy("length", "codes", "bits").agg(F.collect_list("positions").alias("segments"))


def coded(codes: DataFrame, layout: DataFrame) -> DataFrame:
    """Adds ``code``, the value of each segment; without varying bits there is none."""
    value = lambda held: F.aggregate(held, F.lit(0).cast("long"), lambda a, p: a * 2 + bit("words", p))
    beside = codes.join(layout, "length", "left").withColumns({"codes": F.coalesce("codes", F.lit(1)), "bits": F.coalesce("bits", F.lit(0))})
    beside = beside.withColumn("segments", F.coalesce("segments", F.array().cast("array<array<int>>")))
    return beside.withColumn("code", F.transform("segments", value)).withColumn("sizes", F.transform("segments", F.size)).drop("words", "segments")


def distance(x: str, y: str) -> Column:
    apart = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(apart, F.lit(0), lambda n, d: n + d)


def smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """The k smallest ids of each code."""
    for part in (["length", "words", "salt"], ["length", "words"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("id"))
        rows = rows.withColumn("place", rank).where(F.col("place") <= k)
    return rows.groupBy("length", "words").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def probes_to(radius: int) -> Column:
    """Probes of a query in all rounds up to ``radius``."""

    def of_size(size: Column) -> Column:
        term = total = F.lit(1.0)
        for i in range(radius):
            term = term * (size - i) / (i + 1)
            total = total + term
        return total

    return F.aggregate("sizes", F.lit(0.0), lambda n, size: n + of_size(size))


def probes(queries: DataFrame, radius: int) -> DataFrame:
    """query, length, segment and each value that differs from the query's in ``radius`` bits."""
    own = queries.select("query", "length", "sizes", F.posexplode("code").alias("segment", "value"))
    found = own.select("query", "length", "segment", "value", F.get("sizes", F.col("segment")).alias("size"), F.lit(0).alias("next"))
    for _ in range(radius):
        later = F.when(F.col("next") < F.col("size"), F.sequence("next", F.col("size") - 1))
        found = found.withColumn("flip", F.explode(later))
        flipped = F.col("value").bitwiseXOR(F.pow(F.lit(2), F.col("flip")).cast("long"))
        found = found.select("query", "length", "segment", flipped.alias("value"), "size", (F.col("flip") + 1).alias("next"))
    return found.select("query", "length", "segment", "value")


def candidates(queries: DataFrame, values: DataFrame, radius: int) -> DataFrame:
    """query and entry of all codes that ``radius`` meets."""
    # Spark takes the size of the probes for that of the queries; they are never broadcast.
    return probes(queries, radius).hint("merge").join(values, ["length", "segment", "value"]).select("query", "entry").distinct()


def in_blocks(queries: DataFrame, index: DataFrame) -> DataFrame:
    """query and entry of all codes of the query's length; blocks of codes meet copies of the queries."""
    last = F.floor((F.col("codes") - 1) / BLOCK).cast("int")
    asked = queries.select("query", "length", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    blocks = index.select("entry", "length", F.pmod(F.xxhash64("entry"), F.floor((F.col("codes") - 1) / BLOCK) + 1).cast("int").alias("block"))
    return asked.join(blocks, ["length", "block"]).select("query", "entry")


def nearest(met: DataFrame, queries: DataFrame, index: DataFrame, k: int, before: DataFrame | None = None) -> DataFrame:
    """The k nearest of what has been met, with those found earlier."""
    codes = index.select("entry", F.col("code").alias("other"), "ids")
    near = met.join(queries.select("query", "id", "code"), "query").join(codes, "entry")
    near = near.select("query", "id", F.explode("ids").alias("neighbor"), distance("code", "other").alias("distance"))
    near = near.where("neighbor <> id").select("query", "id", "neighbor", "distance")
    if before is not None:
        near = near.union(before.join(queries.select("query"), "query", "left_semi").select(*near.columns))
    order = Window.partitionBy("query").orderBy("distance", "neighbor")
    # An entry is met in several rounds; a neighbour under two codes keeps its nearer one.
    near = near.groupBy("query", "id", "neighbor").agg(F.min("distance").alias("distance"))
    return written(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")


def search(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, neighbor_id and distance of the k nearest rows; ``vectors`` has id and vector."""
    rows = vectors.where("id is not null and size(vector) > 0").select(
        F.col("id").cast("long").alias("id"), F.size("vector").alias("length"), sign_words(F.col("vector")).alias("words")
    )
    rows = written(rows.groupBy("id", "length", "words").agg(F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")), "codes")
    distinct = written(smallest_ids(rows, k + 1), "distinct_codes")
    layout = written(layouts(distinct), "layouts")
    index = written(coded(distinct, layout).withColumn("entry", F.monotonically_increasing_id()), "index")
    values = written(index.select("entry", "length", F.posexplode("code").alias("segment", "value")), "values")
    asked = coded(rows.where(queries).drop("salt"), layout).withColumn("query", F.monotonically_increasing_id())
    still_open, best, answers = written(asked, "queries"), None, []
    for radius in count():
        costly = F.greatest(probes_to(radius), F.lit(1.0)) >= F.col("codes")
        scanned = written(still_open.where(costly), "scanned")
        if scanned.count():
            answers.append(nearest(in_blocks(scanned, index), scanned, index, k))
        probing = still_open.where(~costly)
        now = nearest(candidates(probing, values, radius), probing, index, k, best)
        state = now.groupBy("query").agg(F.count(F.lit(1)).alias("found"), F.max("distance").alias("last"))
        covered = F.size("code") * (radius + 1) - 1
        done = ((F.col("found") >= k) & (F.col("last") <= covered)) | (covered >= F.col("bits"))
        joined = probing.join(state, "query", "left").withColumn("done", F.coalesce(done, F.lit(False)))
        still_open = written(joined.where(~F.col("done")).select(*asked.columns), "open")
        answers.append(now.join(still_open.select("query"), "query", "left_anti").select(*now.columns))
        best = now.drop("rank")
        if not still_open.count():
            break
    found = reduce(DataFrame.unionByName, answers)
    return found.select(F.col("id").alias("query_id"), "rank", F.col("neighbor").alias("neighbor_id"), "distance")
