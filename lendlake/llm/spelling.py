"""Spelling variants of the words of a corpus: neighbours at one edit, found by sorted permuterm rotations.

A word's rotations are those of the word with an end mark. Take out the code point c of ``x c y``: the rotation ``y $ x c`` ends with it, so
the words that differ there only share the prefix ``y $ x``, and the word without it, ``x y``, has that prefix as a whole rotation. Sorted by
this prefix, each group holds the words with one more code point at that place, and at most one word without. A group has no more rows than there
are code points in the alphabet, plus one, whatever the corpus.

No pairs are emitted: in a scan of its group each word gets how many neighbours it has there and the most frequent of them, and these are added up by
word. A replacement is met in one group only. A deletion from a run of equal code points gives the same word for the whole run, so only the first
of the run counts for it.

Words come from ``words``: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z in lower case, summed over all documents in tasks first. Null and empty
texts have none. An empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.words import slices
from lendlake.sources.scratch import written

LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
HELD_WORDS = 300_000
END = "\x00"  # sorts before every letter
LETTER = "[A-Za-zÀ-ÿ]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def misspelled(doc_id: object, run: str, every: int) -> str:
    """``run``, or ``run`` without one code point if ``every`` divides the checksum of the document's id and the run."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, misspell_every: int = 0) -> DataFrame:
    """word and n: all words of ``least_chars`` code points or more that occur ``least_count`` times or more.

    ``misspell_every`` plants errors as ``misspelled`` says, 0 none. Runs of other lengths cannot give such a word: an error makes a run shorter.
    """
    # A shorter run has no part of that length, so whole maximal runs are found.
    pattern = re.compile(f"{LETTER}{{{least_chars},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own: Counter[str] = Counter()
                for run, n in Counter(pattern.findall(text or "")).items():
                    own[run.lower() if run.isascii() else run.translate(LOWER)] += n
                for run, n in own.items():
                    held[misspelled(doc_id, run, misspell_every) if misspell_every else run] += n
            if len(held) >= HELD_WORDS:
                yield rows(held)
                held = Counter()
        if held:
            yield rows(held)

    def rows(held: Counter[str]) -> pa.RecordBatch:
        kept = {w: n for w, n in held.items() if len(w) >= least_chars}
        return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(counted: DataFrame) -> DataFrame:
    """prefix, word, n and the edited code point ``at`` the end of the rotation, null for whole rotations; ``first`` of its run or not."""
    size = F.char_length("word")

    def cut(i: Column) -> Column:
        """The rotation without its last code point, the one at place i from 1."""
        prefix = F.concat(F.substr("word", i + 1), F.lit(END), F.substr("word", F.lit(1), i - 1))
        own = F.substr("word", i, F.lit(1))
        return F.struct(prefix.alias("prefix"), own.alias("at"), ((i == 1) | (F.substr("word", i - 1, F.lit(1)) != own)).alias("first"))

    def whole(i: Column) -> Column:
        prefix = F.concat(F.substr("word", i + 1), F.lit(END), F.substr("word", F.lit(1), i))
        return F.struct(prefix.alias("prefix"), F.lit(None).cast("string").alias("at"), F.lit(True).alias("first"))

    both = F.concat(F.transform(F.sequence(F.lit(1), size), cut), F.transform(F.sequence(F.lit(0), size), whole))
    return counted.select("word", "n", F.inline(both))


def neighbours(counted: DataFrame) -> DataFrame:
    """word, n_near and near, the most frequent near word (n and word; the first in code-point order of equals), of each word with a near word."""
    group = Window.partitionBy("prefix")
    order = group.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own, entry = F.col("at").isNotNull(), F.struct("n", "word")
    scanned = rotations(counted).select(
        "*",
        F.count(F.when(own, 1)).over(order).alias("edited"),
        F.count(F.when(own & F.col("first"), 1)).over(order).alias("longer"),
        F.first(F.when(own, entry), ignorenulls=True).over(order).alias("best"),
        F.nth_value(F.when(own, entry), 2, ignoreNulls=True).over(order).alias("second"),
        F.first(F.when(own & F.col("first"), entry), ignorenulls=True).over(order).alias("best_longer"),
        F.first(F.when(~own, entry), ignorenulls=True).over(order).alias("shorter"),
    )
    shorter = F.when(F.col("first"), F.col("shorter"))
    replaced = F.when(F.col("best.word") != F.col("word"), F.col("best")).otherwise(F.col("second"))
    more = F.col("edited") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)
    found = scanned.select(
        "word",
        F.when(own, more).otherwise(F.col("longer")).alias("n_near"),
        F.when(own, better(replaced, shorter)).otherwise(F.col("best_longer")).alias("near"),
    ).where("n_near > 0")
    best = F.min_by("near", F.struct(-F.col("near.n"), F.col("near.word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("near"))


def better(x: Column, y: Column) -> Column:
    """The more frequent of two entries, the first in code-point order of equals; nulls lose."""
    wins = (x["n"] > y["n"]) | ((x["n"] == y["n"]) & (x["word"] < y["word"]))
    return F.when(y.isNull() | wins, x).otherwise(y)


def with_forms(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form and form_n: the form is the most frequent near word if it is ``ratio`` times as frequent as the word or more."""
    joined = counted.join(neighbours(counted), "word", "left")
    usual = F.col("near.n") >= F.col("n") * ratio
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("near.word")).alias("form"), F.when(usual, F.col("near.n")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """Adds ``root``, the last word reached by following forms.

    Each step looks up the root so far of the root so far, so chains are halved; along a chain n grows by the ratio, so a handful of
    steps end it. A word is the form of no more words than it has near words, so no key is hot.
    """
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        links = written(links, "roots")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(onward, "root", "left_semi").isEmpty():
            break
        links = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO, misspell_every: int = 0) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of ``docs`` (doc_id and text)."""
    counted = written(words(docs, least_chars, least_count, misspell_every), "words")
    formed = written(with_forms(counted, ratio), "forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
