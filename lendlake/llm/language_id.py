"""Language identification with bit-sliced Bloom filters over character n-grams.

Every learned language has a Bloom filter of the n-grams that are more usual in it than in the others. The filters are stored across:
one cell holds the same bit of all filters, so that a probe returns the mask of all languages whose filter has an n-gram, whatever
their number. A text's hits per language are counted from the masks, corrected for the filter's false positives, and divided
by the share of n-grams that the filter covers in its own language; the largest share decides.

Learning takes about SAMPLE documents of each language, chosen by a hash of the id (a documented bound; prediction covers every text
whole), and at most MOST_NGRAMS n-grams of each language, the most frequent first, which bounds what is broadcast. There is no least
count, so a language with a single short document has a filter too.

A null text, or one without a letter, is ``und`` with score 0. A text with letters but no known n-gram gets the most
frequent learned language with score 0; ties go to the more frequent language, then to the first by code point. Without any labelled
row everything is ``und``. Rows are predicted one by one, so repeated rows get equal results; extra columns pass
through ``identify`` (own columns win over equal names); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.words import mix, slices

SAMPLE = 2_000
MOST_NGRAMS = 16_384
CONTRAST = 1.5
PROBES = 3
BITS_PER_NGRAM = 16
UNKNOWN = "und"
LEAST_SCORE = 0.2


@cache
def letters() -> np.ndarray:
    """Code point -> lower-case code point, or a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and chr(code).isalpha():
            table[code] = ord(chr(code).lower()[0])
    return table


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and key of each three-character n-gram around a letter, and which rows have a letter.

    A key holds the code points themselves, so different n-grams never share one.
    """
    texts = pc.fill_null(column, "").to_pylist()
    joined = "  ".join(["", *texts, ""])
    codes = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = 2 + np.concatenate([[0], np.cumsum(lengths[:-1] + 2)]) if len(texts) else np.empty(0, np.int64)
    middle = np.flatnonzero(codes[1:-1] != 32) + 1
    rows = np.searchsorted(starts, middle, "right") - 1
    keys = codes[middle - 1] | codes[middle] << np.uint64(21) | codes[middle + 1] << np.uint64(42)
    return rows, keys, np.bincount(rows, minlength=len(texts))


@dataclass
class Model:
    """Masks of all filters by cell, and what each filter covers and lets through wrongly."""

    languages: list[str]
    masks: np.ndarray
    cover: np.ndarray
    wrong: np.ndarray

    def cells(self, keys: np.ndarray) -> list[np.ndarray]:
        first, step = mix(keys), mix(keys ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
        return [(first + np.uint64(i) * step) & np.uint64(len(self.masks) - 1) for i in range(PROBES)]

    def add(self, language: int, keys: np.ndarray) -> None:
        for cell in self.cells(keys):
            self.masks[cell, language // 64] |= np.uint64(1 << language % 64)

    def hits(self, rows: np.ndarray, keys: np.ndarray, n_rows: int) -> np.ndarray:
        """N-grams of each row that each language's filter has."""
        first, *others = self.cells(keys)
        found = self.masks[first]
        for cell in others:
            found &= self.masks[cell]
        out = np.zeros((n_rows, len(self.languages)), np.int64)
        for i in range(len(self.languages)):
            has = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) > 0
            out[:, i] = np.bincount(rows[has], minlength=n_rows)
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        rows, keys, totals = ngrams(column)
        if not self.languages:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        total = np.maximum(totals, 1)[:, None]
        corrected = np.maximum(0, self.hits(rows, keys, len(column)) / total - self.wrong) / (1 - self.wrong)
        share = np.minimum(1.0, corrected / np.maximum(self.cover, 1e-9))
        best = share.argmax(axis=1)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, totals, strict=True)]
        return names, np.where(totals > 0, share.max(axis=1), 0.0)


def split_remainder(modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the languages in ``labelled`` (doc_id, text, lang); rows without a language are left out."""
    labelled = labelled.where("lang is not null")
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    sizes = sorted(sizes, key=lambda r: (-r["count"], r["lang"].encode()))
    languages = [r["lang"] for r in sizes]
    if not languages:
        return Model([], np.zeros((1, 1), np.uint64), np.zeros(0), np.zeros(0))
    spark = labelled.sparkSession
    shares = [(i, r["lang"], min(1.0, sample / r["count"])) for i, r in enumerate(sizes)]
    chosen = labelled.join(F.broadcast(spark.createDataFrame(shares, "language int, lang string, share double")), "lang")
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, keys, _ = ngrams(batch.column("text"))
            labels = batch.column("language").to_numpy()[rows]
            for label in np.unique(labels):
                values, counts = np.unique(keys[labels == label], return_counts=True)
                arrays = [pa.array(np.full(len(values), label, np.int32)), pa.array(values.view(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(arrays, ["language", "key", "n"])

    counted = chosen.where(drawn).select("language", "text").mapInArrow(count, "language int, key bigint, n bigint")
    summed = counted.groupBy("language", "key").agg(F.sum("n").alias("n"))
    totals = summed.groupBy("language").agg(F.sum("n").alias("total"))
    rated = summed.join(F.broadcast(totals), "language").withColumn("rate", F.col("n") / F.col("total"))
    same = Window.partitionBy("key")
    others = (F.sum("rate").over(same) - F.col("rate")) / max(1, len(languages) - 1)
    usual = rated.withColumn("others", others).where(F.col("rate") >= CONTRAST * F.col("others"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "key")
    kept = usual.withColumn("place", F.row_number().over(order)).where(F.col("place") <= MOST_NGRAMS)
    rows = kept.select("language", "key", "rate").toPandas()  # at most MOST_NGRAMS a language
    most = int(rows.groupby("language").size().max()) if len(rows) else 1
    cells = 1 << max(10, int(BITS_PER_NGRAM * most - 1).bit_length())
    model = Model(languages, np.zeros((cells, -(-len(languages) // 64)), np.uint64), np.zeros(len(languages)), np.zeros(len(languages)))
    for language, part in rows.groupby("language"):
        model.add(int(language), part["key"].to_numpy(np.int64).view(np.uint64))
        model.cover[int(language)] = part["rate"].sum()
        bit = np.uint64(language % 64)
        filled = float(((model.masks[:, int(language) // 64] >> bit) & np.uint64(1)).mean())
        model.wrong[int(language)] = filled**PROBES
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (the corrected share of known n-grams, 0 to 1); one pass, no shuffle."""
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            predicted, score = shared.value.predict(batch.column("text"))
            columns = [*[batch.column(n) for n in names], pa.array(predicted, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return docs.select(*names).mapInArrow(run, schema)


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, by a model of its own labelled rows."""
    own = docs.select(F.struct("*").alias("__row"), "text")
    predicted = identify(own, learn(docs.select("doc_id", "text", "lang")))
    return predicted.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("__row.*")
