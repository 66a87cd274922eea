"""Quality rules: base counts of each text, and robust multivariate outliers per language and source.

Base rules reject a text with fewer than 10 words, or with more than a fifth of its words in repeated 5-word windows. For the others, a vector of
transformed statistics is compared with the minimum-covariance-determinant estimate of its language and source. The core has
h = CORE * n + (p + 1) / 2 of a group's n rows (p statistics; CORE is one half, so that almost half of a group may be junk). From several starts, concentration
steps take the h rows with the least Mahalanobis distance and estimate location and scatter anew. After EARLY steps the start with the least determinant is
kept, and goes on until its determinant stays. As usual, the estimate is then taken once more over all rows within the 0.975
quantile of chi-square. A row whose squared distance exceeds the 0.9999 quantile is rejected.

The statistics are rates shrunk by PRIOR_WORDS words, so that a short text needs more evidence: log mean word length, and the square roots of symbols,
repeated lines and words in repeated windows per word. The sampling error that texts of the group's lengths have is added to
each scatter, as most clean groups have no symbols at all, hence no scatter: the square root of a count has a variance of 1/4 whatever the count, a
repeated window counts WINDOW words, and word lengths deviate by half their mean. It falls with the length of the texts, so
the scatter decides. Estimates of a group are shrunk towards those of its language by PRIOR_ROWS rows, so a small group behaves like
its language.

All estimates cover every row. A step is one pass of aggregates over the written statistics: distances go into fine
logarithmic bins, whose counts give the core's bound per group, and moments are summed; no group is collected.

A null or empty text has no words and fails the base rules. A null language or source is a group like any other. Equal rows get equal verdicts; extra
columns are dropped; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.words import Words, slices
from lendlake.sources.scratch import written

WINDOW = 5
PRIOR_WORDS = 50
PRIOR_ROWS = 50.0
CORE = 0.5
EARLY = 2
MOST_STEPS = 30
STAYS = 1e-3
BINS = 32
FEATURES = ["word_length", "symbols", "lines", "repeats"]
START = [0.05, 0.08, 0.1, 0.15]
# Variance of each statistic times words, from counting alone.
SAMPLING = [0.25, 0.25, 0.25, WINDOW / 4]
# The 0.975 and 0.9999 quantiles of chi-square with four degrees of freedom.
WITHIN = 11.143
CUT = 23.513
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

_symbol = np.zeros(256, bool)
_symbol[list(b"#*$%&|<>")] = True
_blank = " \t\n\v\f\r"


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = Counter(text.split("\n"))
    return sum(n - 1 for line, n in lines.items() if n > 1 and line.strip(_blank))


def repeated_words(words: Words, size: int = WINDOW) -> np.ndarray:
    """Words of each row in windows that its text has twice or more."""
    at, hashes = words.windows(words.hashes(), size)
    rows = words.rows[at]
    order = np.argsort(hashes, kind="stable")
    h, r = hashes[order], rows[order]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    many = np.zeros(len(h), bool)
    many[1:] |= same
    many[:-1] |= same
    change = np.zeros(len(words.starts) + 1, np.int64)
    starts = at[order[many]]
    np.add.at(change, starts, 1)
    np.subtract.at(change, starts + size, 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return covered[words.first[1:]] - covered[words.first[:-1]]


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            is_start = (words.data & 0xC0) != 0x80
            separators = is_start & np.isin(words.data, list(b" \t\n\v\f\r"))
            counted = []
            for mask in (is_start & ~separators, _symbol[words.data]):
                sums = np.concatenate([[0], np.cumsum(mask)])
                counted.append(np.diff(sums[words.offsets]))
            arrays = [words.counts, *counted, np.array([repeated_lines(t) for t in texts], np.int64), repeated_words(words)]
            columns = [*[batch.column(n) for n in ("doc_id", "lang", "source")], *[pa.array(a, pa.int64()) for a in arrays]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", *[c.split(" ")[0] for c in COUNTS.split(", ")]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"))
    return rows.mapInArrow(run, f"doc_id bigint, lang string, source string, {COUNTS}")


def with_features(counts: DataFrame) -> DataFrame:
    words = F.col("n_words") + PRIOR_WORDS
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.select(
        "*",
        failed.alias("base_failed"),
        F.log((F.col("word_chars") + 5 * PRIOR_WORDS) / words).alias("word_length"),
        F.sqrt(F.col("n_symbols") / words).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") / words).alias("lines"),
        F.sqrt(F.col("n_repeat_words") / words).alias("repeats"),
        (1 / words).alias("noise"),
    )


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))


def quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return low


def consistency(share: float, size: int = len(FEATURES)) -> float:
    """What makes the scatter of the innermost ``share`` of normal rows that of all."""
    return share / chi_square(quantile(share, size), size + 2) if share < 1 else 1.0


PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def squared_distance(center: str, inverse: str) -> Column:
    """Squared Mahalanobis distance of the features to a row's own estimate."""
    apart = [F.col(f) - F.get(center, F.lit(i)) for i, f in enumerate(FEATURES)]
    terms = [(1 if i == j else 2) * F.get(inverse, F.lit(k)) * apart[i] * apart[j] for k, (i, j) in enumerate(PAIRS)]
    return F.greatest(F.lit(0.0), sum(terms[1:], terms[0]))


def moments(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Rows, sums, sums of products and the sum of ``noise`` of each group."""
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i, j in PAIRS]
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.sum("noise").alias("noise"), *sums, *products)


ESTIMATE = "center array<double>, scatter array<double>, inverse array<double>, determinant double"


def estimates(summed: DataFrame, groups: list[str], factor: float) -> DataFrame:
    """Location, scatter, and the inverse and log determinant of scatter plus sampling error, from moments; a row per group and start.

    The scatter is multiplied by ``factor``. With columns prior_center and prior_scatter, these count as PRIOR_ROWS further rows.
    """
    size = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {"center": [], "scatter": [], "inverse": [], "determinant": []}
            for row in batch.to_pylist():
                n = row["n"]
                center = np.array([row[f"s{i}"] for i in range(size)]) / n
                scatter = np.zeros((size, size))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = row[f"p{i}{j}"] / n - center[i] * center[j]
                scatter *= factor
                if "prior_center" in row:
                    weight = n / (n + PRIOR_ROWS)
                    prior = np.zeros((size, size))
                    for k, (i, j) in enumerate(PAIRS):
                        prior[i, j] = prior[j, i] = row["prior_scatter"][k]
                    center = weight * center + (1 - weight) * np.asarray(row["prior_center"])
                    scatter = weight * scatter + (1 - weight) * prior
                whole = scatter + np.diag(SAMPLING) * row["noise"] / n
                inverse = np.linalg.inv(whole)
                made["center"].append(center.tolist())
                made["scatter"].append([scatter[i, j] for i, j in PAIRS])
                made["inverse"].append([inverse[i, j] for i, j in PAIRS])
                made["determinant"].append(float(np.linalg.slogdet(whole)[1]))
            kinds = [pa.list_(pa.float64())] * 3 + [pa.float64()]
            arrays = [batch.column(g) for g in [*groups, "start"]] + [pa.array(v, t) for v, t in zip(made.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*groups, "start", *made])

    return summed.mapInArrow(run, ", ".join([*[f"{g} string" for g in groups], "start int", ESTIMATE]))


def same_group(left: str, right: str, groups: list[str]) -> Column:
    match = F.lit(True)
    for g in groups:
        match &= F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return match


def beside(rows: DataFrame, estimate: DataFrame, groups: list[str], how: str = "left") -> DataFrame:
    """Rows with each estimate of their group."""
    joined = rows.alias("r").join(estimate.alias("e"), same_group("r", "e", groups), how)
    return joined.select("r.*", *[f"e.{c}" for c in ("start", "center", "scatter", "inverse", "determinant")])


def summed_up(core: DataFrame, groups: list[str], priors: DataFrame | None) -> DataFrame:
    """Moments by group and start, beside the group's prior."""
    summed = moments(core, [*groups, "start"])
    if priors is None:
        return summed
    prior = priors.select(groups[0], F.col("center").alias("prior_center"), F.col("scatter").alias("prior_scatter"))
    return summed.alias("r").join(prior.alias("p"), same_group("r", "p", groups[:1])).select("r.*", "p.prior_center", "p.prior_scatter")


def concentrate(rows: DataFrame, estimate: DataFrame, groups: list[str], priors: DataFrame | None, core: float) -> DataFrame:
    """One step from each estimate: that of its core, the rows of its group with the least distances."""
    keys = [*groups, "start"]
    near = beside(rows, estimate, groups, "inner").withColumn("bin", F.floor(BINS * F.log2(squared_distance("center", "inverse") + 1e-6)))
    bins = near.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    running = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    reached = bins.withColumn("running", running).withColumn("all", F.sum("n").over(group))
    least = F.least(F.col("all"), F.floor(core * F.col("all") + (len(FEATURES) + 1) / 2))
    bound = reached.where(F.col("running") >= least).groupBy(*keys).agg(F.min("bin").alias("bound"))
    inside = near.alias("r").join(bound.alias("b"), same_group("r", "b", keys)).where(F.col("r.bin") <= F.col("b.bound")).select("r.*")
    return written(estimates(summed_up(inside, groups, priors), groups, consistency(core)), "estimates")


def starts(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Four starts of each group: its medians with the scale START and with the scale of its own quartiles, and its lower and upper quartiles."""
    marks = rows.groupBy(*groups).agg(*[F.percentile_approx(f, [0.25, 0.5, 0.75]).alias(f) for f in FEATURES])
    at = lambda i: F.array(*[F.round(F.get(f, F.lit(i)), 3) for f in FEATURES])
    fixed = [F.lit(v) for v in START]
    own = [F.greatest(F.lit(v / 4), F.get(f, F.lit(2)) - F.get(f, F.lit(0))) for f, v in zip(FEATURES, START, strict=True)]
    parts = []
    for number, (center, scale) in enumerate([(at(1), fixed), (at(0), fixed), (at(2), fixed), (at(1), own)]):
        flat = [scale[i] * scale[i] if i == j else F.lit(0.0) for i, j in PAIRS]
        back = [1 / (scale[i] * scale[i]) if i == j else F.lit(0.0) for i, j in PAIRS]
        columns = [center.alias("center"), F.array(*flat).alias("scatter"), F.array(*back).alias("inverse")]
        parts.append(marks.select(*groups, F.lit(number).alias("start"), *columns, F.lit(None).cast("double").alias("determinant")))
    return written(reduce(DataFrame.unionByName, parts), "estimates")


def core_estimates(rows: DataFrame, first: DataFrame, groups: list[str], priors: DataFrame | None = None, core: float = CORE) -> DataFrame:
    """The estimate of each group's core with the least determinant that the starts lead to."""
    for _ in range(EARLY):
        first = concentrate(rows, first, groups, priors, core)
    best = Window.partitionBy(*groups).orderBy("determinant", "start")
    moving = written(first.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place"), "estimates")
    settled = []
    for _ in range(MOST_STEPS):
        after = concentrate(rows, moving, groups, priors, core).alias("a")
        both = moving.alias("b").join(after, same_group("a", "b", groups))
        less = F.col("a.determinant") < F.col("b.determinant") - STAYS
        settled.append(written(both.where(~less).select("b.*"), "estimates"))
        moving = written(both.where(less).select("a.*"), "estimates")
        if not moving.count():
            break
    return reduce(DataFrame.unionByName, settled, moving)


def reweighted(rows: DataFrame, estimate: DataFrame, groups: list[str], priors: DataFrame | None = None) -> DataFrame:
    """The estimate of all rows within the 0.975 quantile of the core's; a group without any keeps the core's."""
    near = beside(rows, estimate, groups, "inner").where(squared_distance("center", "inverse") <= WITHIN)
    again = written(estimates(summed_up(near, groups, priors), groups, consistency(0.975)), "estimates")
    missing = estimate.alias("e").join(again.alias("a"), same_group("e", "a", groups), "left_anti")
    return written(again.unionByName(missing), "estimates")


def judge(docs: DataFrame, core: float = CORE) -> DataFrame:
    """doc_id, the base counts, base_failed, distance (squared, null where the base rules failed) and kept."""
    rows = written(with_features(base_counts(docs)), "statistics")
    judged = rows.where(~F.col("base_failed"))
    by_language = reweighted(judged, core_estimates(judged, starts(judged, ["lang"]), ["lang"], core=core), ["lang"])
    groups = ["lang", "source"]
    present = judged.select(*groups).distinct()
    of_language = beside(present, by_language, ["lang"]).withColumn("start", F.lit(-1))
    first = starts(judged, groups).unionByName(of_language)
    by_group = core_estimates(judged, first, groups, by_language, core)
    by_group = reweighted(judged, by_group, groups, by_language)
    distance = F.when(~F.col("base_failed"), squared_distance("center", "inverse"))
    measured = beside(rows, by_group, groups).withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.col("distance") <= CUT)
    names = [c.split(" ")[0] for c in COUNTS.split(", ")]
    return measured.select("doc_id", *names, "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), "distance")
