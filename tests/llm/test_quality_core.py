"""The core of op5 against every subset of its size, and groups with much junk."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from lendlake.llm import quality_rules as q
from test_quality_outliers import lines_of


@pytest.mark.parametrize("seed", range(4))
def test_core_has_the_least_determinant(spark, seed):
    rng = np.random.default_rng(seed)
    clean = rng.normal([1.6, 0.1, 0.1, 0.2], [0.05, 0.03, 0.03, 0.05], (9, 4))
    junk = rng.normal([1.9, 0.6, 0.1, 0.3], 0.05, (5, 4))
    made = np.concatenate([clean, junk])
    noise = 0.004
    h = math.floor(len(made) / 2 + 2.5)

    def determinant(rows):
        part = made[list(rows)]
        scatter = np.cov(part.T, bias=True) * q.consistency(0.5) + np.diag(q.SAMPLING) * noise
        return np.linalg.slogdet(scatter)[1]

    least = min(combinations(range(len(made)), h), key=determinant)
    rows = spark.createDataFrame([("en", noise, *map(float, r)) for r in made], ["lang", "noise", *q.FEATURES])
    found = q.core_estimates(rows, q.starts(rows, ["lang"]), ["lang"]).first()
    assert found["determinant"] == pytest.approx(determinant(least), abs=1e-6)
    assert found["center"] == pytest.approx(list(made[list(least)].mean(axis=0)), abs=1e-9)


def test_consistency_factor(spark):
    inner = np.random.default_rng(5).normal(size=(200_000, 4))
    near = inner[np.argsort((inner**2).sum(axis=1))[: len(inner) // 2]]
    assert near.var(axis=0).mean() * q.consistency(0.5) == pytest.approx(1, abs=0.02)
    assert q.chi_square(q.WITHIN, 4) == pytest.approx(0.975, abs=1e-4)
    assert q.chi_square(q.CUT, 4) == pytest.approx(0.9999, abs=1e-5)


def test_forty_percent_of_junk_of_one_kind_is_rejected(spark):
    rng = random.Random(7)
    clean = [(i, "\n".join(lines_of(rng, rng.choice([160, 240, 320]))), "en", "web") for i in range(600)]
    junk = [(1000 + i, "\n".join(f"{line} # | $" for line in lines_of(rng, rng.choice([160, 240]), 7)), "en", "web") for i in range(400)]
    df = spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string, source string").repartition(4)
    found = {r.doc_id: r for r in q.judge(df).collect()}
    assert not any(r.base_failed for r in found.values())
    assert sum(found[i].kept for i, *_ in junk) < 0.02 * len(junk)
    assert sum(found[i].kept for i, *_ in clean) > 0.98 * len(clean)
