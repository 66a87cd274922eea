"""op5 on groups of clean texts with planted outliers, each in one statistic only."""

import random

import pytest
from lendlake.llm import quality_rules


def lines_of(rng, n_words, length=5):
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=max(1, round(rng.gauss(length, 2))))) for _ in range(n_words)]
    return [" ".join(words[i : i + 8]) for i in range(0, n_words, 8)]


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(11)
    rows = [(i, "\n".join(lines_of(rng, rng.choice([160, 240, 320]))), "en", f"s{i % 2}") for i in range(1200)]
    planted = {
        # Half of all lines are the same two words: windows of five words differ.
        "lines": "\n".join(f"{line}\nread more" for line in lines_of(rng, 240)),
        "symbols": "\n".join([f"{line} #" for line in lines_of(rng, 240)]),
        "repeats": "\n".join(lines_of(rng, 400)) + " " + "zq yq xq wq vq uq tq sq rq pq oq nq mq lq kq jq iq hq gq fq eq dq cq bq aq za ya xa wa va ua ta " * 2,
        "word_length": "\n".join(lines_of(rng, 240, 9)),
    }
    rows += [(-1 - i, text, "en", "s0") for i, text in enumerate(planted.values())]
    found = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)).collect()
    return dict(zip(planted, range(-1, -1 - len(planted), -1), strict=True)), {r.doc_id: r for r in found}


@pytest.mark.parametrize("statistic", quality_rules.FEATURES)
def test_an_outlier_in_one_statistic_is_rejected(judged, statistic):
    planted, found = judged
    row = found[planted[statistic]]
    assert not row.base_failed
    assert not row.kept


def test_clean_texts_are_kept(judged):
    _, found = judged
    clean = [r.kept for i, r in found.items() if i >= 0]
    assert sum(clean) > 0.99 * len(clean)
