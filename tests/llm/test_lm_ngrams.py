"""Word bigrams of op9 against brute force, with the filter broadcast at once and in groups."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from lendlake.llm import lm_scoring

END = "\n"


def quantised(n):
    own = lm_scoring.CountFilter
    return int(own.count(own.level(np.array([n])))[0])


class Brute:
    """The model of the docstring with exact follower sets, written anew."""

    def __init__(self, texts, common, false_hits):
        self.one, self.two, self.after = collections.Counter(), collections.Counter(), collections.Counter()
        for text in texts:
            own = [END, *(text or "").split(), END]
            self.one.update(own[1:])
            self.two.update(zip(own, own[1:]))
        for (before, _), n in self.two.items():
            self.after[before] += quantised(n)
        self.total, self.distinct = sum(self.one.values()), len(self.one)
        self.common = {w for w in self.one if common(w, self.one)}
        self.spare = lm_scoring.MU + false_hits * (self.distinct + 1)

    def plain(self, word):
        if word in self.common:
            return (self.one[word] + 1) / (self.total + self.distinct + 1)
        others = [w for w in self.one if w not in self.common]
        return (sum(self.one[w] + 1 for w in others) + 1) / (self.total + self.distinct + 1) / (len(others) + 1)

    def score(self, text):
        own = [END, *(text or "").split(), END]
        top = [quantised(self.two[p]) + lm_scoring.MU * self.plain(p[1]) for p in zip(own, own[1:])]
        return sum(math.log10(t / (self.after[b] + self.spare)) for t, b in zip(top, own))


def corpus():
    """9,000 words; each follows one other word, so that nearly all of the evidence is in words of low rank."""
    random.seed(5)
    rows = [(i, " ".join(f"w{15 * i + j}" for j in range(15))) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 600, 2)]
    return rows + [(2000 + i, rows[0][1]) for i in range(40)]


@pytest.mark.parametrize("part_text, group_bytes", [(1 << 25, 1 << 26), (1 << 13, 1 << 26), (1 << 13, 1), (1 << 13, 8 << 10)])
@pytest.mark.parametrize("common", [1 << 18, 50])
def test_scores_come_from_bigrams_of_all_words(spark, common, part_text, group_bytes):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    model, filters, counts = lm_scoring.learn(docs, common=common, part_text=part_text)
    groups = list(lm_scoring.groups_of(filters, model.parts, group_bytes))
    assert sorted(p for g in groups for p in g) == list(range(model.parts))
    assert (len(groups) > 1) == (part_text == 1 << 13 and group_bytes < 1 << 26)
    mixed = [w for _, t in rows[:600] for w in t.split()]
    random.shuffle(mixed)
    asked = [(i, t) for i, t in rows[:50]] + [(-1, " ".join(mixed[:300])), (-2, ""), (-3, None), (-4, "never seen"), (None, None), (None, "w0 w1")]
    asked += [asked[0], asked[-1], asked[-1]]
    given = spark.createDataFrame(asked, "doc_id bigint, text string").repartition(3)
    found = lm_scoring.score(given, model, filters, counts, group_bytes).collect()
    assert len(found) == len(asked)
    held = set(model.common.tolist())
    hashes = {w: int(lm_scoring.tokens(pa.array([w]))[0][0]) for _, t in rows for w in t.split()} | {END: int(lm_scoring.END_HASH)}
    brute = Brute([t for _, t in rows], lambda w, one: hashes[w] in held, model.false_hits)
    assert (brute.total, brute.distinct) == (model.total, model.distinct)
    expected = sorted((str(i), len((t or "").split()) + 1, brute.score(t)) for i, t in asked)
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in found)
    for (i, n, mine), (doc_id, tokens, score) in zip(expected, got, strict=True):
        assert (i, n) == (doc_id, tokens)
        # Wrong hits of the filter can only raise a score, here by little.
        assert score == pytest.approx(mine, rel=0.01, abs=0.02), doc_id
    per_word = {r.doc_id: r.score / r.n_tokens for r in found if r.doc_id is not None}
    assert per_word[-1] < min(v for k, v in per_word.items() if k >= 0) - 0.3


def test_probabilities_after_a_word_add_up_to_one(spark):
    """Every word of the vocabulary and an unseen one, after 100 contexts of all frequencies, one of them 60,000 times."""
    random.seed(3)
    vocabulary = [f"v{i}" for i in range(2000)]
    texts = [" ".join(random.choices(vocabulary, [1 / (i + 1) for i in range(2000)], k=60)) for _ in range(1500)] + ["v0 v1 " * 60000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for common in (1 << 18, 100):
        model, filters, counts = lm_scoring.learn(docs, common=common, part_text=1 << 17)
        group = {p: f for g in lm_scoring.groups_of(filters, model.parts, 1 << 26) for p, f in g.items()}
        totals = {r["hash"]: r["total"] for r in counts.collect()}
        seen = np.array(sorted(totals), np.int64).view(np.uint64)
        every = np.r_[seen, np.uint64(12345)]
        at, known = model.find(every)
        fallback, found = model.fallback(at, known), []
        for before in [*seen[:: len(seen) // 98], lm_scoring.tokens(pa.array(["v0"]))[0][0], np.uint64(777)]:
            keys = lm_scoring.bigrams(np.full(len(every), before), every)
            parts = lm_scoring.part_of(keys, model.parts)
            n = np.zeros(len(every))
            for part in np.unique(parts):
                n[parts == part] = group[part].lookup(keys[parts == part])
            sums = (n + fallback).sum() / (totals.get(int(before.view(np.int64)), 0) + model.spare)
            # A few false hits more or less than the one expected, each of weight 1 over the context's denominator.
            assert sums == pytest.approx(1, abs=0.001 + 6 / (totals.get(int(before.view(np.int64)), 0) + model.spare))
            found.append(sums)
        assert fallback.sum() == pytest.approx(lm_scoring.MU, rel=1e-9)
        assert np.mean(found) == pytest.approx(1, abs=0.001)


def test_filter_grows_with_the_bigrams(spark):
    sizes = []
    for n in (1000, 16000):
        docs = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i}") for i in range(n)], "doc_id bigint, text string")
        _, filters, _ = lm_scoring.learn(docs)
        sizes.append(filters.selectExpr("sum(bits)").first()[0])
    assert sizes[1] > 15 * sizes[0]


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    learned = lm_scoring.learn(docs.where("doc_id > 5"))
    found = lm_scoring.score(docs, *learned).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in found) == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert lm_scoring.score(docs.where("doc_id > 5"), *learned).isEmpty()


def test_bigrams_are_sent_packed_and_counted_by_part(spark, monkeypatch):
    """A few rows of many pairs go through the shuffle; a part gives each word before once."""
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(4)
    sent = lm_scoring.counted_bigrams(docs, 3)
    pairs = sum(len(t.split()) + 1 for _, t in corpus())
    assert sent.count() <= 12 < pairs / 100
    built = lm_scoring.filter_parts(sent).collect()
    words = [r for r in built if r.part is None]
    assert len([r for r in built if r.part is not None]) == 3 and sum(r.n for r in words) == pairs
    one = collections.Counter(w for _, t in corpus() for w in [END, *t.split()])
    hashes = {w: int(lm_scoring.tokens(pa.array([w]))[0][0].view(np.int64)) for w in one if w != END}
    found = collections.Counter()
    for r in words:
        found[r.before] += r.n
    assert all(found[h] == one[w] for w, h in hashes.items())
    assert max(collections.Counter(r.before for r in words).values()) <= 3
    monkeypatch.setattr(lm_scoring, "PACKED", 100)
    assert sorted(r.n for r in words) == sorted(r.n for r in lm_scoring.filter_parts(lm_scoring.counted_bigrams(docs, 3)).collect() if r.part is None)


def test_probes_of_many_filters_at_once():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 2**63, size, dtype=np.uint64) for size in (3000, 1, 0, 500)]
    levels = [rng.integers(1, 9, len(k)) for k in keys]
    filters = {5 + i: lm_scoring.CountFilter.of(k, v) for i, (k, v) in enumerate(zip(keys, levels))}
    asked = [np.r_[k, rng.integers(0, 2**63, 400, dtype=np.uint64)] for k in keys]
    found = lm_scoring.FilterGroup(filters).lookup(np.concatenate(asked), np.cumsum([0, *map(len, asked)]))
    assert (found == np.concatenate([f.lookup(a) for f, a in zip(filters.values(), asked)])).all()
    own = filters[5]
    for key, count in zip(asked[0], found):
        level = 0
        while all(own.data[int(c[0]) >> 3] >> (int(c[0]) & 7) & 1 for c in own.cells(np.array([key]), level + 1)):
            level += 1
        assert count == own.count(np.array([level]))[0]


def test_common_words_are_found_by_their_upper_bits():
    rng = np.random.default_rng(2)
    for common in (rng.integers(0, 2**64, 5000, dtype=np.uint64), np.arange(1, 900, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64), np.array([7], np.uint64)):
        model = lm_scoring.Model(1, 1, np.sort(common), np.ones(len(common)), np.ones(len(common)), 1, 0.0)
        asked = np.r_[common, rng.integers(0, 2**64, 5000, dtype=np.uint64), np.array([0, 2**64 - 1, lm_scoring.END_HASH], np.uint64)]
        at, known = model.find(asked)
        assert (known == np.isin(asked, common)).all() and (model.common[at[known]] == asked[known]).all()
