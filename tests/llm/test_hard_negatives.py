"""Hard negatives against brute force, and the blocks that bounds leave out."""

import itertools

import numpy as np
import pytest
from lendlake.llm import hard_negatives as hn
from pyspark.sql import functions as F

SCHEMA = "id bigint, label int, vector array<bigint>, block string, dim string, score int"


def brute(rows, asked, low=80, high=100, k=5):
    known = {}
    for i, label, v in rows:
        if None not in (i, label, v) and None not in v:
            known[i] = max(known.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in known.items():
        if not asked(a):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), b, g) for b, (g, w) in known.items() if b != a and len(w) == len(v)]
        scored.sort()
        for s, b, _ in [x for x in scored if x[2] == label][:k]:
            window = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:k]
            out += [(a, b, r, c, -s, -t) for r, (t, c, _) in enumerate(window, 1)]
    return sorted(out)


def table(kind):
    rng = np.random.default_rng(3)
    if kind == "empty":
        return []
    if kind == "edges":
        rows = [(i, i % 3, [int(x) for x in rng.integers(-3, 4, 4)]) for i in range(60)]
        rows += [(100 + i, i % 2, [1, 2, 3]) for i in range(9)] + [(200, 0, []), (201, 1, []), (202, 0, [])]
        rows += [(None, 1, [1, 2, 3, 4]), (300, None, [1, 2, 3, 4]), (301, 1, None), (302, 1, [1, None, 2, 3])]
        return rows + [(5, 2, [9, 9, 9, 9]), rows[7], rows[7], (-20, 1, [2, 2, 2, 2]), (-21, 0, [2, 2, 2, 2])]
    if kind == "copies":  # one vector fills half of the table
        return [(i, int(rng.integers(0, 3)), [7] * 8 if i % 2 else [int(x) for x in rng.normal(0, 9, 8)]) for i in range(400)]
    centres = rng.normal(0, 200, (12, 16))
    return [(i, int(rng.integers(0, 4)), [int(x) for x in centres[i % 12] + rng.normal(0, 12, 16)]) for i in range(1200)]


@pytest.mark.parametrize("kind", ["empty", "edges", "copies", "clusters"])
@pytest.mark.parametrize("block_rows", [4, 64])
def test_brute_force(spark, kind, block_rows):
    rows = table(kind)
    df = spark.createDataFrame([(*r, "b", "d", 1) for r in rows], SCHEMA).repartition(3)
    found = hn.mine(df, F.col("id") % 20 == 0, block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 20 == 0)


def test_other_windows(spark):
    rows = table("clusters")[:300]
    found = hn.mine(spark.createDataFrame([(*r, "b", "d", 1) for r in rows], SCHEMA), F.col("id") % 7 == 0, 3, 3, 33, 101, block_rows=16)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 7 == 0, 33, 101, 3)


def test_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = [k.tobytes() for k in hn.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array(keys, dtype=object))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_leave_out_blocks(spark):
    """On clusters the curve keeps a cluster's rows together, and few of the pairs of anchor and block are read."""
    rows = spark.createDataFrame([(*r, "b", "d", 1) for r in table("clusters")], SCHEMA)
    blocks = hn.written(hn.blocks_of(hn.written(hn.prepared(rows)), 32))
    data = [r.asDict() for r in blocks.collect()]
    lows, highs = [np.stack([np.frombuffer(r[n], np.int32) for r in data]) for n in ("low", "high")]
    labels = np.array([[r["least_label"], r["most_label"]] for r in data])
    vectors = np.concatenate([hn.contents(r)[2] for r in data])
    ids, kinds = [np.concatenate([hn.contents(r)[j] for r in data]) for j in (0, 1)]
    scores = hn.product(vectors[:50], vectors)
    fifth = np.array([np.sort(s[(kinds == kinds[i]) & (ids != ids[i])])[-5] for i, s in enumerate(scores)])
    row = {"dim": 16, "anchors": ids[:50].tobytes(), "anchor_labels": kinds[:50].tobytes(), "anchor_vectors": vectors[:50].tobytes()}
    row |= {"floors": fifth.tobytes(), "tops": np.full(50, 1 << 60).tobytes()}
    asked = hn.Wanted(row, True).asks(lows, highs, labels)
    assert 0 < asked.mean() < 0.4
    holds = np.stack([np.isin(ids, hn.contents(r)[0]) for r in data])
    for i in range(50):  # no block with a row that counts is left out
        counts = (scores[i] >= fifth[i]) & (kinds == kinds[i])
        assert (asked[i] >= (holds & counts).any(axis=1)).all()
