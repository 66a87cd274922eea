"""Repeated lines against brute force, with the whole index broadcast and with most of it probed by shard."""

import collections
import hashlib

import numpy as np
import pytest
from lendlake.llm import line_dedup, perfect_hash

SCHEMA = "doc_id bigint, text string, h1 string, key int, shard string, __lines string, n int"
FOOT = "  All rights reserved, see the terms.\t"
EDGES = [
    (1, None),
    (2, ""),
    (None, f"no id\n{FOOT}"),
    (3, f"{FOOT}\nALL RIGHTS RESERVED, see the terms.\nshort\nshort"),
    (4, f"{FOOT}\r\nown line of this document\nshort\n"),
    (4, f"second row of it\n{FOOT}"),
    (4, f"second row of it\n{FOOT}"),
    (5, "é" * 20 + "\n" + "é" * 19 + "\n\n\n" + "É" * 20),
    (6, "é" * 20 + "\n" + "é" * 19 + "\nshort\nx"),
    (7, "é" * 20 + "\n" + "é" * 19 + "\nshort" + f"\n{FOOT}" * 3),
    (0, "long " * 30_000 + "\n" + FOOT),
    (8, "long " * 30_000 + "\ntwice only, in two documents"),
    (9, "long " * 30_000 + "\ntwice only, in two documents"),
    (-3, "\x85all rights reserved, see the terms.\n" + "\x0b\x0c" + FOOT),
]


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs=3, least=20):
    docs = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n") if i is not None else []:
            docs[key(line)].add(i)
    keeper = {k: max(v) for k, v in docs.items() if len(v) >= min_docs and len(k) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(found, expected):
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, expected), key=repr)


@pytest.fixture(scope="module", params=["edges", "unique", "generated", "empty"])
def rows(request):
    rng = np.random.default_rng(5)
    pool = [f"line number {i} of the pool, long enough" for i in range(400)]
    generated = [(i, "\n".join(rng.choice(pool, rng.integers(0, 12)).tolist() + [FOOT])) for i in range(300)]
    unique = [r for r in EDGES if r[0] not in (4, None)]
    return {"edges": EDGES, "unique": unique, "generated": generated, "empty": []}[request.param]


@pytest.mark.parametrize("most_broadcast", [0, 3, 1000])
def test_brute_force(spark, rows, most_broadcast):
    docs = spark.createDataFrame([(*r, "a", 1, "b", "c", 2) for r in rows], SCHEMA).repartition(3)
    expected = brute(rows)
    found = line_dedup.digest(docs, most_broadcast=most_broadcast)
    same(found.collect(), [(i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in expected])
    cut = line_dedup.deduplicate(docs, most_broadcast=most_broadcast)
    assert cut.schema == docs.schema
    texts = [(i, t if old is not None else None) for (i, old), (_, _, _, t) in zip(rows, expected, strict=True)]
    same(cut.collect(), [(*r, "a", 1, "b", "c", 2) for r in texts])


def test_two_documents_are_enough(spark, rows):
    found = line_dedup.digest(spark.createDataFrame([(*r, "a", 1, "b", "c", 2) for r in rows], SCHEMA), min_docs=2, least_chars=5)
    same([r[:3] for r in found.collect()], [r[:3] for r in brute(rows, 2, 5)])


@pytest.mark.parametrize("n", [1, 2, 1000, 30_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2), rng.integers(0, 2**63, n).astype(np.uint64)
    high[: n // 3] = high[0]  # equal first halves
    bits = perfect_hash.shard_bits(n)
    shard = perfect_hash.shard_of(high, bits)
    rows = []
    for s in np.unique(shard).tolist():
        at = np.flatnonzero(shard == s)
        rows.append(perfect_hash.built(s, high[at], low[at], at, at.astype(np.int64)).to_pylist()[0])
    index = perfect_hash.Index(bits, rows[::-1])
    place = index.find(high, low)
    assert sorted(place.tolist()) == list(range(n))
    assert (index.keepers[place] == np.arange(n)).all() and (index.counts[place] == np.arange(n)).all()
    assert (index.find(high + np.uint64(1), low ^ np.uint64(5)) == -1).all()
    assert 64 * len(index.words) < 5 * n + 64 * 40


def test_no_keys():
    index = perfect_hash.Index(1, [])
    assert index.find(np.array([1, 2**63], np.uint64), np.array([1, 2], np.uint64)).tolist() == [-1, -1]
