"""The texts of the substring stage against brute force, on planted passages and clean documents."""

import random
from collections import Counter

from lendlake.llm import substring_dedup


def test_texts_without_passages_of_earlier_documents(spark):
    rng, size = random.Random(4), 50
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(60):
        own = [f"d{i}x{j}" for j in range(rng.randint(20, 120))]
        if i % 3 == 0:
            start, length = rng.randrange(15), rng.choice([49, 50, 55])
            at = rng.randrange(len(own))
            own[at:at] = passage[start : start + length]
        rows.append((i, " ".join(own)))
    first, expected = {}, Counter()
    for i, text in rows:
        w = text.split()
        for j in range(len(w) - size + 1):
            first.setdefault(tuple(w[j : j + size]), i)
    for i, text in rows:
        w, gone = text.split(), set()
        for j in range(len(w) - size + 1):
            if first[tuple(w[j : j + size])] < i:
                gone.update(range(j, j + size))
        expected[i, tuple(x for j, x in enumerate(w) if j not in gone)] += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = Counter((r.doc_id, tuple(r.text.split())) for r in substring_dedup.deduplicate(docs, size).collect())
    assert sum(len(k[1]) for k in expected) < sum(len(t.split()) for _, t in rows)
    assert found == expected
