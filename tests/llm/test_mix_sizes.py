"""op8 with sources of very different sizes: every one gets its target."""

import collections

import pytest
from lendlake.llm import mixing


@pytest.mark.parametrize("blocks", [100, 1000, 65536])
def test_tiny_sources_beside_a_huge_one_get_their_targets(spark, blocks):
    rows = [("huge", i, 5_000 + i) for i in range(400)]
    rows += [(f"tiny{i:02}", 1000 + 3 * i + j, 1 + 7 * i + 40 * j) for i in range(30) for j in range(3)]
    rows += [("middle", 5000 + i, 700) for i in range(4)]
    found = mixing.mix(spark.createDataFrame(rows, "source string, doc_id bigint, size bigint"), ["doc_id"], blocks).collect()
    taken, target = collections.Counter(), {}
    for r in found:
        assert r.taken <= 2 * r["size"]
        assert r.taken == sum(s.words for s in r.spans)
        assert all(0 <= s.shard < mixing.SHARDS and s["first"] + s.words <= r["size"] for s in r.spans)
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(found) == len(rows)
    assert {s: taken[s] for s in target} == {s: pytest.approx(t, abs=0.51) for s, t in target.items()}
