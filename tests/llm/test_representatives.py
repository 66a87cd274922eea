"""One row of each group of near duplicates stays, also where ids repeat or are missing."""

from collections import Counter

from lendlake.llm import jaccard_join


def text(name, changed=None):
    words = [f"{name}{i}" for i in range(80)]
    if changed is not None:
        words[changed] = "other"
    return " ".join(words)


def test_rows_with_repeated_and_missing_ids(spark):
    rows = [
        (3, text("c")), (5, text("a")), (5, text("c", 79)),  # a near copy of 3 under the id of another document
        (None, text("n")), (None, text("n", 79)), (None, text("n")), (None, text("c", 78)),
        (None, text("m")), (9, text("m", 79)), (7, text("m", 0)),
        (8, text("d")), (8, text("d")), (11, "short one"), (12, ""), (12, ""), (None, ""), (None, " "), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = Counter((r.doc_id, r.text) for r in jaccard_join.representatives(docs).collect())
    group = [k for k in found if k[0] is None and k[1] and k[1].startswith("n0 ")]
    assert len(group) == 1 and found.pop(group[0]) == 1
    assert found == Counter([(3, text("c")), (5, text("a")), (7, text("m", 0)), (8, text("d")), (11, "short one"), (12, ""), (None, ""), (None, " "), (None, None)])
