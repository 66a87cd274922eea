"""Spelling variants against brute force over all pairs of words."""

import collections
import re
import zlib

import numpy as np
import pytest
from lendlake.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int, prefix string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
EDGES = [
    (1, None),
    (2, ""),
    (None, "Keyboard keyboard keybord keybboard"),
    (3, "keyboard " * 30 + "KEYBOARD keyboards keyboards keyboerd keyboerd"),
    (3, "keyboard " * 30),
    (4, "Éclair-éclairs éclairs éclaires éclaires éclaires×éclaires Ākeyboardā x"),
    (5, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaab aaaaaaab baaaaaaa baaaaaaa"),
    (6, "keyboard\n" * 40_000 + "keyboad keyboad"),
    (7, "keyboar keyboar kkeyboard kkeyboard keyboardd keyboardd " + "keyboar " * 400),
]


def counts(rows, least, every):
    total = collections.Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode()) if every else 1
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio):
    close = {w: [v for v in words if v != w and near(v, w)] for w in words}
    best = {w: min(c, key=lambda v: (-words[v], v)) for w, c in close.items() if c}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(close[w]), words.get(form.get(w))))
    return out


@pytest.mark.parametrize("least, every, ratio", [(7, 31, 10), (7, 0, 10), (1, 3, 1.5), (3, 2, 2)])
@pytest.mark.parametrize("kind", ["edges", "generated", "empty"])
def test_brute_force(spark, kind, least, every, ratio):
    rng = np.random.default_rng(least)
    words = ["".join(rng.choice(list("abé"), n)) for n in rng.integers(1, 10, 300)]
    weights = 1 / np.arange(1, 301) ** 1.5
    generated = [(i, " ".join(rng.choice(words, 200, p=weights / weights.sum()))) for i in range(30)]
    rows = {"edges": EDGES, "generated": generated, "empty": []}[kind]
    docs = spark.createDataFrame([(*r, "w", 3, "p") for r in rows], SCHEMA).repartition(3)
    found = spelling.variants(docs, least_chars=least, ratio=ratio, misspell_every=every)
    expected = brute(counts(rows, least, every), ratio)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_chains_end_at_the_last_word(spark):
    chain = ["abcdefg", "abcdefh", "abcdeih", "abcdjih", "abckjih"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(2 * 3**i))
    found = spelling.variants(spark.createDataFrame([(1, text)], "doc_id int, text string"), ratio=3)
    assert {r.word: r.root for r in found.collect()} == dict.fromkeys(chain, chain[-1])


def test_groups_have_no_more_rows_than_the_alphabet(spark):
    """No group of a hot word: rows by prefix stay below the number of letters."""
    words = spark.createDataFrame([("keyboar" + chr(c), 2) for c in [*range(97, 123), *range(0xC0, 0x100)]] + [("keyboar", 2)], "word string, n bigint")
    sizes = spelling.rotations(words).groupBy("prefix").count()
    assert sizes.agg({"count": "max"}).first()[0] == 26 + 64 + 1
