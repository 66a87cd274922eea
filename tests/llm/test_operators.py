"""Numbered operators against brute force, on the small test tables and on edge rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from lendlake.llm import (
    jaccard_join,
    language_id,
    lm_scoring,
    mixing,
    packing,
    quality_rules,
    sharding,
    sketch,
    substring_dedup,
    token_counts,
)
from lendlake.llm.queries import QUERIES
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, row string, key string, size int"
LONG = "long " * 30_000
EDGES = [
    (1, None, "en", None),
    (2, "", None, "s"),
    (None, "a b c d e f", "en", "s"),
    (3, "a b c d e f", None, None),
    (4, "x a b c d e f y", "de", "s"),
    (4, "x a b c d e f y", "de", "s"),
    (4, "q A b C d e f", "de", "s"),
    (5, "a b 日本語 \U0001f389 <|endoftext|> # $ %\n\nx\nx\nx", "en", "t"),
    (6, LONG, "en", "t"),
    (0, "123 456", None, "t"),
]


def words(text, lower=False):
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def crc(value):
    return zlib.crc32(("" if value is None else str(value)).encode())


@pytest.fixture(scope="module", params=["edges", "documents", "empty"])
def docs(request, spark):
    if request.param == "documents":
        return spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(i, t, g, s, len(t or ""), "r", "k", 7) for i, t, g, s in EDGES] if request.param == "edges" else []
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return docs.select("doc_id", "text", "lang", "source").collect()


def same(found, expected):
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, expected), key=repr)


@pytest.mark.parametrize("size", [3, 13])
def test_substring_dedup(docs, rows, size):
    first, expected = {}, []
    for r in rows:
        w = words(r.text)
        for i in range(len(w) - size + 1) if r.doc_id is not None else []:
            first[tuple(w[i : i + size])] = min(first.get(tuple(w[i : i + size]), r.doc_id), r.doc_id)
    for r in rows:
        w = words(r.text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1) if r.doc_id is not None else []:
            if first[tuple(w[i : i + size])] < r.doc_id:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        expected.append((r.doc_id, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    same(substring_dedup.digest(docs, size).collect(), expected)
    cut = substring_dedup.deduplicate(docs, size)
    assert cut.columns == docs.columns
    left = [len(words(r.text)) for r in cut.collect()]
    assert sum(left) == sum(n - m for _, n, m, _ in expected)


def test_hot_windows_are_grouped_like_others(spark):
    table = [(i, f"p q r s t u v w {i}") for i in range(2 * sketch.HOT)]
    found = substring_dedup.digest(spark.createDataFrame(table, "doc_id bigint, text string").repartition(7), 4).collect()
    assert {r.doc_id: r.n_removed for r in found} == {i: 8 if i else 0 for i, _ in table}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(docs, rows, size, percent):
    sets = []
    for r in rows:
        w = words(r.text, lower=True)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)] += [r.doc_id] if r.doc_id is not None else []
    expected = [(r.doc_id, len(sets[i]), min(least[find(i)], default=None)) for i, r in enumerate(rows)]
    found = jaccard_join.components(docs, size, percent).select("doc_id", "n_shingles", "component_id")
    same(found.collect(), expected)


def test_near_copies_with_many_versions(spark):
    random.seed(3)
    base = [f"w{i}" for i in range(120)]
    table = []
    for i in range(120):
        text = list(base)
        for _ in range(random.choice([0, 1, 1, 2, 3, 5])):
            text[random.randrange(120)] = f"x{random.random()}"
        table.append((1000 - i, " ".join(text)))
    sets = [{tuple(t.split()[i : i + 3]) for i in range(118)} for _, t in table]
    links = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    label = {i: table[i][0] for i in range(120)}
    for _ in range(120):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    found = jaccard_join.components(spark.createDataFrame(table, "doc_id bigint, text string").repartition(4), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in found} == {table[i][0]: label[i] for i in range(120)}


def test_token_counts(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = token_counts.count_tokens(docs, path).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    counts = [len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows]
    expected = [(r.doc_id, len((r.text or "").encode()), n, n > 1024) for r, n in zip(rows, counts, strict=True)]
    same(found, expected)


def test_language_id(docs, rows):
    found = language_id.identify(docs, language_id.learn(docs.select("doc_id", "text", "lang"))).collect()
    learned = {r.lang for r in rows} - {None}
    assert len(found) == len(rows)
    for r in found:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in learned) if has_letter else r.lang_pred == "und"
        assert 0 <= r.score <= 1


def test_language_id_on_held_out_documents(spark):
    found = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    judged = found.join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.97


def test_quality_rules(docs, rows):
    def base(text):
        w = words(text)
        seen, lines = set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                lines += line in seen
                seen.add(line)
        windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        many = [False] * len(w)
        for i in range(len(w) - 4):
            if windows[tuple(w[i : i + 5])] > 1:
                many[i : i + 5] = [True] * 5
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        return len(w), sum(map(len, w)), symbols, lines, sum(many)

    found = quality_rules.judge(docs).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    same([[r[n] for n in names] for r in found], [(r.doc_id, *base(r.text)) for r in rows])
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_rules_know_junk(spark):
    path = "/root/testdata/sf0.1"
    judged = quality_rules.judge(spark.read.parquet(f"{path}/documents.parquet")).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    good = judged.where("quality = 1 and not base_failed").selectExpr("avg(int(kept))").first()[0]
    junk = judged.where("quality = 0 and not base_failed").selectExpr("avg(int(kept))").first()[0]
    assert good > 0.99 and junk < 0.1


def test_sharding(docs, rows):
    placed = sharding.shard(docs).collect()
    sizes = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows]
    same([(r.doc_id, r["size"], r.text_crc32) for r in placed], sizes)
    slots = collections.defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 40:
        assert {len(s) for s in slots.values()} <= {len(rows) // 40, -(-len(rows) // 40)}
    same(placed, sharding.shard(docs.repartition(5)).collect())


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 1000, 4099])
def test_permutation_is_one_to_one(spark, n):
    found = spark.range(n).select(sharding.permuted(sharding.F.col("id"), n, 9)).collect()
    assert sorted(r[0] for r in found) == list(range(n))


def test_mixing(docs, rows):
    mixed = mixing.mix_documents(docs).collect()
    assert len(mixed) == len(rows)
    total = collections.Counter()
    for r in rows:
        total[r.source] += len(words(r.text))
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * total[s] + 1e-9}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2.0 * total[s] for s in over}
        left -= sum(2 * total[s] for s in over)
        free -= over
    source = {}
    for r in mixed:
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.target == pytest.approx(target[r.source])
        assert r.source_size == total[r.source]
        source[r.source] = source.get(r.source, 0) + r.taken
    block = max(1, int(1.5 * sum(total.values())) // mixing.BLOCKS)
    assert all(abs(taken - target[s]) <= 2 * block + 1 for s, taken in source.items())
    same([tuple(r) for r in mixed], [tuple(r) for r in mixing.mix_documents(docs.repartition(5)).collect()])
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    assert sum(len(words(r.text)) for r in texts.collect()) == sum(source.values())


def test_quotas_go_to_the_highest_quotients(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 500), ("c", 300)], "source string, source_size bigint")
    targets = mixing.source_targets(sizes).collect()
    seats = collections.Counter(r["rank"] for r in mixing.quotas(mixing.source_targets(sizes), blocks=100).collect())
    block = max(1, int(targets[0].total) // 100)
    tries = sorted((-r.target / (2 * j - 1), r["rank"], j) for r in targets for j in range(1, 2 * r.source_size // block + 1))
    house = sum(int(r.target / block + 0.5) for r in targets)
    assert seats == collections.Counter(t[1] for t in tries[:house])


def test_lm_scoring(docs, rows):
    train = [r for r in rows if crc(r.doc_id) % 7 != 2]
    found = lm_scoring.score(docs, *lm_scoring.learn(docs.where(language_id.split_remainder(7) != 2))).collect()
    tokens = [[*words(r.text, lower=True), "\n"] for r in rows]
    known = collections.Counter(t for r in train for t in [*words(r.text, lower=True), "\n"])
    total, distinct = sum(known.values()), len(known)
    expected = []
    for r, own in zip(rows, tokens, strict=True):
        base = sum(math.log10((known[t] + 1) / (total + distinct + 1)) for t in own)
        expected.append((str(r.doc_id), len(own), sum(known[t] > 0 for t in own), round(base, 4)))
    same([(str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in found], expected)
    assert all(r.train_tokens == total and math.isfinite(r.score) and r.score <= 0 for r in found)


def test_lm_beats_its_base_on_held_out_texts(spark):
    found = QUERIES["op9_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out")
    model, base = found.selectExpr("sum(score)", "sum(base_score)").first()
    assert model > base


def test_count_filter_never_underestimates():
    keys, counts = np.arange(2000, dtype=np.uint64), np.arange(1, 2001)
    own = lm_scoring.CountFilter.of(keys, own_levels := lm_scoring.CountFilter.level(counts))
    least = own.count(own_levels)
    assert (own.lookup(keys) >= least).all() and (least <= counts).all() and (3 * least >= 2 * counts).all()
    wrong = np.mean(own.lookup(np.arange(10**6, 2 * 10**6, dtype=np.uint64)) > 0)
    assert 0.5 * own.false_hits() < wrong < 2 * own.false_hits() < 0.004


def test_packing(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = collections.Counter()
    for r in rows:
        full = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        for start in range(0, len(full), packing.WINDOW):
            piece = np.array(full[start : start + packing.WINDOW], "<u4")
            ids[r.doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(full)] += 1
    found = packing.pack(docs, path).collect()
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == ids
    filled = collections.defaultdict(list)
    for r in found:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW


def test_best_fit_decreasing_takes_the_tightest_window():
    random.seed(1)
    for _ in range(30):
        lengths = sorted((random.randint(1, 64) for _ in range(200)), reverse=True)
        used = collections.Counter()
        for length, sequence in zip(lengths, packing.best_fit_decreasing(lengths, 64)[0], strict=True):
            used[sequence] += length
        rooms = []
        for length in lengths:
            fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
            at = min(fitting)[1] if fitting else len(rooms)
            rooms[at:at] = [] if fitting else [64]
            rooms[at] -= length
        assert sorted(64 - n for n in used.values()) == sorted(rooms)
