"""Token counts of pre-tokens that fill a whole text: equal to the library's, in time that grows with their length."""

import random
import time

import public_tokenizers
import pytest
from lendlake.llm import token_counts
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "aé日", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789", "=-_#", "theanding"]


@pytest.mark.parametrize("letters", ALPHABETS)
@pytest.mark.parametrize("size", [1, 2, 3, 1001, 6000])
def test_equal_to_the_library(letters, size):
    rng = random.Random(size)
    library, rules = Tokenizer.from_file(PATH), token_counts.merges(PATH)
    for _ in range(3 if size > 3 else 30):
        text = "".join(rng.choice(letters) for _ in range(size))
        tokens, extra = rules.split(text)
        found = extra + sum(rules.surviving_long(t.encode()) for t in tokens)
        assert found == len(library.encode(text, add_special_tokens=False).ids)


def test_a_megabyte_in_one_pre_token(spark):
    rng = random.Random(1)
    text = "".join(rng.choice(ALPHABETS[4]) for _ in range(1 << 20))
    start = time.monotonic()
    found = token_counts.merges(PATH).count([text])
    assert time.monotonic() - start < 20
    assert found == [len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)]
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id bigint, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}[1] == found[0]
